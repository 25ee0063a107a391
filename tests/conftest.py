import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

FIXTURES = os.path.join(ROOT, "tests", "fixtures")
TRIP_FILES = [os.path.join(FIXTURES, "trips_2017.json"), os.path.join(FIXTURES, "trips_2018.json")]
STATION_CSV = os.path.join(FIXTURES, "stations.csv")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from pedalflow.session import DEFAULT_CONF, ensure_checkpoint_dir

    builder = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def data(spark):
    from pedalflow.plans.data import TripData

    return TripData.from_files(spark, TRIP_FILES, STATION_CSV)


@pytest.fixture(scope="session")
def data_exact(spark):
    from pedalflow.plans.data import TripData

    return TripData.from_files(spark, TRIP_FILES, STATION_CSV, match="exact")


def rows(df, *cols):
    """Sorted list of tuples of the given columns."""
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
