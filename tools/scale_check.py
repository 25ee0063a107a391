"""Scale rehearsal: time studies on trip tables derived from sf0.1 at growing size.

usage: python tools/scale_check.py <scratch_dir> [factor ...]

For each factor N, lineitem is replicated N times by Spark (``explode`` of copy
numbers, order keys shifted so copies stay distinct), written with 64 files
under <scratch_dir>, and the small tables are linked next to it.  A skewed
variant moves a third of the trips to start station 0.  Prints one line per
(variant, study) with wall seconds; nothing here is registered as a query.
"""

from __future__ import annotations

import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from pedalflow.plans import calendar_studies as cal  # noqa: E402
from pedalflow.plans import flows, zone_stats  # noqa: E402
from pedalflow.plans.data import TripData  # noqa: E402
from pedalflow.session import local_session  # noqa: E402

SRC = "/root/testdata/sf0.1"
STUDIES = {
    "zone_stats": lambda d: zone_stats.zone_stats(d, "all"),
    "zone_stats_season": lambda d: zone_stats.zone_stats(d, "season"),
    "zone_balance": flows.zone_balance,
    "trips_by_week_year": cal.trips_by_week_year,
    "od_weekday_top": lambda d: flows.od_weekday_top(d, 10),
}


def build(spark, out: str, factor: int, skew: bool) -> None:
    li = spark.read.parquet(f"{SRC}/lineitem.parquet")
    top = li.agg(F.max("l_orderkey")).first()[0] + 1
    copies = F.explode(F.array(*[F.lit(i) for i in range(factor)])).alias("copy")
    big = li.select("*", copies).withColumn("l_orderkey", F.col("l_orderkey") + F.col("copy") * top).drop("copy")
    if skew:
        big = big.withColumn("l_suppkey", F.when(F.col("l_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("l_suppkey")))
    os.makedirs(out, exist_ok=True)
    big.repartition(64).write.mode("overwrite").parquet(f"{out}/lineitem.parquet")
    for t in ("supplier", "nation", "region", "part", "events"):
        link = f"{out}/{t}.parquet"
        if not os.path.exists(link):
            os.symlink(f"{SRC}/{t}.parquet", link)


def main() -> None:
    scratch = sys.argv[1]
    factors = [int(x) for x in sys.argv[2:]] or [1, 10]
    spark = local_session(cores="8", shuffle_partitions=64)
    for factor in factors:
        for skew in (False, True):
            name = f"x{factor}{'-skew' if skew else ''}"
            path = os.path.join(scratch, name)
            build(spark, path, factor, skew)
            data = TripData.from_proxy(spark, path)
            n = data.trips.count()
            for study, fn in STUDIES.items():
                fn(data).write.format("noop").mode("overwrite").save()  # warm
                t0 = time.perf_counter()
                fn(data).write.format("noop").mode("overwrite").save()
                print(f"{name}\trows={n}\t{study}\t{time.perf_counter() - t0:.2f}s", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
