"""Small helpers shared by the corpus operators: column picking, shared scratch tables."""

from __future__ import annotations

import io
import os
import uuid
import zipfile
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pedalflow.session import ensure_checkpoint_dir

#: ASCII white space of the word definitions: space, \t, \n, \v, \f, \r.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns of ``df``, by exact name, the first where a name repeats.

    Other columns may be called anything (``Text`` beside ``text``, the name of
    a result column, twice the same name); they are left behind.
    """
    at = {}
    for i, c in enumerate(df.columns):
        at.setdefault(c, i)
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"c{at[n]}").alias(n) for n in names])


def let(value: Column, body) -> Column:
    """``body(v)`` with ``value`` computed once a row; a lambda variable is never inlined again."""
    return F.transform(F.array(value), body)[0]


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z; every other character stays as it is."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table_dir(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that the session names in ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder as Parquet and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = table_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """The working tables of one computation: one folder in the shared folder, removed as a whole."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.dir, self.tables = spark, table_dir(spark, name), 0

    def saved(self, df: DataFrame, name: str) -> DataFrame:
        self.tables += 1
        path = f"{self.dir}/{self.tables:03d}-{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.dir)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reachable(spark: SparkSession) -> None:
    """Lets Python workers import this package, besides any installed copy.

    Workers of this machine find it where the driver has it.  On a cluster it is also sent to
    them, as a zip file in the shared folder that its content names.
    """
    sc = spark.sparkContext
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = [p for p in sc.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        sc.environment["PYTHONPATH"] = os.pathsep.join([*paths, root])
    if sc.applicationId not in _SENT and not sc.master.startswith("local"):
        raw = package_zip(root)
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pedalflow-{zlib.crc32(raw):08x}.zip"
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
        if not fs.exists(target):
            out = fs.create(target)
            out.write(bytearray(raw))
            out.close()
        sc.addPyFile(path)
        _SENT.add(sc.applicationId)


#: Applications whose workers have the package.
_SENT: set[str] = set()


def package_zip(root: str) -> bytes:
    """The package's modules as a zip file, the same bytes for the same modules."""
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in sorted(os.walk(os.path.join(root, "pedalflow"))):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    with open(path, "rb") as f:
                        z.writestr(zipfile.ZipInfo(os.path.relpath(path, root)), f.read())
    return held.getvalue()


def map_arrow(df: DataFrame, run, schema: str) -> DataFrame:
    """``df.mapInArrow`` by a function of this package."""
    reachable(df.sparkSession)
    return df.mapInArrow(run, schema)
