"""Session helpers: sane defaults for local runs and a shared checkpoint folder.

On a cluster the session is created by the platform; ``ensure_checkpoint_dir``
only fills in ``spark.checkpoint.dir`` when nobody has set it (tests, local
runs), and never overrides what the cluster names.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every study relies on.  AQE re-plans joins / partition counts from
# runtime statistics and splits skewed shuffle partitions (a hot station or
# zone may hold a third of all trips).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Checkpointed study aggregates (year pivots, zone cube) are deleted once unreferenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Those of them that an existing session takes (the batch job sets them on a cluster's session).
RUNTIME_CONF = {k: v for k, v in DEFAULT_CONF.items() if k.startswith("spark.sql.adaptive.")}


def local_session(
    cores: str = "*", shuffle_partitions: int = 8, app: str = "pedalflow", driver_memory: str = "8g"
) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", driver_memory)
    )
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a scratch one only when unset locally.

    The cluster names its shared folder in ``spark.checkpoint.dir``; that is
    always used as is.  A private scratch folder is only made when the master
    is ``local[...]`` (tests, single-machine runs); on a cluster a missing
    setting is an error rather than a machine-local folder executors cannot share.
    Under Spark Connect (no SparkContext on the client) the server's setting is used.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: checkpointing is configured on the server
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a folder shared by all executors")
    path = tempfile.mkdtemp(prefix="pedalflow-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path
