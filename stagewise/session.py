"""Session helper and lineage cutting.

The session is pinned to UTC so that timestamp arithmetic and formatting agree
with the SQL oracle; ANSI mode stays on (Spark 4 default), so every lenient
conversion in this package goes through ``try_*`` functions.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Semantics this package relies on (applied to every session it is given).
_SEMANTICS = {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true"}
# Performance defaults, applied only where the launch configuration is silent.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "stagewise", driver_memory: str | None = None) -> SparkSession:
    """Return (or create) a session configured for this package.

    On a cluster, master, resources and ``spark.sql.shuffle.partitions`` come
    from ``spark-submit`` and are left alone; only the semantics (UTC, ANSI)
    are pinned and AQE is switched on where the launch did not decide.
    ``shuffle_partitions`` (or STAGEWISE_SHUFFLE_PARTITIONS) sets the number of
    shuffle partitions; without it Spark's own setting stands."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if SparkSession.getActiveSession() is None:
        builder = (builder.config("spark.ui.enabled", "false")
                   .config("spark.ui.showConsoleProgress", "false"))
        if driver_memory:               # only meaningful before the JVM starts (local mode)
            builder = builder.config("spark.driver.memory", driver_memory)
    spark = builder.getOrCreate()
    launch = spark.sparkContext.getConf()
    for k, v in _SEMANTICS.items():
        spark.conf.set(k, v)
    for k, v in _DEFAULTS.items():
        if not launch.contains(k):
            spark.conf.set(k, v)
    if shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    elif env := os.environ.get("STAGEWISE_SHUFFLE_PARTITIONS"):
        spark.conf.set("spark.sql.shuffle.partitions", env)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where it is unset, a private folder is made in local mode only (tests); on
    a cluster that is an error, as executors would write to their own disks."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    d = tempfile.mkdtemp(prefix="stagewise-ckpt-")
    spark.conf.set("spark.checkpoint.dir", d)
    return d


def shared_path(spark: SparkSession, name: str) -> str:
    """An unused path in the shared folder, deleted when the session's JVM ends."""
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def materialize(df: DataFrame, name: str | None = None) -> DataFrame:
    """Cut lineage by writing ``df`` as parquet under the shared checkpoint dir
    and reading it back; survives executor loss (unlike caching)."""
    path = shared_path(df.sparkSession, name or "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
