"""Spark session settings the library relies on.

On a cluster the session is created by the platform; ``configure`` only sets
what is unset so cluster-level choices (shuffle partitions, checkpoint folder)
win. ``local_session`` is for tests and the bench.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the operators assume. Timestamps are naive (TIMESTAMP_NTZ) and
# calendar parts must not move with the JVM zone, so the session zone is UTC.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (set by the cluster). Only when it is
    unset and the master is local, as in tests, a scratch folder is created
    and registered; on a cluster an unset folder is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="shipwise-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def materialize(df):
    """Compute ``df`` once and cut its lineage.

    The rows are written as a parquet table into the cluster's shared
    checkpoint folder (``spark.checkpoint.dir``; never ``localCheckpoint`` and
    never a machine-local folder on a cluster) and read back. A lost executor
    then re-reads files instead of recomputing from the sources. Unlike
    ``checkpoint(eager=True)`` on an uncached plan, the input is computed once.
    """
    import uuid

    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    _MATERIALIZED.append(path)
    return spark.read.parquet(path)


_MATERIALIZED: list[str] = []


def discard(df) -> None:
    """Delete the files of a table that ``materialize`` wrote and that no later step reads."""
    spark = df.sparkSession
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def release_materialized(spark: SparkSession) -> int:
    """Delete the tables written by ``materialize`` in this driver process.

    Call it once the results that read them have been written out.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    removed = 0
    while _MATERIALIZED:
        path = jvm.org.apache.hadoop.fs.Path(_MATERIALIZED.pop())
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            fs.delete(path, True)
            removed += 1
    return removed


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "shipwise") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SHIPWISE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # tests / bench only: catalog tables go to a scratch warehouse, not the cwd
        .config("spark.sql.warehouse.dir", os.environ.get("SHIPWISE_WAREHOUSE", tempfile.mkdtemp(prefix="shipwise-wh-")))
    )
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    checkpoint_dir(spark)
    return spark
