"""Session settings, table loading and lineage cutting shared by all operators."""

from __future__ import annotations

import atexit
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where that costs one more shuffle behind the join
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # rows of a task stay few as the input grows: small files, and many small partitions that are joined where data are few
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "256",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}

_scratch: list[str] = []


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, from spark.checkpoint.dir; without it only a local master will do.

    A local master has one machine, so its warehouse folder is shared by all its threads.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} can reach")
    folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; what is written there goes when the session's Python ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if not _scratch:
        atexit.register(clear_scratch)
    _scratch.append(path)
    return path


def clear_scratch() -> None:
    """Delete the scratch tables of this session, if it still runs."""
    spark = SparkSession.getActiveSession()
    if spark is None or spark.sparkContext._jsc is None:
        return
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while _scratch:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch.pop())
        path.getFileSystem(conf).delete(path, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result survives the loss of executors."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a result once and read it back, for inputs that several actions share."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def load(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")
