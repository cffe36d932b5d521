"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
#: With this Spark deletes the shuffle files of a query when it ends; else they stay until the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``, else the folder that ``SparkContext.setCheckpointDir`` was given.

    Where neither is set, a temporary folder of our own, which only a master in this process can share;
    on any other master that is an error.
    """
    context = spark.sparkContext
    if named := spark.conf.get("spark.checkpoint.dir", None):
        return named.rstrip("/")
    given = context._jsc.sc().getCheckpointDir()
    if given.isDefined():
        return given.get().rstrip("/")
    if not context.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = context.applicationId
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return _own[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{folder(spark)}/mereflow-{name}-{uuid.uuid4().hex}"


def _delete(spark: SparkSession, path: str, at_exit: bool = False) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    disk = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if at_exit:
        disk.deleteOnExit(hadoop)
    else:
        disk.delete(hadoop, True)


def at_exit(spark: SparkSession, path: str) -> None:
    """Delete a folder when the driver's process ends."""
    _delete(spark, path, at_exit=True)


def save(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut and lost executors lose nothing.

    The table goes with the driver's process; :func:`drop` deletes it earlier. ``options`` are the writer's.
    """
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.options(compression="zstd", **options).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    _delete(spark, path, at_exit=True)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def drop(df: DataFrame) -> None:
    """Delete a table that :func:`save` wrote and nothing reads any more."""
    if path := getattr(df, "_scratch_path", None):
        _delete(df.sparkSession, path)
