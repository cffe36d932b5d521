"""Helpers that several operators share."""

from __future__ import annotations

import re

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A-Z and a-z, for lower-casing of ASCII only.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_rows(spark: SparkSession, most: int = 256) -> None:
    """At most ``most`` rows and 16 MB per Arrow batch: texts can be long, and a task's memory is bounded by a batch."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= most:
        spark.conf.set(key, str(most))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16m")


def open_file(uri: str) -> pa.NativeFile:
    """A file of the shared folder, for tasks that read tables one file after the other."""
    disk, path = fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri))
    return disk.open_input_file(path)


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def id_fold(column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the text ``null``."""
    return F.crc32(F.encode(F.coalesce(F.col(column).cast("string"), F.lit("null")), "UTF-8")) % folds


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """Texts of a batch; null counts as empty."""
    return [x if x is not None else "" for x in batch.column(column).to_pylist()]


def join_hot(left: DataFrame, right: DataFrame, key: str, n: str) -> DataFrame:
    """Inner join of ``left`` with ``right``, whose ``key`` is unique and whose column ``n`` counts the left rows of each key.

    Keys that hold more than a quarter of a partition's fair share would weigh on one task; there are at most four per
    partition, so their right rows are broadcast, and only the other keys are shuffled. ``n`` is not returned.
    """
    spark = left.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    total = right.agg(F.sum(n)).first()[0] or 0
    most = max(64, total / (4 * parts))
    hot = [r[key] for r in right.where(F.col(n) > most).select(key).collect()]  # at most 4 x parts keys
    cold = left.join(right.drop(n), key)
    if not hot:
        return cold
    some = F.col(key).isin(hot)
    warm = left.where(some).join(F.broadcast(right.where(some).drop(n)), key)
    return left.where(~some).join(right.where(~some).drop(n), key).unionByName(warm)
