"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: After A-Z are lower-cased: runs of digits, a-z and everything outside ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: What stands between words.
BETWEEN = WORD.replace("^", "")


#: A table of fewer bytes is dealt out to all cores, as its file may be one row group, which is one task.
SPREAD = 20_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(spark.sparkContext.defaultParallelism) if 1_000_000 < size < SPREAD else df


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; only where driver and executors are one process, one is made if the session names none."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        sc = spark.sparkContext
        if not sc.getCheckpointDir():
            if not re.match(r"local(\[|$)", sc.master):
                raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="strandweave-"))
        base = sc.getCheckpointDir()
    return base.rstrip("/")


@contextmanager
def _shuffles_end(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of each write in here go when it is done."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, old)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage of a large table by writing it to the shared folder; it goes when the session ends, and its shuffles when it is written."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with _shuffles_end(spark):
        df.write.parquet(path)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def cut(df: DataFrame) -> DataFrame:
    """The same for a small table; a checkpoint would work it out twice."""
    return stored(df, "cut")


def discard(df: DataFrame) -> None:
    """Deletes a stored table of which nothing more will be read."""
    spark = df.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(df._stored_at)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


#: Bytes that a table may have, as JSON, to be broadcast.
BROADCAST = 16_000_000


def small(df: DataFrame) -> DataFrame:
    """``df``, a table cut off from its lineage, for a broadcast if its measured size allows that, else as it is, for a shuffle."""
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct(*df.columns))))).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST else df


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else unchanged; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def words(text: Column) -> Column:
    """The runs of WORD; split at the rest, which is faster than to extract them."""
    return F.array_remove(F.split(ascii_lower(text), BETWEEN, -1), "")


def row_key(*columns: str) -> list[Column]:
    """What tells two rows of documents apart without their texts."""
    return [F.xxhash64(*columns).alias("row_hash"), F.length(columns[-1]).alias("row_chars")]
