"""The provided tables as sensor records, frames and vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros(ts: str | Column) -> Column:
    """Microseconds since 1970 of a time without a zone, whatever the session's zone is."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    days = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    seconds = (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("long")
    return days * 86_400_000_000 + F.hour(ts).cast("long") * 3_600_000_000 + F.minute(ts).cast("long") * 60_000_000 + seconds


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as sensor records: a session for each user, a stream for each type."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("session_id"),
        F.col("event_type").alias("stream"),
        (micros("ts") * 1000).alias("timestamp_ns"),
        F.concat_ws("/", "event_type", F.col("event_id").cast("string")).alias("path"),
        "event_id",
        "value",
        "props",
    )


#: The same in SQL.
REC = """rec AS (SELECT user_id AS session_id, event_type AS stream, epoch_us(ts) * 1000 AS timestamp_ns,
  event_type || '/' || event_id AS path, event_id, value, props FROM events)"""
