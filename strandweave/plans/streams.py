"""Streaming queries: the events' file as a stream, run to its end, against the same in SQL."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandweave.plans.registry import query
from strandweave.sources.tables import micros
from strandweave.streaming import flows


def shared_folder(spark: SparkSession) -> str:
    """A new folder that all executors share: under spark.checkpoint.dir; only in one process a temporary one where the session names none."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    base = base or tempfile.mkdtemp(prefix="strandweave-")
    return f"{base.rstrip('/')}/stream-{uuid.uuid4().hex}"


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events*.parquet").parquet(sf_dir)
    return stream.withColumn("ts", F.timestamp_micros(micros("ts")))


@query("""SELECT epoch_us(time_bucket(INTERVAL '4 hours', ts)) // 1000000 AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2""")
def stream_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = flows.windows(events_stream(spark, sf_dir), "ts", "4 hours")
    rows = flows.collected(spark, found, shared_folder(spark), "complete")
    return rows.select(F.unix_seconds("w.start").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@query("""WITH g AS (SELECT user_id, ts, value, (ts - lag(ts) OVER w > INTERVAL '6 hours')::INT AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, sum(coalesce(new, 1)) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT user_id, epoch_us(min(ts)) // 1000000 AS start, count(*) AS n, round(sum(value), 4) AS total FROM s GROUP BY user_id, k""")
def stream_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = flows.sessions(events_stream(spark, sf_dir), "ts", "6 hours", "user_id")
    rows = flows.collected(spark, found, shared_folder(spark), "complete")
    return rows.select("user_id", F.unix_seconds("w.start").alias("start"), "n", F.round("total", 4).alias("total"))


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = flows.distinct(events_stream(spark, sf_dir).select("ts", "user_id", "event_type"), "ts", ["user_id", "event_type"], "60 days")
    return flows.collected(spark, found, shared_folder(spark)).select("user_id", "event_type")


@query("""SELECT v.event_id AS view_id, c.event_id AS click_id, abs(epoch_us(c.ts) - epoch_us(v.ts)) // 1000000 AS offset_s FROM events v JOIN events c ON v.user_id = c.user_id AND v.event_type = 'view' AND c.event_type = 'click' AND abs(epoch_us(c.ts) - epoch_us(v.ts)) <= 21600000000""")
def stream_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    side = lambda kind, n: events_stream(spark, sf_dir).where(F.col("event_type") == kind).select(F.col("ts").alias(f"{n}_ts"), F.col("user_id").alias(f"{n}_user"), F.col("event_id").alias(f"{n}_id"))
    within = (F.col("click_ts") >= F.col("view_ts") - F.expr("interval 6 hours")) & (F.col("click_ts") <= F.col("view_ts") + F.expr("interval 6 hours"))
    pairs = flows.aligned(side("view", "view"), side("click", "click"), F.col("view_user") == F.col("click_user"), within, ("view_ts", "click_ts"), "6 hours")
    rows = flows.collected(spark, pairs, shared_folder(spark))
    return rows.select("view_id", "click_id", F.expr("abs(unix_micros(click_ts) - unix_micros(view_ts)) div 1000000").alias("offset_s"))


@query("""WITH RECURSIVE e AS (SELECT user_id, ts, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, value) AS i FROM events),
f AS (SELECT user_id, ts, value, i, value AS y FROM e WHERE i = 1 UNION ALL SELECT e.user_id, e.ts, e.value, e.i, 0.5 * e.value + 0.5 * f.y FROM f JOIN e ON e.user_id = f.user_id AND e.i = f.i + 1)
SELECT user_id, epoch_us(ts) AS t, value, round(y + 1e-8, 6) AS smooth FROM f""")
def stream_filter_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = flows.low_pass(events_stream(spark, sf_dir).select("user_id", "ts", "value"), "user_id", "ts", "value")
    rows = flows.collected(spark, found, shared_folder(spark))
    return rows.select("user_id", F.unix_micros("ts").alias("t"), "value", F.round(F.col("smooth") + 1e-8, 6).alias("smooth"))


@query("SELECT event_type, count(*) AS n, round(avg(value), 4) AS mean FROM events GROUP BY event_type")
def stream_append_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches appended to an index by number, so that a batch that is run again replaces itself."""
    rows = flows.collected(spark, events_stream(spark, sf_dir).select("event_type", "value"), shared_folder(spark))
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 4).alias("mean"))


@query("""SELECT conv_id AS epoch, turn AS step, length(text) / 1000.0 AS loss FROM conversations""")
def stream_log_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training-log lines, read as a stream of text, and their numbers by pattern."""
    folder = shared_folder(spark)
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows.select(F.format_string("epoch %d step %d loss %.3f", "conv_id", "turn", F.length("text") / 1000.0)).write.text(f"{folder}/logs")
    pattern = r"epoch (\d+) step (\d+) loss ([0-9.]+)"
    field = lambda i, kind, name: F.regexp_extract("value", pattern, i).cast(kind).alias(name)
    parsed = spark.readStream.text(f"{folder}/logs").where(F.col("value").rlike(pattern)).select(field(1, "long", "epoch"), field(2, "long", "step"), field(3, "double", "loss"))
    return flows.collected(spark, parsed, folder)
