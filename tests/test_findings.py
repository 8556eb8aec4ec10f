"""Queries on inputs that the given tables lack, against their SQL."""

import duckdb
import pytest
from oracle import connected, same
from pyspark.sql import functions as F

from strandweave.plans import ORACLE, QUERIES, alignment


@pytest.fixture
def made(tmp_path):
    """Writes an events table from SQL over the smallest one; gives its folder."""

    def make(sql):
        duckdb.sql(f"COPY (SELECT event_id, ts, user_id, event_type, value, props FROM ({sql.format(events="'/root/testdata/sf0.001/events.parquet'")})) TO '{tmp_path}/events.parquet'")
        return str(tmp_path)

    return make


#: First values of 0, -0 and others, last ones of 0, negative and others; some users have one event.
ZEROS = """SELECT * REPLACE (CASE WHEN n = 1 AND user_id % 3 = 0 THEN 0.0 WHEN n = 1 AND user_id % 3 = 1 THEN '-0.0'::DOUBLE WHEN n = m AND user_id % 4 = 0 THEN 0.0 WHEN n = m AND user_id % 4 = 1 THEN -3.5 ELSE value END AS value)
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n, count(*) OVER (PARTITION BY user_id) AS m FROM {events}) WHERE n = 1 OR user_id % 5 != 0"""


@pytest.mark.parametrize("name", ["loss_diagnosis", "ingest_summary"])
def test_division_by_zero(spark, made, name):
    folder = made(ZEROS)
    same(connected(folder), QUERIES[name](spark, folder), ORACLE[name])


def test_low_pass_over_cut_frames(spark, made):
    """A user's rows come in no order and in several Arrow batches."""
    folder = made("SELECT * FROM {events} ORDER BY hash(event_id)")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        same(connected(folder), QUERIES["stream_filter_state"](spark, folder), ORACLE["stream_filter_state"])
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_rows_without_a_match_are_dealt_out(spark):
    """Most aligned rows have no path; joined by it alone they would make up one partition."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        rows = alignment.matched(spark, "/root/testdata/sf0.001").withColumn("at", F.spark_partition_id())
        sizes = [r["count"] for r in rows.groupBy("at").count().collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(sizes) == 8 and max(sizes) < 2 * sum(sizes) / 8
