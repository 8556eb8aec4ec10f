"""Alignment queries over the provided tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandweave.functions import text
from strandweave.operators import align
from strandweave.plans.registry import query
from strandweave.sources.tables import REC, records, table

EXPECTED = ["click", "error", "purchase", "signup"]
TOLERANCE_NS = 6 * 3_600_000_000_000
#: Confidence from which on a sample is accepted without review.
ACCEPT = 0.85

_ALIGNED = f"""{REC},
a AS (SELECT session_id, timestamp_ns, path AS anchor_path, unnest(['click', 'error', 'purchase', 'signup']) AS stream FROM rec WHERE stream = 'view'),
near AS (
  SELECT a.*, r.path AS p, abs(r.timestamp_ns - a.timestamp_ns) AS delta,
    row_number() OVER (PARTITION BY a.session_id, a.anchor_path, a.stream
      ORDER BY abs(r.timestamp_ns - a.timestamp_ns), (r.timestamp_ns < a.timestamp_ns)::INT,
        CASE WHEN r.timestamp_ns >= a.timestamp_ns THEN r.path END, r.path DESC) AS n
  FROM a LEFT JOIN rec r ON r.session_id = a.session_id AND r.stream = a.stream
),
al AS (
  SELECT session_id, timestamp_ns, anchor_path, stream, CASE WHEN delta <= {TOLERANCE_NS} THEN p END AS path,
    CASE WHEN delta <= {TOLERANCE_NS} THEN round(delta / 1e6, 6) END AS delta_ms FROM near WHERE n = 1
)"""
_ID = "regexp_replace(session_id::VARCHAR, '[^0-9A-Za-z._-]', '_', 'g') || '-' || timestamp_ns || '-' || substr(sha1(session_id || ':' || timestamp_ns || ':' || anchor_path), 1, 10)"


def aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(records(spark, sf_dir).select("session_id", "stream", "timestamp_ns", "path"), "view", EXPECTED, TOLERANCE_NS)


@query(f"""WITH {_ALIGNED}
SELECT {_ID} AS sample_id, session_id, timestamp_ns,
  coalesce(string_agg(stream || '=' || path, ',' ORDER BY stream) FILTER (path IS NOT NULL), '') AS streams,
  coalesce(string_agg(stream, ',' ORDER BY stream) FILTER (path IS NULL), '') AS missing_streams,
  max(delta_ms) AS max_delta_ms
FROM al GROUP BY session_id, timestamp_ns, anchor_path""")
def asof_nearest_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = align.samples(aligned(spark, sf_dir))
    entries = F.map_entries("streams")
    return found.select(
        text.sample_id(F.col("session_id"), F.col("timestamp_ns"), F.col("anchor_path")).alias("sample_id"),
        "session_id",
        "timestamp_ns",
        F.array_join(F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"]["path"])), ",").alias("streams"),
        F.array_join("missing_streams", ",").alias("missing_streams"),
        F.array_max(F.transform(entries, lambda e: e["value"]["delta_ms"])).alias("max_delta_ms"),
    )


@query(f"""WITH {REC}
SELECT event_id, last_value(CASE WHEN stream = 'view' THEN value END IGNORE NULLS)
  OVER (PARTITION BY session_id ORDER BY timestamp_ns, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_view FROM rec""")
def asof_backward_ffill(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = records(spark, sf_dir)
    view = F.when(F.col("stream") == "view", F.col("value"))
    return rec.select("event_id", align.last_before(rec, view, ["session_id"], ["timestamp_ns", "event_id"]).alias("last_view"))


@query(f"""WITH {_ALIGNED}
SELECT stream, count(*) AS samples, count(path) AS matched, count(*) - count(path) AS missing, round(avg(delta_ms), 3) AS mean_delta_ms
FROM al GROUP BY stream""")
def align_missing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.count(F.lit(1))
    return aligned(spark, sf_dir).groupBy("stream").agg(
        n.alias("samples"), F.count("path").alias("matched"), (n - F.count("path")).alias("missing"), F.round(F.avg("delta_ms"), 3).alias("mean_delta_ms")
    )


_CONFIDENCE = f"""WITH {_ALIGNED},
m AS (
  SELECT al.*, (rec.props->>'$.k')::DOUBLE / 100 AS own, CASE WHEN rec.value > 50 THEN rec.stream END AS label
  FROM al LEFT JOIN rec ON rec.path = al.path
),
g AS (
  SELECT session_id, timestamp_ns, anchor_path, count(path) AS n, count(*) - count(path) AS missing, coalesce(max(delta_ms), 0) AS worst,
    max(least(1, greatest(0, own))) AS own, arg_min(label, stream) FILTER (label IS NOT NULL) AS label
  FROM m GROUP BY session_id, timestamp_ns, anchor_path
),
c AS (
  SELECT *, CASE WHEN n = 0 THEN 0.0 ELSE round(least(n / (n + missing), greatest(0, 1 - worst / 100),
    least(CASE WHEN label IS NOT NULL THEN 1.0 ELSE 0.5 END, coalesce(own, 1.0))), 4) END AS confidence FROM g
)"""


def matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aligned rows with the metadata's score and the label of the record they are matched with."""
    own = F.get_json_object("props", "$.k").try_cast("double") / 100
    meta = records(spark, sf_dir).select(
        F.col("path").alias("p"), own.alias("own"), F.when(F.col("value") > 50, F.col("stream")).alias("label")
    )
    return align.looked_up(aligned(spark, sf_dir), meta, "path", "p", "anchor_path")


def confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples with a label (of the first stream by name that has one) and a confidence.

    Confidence is the least of completeness, 1 less the largest offset in
    units of 100 ms, and the metadata's score.
    """
    n, missing = F.count("path"), F.count(F.lit(1)) - F.count("path")
    found = matched(spark, sf_dir).groupBy("session_id", "timestamp_ns", "anchor_path").agg(
        n.alias("n"),
        missing.alias("missing"),
        F.coalesce(F.max("delta_ms"), F.lit(0.0)).alias("worst"),
        F.max(F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("own")))).alias("own"),
        F.min_by("label", F.when(F.col("label").isNotNull(), F.col("stream"))).alias("label"),
    )
    score = F.least(F.when(F.col("label").isNotNull(), 1.0).otherwise(0.5), F.coalesce("own", F.lit(1.0)))
    least = F.least(F.col("n") / (F.col("n") + F.col("missing")), F.greatest(F.lit(0.0), 1 - F.col("worst") / 100), score)
    return found.withColumn("confidence", F.when(F.col("n") == 0, 0.0).otherwise(F.round(least, 4)))


@query(f"""{_CONFIDENCE}
SELECT session_id, timestamp_ns, coalesce(label, 'unlabeled') AS label, confidence::DOUBLE AS confidence,
  CASE WHEN confidence >= {ACCEPT} THEN 'accepted' ELSE 'review' END AS route,
  CASE WHEN confidence >= {ACCEPT} THEN NULL ELSE 'low_confidence' END AS review_reason
FROM c""")
def confidence_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted = F.col("confidence") >= ACCEPT
    return confidence(spark, sf_dir).select(
        "session_id",
        "timestamp_ns",
        F.coalesce("label", F.lit("unlabeled")).alias("label"),
        "confidence",
        F.when(accepted, "accepted").otherwise("review").alias("route"),
        F.when(~accepted, "low_confidence").alias("review_reason"),
    )


@query(f"""{_CONFIDENCE}
SELECT coalesce(label, 'unlabeled') AS label, count(*) AS samples FROM c GROUP BY 1""")
def label_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confidence(spark, sf_dir).groupBy(F.coalesce("label", F.lit("unlabeled")).alias("label")).agg(F.count(F.lit(1)).alias("samples"))


@query("""SELECT event_id, regexp_replace(regexp_replace('s ' || user_id || '/' || event_type || '.', '[^0-9A-Za-z._-]', '_', 'g'), '^[._]+|[._]+$', '', 'g') AS safe,
  user_id || '-' || (epoch_us(ts) * 1000) || '-' || substr(sha1(user_id || ':' || (epoch_us(ts) * 1000) || ':' || event_type || '/' || event_id), 1, 10) AS sample_id FROM events""")
def stable_sample_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.lit("s "), F.col("session_id").cast("string"), F.lit("/"), F.col("stream"), F.lit("."))
    return records(spark, sf_dir).select(
        "event_id", text.safe_name(raw).alias("safe"), text.sample_id(F.col("session_id"), F.col("timestamp_ns"), F.col("path")).alias("sample_id")
    )


@query("""WITH n AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) - 1 AS position FROM events),
v AS (SELECT * FROM n WHERE event_type = 'view'), c AS (SELECT * FROM n WHERE event_type = 'click')
SELECT v.user_id, v.position, v.event_id AS view_id, c.event_id AS click_id, round((epoch_us(c.ts) - epoch_us(v.ts)) / 1000.0, 3) AS offset_ms
FROM v LEFT JOIN c USING (user_id, position)""")
def positional_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = records(spark, sf_dir)
    side = lambda s, n: rec.where(F.col("stream") == s).select(F.col("session_id").alias("user_id"), F.col("timestamp_ns").alias(f"{n}_t"), F.col("event_id").alias(f"{n}_id"))
    left = side("view", "view").withColumn("position", F.row_number().over(Window.partitionBy("user_id").orderBy("view_t", "view_id")) - 1)
    right = side("click", "click").withColumn("position", F.row_number().over(Window.partitionBy("user_id").orderBy("click_t", "click_id")) - 1)
    return left.join(right, ["user_id", "position"], "left").select(
        "user_id", F.col("position").cast("long").alias("position"), "view_id", "click_id", F.round((F.col("click_t") - F.col("view_t")) / 1e6, 3).alias("offset_ms")
    )


@query("""WITH k AS (SELECT user_id, printf('%.6f', epoch_us(ts) / 1000000.0) AS key, value FROM events WHERE event_type = 'click')
SELECT e.event_id, printf('%.6f', epoch_us(ts) / 1000000.0) AS key, coalesce('entry', '') AS source, k.value AS value
FROM events e JOIN k ON k.user_id = e.user_id AND k.key = printf('%.6f', epoch_us(e.ts) / 1000000.0)
UNION ALL SELECT e.event_id, printf('%.6f', epoch_us(ts) / 1000000.0), 'no_entry', NULL
FROM events e ANTI JOIN k ON k.user_id = e.user_id AND k.key = printf('%.6f', epoch_us(e.ts) / 1000000.0)""")
def formatted_key_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = records(spark, sf_dir).withColumn("key", F.format_string("%.6f", F.expr("timestamp_ns div 1000") / 1e6))
    entries = rec.where("stream = 'click'").select("session_id", "key", F.col("value").alias("entry"))
    return rec.join(entries, ["session_id", "key"], "left").select(
        "event_id", "key", F.when(F.col("entry").isNull(), "no_entry").otherwise("entry").alias("source"), F.col("entry").alias("value")
    )


_HALF = 6 * 3_600_000_000


@query(f"""WITH f AS (SELECT user_id, epoch_us(ts) AS t FROM events WHERE event_type = 'view'),
s AS (SELECT user_id, epoch_us(ts) AS st, value, event_id FROM events WHERE event_type = 'click'),
b AS (SELECT f.user_id, t, avg(value) FILTER (st >= t - {_HALF} AND st < t + {_HALF}) AS mean,
    count(value) FILTER (st >= t - {_HALF} AND st < t + {_HALF}) AS n,
    arg_min(value, (abs(st - t), (st < t)::INT)) AS near FROM f LEFT JOIN s USING (user_id) GROUP BY f.user_id, t)
SELECT user_id, t, round(coalesce(mean, near, 0.0), 6) AS value, n FROM b""")
def bin_mean_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = records(spark, sf_dir).select(F.col("session_id").alias("user_id"), "stream", F.expr("timestamp_ns div 1000").alias("t"), "value", F.col("event_id").alias("sample_id"))
    found = align.bin_mean(rec.where("stream = 'view'"), rec.where("stream = 'click'"), "user_id", _HALF)
    return found.withColumn("value", F.round("value", 6))


_CLIPS = """clips AS (SELECT user_id, k, t0 + k * 259200000000 AS start, t0 + k * 259200000000 + 345600000000 AS "end"
  FROM (SELECT user_id, min(epoch_us(ts)) AS t0, max(epoch_us(ts)) AS t1 FROM events GROUP BY user_id), range(0, 10) r(k) WHERE t0 + k * 259200000000 <= t1)"""
_DAY4 = 345_600_000_000


def clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips of four days, a new one every three, over each user's events."""
    t = F.expr("timestamp_ns div 1000")
    spans = records(spark, sf_dir).groupBy(F.col("session_id").alias("user_id")).agg(F.min(t).alias("t0"), F.max(t).alias("t1"))
    start = F.col("t0") + F.col("k") * F.lit(259_200_000_000)
    return (
        spans.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(t1 - t0) div 259200000000"))))
        .select("user_id", "k", start.alias("start"), (start + _DAY4).alias("end"))
    )


@query(f"""WITH {_CLIPS},
l AS (SELECT user_id, event_id, epoch_us(ts) AS s, epoch_us(ts) + 86400000000 AS e FROM events WHERE event_type = 'error')
SELECT l.user_id, event_id, k, greatest(s, start) AS cut_start, least(e, "end") AS cut_end
FROM l JOIN clips ON l.user_id = clips.user_id AND e > start AND s < "end" """)
def interval_overlap_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.expr("timestamp_ns div 1000")
    labels = records(spark, sf_dir).where("stream = 'error'").select(F.col("session_id").alias("user_id"), "event_id", t.alias("s"), (t + F.lit(86_400_000_000)).alias("e"))
    return align.overlaps(labels, clips(spark, sf_dir), ["user_id"], _DAY4).select("user_id", "event_id", "k", "cut_start", "cut_end")


@query(f"""WITH {_CLIPS},
f AS (SELECT user_id, epoch_us(ts) AS t, value, event_type != 'error' AS visible FROM events),
p AS (SELECT user_id, quantile_cont(value, 0.9) AS p90 FROM f GROUP BY user_id)
SELECT clips.user_id, k, count(t) AS frames, round(CASE WHEN count(t) = 0 THEN 0.0 ELSE
  avg(visible::INT) * coalesce(avg(value) / 100, 1) * CASE WHEN max(p90) <= 1e-9 THEN 1.0 ELSE least(1, greatest(0, avg(value) / max(p90))) END END, 4) AS reliability
FROM clips JOIN p USING (user_id) LEFT JOIN f ON f.user_id = clips.user_id AND t >= start AND t < "end" GROUP BY clips.user_id, k""")
def interval_clip_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = records(spark, sf_dir).select(F.col("session_id").alias("user_id"), F.expr("timestamp_ns div 1000").alias("t"), "value", (F.col("stream") != "error").cast("int").alias("visible"))
    p90 = frames.groupBy("user_id").agg(F.percentile("value", F.lit(0.9)).alias("p90"))
    all_clips = clips(spark, sf_dir)
    inside = align.in_intervals(frames, all_clips, ["user_id"], "t", "start", "end", _DAY4)
    stats = inside.groupBy("user_id", "k").agg(F.count("t").alias("frames"), F.avg("visible").alias("coverage"), F.avg("value").alias("mean"))
    saliency = F.when(F.col("p90") <= 1e-9, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("mean") / F.col("p90"))))
    score = F.col("coverage") * F.coalesce(F.col("mean") / 100, F.lit(1.0)) * saliency
    return all_clips.join(stats, ["user_id", "k"], "left").join(p90, "user_id").select(
        "user_id", "k", F.coalesce("frames", F.lit(0)).alias("frames"), F.round(F.coalesce(score, F.lit(0.0)), 4).alias("reliability")
    )


@query("""WITH b AS (SELECT user_id, min(epoch_us(ts)) FILTER (event_type = 'view') AS t0, max(epoch_us(ts)) FILTER (event_type = 'view') + 3600000000 AS t1 FROM events GROUP BY user_id)
SELECT user_id, count(*) FILTER (epoch_us(ts) >= t0 AND epoch_us(ts) < t1) AS kept,
  count(*) - count(*) FILTER (epoch_us(ts) >= t0 AND epoch_us(ts) < t1) AS dropped FROM events JOIN b USING (user_id) GROUP BY user_id""")
def interval_crop(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.expr("timestamp_ns div 1000")
    rec = records(spark, sf_dir).select(F.col("session_id").alias("user_id"), t.alias("t"), "stream")
    view = F.when(F.col("stream") == "view", F.col("t"))
    w = Window.partitionBy("user_id")
    inside = F.coalesce((F.col("t") >= F.col("t0")) & (F.col("t") < F.col("t1") + F.lit(3_600_000_000)), F.lit(False))
    return (
        rec.select("user_id", "t", F.min(view).over(w).alias("t0"), F.max(view).over(w).alias("t1"))
        .groupBy("user_id")
        .agg(F.count_if(inside).alias("kept"), F.count_if(~inside).alias("dropped"))
    )


@query("""SELECT o_orderkey, l_partkey, l_suppkey, l_linenumber, row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) - 1 AS frame,
  o_orderdate <= l_shipdate AS inside FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def episode_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("o_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    return table(spark, sf_dir, "orders").join(table(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey")).select(
        "o_orderkey", "l_partkey", "l_suppkey", "l_linenumber", (F.row_number().over(w) - 1).cast("long").alias("frame"), (F.col("o_orderdate") <= F.col("l_shipdate")).alias("inside")
    )


@query("""SELECT conv_id, turn, CASE role WHEN 'user' THEN 0 WHEN 'assistant' THEN 1 ELSE 2 END AS main_type,
  coalesce(nullif(CASE WHEN quality = 1 THEN 'clip ' || conv_id ELSE '' END, ''), role) AS task, coalesce(toxic, 0)::INTEGER AS score
FROM conversations LEFT JOIN labels ON conv_id = doc_id""")
def episode_text_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = F.when(F.col("quality") == 1, F.concat(F.lit("clip "), F.col("conv_id").cast("string")))
    return table(spark, sf_dir, "conversations").join(table(spark, sf_dir, "labels"), F.col("conv_id") == F.col("doc_id"), "left").select(
        "conv_id", "turn", F.when(F.col("role") == "user", 0).when(F.col("role") == "assistant", 1).otherwise(2).alias("main_type"), F.coalesce(own, "role").alias("task"), F.coalesce("toxic", F.lit(0)).alias("score")
    )


@query("""SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, CASE WHEN l.doc_id IS NULL THEN 'missing' WHEN d.doc_id IS NULL THEN 'extra' ELSE 'matched' END AS state
FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id""")
def manifest_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    declared = table(spark, sf_dir, "documents").select("doc_id", F.lit(True).alias("declared"))
    there = table(spark, sf_dir, "labels").select("doc_id", F.lit(True).alias("there"))
    state = F.when(F.col("there").isNull(), "missing").when(F.col("declared").isNull(), "extra").otherwise("matched")
    return declared.join(there, "doc_id", "full").select("doc_id", state.alias("state"))


_DIGEST = "sha256('model|prompt|' || array_to_string(list_sort([sha256(coalesce(text, '')), sha256(lang)]), ','))"


def keyed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the key under which a response to them is kept; parts are sorted, so their order is no matter."""
    parts = F.array_sort(F.array(F.sha2(F.coalesce("text", F.lit("")), 256), F.sha2("lang", 256)))
    return table(spark, sf_dir, "documents").withColumn("key", F.sha2(F.concat(F.lit("model|prompt|"), F.array_join(parts, ",")), 256))


@query(f"""WITH k AS (SELECT doc_id, {_DIGEST} AS key FROM documents)
SELECT min(doc_id) AS doc_id, key FROM k ANTI JOIN (SELECT key FROM k JOIN labels USING (doc_id)) c USING (key) GROUP BY key""")
def cache_miss_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = keyed_documents(spark, sf_dir).select("doc_id", "key")
    kept = keyed.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id").select("key")
    return keyed.join(kept, "key", "left_anti").groupBy("key").agg(F.min("doc_id").alias("doc_id"))


@query(f"""WITH k AS (SELECT doc_id, {_DIGEST} AS key, row_number() OVER (PARTITION BY {_DIGEST} ORDER BY doc_id DESC) AS n FROM documents)
SELECT count(*) AS calls, count(*) FILTER (n = 1) AS rows, round(1 - count(*) FILTER (n = 1) / count(*), 6) AS hit_rate, max(doc_id) FILTER (n = 1) AS latest FROM k""")
def cache_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_key = keyed_documents(spark, sf_dir).groupBy("key").agg(F.count(F.lit(1)).alias("calls"), F.max("doc_id").alias("latest"))
    rows = F.count(F.lit(1))
    return by_key.agg(F.sum("calls").alias("calls"), rows.alias("rows"), F.round(1 - rows / F.sum("calls"), 6).alias("hit_rate"), F.max("latest").alias("latest"))


@query("""SELECT conv_id, CASE WHEN max(l.doc_id) IS NOT NULL THEN 'done' WHEN count(*) < 3 THEN 'single' ELSE 'run' END AS plan, count(*) AS turns
FROM conversations LEFT JOIN labels l ON conv_id = l.doc_id GROUP BY conv_id""")
def session_resume_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    sessions = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"))
    done = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("done")).distinct()
    plan = F.when(F.col("done").isNotNull(), "done").when(F.col("turns") < 3, "single").otherwise("run")
    return sessions.join(done, F.col("conv_id") == F.col("done"), "left").select("conv_id", plan.alias("plan"), "turns")
