"""Aggregates, quality reports and rules over the provided tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandweave.operators import ingest, stats
from strandweave.operators.segment import ordered
from strandweave.plans.registry import query
from strandweave.plans.sequences import BY, EV, ORDER, events
from strandweave.sources.tables import table

_VECTOR = """SELECT {by} i - 1 AS dim, round(avg(x), 5) AS mean, round(stddev_pop(x), 5) AS std, round(min(x), 5) AS min, round(max(x), 5) AS max, count(x) AS n
FROM (SELECT label, unnest(embedding)::DOUBLE AS x, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings) {where} GROUP BY {by} i"""


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 5).alias(c) if c in ("mean", "std", "min", "max") else F.col(c) for c in df.columns]).withColumn("dim", F.col("dim").cast("long"))


@query(_VECTOR.format(by="", where=""))
def vector_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(stats.vector_stats(table(spark, sf_dir, "embeddings"), "embedding"))


@query(_VECTOR.format(by="label,", where=""))
def stats_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics by group from merged partial ones: halves of the table are summed apart and then together."""
    rows = table(spark, sf_dir, "embeddings").select("label", "vec_id", F.posexplode("embedding").alias("dim", "x"))
    x = F.col("x").cast("double")
    parts = rows.groupBy("label", "dim", (F.col("vec_id") % 2).alias("half")).agg(F.count("x").alias("n"), F.avg(x).alias("m"), F.var_pop(x).alias("v"), F.min(x).alias("lo"), F.max(x).alias("hi"))
    n, total = F.sum("n"), F.sum(F.col("n") * F.col("m"))
    second = F.sum(F.col("n") * (F.col("v") + F.col("m") * F.col("m")))
    merged = parts.groupBy("label", "dim").agg((total / n).alias("mean"), F.sqrt(second / n - (total / n) * (total / n)).alias("std"), F.min("lo").alias("min"), F.max("hi").alias("max"), n.alias("n"))
    return _rounded(merged)


@query("""WITH c AS (SELECT user_id, event_type, count(*) AS c FROM events GROUP BY user_id, event_type), n AS (SELECT user_id, sum(c) AS n FROM c GROUP BY user_id)
SELECT user_id, round(-sum(c / n * log2(c / n)), 4) AS entropy, max(n)::BIGINT AS n, count(*) AS distinct FROM c JOIN n USING (user_id) GROUP BY user_id""")
def entropy_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.entropy(table(spark, sf_dir, "events"), F.col("event_type"), ["user_id"])


_SOURCE = """s AS (SELECT source, count(*) AS episodes, sum(n_chars)::BIGINT AS bytes, count(DISTINCT text) AS tasks, avg(quality)::DOUBLE AS quality, avg(toxic)::DOUBLE AS toxic, count(quality) AS labelled
  FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source)"""


def by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars", F.sha2("text", 256).alias("digest"))
    return docs.join(table(spark, sf_dir, "labels"), "doc_id", "left").groupBy("source").agg(
        F.count(F.lit(1)).alias("episodes"), F.sum("n_chars").alias("bytes"), F.count_distinct("digest").alias("tasks"), F.avg("quality").alias("quality"), F.avg("toxic").alias("toxic"), F.count("quality").alias("labelled")
    )


@query(f"""WITH {_SOURCE} SELECT count(*) AS sessions, sum(bytes)::BIGINT AS bytes, round(sum(bytes) / 1e6, 2) AS mb, round(quantile_cont(quality, 0.05), 3) AS p5, round(quantile_cont(quality, 0.95), 3) AS p95,
  round(count(*) FILTER (quality >= 0.5) / count(*), 4) AS pass_rate, round(100 * max(episodes) / sum(episodes), 2) AS dominant_pct FROM s""")
def quality_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.percentile("quality", F.array(F.lit(0.05), F.lit(0.95)))
    n = F.count(F.lit(1))
    return by_source(spark, sf_dir).agg(
        n.alias("sessions"), F.sum("bytes").alias("bytes"), F.round(F.sum("bytes") / 1e6, 2).alias("mb"), F.round(at[0], 3).alias("p5"), F.round(at[1], 3).alias("p95"),
        F.round(F.count_if(F.col("quality") >= 0.5) / n, 4).alias("pass_rate"), F.round(100 * F.max("episodes") / F.sum("episodes"), 2).alias("dominant_pct"),
    )


@query(f"""WITH {_SOURCE}, l AS (SELECT source, lang, count(*) AS c FROM documents GROUP BY source, lang), n AS (SELECT source, sum(c) AS n FROM l GROUP BY source),
e AS (SELECT source, round(-sum(c / n * log2(c / n)), 4) AS entropy, string_agg(lang || '=' || c, ',' ORDER BY c DESC, lang) AS langs FROM l JOIN n USING (source) GROUP BY source)
SELECT source, episodes, bytes, tasks, round(1 - tasks / episodes, 4) AS dedupe_ratio, round(quality, 4) AS quality, round(toxic, 4) AS toxic, labelled, entropy, langs FROM s JOIN e USING (source)""")
def session_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("source", "lang")
    counts = docs.groupBy("source", "lang").agg(F.count(F.lit(1)).alias("c"))
    listed = F.array_sort(F.collect_list(F.struct((-F.col("c")).alias("k"), "lang")))
    langs = counts.groupBy("source").agg(F.array_join(F.transform(listed, lambda x: F.concat(x["lang"], F.lit("="), (-x["k"]).cast("string"))), ",").alias("langs"))
    bits = stats.entropy(docs, F.col("lang"), ["source"]).select("source", "entropy")
    return by_source(spark, sf_dir).join(bits, "source").join(langs, "source").select(
        "source", "episodes", "bytes", "tasks", F.round(1 - F.col("tasks") / F.col("episodes"), 4).alias("dedupe_ratio"), F.round("quality", 4).alias("quality"), F.round("toxic", 4).alias("toxic"), "labelled", "entropy", "langs"
    )


@query(f"""WITH {EV}, o AS (SELECT user_id, t - lag(t) OVER (PARTITION BY user_id ORDER BY position) AS d FROM ev)
SELECT user_id, round(avg(d) / 1000, 3) AS mean_ms, round(max(abs(d)) / 1000, 3) AS max_ms, round(median(d) / 1000, 3) AS median_ms FROM o GROUP BY user_id""")
def offset_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("user_id", (F.col("t") - F.lag("t").over(ordered(BY, ORDER))).alias("d"))
    return rows.groupBy("user_id").agg(F.round(F.avg("d") / 1000, 3).alias("mean_ms"), F.round(F.max(F.abs("d")) / 1000, 3).alias("max_ms"), F.round(F.median("d") / 1000, 3).alias("median_ms"))


@query(f"""WITH {EV} SELECT user_id, count(*) AS frames, round((count(*) - 1) / ((max(t) - min(t)) / 1e6), 9) AS rate, round((max(t) - min(t)) / 1e6 + 1 / 30.0, 4) AS duration_s,
  count(*) FILTER (event_type = 'error') AS excluded, count(*) FILTER (event_type IN ('click', 'view')) AS active, min(position) FILTER (event_type = 'purchase') AS first_purchase, max(position) FILTER (event_type = 'purchase') AS last_purchase
FROM ev GROUP BY user_id""")
def ingest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).withColumn("position", (F.row_number().over(ordered(BY, ORDER)) - 1).cast("long"))
    span = (F.max("t") - F.min("t")) / 1e6
    bought = F.when(F.col("event_type") == "purchase", F.col("position"))
    return rows.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("frames"), F.round(stats.quotient(F.count(F.lit(1)) - 1, span), 9).alias("rate"), F.round(span + 1 / 30, 4).alias("duration_s"), F.count_if(F.col("event_type") == "error").alias("excluded"),
        F.count_if(F.col("event_type").isin("click", "view")).alias("active"), F.min(bought).alias("first_purchase"), F.max(bought).alias("last_purchase"),
    )


@query(f"""WITH {EV}, h AS (SELECT *, last_value(CASE WHEN position % 5 = 0 THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY position ROWS UNBOUNDED PRECEDING) AS held FROM ev)
SELECT event_id, round((least(1, held / 60) + greatest(0, 1 - abs(held - 128) / 80)) / 2, 8) AS overall, (least(1, held / 60) + greatest(0, 1 - abs(held - 128) / 80)) / 2 >= 0.4 AND event_type != 'error' AS kept FROM h""")
def frame_quality_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = ordered(BY, ORDER)
    rows = events(spark, sf_dir).withColumn("position", F.row_number().over(w) - 1)
    held = F.last(F.when(F.col("position") % 5 == 0, F.col("value")), True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("held", held)
    overall = (F.least(F.lit(1.0), F.col("held") / 60) + F.greatest(F.lit(0.0), 1 - F.abs(F.col("held") - 128) / 80)) / 2
    return rows.select("event_id", F.round(overall, 8).alias("overall"), ((overall >= 0.4) & (F.col("event_type") != "error")).alias("kept"))


@query(f"""WITH {EV} SELECT user_id, count(*) FILTER (event_type = 'error') AS failures, round(avg(value) FILTER (position < 10), 4) AS sampled_mean,
  array_to_string(list_sort(list(event_id) FILTER (position < 10))[1:3], ',') AS first_ids FROM ev GROUP BY user_id""")
def video_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).withColumn("position", F.row_number().over(ordered(BY, ORDER)) - 1)
    early = F.col("position") < 10
    ids = F.slice(F.array_sort(F.collect_list(F.when(early, F.col("event_id")))), 1, 3)
    return rows.groupBy("user_id").agg(F.count_if(F.col("event_type") == "error").alias("failures"), F.round(F.avg(F.when(early, F.col("value"))), 4).alias("sampled_mean"), F.array_join(ids.cast("array<string>"), ",").alias("first_ids"))


@query("SELECT user_id, round(avg(value), 4) AS mean_error, round(max(value), 4) AS max_error, round(avg((value <= 50)::INT), 6) AS within FROM events GROUP BY user_id")
def fit_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    inside = (F.col("value") <= 50).cast("int")
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.round(F.avg("value"), 4).alias("mean_error"), F.round(F.max("value"), 4).alias("max_error"), F.round(F.avg(inside), 6).alias("within"))


@query("WITH c AS (SELECT conv_id, count(*) FILTER (role = 'assistant') AS n FROM conversations GROUP BY conv_id) SELECT arg_max(conv_id, (n, -conv_id)) AS conv_id, max(n) AS n FROM c")
def best_group_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count_if(F.col("role") == "assistant").alias("n"))
    return counts.agg(F.max_by("conv_id", F.struct("n", -F.col("conv_id"))).alias("conv_id"), F.max("n").alias("n"))


@query("""WITH f AS (SELECT label, vec_id, len(list_filter(embedding, lambda x: x > 0)) AS n FROM embeddings) SELECT label, arg_max(vec_id, (n, -vec_id)) AS vec_id, max(n)::BIGINT AS n FROM f GROUP BY label""")
def best_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("label", "vec_id", F.size(F.filter("embedding", lambda x: x > 0)).cast("long").alias("n"))
    return rows.groupBy("label").agg(F.max_by("vec_id", F.struct("n", -F.col("vec_id"))).alias("vec_id"), F.max("n").alias("n"))


@query(f"""WITH {EV}, p AS (SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY position) AS guess FROM ev)
SELECT user_id, count(guess) AS n, round(avg(abs(value - guess)), 8) AS mean_abs_error, round(corr(value, guess), 4) AS correlation FROM p GROUP BY user_id""")
def error_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).withColumn("guess", F.lag("value").over(ordered(BY, ORDER)))
    return rows.groupBy("user_id").agg(F.count("guess").alias("n"), F.round(F.avg(F.abs(F.col("value") - F.col("guess"))), 8).alias("mean_abs_error"), F.round(F.corr("value", "guess"), 4).alias("correlation"))


@query(f"""WITH {EV}, h AS (SELECT user_id, arg_min(value, position) AS v0, arg_max(value, position) AS vl, count(*) AS n FROM ev GROUP BY user_id),
k AS (SELECT ev.user_id, avg(value) FILTER (event_type = 'view') AS train, arg_min(value, position) FILTER (position >= n - greatest(1, n // 3)) AS tail0 FROM ev JOIN h USING (user_id) GROUP BY ev.user_id)
SELECT user_id, round((v0 - vl) / v0, 4) AS drop_ratio, CASE WHEN abs(tail0 - vl) / greatest(tail0, 1e-9) < 0.05 THEN 'converged' WHEN (vl - train) / greatest(vl, 1e-9) > 0.5 THEN 'overfit' WHEN vl > 0.15 THEN 'underfit' ELSE 'healthy' END AS diagnosis
FROM h JOIN k USING (user_id)""")
def loss_diagnosis(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = ordered(BY, ORDER)
    n = F.count(F.lit(1)).over(Window.partitionBy("user_id"))
    rows = events(spark, sf_dir).withColumn("position", F.row_number().over(w) - 1).withColumn("n", n)
    tail = F.col("position") >= F.col("n") - F.greatest(F.lit(1), F.expr("n div 3"))
    found = rows.groupBy("user_id").agg(
        F.min_by("value", "position").alias("v0"), F.max_by("value", "position").alias("vl"), F.avg(F.when(F.col("event_type") == "view", F.col("value"))).alias("train"), F.min_by("value", F.when(tail, F.col("position"))).alias("tail0")
    )
    last, low = F.col("vl"), F.lit(1e-9)
    text = F.when(F.abs(F.col("tail0") - last) / F.greatest("tail0", low) < 0.05, "converged").when((last - F.col("train")) / F.greatest(last, low) > 0.5, "overfit").when(last > 0.15, "underfit").otherwise("healthy")
    return found.select("user_id", F.round(stats.quotient(F.col("v0") - last, F.col("v0")), 4).alias("drop_ratio"), text.alias("diagnosis"))


@query("""WITH c AS (SELECT c_nationkey AS nation, avg(c_acctbal) AS a, max(c_acctbal) AS m FROM customer GROUP BY 1), s AS (SELECT s_nationkey AS nation, avg(s_acctbal) AS a, max(s_acctbal) AS m FROM supplier GROUP BY 1)
SELECT nation, field, round(x, 4) AS ours, round(y, 4) AS theirs FROM (SELECT nation, 'mean' AS field, c.a AS x, s.a AS y FROM c JOIN s USING (nation) UNION ALL SELECT nation, 'max', c.m, s.m FROM c JOIN s USING (nation)) WHERE abs(x - y) > 500""")
def calibration_crosscheck(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(F.avg("c_acctbal").alias("a"), F.max("c_acctbal").alias("m"))
    two = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("nation")).agg(F.avg("s_acctbal").alias("b"), F.max("s_acctbal").alias("n"))
    each = one.join(two, "nation").select("nation", F.expr("stack(2, 'mean', a, b, 'max', m, n) as (field, x, y)"))
    return each.where("abs(x - y) > 500").select("nation", "field", F.round("x", 4).alias("ours"), F.round("y", 4).alias("theirs"))


@query("""WITH required AS (SELECT unnest(['doc_id', 'text', 'lang', 'score', 'fps']) AS name), there AS (SELECT column_name AS name FROM (DESCRIBE documents))
SELECT name, CASE WHEN t.name IS NULL THEN 'missing' WHEN r.name IS NULL THEN 'extra' ELSE 'ok' END AS state FROM required r FULL JOIN there t USING (name)""")
def schema_compliance(spark: SparkSession, sf_dir: str) -> DataFrame:
    required, there = ["doc_id", "text", "lang", "score", "fps"], table(spark, sf_dir, "documents").columns
    state = lambda n: "missing" if n not in there else "ok" if n in required else "extra"
    return spark.createDataFrame([(n, state(n)) for n in dict.fromkeys([*required, *there])], "name string, state string")


@query(f"""WITH {EV}, n AS (SELECT *, t - lag(t) OVER (PARTITION BY user_id ORDER BY position) AS gap FROM ev),
i AS (SELECT user_id AS session_id, 'GAP' AS code, 'warn' AS severity, 'position ' || position AS message FROM n WHERE gap > 172800000000
UNION ALL SELECT user_id, 'NON_MONOTONIC', 'error', 'position ' || position FROM n WHERE gap <= 0
UNION ALL SELECT user_id, 'COUNT_MISMATCH', 'warn', 'rows ' || count(*) FROM ev GROUP BY user_id HAVING count(*) < 60
UNION ALL SELECT conv_id, 'FEW_TURNS', 'error', 'turns ' || count(*) FROM conversations GROUP BY conv_id HAVING count(*) < 3)
SELECT session_id, code, severity, message FROM i""")
def issue_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = ordered(BY, ORDER)
    rows = events(spark, sf_dir).withColumn("position", F.row_number().over(w) - 1).withColumn("gap", F.col("t") - F.lag("t").over(w))
    place = F.concat(F.lit("position "), F.col("position").cast("string"))
    sizes = rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    return stats.issues([
        stats.issue(rows, "user_id", "GAP", "warn", F.col("gap") > F.lit(172_800_000_000), place),
        stats.issue(rows, "user_id", "NON_MONOTONIC", "error", F.col("gap") <= 0, place),
        stats.issue(sizes, "user_id", "COUNT_MISMATCH", "warn", F.col("n") < 60, F.concat(F.lit("rows "), F.col("n").cast("string"))),
        stats.issue(turns, "conv_id", "FEW_TURNS", "error", F.col("n") < 3, F.concat(F.lit("turns "), F.col("n").cast("string"))),
    ])


_RECORDED = f"""{EV}, f AS (
  SELECT user_id AS id, 'rgb' AS stream, position AS row, CASE WHEN user_id % 5 = 0 AND position >= 7 THEN position + 1 ELSE position END AS frame_index, CASE WHEN user_id % 7 = 0 AND position = 9 THEN 0 ELSE position / 30.0 END AS t FROM ev
  UNION ALL SELECT user_id, 'depth', position, CASE WHEN user_id % 11 = 0 AND position = 3 THEN 99 ELSE position END, CASE WHEN user_id % 13 = 0 THEN 1.0 ELSE position / 30.0 END FROM ev WHERE user_id % 3 != 0 OR position > 0
), h AS (SELECT id, stream, row_number() OVER w - 1 AS place, frame_index, t, lag(t) OVER w AS old, row FROM f WHERE id % CASE WHEN stream = 'rgb' THEN 17 ELSE 19 END != 0 WINDOW w AS (PARTITION BY id, stream ORDER BY row)),
k AS (SELECT id, stream, count(*) AS n, min(place) FILTER (frame_index != place) AS gap, min(place) FILTER (t <= old) AS fall, arg_max(t, row) - arg_min(t, row) AS span FROM h GROUP BY id, stream),
s AS (SELECT DISTINCT user_id AS id FROM events), r AS (SELECT s.id, a.n, a.gap, a.fall, a.span, b.n AS dn, b.gap AS dgap, b.fall AS dfall FROM s LEFT JOIN k a ON a.id = s.id AND a.stream = 'rgb' LEFT JOIN k b ON b.id = s.id AND b.stream = 'depth')"""


@query(f"""WITH {_RECORDED}, i AS (
SELECT id, 'DISCOVERY_MISMATCH' AS code, CASE WHEN id % 4 = 0 THEN 'error' ELSE 'warn' END AS severity, 'imu: renamed' AS message FROM s WHERE id % 6 = 0
UNION ALL SELECT id, 'MISSING_RGB_TIMESTAMPS', 'error', 'no RGB times; cannot align' FROM s WHERE id % 17 = 0
UNION ALL SELECT id, 'MISSING_DEPTH_TIMESTAMPS', 'warn', 'no depth times; frames are paired one by one' FROM s WHERE id % 19 = 0
UNION ALL SELECT id, 'RGB_FRAME_INDEX_NON_CONTIGUOUS', 'error', 'first gap at row ' || gap FROM r WHERE gap IS NOT NULL
UNION ALL SELECT id, 'RGB_TIMESTAMPS_NON_MONOTONIC', 'error', 'first violation at row ' || fall FROM r WHERE fall IS NOT NULL
UNION ALL SELECT id, 'DEPTH_FRAME_INDEX_NON_CONTIGUOUS', 'error', 'first gap at row ' || dgap FROM r WHERE dgap IS NOT NULL
UNION ALL SELECT id, 'DEPTH_TIMESTAMPS_NON_MONOTONIC', 'error', 'first violation at row ' || dfall FROM r WHERE dfall IS NOT NULL
UNION ALL SELECT id, 'RGB_FRAME_COUNT_MISMATCH', 'warn', 'declared 70, found ' || n FROM r WHERE id % 2 = 0 AND n != 70
UNION ALL SELECT id, 'DEPTH_FRAME_COUNT_MISMATCH', 'warn', 'declared 70, found ' || dn FROM r WHERE id % 3 = 0 AND dn != 70
UNION ALL SELECT id, 'RGB_DEPTH_FRAME_COUNT_MISMATCH', 'error', n || ' RGB and ' || dn || ' depth frames' FROM r WHERE n != dn
UNION ALL SELECT id, 'DURATION_MISMATCH', 'warn', 'declared 2.000 s, observed ' || printf('%.3f', span + 1 / 30.0) || ' s' FROM r WHERE abs(span + 1 / 30.0 - 2) > 0.5
UNION ALL SELECT id, 'CALIBRATION_INVALID_INTRINSICS', 'error', 'fx 0.000, fy 500.000' FROM s WHERE id % 23 = 0
UNION ALL SELECT id, 'CALIBRATION_CROSS_CHECK', 'warn', unnest(['fx differs', 'cx differs']) FROM s WHERE id % 29 = 0
UNION ALL SELECT id, 'CALIBRATION_NO_IMU', 'warn', 'no IMU calibration; defaults are used' FROM s WHERE id % 31 = 0)
SELECT id AS session_id, code, severity, message FROM i""")
def ingest_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 14 rules over users' events as frames of two streams, some of them spoilt."""
    rows = events(spark, sf_dir).withColumn("row", (F.row_number().over(ordered(BY, ORDER)) - 1).cast("long"))
    id, row = F.col("user_id"), F.col("row")
    t = row / 30.0
    rgb = rows.select(id.alias("session_id"), F.lit("rgb").alias("stream"), "row", F.when((id % 5 == 0) & (row >= 7), row + 1).otherwise(row).alias("frame_index"), F.when((id % 7 == 0) & (row == 9), 0.0).otherwise(t).alias("t"))
    depth = rows.where((id % 3 != 0) | (row > 0)).select(id.alias("session_id"), F.lit("depth").alias("stream"), "row", F.when((id % 11 == 0) & (row == 3), 99).otherwise(row).alias("frame_index"), F.when(id % 13 == 0, 1.0).otherwise(t).alias("t"))
    sessions = rows.select(id.alias("session_id")).distinct()
    s = F.col("session_id")
    mismatches = sessions.where(s % 6 == 0).select("session_id", F.lit("imu").alias("name"), F.lit("renamed").alias("note"), F.when(s % 4 != 0, "imu2.txt").alias("actual"))
    sessions = sessions.select(
        "session_id", (s % 17 != 0).alias("rgb_file"), (s % 19 != 0).alias("depth_file"), F.when(s % 2 == 0, 70).alias("rgb_count"), F.when(s % 3 == 0, 70).alias("depth_count"), F.lit(2.0).alias("duration_s"),
        F.when(s % 23 == 0, 0.0).otherwise(500.0).alias("fx"), F.lit(500.0).alias("fy"), F.when(s % 29 == 0, F.array(F.lit("fx differs"), F.lit("cx differs"))).alias("notes"), (s % 31 != 0).alias("has_imu"),
    )
    return ingest.issues(sessions, rgb.unionByName(depth), mismatches)


@query("""SELECT doc_id, array_to_string(list_filter([CASE WHEN doc_id % 7 = 0 THEN 'missing_path' END, CASE WHEN n_chars < 50 THEN 'missing_file' END, CASE WHEN doc_id % 11 = 0 THEN 'invalid_timestamp' END, CASE WHEN lang IS NULL THEN 'missing_stream' END], lambda x: x IS NOT NULL), ',') AS reasons,
  NOT (doc_id % 7 = 0 OR n_chars < 50 OR doc_id % 11 = 0 OR lang IS NULL) AS valid FROM documents""")
def manifest_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a manifest in which the path of every seventh and the time of every eleventh row is spoilt."""
    manifest = table(spark, sf_dir, "documents").select(
        "doc_id", F.when(F.col("doc_id") % 7 != 0, F.lit("x")).alias("path"), (F.col("n_chars") >= 50).alias("there"), F.when(F.col("doc_id") % 11 == 0, -1).otherwise(1).alias("timestamp_ns"), F.col("lang").alias("stream")
    )
    why = stats.reasons({"missing_path": F.col("path").isNull(), "missing_file": ~F.col("there"), "invalid_timestamp": F.col("timestamp_ns") < 0, "missing_stream": F.col("stream").isNull()})
    return manifest.select("doc_id", F.array_join(why, ",").alias("reasons"), (F.size(why) == 0).alias("valid"))


_PAIR = """WITH n AS (SELECT label, vec_id, list_transform(embedding, lambda x: 128 + 100 * x::DOUBLE) AS a, row_number() OVER w AS i, lead(embedding) OVER w AS nx FROM embeddings WINDOW w AS (PARTITION BY label ORDER BY vec_id)),
p AS (SELECT vec_id, a, list_transform(nx, lambda x: 128 + 100 * x::DOUBLE) AS b FROM n WHERE nx IS NOT NULL),
m AS (SELECT *, len(a) AS n, list_sum(a) / len(a) AS ma, list_sum(b) / len(b) AS mb, list_sum(list_transform(range(1, len(a) + 1), lambda i: (a[i] - b[i]) * (a[i] - b[i]))) / len(a) AS mse,
  list_sum(list_transform(a, lambda x: x * x)) / len(a) AS aa, list_sum(list_transform(b, lambda x: x * x)) / len(b) AS bb, list_sum(list_transform(range(1, len(a) + 1), lambda i: a[i] * b[i])) / len(a) AS ab FROM p)"""


def image_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector as an 8 x 8 image, with the next one of its label."""
    grey = lambda c: F.transform(c, lambda x: 128 + 100 * x.cast("double"))
    rows = table(spark, sf_dir, "embeddings").withColumn("nx", F.lead("embedding").over(ordered(["label"], ["vec_id"])))
    return rows.where("nx is not null").select("vec_id", grey("embedding").alias("a"), grey("nx").alias("b"))


@query(f"""{_PAIR} SELECT vec_id, round(CASE WHEN mse <= 1e-9 THEN 'inf'::DOUBLE ELSE 10 * log10(65025 / mse) END, 4) AS psnr,
  round((2 * ma * mb + 6.5025) * (2 * (ab - ma * mb) + 58.5225) / ((ma * ma + mb * mb + 6.5025) * (aa - ma * ma + bb - mb * mb + 58.5225)), 4) AS ssim FROM m""")
def psnr_ssim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return image_pairs(spark, sf_dir).select("vec_id", F.round(stats.psnr("a", "b"), 4).alias("psnr"), F.round(stats.ssim("a", "b"), 4).alias("ssim"))


@query("""WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: 128 + 100 * x::DOUBLE) AS a FROM embeddings), l AS (SELECT vec_id, list_transform(list_filter(range(64), lambda i: i // 8 BETWEEN 1 AND 6 AND i % 8 BETWEEN 1 AND 6), lambda i: a[i] + a[i + 2] + a[i - 7] + a[i + 9] - 4 * a[i + 1]) AS v FROM e)
SELECT vec_id, round(list_sum(list_transform(v, lambda x: x * x)) / 36 - (list_sum(v) / 36) * (list_sum(v) / 36), 2) AS blur FROM l""")
def laplacian_blur(spark: SparkSession, sf_dir: str) -> DataFrame:
    grey = F.transform("embedding", lambda x: 128 + 100 * x.cast("double"))
    return table(spark, sf_dir, "embeddings").select("vec_id", grey.alias("a")).select("vec_id", F.round(stats.laplacian_variance("a", 8), 2).alias("blur"))
