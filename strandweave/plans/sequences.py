"""Queries over ordered sequences: each user's events, each conversation's turns, each label's vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandweave.operators import segment
from strandweave.plans.registry import query
from strandweave.sources.tables import micros, table

BY, ORDER = ["user_id"], ["t", "event_id"]
EV = "ev AS (SELECT user_id, event_id, event_type, epoch_us(ts) AS t, value, row_number() OVER w - 1 AS position FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))"
HOUR = 3_600_000_000


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", micros("ts").alias("t"), "value")


@query(f"""WITH {EV}, g AS (SELECT *, t - lag(t) OVER (PARTITION BY user_id ORDER BY t, event_id) AS gap FROM ev)
SELECT user_id, position, gap AS interval FROM g WHERE gap > 1.6 * 24 * {HOUR}""")
def gap_anomaly(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = segment.gaps(events(spark, sf_dir), BY, ORDER, F.col("t"), F.lit(1.6 * 24 * HOUR))
    return found.select("user_id", F.col("position").cast("long").alias("position"), "interval")


@query("""WITH n AS (SELECT *, row_number() OVER w - 1 AS i, turn > coalesce(lag(turn) OVER w, -1) AS rising FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
SELECT conv_id, bool_and(i = turn) AS contiguous, bool_and(rising) AS monotonic, min(turn) FILTER (i != turn) AS first_violation FROM n GROUP BY conv_id""")
def contiguity_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = segment.ordered(["conv_id"], ["turn"])
    rows = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", (F.row_number().over(w) - 1).alias("i"), (F.col("turn") > F.coalesce(F.lag("turn").over(w), F.lit(-1))).alias("rising")
    )
    return rows.groupBy("conv_id").agg(
        F.bool_and(F.col("i") == F.col("turn")).alias("contiguous"), F.bool_and("rising").alias("monotonic"), F.min(F.when(F.col("i") != F.col("turn"), F.col("turn"))).alias("first_violation")
    )


_RUNS = f"""{EV}, m AS (SELECT *, value >= 20 AS flag FROM ev),
r AS (SELECT *, position - row_number() OVER (PARTITION BY user_id, flag ORDER BY position) AS island FROM m),
runs AS (SELECT user_id, flag, min(position) AS start, max(position) + 1 AS "end", count(*) AS length FROM r GROUP BY user_id, flag, island)"""


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = segment.run_lengths(events(spark, sf_dir), BY, ORDER, F.col("value") >= 20)
    return found.select("user_id", "flag", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "length")


@query(f"WITH {_RUNS} SELECT * FROM runs")
def run_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _runs(spark, sf_dir)


@query(f"WITH {_RUNS} SELECT user_id, max(length) AS length, arg_max(start, (length, -start)) AS start FROM runs WHERE flag GROUP BY user_id")
def longest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = F.struct("length", -F.col("start"))
    return _runs(spark, sf_dir).where("flag").groupBy("user_id").agg(F.max("length").alias("length"), F.max_by("start", best).alias("start"))


@query(f"""WITH {EV}, k AS (SELECT *, event_type != 'error' AS kept FROM ev),
n AS (SELECT *, max(position) FILTER (kept) OVER (w ROWS UNBOUNDED PRECEDING) AS l, min(position) FILTER (kept) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS r
  FROM k WINDOW w AS (PARTITION BY user_id ORDER BY position))
SELECT n.event_id, n.kept, round(CASE WHEN n.kept THEN n.value WHEN r - l - 1 <= 5 THEN a.value * (1 - (n.position - l) / (r - l)) + b.value * ((n.position - l) / (r - l)) END, 6) AS filled
FROM n LEFT JOIN ev a ON a.user_id = n.user_id AND a.position = l LEFT JOIN ev b ON b.user_id = n.user_id AND b.position = r""")
def interp_short_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = segment.interpolate(events(spark, sf_dir), BY, ORDER, "value", F.col("event_type") != "error")
    return found.select("event_id", "kept", F.round("filled", 6).alias("filled"))


_MEAN = """list_aggregate(list_transform(range(-2, 3), lambda d: vs[least(greatest(position + d, 0), len(vs) - 1) + 1]), 'sum') / 5"""


@query(f"""WITH {EV}, a AS (SELECT user_id, list(value ORDER BY position) AS vs FROM ev GROUP BY user_id)
SELECT event_id, round({_MEAN}, 6) AS mean FROM ev JOIN a USING (user_id)""")
def moving_avg_edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("event_id", F.round(segment.moving_mean(F.col("value"), BY, ORDER), 6).alias("mean"))


_SPEED = """e AS (SELECT label, vec_id, embedding[1:3] AS p, row_number() OVER w - 1 AS position, lag(embedding[1:3]) OVER w AS b FROM embeddings WINDOW w AS (PARTITION BY label ORDER BY vec_id)),
s AS (SELECT *, CASE WHEN b IS NOT NULL THEN sqrt(list_sum(list_transform(range(1, 4), lambda i: (p[i]::DOUBLE - b[i]::DOUBLE) * (p[i]::DOUBLE - b[i]::DOUBLE)))) END AS step FROM e),
f AS (SELECT *, coalesce(step, lead(step) OVER (PARTITION BY label ORDER BY vec_id), 0) AS value FROM s),
a AS (SELECT label, list(value ORDER BY position) AS vs FROM f GROUP BY label)"""


def speeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The smoothed speed of each label's vectors in their first three dimensions."""
    w = segment.ordered(["label"], ["vec_id"])
    at = lambda i: F.col("embedding")[i].cast("double")
    step = F.sqrt(sum(((at(i) - F.lag(at(i)).over(w)) * (at(i) - F.lag(at(i)).over(w)) for i in range(3)), F.lit(0.0)))
    rows = table(spark, sf_dir, "embeddings").select("label", "vec_id", step.alias("step"))
    rows = rows.withColumn("value", F.coalesce("step", F.lead("step").over(w), F.lit(0.0)))
    return rows.select("label", "vec_id", F.round(segment.moving_mean(F.col("value"), ["label"], ["vec_id"]), 6).alias("speed"))


@query(f"WITH {_SPEED} SELECT label, vec_id, round({_MEAN}, 6) AS speed FROM f JOIN a USING (label)")
def speed_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return speeds(spark, sf_dir)


@query(f"""WITH {_SPEED}, v AS (SELECT label, position, round({_MEAN}, 6) AS speed FROM f JOIN a USING (label))
SELECT position AS frame, max(speed) AS speed FROM v WHERE label IN (0, 1) GROUP BY position""")
def max_speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = speeds(spark, sf_dir).where("label in (0, 1)")
    frame = F.row_number().over(segment.ordered(["label"], ["vec_id"])) - 1
    return both.select(frame.cast("long").alias("frame"), "speed").groupBy("frame").agg(F.max("speed").alias("speed"))


_MINIMA = f"""{EV}, c AS (SELECT *, coalesce(value < lag(value) OVER w AND value < lead(value) OVER w AND value < 10, false) AS cut FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY position))"""


@query(f"WITH {_MINIMA} SELECT user_id, position, value FROM c WHERE cut")
def local_minima(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("user_id", (F.row_number().over(segment.ordered(BY, ORDER)) - 1).cast("long").alias("position"), "value", segment.local_minima("value", BY, ORDER, 10.0).alias("cut"))
    return rows.where("cut").drop("cut")


@query(f"""WITH {_MINIMA}, n AS (SELECT user_id, count(*) AS n, count(*) FILTER (cut) AS minima FROM c GROUP BY user_id HAVING count(*) >= 5),
p AS (SELECT user_id, position AS a FROM c WHERE cut UNION SELECT user_id, 0 FROM n UNION SELECT user_id, n FROM n),
s AS (SELECT user_id, a, b FROM (SELECT user_id, a, lead(a) OVER (PARTITION BY user_id ORDER BY a) AS b FROM p) WHERE b - a >= 5)
SELECT user_id, coalesce(a, 0) AS start, coalesce(b, n) AS "end", CASE WHEN a IS NULL THEN 'fallback' WHEN minima > 0 THEN 'velocity_min' ELSE 'label_json' END AS source,
  row_number() OVER (PARTITION BY user_id ORDER BY a) - 1 AS idx FROM n LEFT JOIN s USING (user_id)""")
def atomic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment.atomic_segments(events(spark, sf_dir), BY, ORDER, "value", 10.0)


@query("""WITH n AS (SELECT user_id, count(*) AS n FROM events GROUP BY user_id), k AS (SELECT user_id, n, greatest(ceil((n - 30) / 25.0), 0)::BIGINT AS more FROM n)
SELECT user_id, i AS clip, i * 25 AS start, least(i * 25 + 30, n) AS "end", CASE WHEN i = 0 THEN 0 ELSE 5 END AS "left", CASE WHEN i = more THEN 0 ELSE 5 END AS "right"
FROM (SELECT *, unnest(range(more + 1)) AS i FROM k)""")
def overlap_clip_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return n.select("user_id", F.posexplode(segment.overlapping_clips(F.col("n"), 30, 5)).alias("clip", "c")).select("user_id", F.col("clip").cast("long").alias("clip"), "c.*")


@query(f"WITH {EV} SELECT user_id, position // 20 AS clip, min(position) AS start, max(position) + 1 AS \"end\" FROM ev GROUP BY user_id, position // 20")
def fixed_window_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).withColumn("position", (F.row_number().over(segment.ordered(BY, ORDER)) - 1).cast("long"))
    return rows.groupBy("user_id", F.expr("position div 20").alias("clip")).agg(F.min("position").alias("start"), (F.max("position") + 1).alias("end"))


@query(f"""WITH {EV}, n AS (SELECT user_id, count(*) AS n FROM ev GROUP BY user_id), k AS (SELECT user_id, n, greatest(ceil((n - 30) / 25.0), 0)::BIGINT AS more FROM n),
c AS (SELECT user_id, i AS clip, i * 25 AS s, least(i * 25 + 30, n) AS e, CASE WHEN i = 0 THEN 0 ELSE 5 END AS l, CASE WHEN i = more THEN 0 ELSE 5 END AS r FROM (SELECT *, unnest(range(more + 1)) AS i FROM k)),
p AS (SELECT ev.user_id, position, value + clip AS value, event_type != 'error' AS valid,
  CASE WHEN position - s < l THEN (position - s + 1) / l WHEN r > 0 AND position - s - (e - s - r) >= 0 THEN 1 - (position - s - (e - s - r)) / r ELSE 1.0 END AS w
  FROM ev JOIN c ON ev.user_id = c.user_id AND position >= s AND position < e)
SELECT user_id, position, round(sum(w * value) / CASE WHEN sum(w) <= 1e-6 THEN 1 ELSE sum(w) END, 6) AS value, bool_or(valid) AS valid FROM p GROUP BY user_id, position""")
def overlap_blend(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strandweave.operators.align import in_intervals

    rows = events(spark, sf_dir).withColumn("position", (F.row_number().over(segment.ordered(BY, ORDER)) - 1).cast("long"))
    n = rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    clips = n.select("user_id", F.posexplode(segment.overlapping_clips(F.col("n"), 30, 5)).alias("clip", "c")).select("user_id", "clip", "c.*")
    inside = in_intervals(rows, clips, ["user_id"], "position", "start", "end", 30)
    parts = inside.select("user_id", "position", (F.col("position") - F.col("start")).alias("i"), (F.col("end") - F.col("start")).alias("n"), "left", "right", (F.col("value") + F.col("clip")).alias("value"), (F.col("event_type") != "error").alias("valid"))
    return segment.blend(parts, ["user_id", "position"]).withColumn("value", F.round("value", 6))


_SHARE = lambda cutoff: f"(1 / (1 + 30 / (2 * pi() * ({cutoff}))))"


@query(f"""WITH RECURSIVE {EV}, f AS (
  SELECT user_id, position, value AS x, value AS y, 0::DOUBLE AS d FROM ev WHERE position = 0
  UNION ALL SELECT user_id, position, x, y + {_SHARE("2 + 0.7 * abs(d)")} * (x - y), d FROM (
    SELECT e.user_id, e.position, e.value AS x, f.y, {_SHARE("1")} * (e.value - f.x) * 30 + (1 - {_SHARE("1")}) * f.d AS d FROM f JOIN ev e ON e.user_id = f.user_id AND e.position = f.position + 1)
) SELECT user_id, position, x AS value, round(y, 6) AS smooth FROM f""")
def one_euro(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = segment.one_euro(events(spark, sf_dir), "user_id", ORDER, "value")
    return found.withColumn("smooth", F.round("smooth", 6))


@query(f"""WITH {EV}, s AS (SELECT user_id, avg(value * value) + 1.5 * stddev_pop(value * value) AS most FROM ev GROUP BY user_id),
k AS (SELECT ev.*, value * value > most AS spike FROM ev JOIN s USING (user_id)),
b AS (SELECT user_id, min(position) FILTER (spike) AS a, max(position) FILTER (spike) AS z FROM k GROUP BY user_id)
SELECT event_id, CASE WHEN a IS NULL OR position < a THEN 0 WHEN position <= z THEN 1 ELSE 2 END AS phase FROM ev JOIN b USING (user_id)""")
def contact_phase(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("user_id")
    rows = events(spark, sf_dir).withColumn("position", F.row_number().over(segment.ordered(BY, ORDER)) - 1).withColumn("energy", F.col("value") * F.col("value"))
    rows = rows.withColumn("spike", F.col("energy") > F.avg("energy").over(w) + 1.5 * F.stddev_pop("energy").over(w))
    at = F.when(F.col("spike"), F.col("position"))
    a, z = F.min(at).over(w), F.max(at).over(w)
    return rows.select("event_id", F.when(a.isNull() | (F.col("position") < a), 0).when(F.col("position") <= z, 1).otherwise(2).alias("phase"))


@query(f"WITH {EV} SELECT event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY position ROWS UNBOUNDED PRECEDING), 4) AS walk FROM ev")
def cumsum_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = segment.ordered(BY, ORDER).rowsBetween(Window.unboundedPreceding, 0)
    return events(spark, sf_dir).select("event_id", F.round(F.sum("value").over(w), 4).alias("walk"))


@query("""SELECT conv_id, turn // 2 AS pair, avg(length(text)) FILTER (role IN ('user', 'assistant'))::DOUBLE AS mean_chars, bool_or(role = 'assistant') AS answered FROM conversations GROUP BY conv_id, turn // 2""")
def two_hand_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    side = F.when(F.col("role").isin("user", "assistant"), F.length("text"))
    return table(spark, sf_dir, "conversations").groupBy("conv_id", F.expr("turn div 2").alias("pair")).agg(F.avg(side).alias("mean_chars"), F.bool_or(F.col("role") == "assistant").alias("answered"))


@query(f"""WITH {EV} SELECT user_id, position AS cut FROM ev WHERE event_type = 'signup' UNION SELECT user_id, position FROM ev WHERE value < 5
UNION SELECT user_id, 0 FROM ev UNION SELECT user_id, count(*) FROM ev GROUP BY user_id""")
def cut_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).withColumn("position", (F.row_number().over(segment.ordered(BY, ORDER)) - 1).cast("long"))
    ends = rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).select("user_id", F.explode(F.array(F.lit(0).cast("long"), "n")).alias("cut"))
    cuts = rows.where("event_type = 'signup' or value < 5").select("user_id", F.col("position").alias("cut"))
    return cuts.unionByName(ends).distinct()


@query("""SELECT event_id AS id, event_type AS label, 'events' AS origin FROM events WHERE event_type = 'error'
UNION ALL SELECT doc_id, CASE WHEN toxic = 1 THEN 'toxic' ELSE 'clean' END, 'labels' FROM labels""")
def label_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = table(spark, sf_dir, "events").where("event_type = 'error'").select(F.col("event_id").alias("id"), F.col("event_type").alias("label"), F.lit("events").alias("origin"))
    two = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.when(F.col("toxic") == 1, "toxic").otherwise("clean").alias("label"), F.lit("labels").alias("origin"))
    return one.unionByName(two)


@query(f"WITH {EV}, n AS (SELECT user_id, count(*) AS n FROM ev GROUP BY user_id) SELECT user_id, position, event_id FROM ev JOIN n USING (user_id) WHERE position IN (0, n // 2, n - 1)")
def first_mid_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.count(F.lit(1)).over(Window.partitionBy("user_id"))
    rows = events(spark, sf_dir).withColumn("position", (F.row_number().over(segment.ordered(BY, ORDER)) - 1).cast("long")).withColumn("n", n)
    return rows.where("position = 0 or position = n div 2 or position = n - 1").select("user_id", "position", "event_id")


@query("SELECT event_type AS label, count(*) AS n FROM events GROUP BY event_type ORDER BY n DESC, label LIMIT 3")
def topk_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("label")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "label").limit(3)


@query("""WITH u AS (SELECT user_id, max(event_type || '-' || event_id) AS latest FROM events GROUP BY user_id)
SELECT user_id, latest FROM (SELECT *, row_number() OVER (ORDER BY user_id) - 1 AS i FROM u) WHERE i % 10 = 0""")
def every_kth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth session; ranks come from counts of ranges of ids, so that no task sees all of them."""
    latest = F.max(F.concat_ws("-", "event_type", F.col("event_id").cast("string")))
    users = table(spark, sf_dir, "events").groupBy("user_id").agg(latest.alias("latest")).withColumn("cell", F.expr("user_id div 4096"))
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = users.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).select("cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = users.join(cells, "cell").withColumn("i", F.col("base") + F.row_number().over(Window.partitionBy("cell").orderBy("user_id")) - 1)
    return ranked.where("i % 10 = 0").select("user_id", "latest")


@query(f"""WITH RECURSIVE {EV}, s AS (SELECT user_id, count(*) AS n, max(coalesce(value, 0)) AS most, list(position ORDER BY -coalesce(value, 0), position)[1:16] AS top FROM ev GROUP BY user_id),
g AS (SELECT *, list_transform(range(greatest(1, least(8, n))), lambda i: round_even((n - 1) * i / greatest(1, greatest(1, least(8, n)) - 1), 0)::BIGINT) AS grid, greatest(1, n // 16) AS apart FROM s),
c AS (SELECT user_id, apart, n < 16 OR most < 1e-3 AS flat, CASE WHEN n < 16 OR most < 1e-3 THEN grid ELSE list_concat(top, grid) END AS cand FROM g),
r AS (SELECT user_id, apart, flat, cand, 0 AS j, []::BIGINT[] AS kept FROM c
  UNION ALL SELECT user_id, apart, flat, cand, j + 1, CASE WHEN flat OR len(kept) < 8 AND len(list_filter(kept, lambda p: abs(p - cand[j + 1]) < apart)) = 0 THEN list_append(kept, cand[j + 1]) ELSE kept END FROM r WHERE j < len(cand)),
k AS (SELECT DISTINCT user_id, unnest(kept) AS position FROM r WHERE j = len(cand))
SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY position) - 1 AS idx, position FROM k""")
def motion_peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment.peaks(events(spark, sf_dir), "user_id", ORDER, "value", 8)


@query("""WITH RECURSIVE e AS (SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS i, list_transform(embedding[1:4], lambda x: x::DOUBLE) AS v FROM embeddings),
u AS (SELECT label, vec_id, i, list_transform(v, lambda x: x / sqrt(list_sum(list_transform(v, lambda y: y * y)))) AS x FROM e),
f AS (SELECT label, vec_id, i, x AS y FROM u WHERE i = 1
  UNION ALL SELECT label, vec_id, i, list_transform(raw, lambda a: a / sqrt(list_sum(list_transform(raw, lambda b: b * b)))) FROM (
    SELECT label, vec_id, i, list_transform(range(1, 5), lambda k: (CASE WHEN ang < 1e-6 THEN 0.5 ELSE sin(0.5 * ang) / sin(ang) END) * (y[k] + (CASE WHEN dot < 0 THEN -1 ELSE 1 END) * x[k])) AS raw FROM (
      SELECT *, acos(least(abs(dot), 1)) AS ang FROM (
        SELECT u.label, u.vec_id, u.i, u.x, f.y, u.x[1] * f.y[1] + u.x[2] * f.y[2] + u.x[3] * f.y[3] + u.x[4] * f.y[4] AS dot FROM f JOIN u ON u.label = f.label AND u.i = f.i + 1)))
) SELECT label, vec_id, round(y[1], 6) AS w, round(y[2], 6) AS x, round(y[3], 6) AS y, round(y[4], 6) AS z FROM f""")
def quat_smooth(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("label", "vec_id", F.slice("embedding", 1, 4).cast("array<double>").alias("q"))
    found = segment.smooth_rotations(rows, "label", "vec_id", "q")
    return found.select("label", "vec_id", *[F.round(F.col("smooth")[i], 6).alias(c) for i, c in enumerate("wxyz")])


@query("""WITH RECURSIVE d AS (SELECT source, doc_id, n_chars, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i FROM documents),
f AS (SELECT source, doc_id, i, 0::BIGINT AS shard, n_chars + 64 AS filled FROM d WHERE i = 1
  UNION ALL SELECT d.source, d.doc_id, d.i, CASE WHEN filled > 0 AND filled + n_chars > 50000 THEN shard + 1 ELSE shard END,
    CASE WHEN filled > 0 AND filled + n_chars > 50000 THEN n_chars + 64 ELSE filled + n_chars + 64 END FROM f JOIN d ON d.source = f.source AND d.i = f.i + 1)
SELECT source, doc_id, shard FROM f""")
def shard_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("source", "doc_id", "n_chars")
    return segment.shards(docs, "source", ["doc_id"], "n_chars", 50_000, 64).select("source", "doc_id", "shard")
