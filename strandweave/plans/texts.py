"""Queries over texts, paths, JSON and keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandweave.functions import text as T
from strandweave.operators.segment import numbered, ordered
from strandweave.plans.registry import query
from strandweave.sources.tables import micros, table


def paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The paths in the pages' addresses."""
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", r"^[a-z]+://[^/]*/?(.*)$", 1).alias("path"))


_PATH = "p AS (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/]*/?(.*)$', 1) AS path FROM pages)"
#: Pages are no sensor's files; here they have a modality of their own.
_EXTENSIONS = {**T.EXTENSIONS, "page": [".html", ".HTM"]}
_MODALITY = """CASE WHEN contains(lower(path), 'depth') THEN 'depth' WHEN contains(lower(path), 'imu') THEN 'imu' WHEN regexp_matches(lower(path), 'pose|6dof|tf') THEN 'pose' WHEN regexp_matches(lower(path), 'point_?cloud|lidar') THEN 'pointcloud'
  WHEN regexp_matches(lower(path), '[.](jpe?g|png|bmp|webp)$') THEN 'rgb' WHEN regexp_matches(lower(path), '[.](npy|npz|pfm|exr|tiff?)$') THEN 'depth' WHEN regexp_matches(lower(path), '[.](wav|flac|mp3|aac)$') THEN 'audio'
  WHEN regexp_matches(lower(path), '[.](jsonl?|csv)$') THEN 'imu' WHEN regexp_matches(lower(path), '[.]txt$') THEN 'pose' WHEN regexp_matches(lower(path), '[.](pcd|ply|bin|la[sz])$') THEN 'pointcloud' WHEN regexp_matches(lower(path), '[.]html?$') THEN 'page' END"""
#: Files of many kinds, named after orders.
_FILES = f"""f AS (SELECT o_orderkey, ['rgb/cam_left', 'data/RGB', 'raw/frames', 'run1/lidar', 'tf', 'a/b', ''][o_orderkey % 7 + 1] AS folder, ['jpg', 'npz', 'FLAC', 'jsonl', 'txt', 'laz', 'las', 'webp', 'xyz'][o_orderkey % 9 + 1] AS ext FROM orders),
g AS (SELECT o_orderkey, folder || CASE WHEN folder = '' THEN '' ELSE '/' END || o_orderkey || '.' || ext AS path FROM f), m AS (SELECT *, {_MODALITY} AS modality FROM g)"""


@query(f"""WITH {_PATH}, {_FILES} SELECT page_id AS id, {_MODALITY} AS modality FROM p UNION ALL SELECT -o_orderkey, modality FROM m""")
def modality_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    some = paths(spark, sf_dir).select(F.col("page_id").alias("id"), "path").unionByName(files(spark, sf_dir).select((-F.col("o_orderkey")).alias("id"), "path"))
    return some.select("id", T.modality(F.col("path"), _EXTENSIONS).alias("modality"))


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("o_orderkey")
    pick = lambda xs: F.element_at(F.array(*map(F.lit, xs)), (n % len(xs) + 1).cast("int"))
    folder = pick(["rgb/cam_left/", "data/RGB/", "raw/frames/", "run1/lidar/", "tf/", "a/b/", ""])
    ext = pick(["jpg", "npz", "FLAC", "jsonl", "txt", "laz", "las", "webp", "xyz"])
    return table(spark, sf_dir, "orders").select("o_orderkey", F.concat(folder, n.cast("string"), F.lit("."), ext).alias("path"))


@query(f"""WITH {_FILES}, s AS (SELECT *, list_filter(string_split(path, '/')[:-2], lambda x: lower(x) NOT IN ('', 'data', 'raw', 'frames') AND lower(x) IS DISTINCT FROM modality) AS f FROM m)
SELECT o_orderkey, CASE WHEN len(f) > 0 THEN f[1] ELSE modality END AS sensor FROM s""")
def sensor_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.col("path")
    return files(spark, sf_dir).select("o_orderkey", T.sensor(path, T.modality(path, _EXTENSIONS)).alias("sensor"))


@query("""WITH n AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'f_' || (epoch_us(ts) // 1000000) WHEN 1 THEN 'f_' || (epoch_us(ts) // 1000) WHEN 2 THEN 'f_' || epoch_us(ts) ELSE 'f_' || epoch_us(ts) || '000.x' END AS name, epoch_us(ts) AS t FROM events)
SELECT event_id, CASE event_id % 4 WHEN 0 THEN t // 1000000 * 1000000000 WHEN 1 THEN t // 1000 * 1000000 ELSE t * 1000 END AS timestamp_ns FROM n""")
def ts_digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("t")
    name = F.when(F.col("event_id") % 4 == 0, F.expr("t div 1000000")).when(F.col("event_id") % 4 == 1, F.expr("t div 1000")).otherwise(t).cast("string")
    name = F.concat(F.lit("f_"), name, F.when(F.col("event_id") % 4 == 3, "000.x").otherwise(""))
    return table(spark, sf_dir, "events").select("event_id", micros("ts").alias("t")).select("event_id", T.digits_to_ns(name).alias("timestamp_ns"))


@query("""SELECT event_id, CASE WHEN event_id % 3 = 2 THEN NULL ELSE (CASE WHEN event_id % 2 = 0 THEN '' ELSE '/root/' END) || event_type || '.json' END AS path,
  CASE event_id % 3 WHEN 0 THEN epoch_us(ts) * 1000 WHEN 1 THEN (epoch_us(ts) // 1000) * 1000000 END AS timestamp_ns, event_id % 3 = 2 AS rejected, '{"value":"' || event_id || '"}' AS extra FROM events""")
def manifest_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest rows as JSON text, whose times and paths stand under several names; unknown keys are gathered."""
    us = F.col("t")
    row = F.to_json(F.struct(
        F.when(F.col("event_id") % 3 == 0, us * 1000).alias("timestamp_ns"),
        F.when(F.col("event_id") % 3 == 1, F.expr("t div 1000")).alias("timestamp_ms"),
        F.when(F.col("event_id") % 3 == 0, F.concat(F.col("event_type"), F.lit(".json"))).alias("path"),
        F.when(F.col("event_id") % 3 == 1, F.concat(F.col("event_type"), F.lit(".json"))).alias("uri"),
        F.col("event_id").cast("string").alias("value"),
    ))
    raw = table(spark, sf_dir, "events").select("event_id", "event_type", micros("ts").alias("t")).select("event_id", row.alias("row"))
    known = F.from_json("row", "timestamp_ns long, timestamp_us long, timestamp_ms long, path string, file string, uri string, value string")
    rows = raw.select("event_id", known.alias("r"))
    name = F.coalesce("r.path", "r.file", "r.uri")
    when = F.coalesce(F.col("r.timestamp_ns"), F.col("r.timestamp_us") * 1000, F.col("r.timestamp_ms") * 1_000_000)
    full = F.when(F.col("event_id") % 2 == 0, name).otherwise(F.concat(F.lit("/root/"), name))
    return rows.select("event_id", full.alias("path"), when.alias("timestamp_ns"), name.isNull().alias("rejected"), F.to_json(F.struct(F.col("r.value").alias("value"))).alias("extra"))


@query("""WITH s AS (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN '{broken' ELSE props END AS props FROM events) SELECT event_id, CASE WHEN json_valid(props) THEN (props->>'$.k')::BIGINT END AS k, json_valid(props) AS parsed FROM s""")
def sidecar_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field of the metadata beside a file; text that is no JSON counts as none, as that of every fifth here."""
    text = F.when(F.col("event_id") % 5 == 0, "{broken").otherwise(F.col("props"))
    parsed = F.try_parse_json(text)
    return table(spark, sf_dir, "events").select("event_id", F.try_variant_get(parsed, "$.k", "long").alias("k"), parsed.isNotNull().alias("parsed"))


@query("""SELECT conv_id, turn, CASE WHEN turn % 4 = 3 THEN NULL ELSE 'grasp ' || turn END AS text, CASE turn % 4 WHEN 0 THEN 'lift' WHEN 1 THEN 'move' WHEN 2 THEN 'place' END AS label FROM conversations""")
def json_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers as whole JSON in a fence, within other words, broken, and without any field."""
    turn = F.col("turn").cast("string")
    whole = F.concat(F.lit('```json\n{"text": "grasp '), turn, F.lit('", "label": "lift"}\n```'))
    inside = F.concat(F.lit('Sure: {"text": "grasp '), turn, F.lit('", "label": "move"} done'))
    broken = F.concat(F.lit('{"text": "grasp '), turn, F.lit('", "label": "place", '))
    case = F.col("turn") % 4
    raw = F.when(case == 0, whole).when(case == 1, inside).when(case == 2, broken).otherwise("nothing at all")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", raw.alias("raw"))
    return rows.select("conv_id", "turn", T.json_field(F.col("raw"), "text").alias("text"), T.json_field(F.col("raw"), "label").alias("label"))


_LABEL = " ".join(f"WHEN contains(lower(raw), '{a}') THEN '{a}'" for a in T.ACTIONS) + " " + " ".join(f"WHEN contains(raw, '{a}') THEN '{v}'" for a, v in T.ALIASES.items())
_ACTIONS = "[" + ", ".join(f"'{a}'" for a in T.ACTIONS) + "]"
_RAW = "CASE event_id % 6 WHEN 0 THEN 'Please GRASP it' WHEN 1 THEN '她抓住了' WHEN 2 THEN 'place after reach' WHEN 3 THEN '放置' WHEN 4 THEN event_type ELSE '松开' END"


@query(f"SELECT event_id, CASE {_LABEL} ELSE 'move' END AS label FROM (SELECT event_id, {_RAW} AS raw FROM events)")
def label_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.element_at(F.array(F.lit("Please GRASP it"), F.lit("她抓住了"), F.lit("place after reach"), F.lit("放置"), F.col("event_type"), F.lit("松开")), (F.col("event_id") % 6 + 1).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", raw.alias("raw")).select("event_id", T.action(F.col("raw")).alias("label"))


@query(r"""SELECT conv_id, turn, substr(regexp_replace(trim(regexp_replace(text, '[^\p{L}\p{N} ]', '', 'g')), ' +', '-', 'g'), 1, 40) AS slug, coalesce(nullif(substr(translate(text, chr(13) || chr(10), '  '), 1, 60), ''), '[empty]') AS line FROM conversations""")
def slugify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", T.slug(F.col("text")).alias("slug"), T.one_line(F.col("text")).alias("line"))


@query("""SELECT doc_id, concat_ws(' | ', CASE WHEN n_chars > 1000 THEN 'long' END, lang, CASE WHEN quality = 1 THEN 'good' END, source) AS context FROM documents LEFT JOIN labels USING (doc_id)""")
def task_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return docs.select("doc_id", F.concat_ws(" | ", F.when(F.col("n_chars") > 1000, "long"), "lang", F.when(F.col("quality") == 1, "good"), "source").alias("context"))


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN 30000 / 1001.0 WHEN 1 THEN event_id::DOUBLE WHEN 2 THEN NULL ELSE NULL END AS fps FROM events""")
def rate_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    case = F.col("event_id") % 4
    raw = F.when(case == 0, "30000/1001").when(case == 1, F.col("event_id").cast("string")).when(case == 2, "30/0").otherwise("n/a")
    return table(spark, sf_dir, "events").select("event_id", raw.alias("raw")).select("event_id", T.rate(F.col("raw")).alias("fps"))


@query("""SELECT doc_id, sha256('model|prompt|' || array_to_string(list_sort([sha256(coalesce(text, '')), sha256(lang)]), ',')) AS key FROM documents""")
def cache_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strandweave.plans.alignment import keyed_documents

    return keyed_documents(spark, sf_dir).select("doc_id", "key")


@query("SELECT event_id, printf('clip %05d of user %d: %s', event_id, user_id, event_type) AS prompt FROM events")
def prompt_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.format_string("clip %05d of user %d: %s", "event_id", "user_id", "event_type").alias("prompt"))


@query("""WITH n AS (SELECT event_id, user_id, epoch_us(ts) AS s, lead(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS e FROM events)
SELECT event_id, greatest(coalesce(e, s) - s, 0) AS length_us, greatest(least(coalesce(e, s), s + 3600000000) - s, 0) AS overlap_us FROM n""")
def interval_len(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", micros("ts").alias("s"))
    rows = rows.withColumn("e", F.coalesce(F.lead("s").over(ordered(["user_id"], ["s", "event_id"])), "s"))
    none = F.lit(0).cast("long")
    return rows.select("event_id", F.greatest(F.col("e") - F.col("s"), none).alias("length_us"), F.greatest(F.least("e", F.col("s") + F.lit(3_600_000_000)) - F.col("s"), none).alias("overlap_us"))


@query(f"WITH {_PATH}, g AS (SELECT CASE WHEN contains(path, 'en') THEN 'overlay' WHEN contains(path, 'de') THEN 'cloud' WHEN contains(path, '.html') THEN 'page' ELSE 'other' END AS media FROM p) SELECT media, count(*) AS n FROM g GROUP BY media")
def media_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.col("path")
    media = F.when(path.contains("en"), "overlay").when(path.contains("de"), "cloud").when(path.contains(".html"), "page").otherwise("other")
    return paths(spark, sf_dir).groupBy(media.alias("media")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT conv_id, least(greatest(round_even(sum(length(text)) / 100.0, 0), 4), 16)::INTEGER AS samples FROM conversations GROUP BY conv_id")
def sample_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.least(F.greatest(F.bround(F.sum(F.length("text")) / 100.0, 0), F.lit(4.0)), F.lit(16.0))
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(n.cast("int").alias("samples"))


@query(f"""SELECT event_id, {_ACTIONS}[('0x' || substr(sha256(user_id || '|' || event_id || '|*'), 1, 6))::INT % 7 + 1] AS label,
  round(('0x' || substr(sha256(user_id || '|' || event_id || '|*'), 7, 6))::INT / 16777215.0, 6) AS score, 'clip ' || event_id AS text FROM events""")
def annotate_clip_mock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stand-in for a model: label and score follow from a digest of the clip's identity."""
    digest = F.sha2(F.concat_ws("|", F.col("user_id").cast("string"), F.col("event_id").cast("string"), F.lit("*")), 256)
    number = lambda at: F.conv(F.substring(digest, at, 6), 16, 10).cast("long")
    label = F.element_at(F.array(*map(F.lit, T.ACTIONS)), (number(1) % 7 + 1).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", label.alias("label"), F.round(number(7) / 16777215.0, 6).alias("score"), F.concat(F.lit("clip "), F.col("event_id").cast("string")).alias("text"))


@query("""SELECT event_id, round(('0x' || substr(sha256('quality|' || event_id), 1, 6))::INT / 16777215.0, 6) AS overall, ('0x' || substr(sha256('quality|' || event_id), 1, 6))::INT / 16777215.0 >= 0.4 AS kept FROM events""")
def frame_quality_mock(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.sha2(F.concat(F.lit("quality|"), F.col("event_id").cast("string")), 256)
    score = F.conv(F.substring(digest, 1, 6), 16, 10).cast("long") / 16777215.0
    return table(spark, sf_dir, "events").select("event_id", F.round(score, 6).alias("overall"), (score >= 0.4).alias("kept"))


@query("""WITH f AS (SELECT role || ' ' || length(text) % 5 AS task, min(conv_id * 1000 + turn) AS first FROM conversations GROUP BY 1), r AS (SELECT task, row_number() OVER (ORDER BY first) - 1 AS task_index FROM f),
n AS (SELECT conv_id, count(*) AS length, min(conv_id * 1000 + turn) AS first FROM conversations GROUP BY conv_id),
e AS (SELECT *, sum(length) OVER (ORDER BY conv_id ROWS UNBOUNDED PRECEDING)::BIGINT AS dataset_to FROM n), k AS (SELECT conv_id, role || ' ' || length(text) % 5 AS task FROM conversations WHERE turn = 0)
SELECT conv_id, length, dataset_to - length AS dataset_from, dataset_to, task_index FROM e JOIN k USING (conv_id) JOIN r USING (task)""")
def task_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks numbered as first seen, and each episode's place in the whole dataset.

    Episodes' lengths are summed by ranges of ids first, so that the running
    sum over all is over ranges.
    """
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.concat(F.col("role"), F.lit(" "), (F.length("text") % 5).cast("string")).alias("task"))
    tasks = rows.groupBy("task").agg(F.min(F.struct("conv_id", "turn")).alias("first")).select("task", "first.*")
    tasks = numbered(tasks, "conv_id", ["conv_id", "turn"], "task_index").select("task", "task_index")
    sizes = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("length"), F.min_by("task", "turn").alias("task")).withColumn("cell", F.expr("conv_id div 4096"))
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = sizes.groupBy("cell").agg(F.sum("length").alias("s")).select("cell", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("base"))
    to = F.col("base") + F.sum("length").over(Window.partitionBy("cell").orderBy("conv_id").rowsBetween(Window.unboundedPreceding, 0))
    placed = sizes.join(cells, "cell").withColumn("dataset_to", to)
    return placed.join(tasks, "task").select("conv_id", "length", (F.col("dataset_to") - F.col("length")).alias("dataset_from"), "dataset_to", "task_index")
