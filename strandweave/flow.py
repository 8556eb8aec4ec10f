"""The sensor flow: discover, validate, align, score and route, pack, report.

Each step is a DataFrame function; ``run`` writes what they return and goes on
from what it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandweave.config import Alignment
from strandweave.functions import text
from strandweave.operators.align import nearest
from strandweave.operators.segment import shards
from strandweave.operators.stats import reasons
from strandweave.sources import records, sinks

#: The metadata keys that hold a label, in the order of search.
LABELS = ["label", "action", "state"]
PAYLOAD = ["path", "modality", "sensor_id", "frame_id", "metadata"]


def discover(spark: SparkSession, source: str, manifest: str | None = None, session: str = "default", settings: Alignment = Alignment()) -> DataFrame:
    """Records of a manifest, or of all files under ``source``; rows of a manifest without a path stay, for ``validate``."""
    if manifest is None:
        return records.scan(spark, source, session, settings.extensions, settings.skipped).drop("length")
    return records.all_normalized(records.manifest(spark, manifest), source)


def listing(spark: SparkSession, source: str, *more: str) -> DataFrame:
    """file (relative to ``source``), length and ``more`` of the files under ``source``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source)
    root = source.rstrip("/").removeprefix("file:") + "/"
    return files.select(F.element_at(F.split("path", root, 2), -1).alias("file"), "length", *more)


def validate(found: DataFrame, files: DataFrame, source: str) -> DataFrame:
    """``found`` with ``validation_errors``, empty for valid rows.

    Paths under ``source`` must be in ``files`` (file); those elsewhere are
    not looked up.
    """
    root = source.rstrip("/").removeprefix("file:") + "/"
    file = F.when(F.col("path").startswith(root), F.substring("path", len(root) + 1, 2**31 - 1)).otherwise(F.col("path"))
    known = files.select(F.col("file").alias("_file"), F.lit(True).alias("_there")).distinct()
    rules = {
        "missing_path": F.col("path").isNull(),
        "missing_file": F.col("path").isNotNull() & ~file.startswith("/") & F.col("_there").isNull(),
        "missing_timestamp_ns": F.col("timestamp_ns").isNull(),
        "missing_stream": F.coalesce(F.col("stream"), F.lit("")) == "",
    }
    joined = found.join(known, file == F.col("_file"), "left")
    return joined.select(*found.columns, reasons(rules).alias("validation_errors"))


def align(found: DataFrame, settings: Alignment = Alignment()) -> DataFrame:
    """One sample per anchor: sample_id, session_id, anchor_stream, timestamp_ns, streams, missing_streams.

    Anchors are the records of the anchor's stream or modality, in a session
    without one those of its first expected stream.  A session expects the
    streams it has, in order of their names, unless the settings name some.
    Repeated records give one sample.
    """
    anchor = (F.col("stream") == settings.anchor) | (F.col("modality") == settings.anchor)
    seen = F.array_sort(F.collect_set("stream"))
    expected = F.array(*map(F.lit, settings.expected)) if settings.expected else seen
    sessions = found.groupBy("session_id").agg(expected.alias("expected"), F.max(anchor).alias("_has"))
    chosen = F.when(F.col("_has"), anchor).otherwise(F.col("stream") == F.col("expected")[0])
    at = (
        found.join(sessions, "session_id")
        .where(chosen)
        .select("session_id", "timestamp_ns", F.col("path").alias("anchor_path"), F.col("stream").alias("anchor_stream"), "expected")
        .distinct()
        .withColumn("stream", F.explode("expected"))
    )
    near = nearest(at, found.select("session_id", "stream", "timestamp_ns", *PAYLOAD), ["session_id", "stream"], "timestamp_ns", PAYLOAD, "path")
    entry = F.struct("stream", F.col("found.*"), F.round(F.col("delta") / 1e6, 6).alias("delta_ms"))
    within = F.col("delta") <= settings.tolerance_ms * 1e6
    value = lambda e: F.struct(*[e[c].alias(c) for c in [*PAYLOAD, "timestamp_ns", "delta_ms"]])
    return (
        near.groupBy("session_id", "timestamp_ns", "anchor_path", "anchor_stream", "expected")
        .agg(F.collect_list(F.when(within, entry)).alias("_found"))
        # few streams: their order is that of the expected ones
        .withColumn("_found", F.filter(F.transform("expected", lambda s: F.get(F.filter("_found", lambda e: e["stream"] == s), F.lit(0))), lambda e: e.isNotNull()))
        .select(
            text.sample_id(F.col("session_id"), F.col("timestamp_ns"), F.col("anchor_path")).alias("sample_id"),
            "session_id",
            "anchor_stream",
            "timestamp_ns",
            F.map_from_entries(F.transform("_found", lambda e: F.struct(e["stream"], value(e)))).alias("streams"),
            F.array_except("expected", F.transform("_found", lambda e: e["stream"])).alias("missing_streams"),
        )
    )


def annotate(samples: DataFrame, accept: float = Alignment.accept) -> DataFrame:
    """Adds ``label``, ``confidence`` and ``accepted``.

    Confidence is the least of completeness, 1 less the largest offset in
    units of 100 ms, and the metadata's score; 0 without any stream.
    """
    own = F.map_values("streams")
    field = lambda v, k: F.nullif(F.get_json_object(v["metadata"], f"$.{k}"), F.lit(""))
    labels = F.filter(F.transform(own, lambda v: F.coalesce(*[field(v, k) for k in LABELS])), lambda x: x.isNotNull())
    n, missing = F.size("streams"), F.size("missing_streams")
    timing = F.greatest(F.lit(0.0), 1 - F.coalesce(F.array_max(F.transform(own, lambda v: v["delta_ms"])), F.lit(0.0)) / 100)
    readable = F.filter(F.transform(own, lambda v: field(v, "confidence").try_cast("double")), lambda x: x.isNotNull())
    stated = F.array_max(F.transform(readable, lambda x: F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))))
    score = F.least(F.when(F.exists(own, lambda v: field(v, "label").isNotNull()), 1.0).otherwise(0.5), F.coalesce(stated, F.lit(1.0)))
    confidence = F.when(n == 0, 0.0).otherwise(F.round(F.least(n / (n + missing), timing, score), 4))
    out = samples.withColumn("label", F.coalesce(F.get(labels, F.lit(0)), F.lit("unlabeled"))).withColumn("confidence", confidence)
    return out.withColumn("accepted", F.col("confidence") >= accept)


def pack(accepted: DataFrame, files: DataFrame, most: int = Alignment.shard_bytes) -> DataFrame:
    """Members of archives: session_id, shard, sample_id, name, data; a sample's document and its streams' files.

    ``files``: file, length, content.  Shards are filled in order of time and
    numbered within a session, so that sessions don't wait for each other.
    """
    document = F.to_json(F.struct(*sorted(accepted.columns))).cast("binary")
    # a sample without a file still takes part in the order, with no payload
    each = accepted.select("sample_id", F.explode(F.map_values("streams")).alias("v")).select("sample_id", F.col("v.path").alias("file"))
    sizes = each.join(files.select("file", "length"), "file").groupBy("sample_id").agg(F.sum("length").alias("payload"))
    sized = accepted.join(sizes, "sample_id", "left").select("session_id", "timestamp_ns", "sample_id", document.alias("document"), F.coalesce("payload", F.lit(0)).alias("payload"), "streams")
    dealt = shards(sized.select("session_id", "timestamp_ns", "sample_id", "payload", F.octet_length("document").alias("head")), "session_id", ["timestamp_ns", "sample_id"], "payload", most, "head")
    dealt = dealt.select(F.col("sample_id").alias("_id"), "shard")
    placed = sized.join(dealt, F.col("sample_id") == F.col("_id")).drop("_id", "payload")
    head = placed.select("session_id", "shard", "sample_id", F.concat("sample_id", F.lit(".json")).alias("name"), F.col("document").alias("data"))
    streams = placed.select("session_id", "shard", "sample_id", F.explode("streams").alias("stream", "v"))
    suffix = F.regexp_extract("file", r"(\.[^./]+)$", 1)
    body = streams.join(files.select("file", "content"), F.col("v.path") == F.col("file")).select(
        "session_id",
        "shard",
        "sample_id",
        F.concat("sample_id", F.lit("."), text.safe_name(F.col("stream")), F.when(suffix == "", ".bin").otherwise(suffix)).alias("name"),
        F.col("content").alias("data"),
    )
    return head.unionByName(body)


def run(spark: SparkSession, source: str, output: str, settings: Alignment = Alignment(), manifest: str | None = None, session: str = "default") -> dict:
    """The whole flow; returns the report, which is written too.

    Under ``output``: manifests/raw, validated and invalid; aligned samples;
    annotation/accepted and review; shards with their index; report.
    """
    stages: list[dict] = []

    def put(df: DataFrame, name: str) -> int:
        return sinks.write_jsonl(df, f"{output}/{name}")

    def done(name: str, **metrics) -> None:
        stages.append({"name": name, "metrics": metrics})

    found = discover(spark, source, manifest, session, settings)
    done("discover", records=put(found, "manifests/raw"), mode="manifest" if manifest else "directory_scan")
    raw = records.stage(spark, f"{output}/manifests/raw")
    checked = validate(raw, listing(spark, source), source)
    bad = F.size("validation_errors") > 0
    valid = put(checked.where(~bad).drop("validation_errors"), "manifests/validated")
    done("validate", valid=valid, invalid=put(checked.where(bad), "manifests/invalid"))
    samples = align(records.stage(spark, f"{output}/manifests/validated"), settings)
    kind = samples.schema
    n = put(samples, "manifests/aligned")
    samples = records.stage(spark, f"{output}/manifests/aligned", kind)
    missing = samples.agg(F.coalesce(F.sum(F.size("missing_streams")), F.lit(0))).first()[0]
    done("align", samples=n, missing_stream_refs=missing)
    judged = annotate(samples, settings.accept)
    accepted = put(judged.where("accepted").drop("accepted"), "annotation/accepted")
    review = judged.where("not accepted").drop("accepted").withColumns({"review_reason": F.lit("confidence_below_threshold"), "threshold": F.lit(settings.accept)})
    done("annotate", accepted=accepted, review=put(review, "annotation/review"), threshold=settings.accept)
    kept = judged.where("accepted").drop("accepted")
    members = pack(kept, listing(spark, source, "content"), settings.shard_bytes)
    archives = sinks.tar_shards(members, ["session_id", "shard"], "name", "data")
    archives.write.mode("overwrite").parquet(f"{output}/shards/archives")
    index = members.where(F.col("name") == F.concat("sample_id", F.lit(".json"))).select("sample_id", "session_id", "shard")
    packed = put(index, "shards/index")
    done("pack", samples_packed=packed, shards=spark.read.parquet(f"{output}/shards/archives").count())
    report = {"input": source, "output": output, "stages": stages}
    sinks.write_document(report, f"{output}/report", spark)
    return report
