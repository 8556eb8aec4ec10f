"""Sensor records from folders, manifests and stage files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strandweave.functions import text as T

#: Names of folders and files that a scan skips, in either case.
SKIPPED = [".git", "__pycache__", ".venv", "venv", "processed"]
#: A larger sidecar counts as none.
SIDECAR_BYTES = 5 * 1024 * 1024
RECORD = "session_id string, stream string, modality string, sensor_id string, timestamp_ns bigint, path string, frame_id string, metadata string"
#: The keys of a manifest row.
KEYS = "session_id stream modality sensor_id sensor timestamp_ns timestamp_us timestamp_ms timestamp_s timestamp path file uri frame_id metadata".split()


def scan(
    spark: SparkSession, folder: str, session: str = "session", extensions: dict[str, list[str]] = T.EXTENSIONS, skipped: Sequence[str] = SKIPPED
) -> DataFrame:
    """One record per file under ``folder`` whose modality and time can be told.

    The time is in the file's name, else in the document of a JSON file; no
    other contents are read.  ``metadata`` is that document with ``discovered``.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "length")
    root = folder.rstrip("/").removeprefix("file:")
    path = F.element_at(F.split("path", root + "/", 2), -1)
    name = F.element_at(F.split(path, "/"), -1)
    modality = T.modality(path, extensions)
    known = sidecars(spark, folder).select(F.col("path").alias("_path"), "metadata")
    files = files.join(known, F.col("path") == F.col("_path"), "left")
    stated = {k: F.try_variant_get("metadata", f"$.{k}", "string") for k in KEYS if k.startswith("timestamp")}
    rows = files.select(
        F.lit(session).alias("session_id"),
        modality.alias("modality"),
        T.sensor(path, modality).alias("sensor_id"),
        F.coalesce(T.digits_to_ns(name), timestamp_ns(stated)).alias("timestamp_ns"),
        path.alias("path"),
        F.regexp_replace(name, r"\.[^.]*$", "").alias("frame_id"),
        _with_member(F.coalesce(F.to_json("metadata"), F.lit("{}")), "discovered", F.lit("true")).alias("metadata"),
        "length",
    )
    names = F.array(*[F.lit(x.lower()) for x in skipped]).cast("array<string>")
    rows = rows.where(F.col("modality").isNotNull() & F.col("timestamp_ns").isNotNull() & ~F.arrays_overlap(F.split(F.lower("path"), "/"), names))
    return rows.withColumn("stream", F.concat_ws(":", "modality", "sensor_id"))


def _with_member(document: Column, name: str, value: Column) -> Column:
    """A JSON object with one member more; both are texts."""
    open_end = F.concat(F.regexp_replace(document, r"\s*\}\s*$", ""), F.when(document.rlike(r"^\s*\{\s*\}\s*$"), "").otherwise(","))
    return F.concat(open_end, F.lit(f'"{name}":'), value, F.lit("}"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """A manifest in JSON lines, or in CSV with a header, as text columns."""
    if path.rstrip("/").endswith(".csv"):
        return spark.read.option("header", True).csv(path)
    return spark.read.option("primitivesAsString", True).json(path)


def timestamp_ns(of: dict[str, Column]) -> Column:
    """Whole numbers keep all their digits; without a unit its size tells it."""
    def scaled(c: Column, k: int) -> Column:
        return F.coalesce(c.try_cast("long") * k, (c.try_cast("double") * k).cast("long"))

    plain = of["timestamp"]
    size = plain.try_cast("double")
    unitless = F.when(size > 10**15, scaled(plain, 1)).when(size > 10**12, scaled(plain, 1000)).when(size > 10**9, scaled(plain, 10**6)).otherwise(scaled(plain, 10**9))
    return F.coalesce(scaled(of["timestamp_ns"], 1), scaled(of["timestamp_us"], 1000), scaled(of["timestamp_ms"], 10**6), scaled(of["timestamp_s"], 10**9), unitless)


def normalized(rows: DataFrame, root: str = "") -> tuple[DataFrame, DataFrame]:
    """Records, and the rows without a path."""
    name = [F.nullif(F.col(k).cast("string"), F.lit("")) for k in ("path", "file", "uri") if k in rows.columns]
    return all_normalized(rows, root).where("path is not null"), rows.where(F.coalesce(*name, F.lit(None)).isNull())


def all_normalized(rows: DataFrame, root: str = "") -> DataFrame:
    """A record for each row, even without a path; keys that no record has are gathered in metadata.manifest_extra.

    Paths under ``root`` are stored from there on.  Metadata that is no JSON
    object stands under raw_metadata.
    """
    of = {k: F.nullif(F.col(k).cast("string"), F.lit("")) if k in rows.columns else F.lit(None).cast("string") for k in KEYS}
    name = F.coalesce(of["path"], of["file"], of["uri"])
    base = root.rstrip("/") + "/"
    inside = F.lit(bool(root)) & name.startswith(base)
    stored = F.when(inside, F.substring(name, len(base) + 1, 2**31 - 1)).otherwise(name)
    extra = [c for c in rows.columns if c not in KEYS]
    rest = F.to_json(F.struct(*[F.col(c) for c in extra])) if extra else F.lit("{}")
    if "metadata" in rows.columns and isinstance(rows.schema["metadata"].dataType, StructType):
        own = F.coalesce(F.to_json("metadata"), F.lit("{}"))
    else:
        text = of["metadata"]
        raw = F.to_json(F.struct(text.alias("raw_metadata")))
        own = F.when(text.isNull(), "{}").when(F.schema_of_variant(F.try_parse_json(text)).startswith("OBJECT"), F.trim(text)).otherwise(raw)
    modality = F.coalesce(of["modality"], T.modality(name), F.lit("unknown"))
    sensor = F.coalesce(of["sensor_id"], of["sensor"], modality)
    stem = F.regexp_replace(F.element_at(F.split(name, "/"), -1), r"(?<=.)\.[^.]*$", "")
    return rows.select(
        F.coalesce(of["session_id"], F.lit("session")).alias("session_id"),
        F.coalesce(of["stream"], F.concat_ws(":", modality, sensor)).alias("stream"),
        modality.alias("modality"),
        sensor.alias("sensor_id"),
        timestamp_ns(of).alias("timestamp_ns"),
        stored.alias("path"),
        F.coalesce(of["frame_id"], stem).alias("frame_id"),
        F.when(rest == "{}", own).otherwise(_with_member(own, "manifest_extra", rest)).alias("metadata"),
    )


def sidecars(spark: SparkSession, folder: str) -> DataFrame:
    """path and metadata (variant) of the JSON files under ``folder``; null if too large, broken or no object."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").load(folder)
    parsed = F.try_parse_json(F.when(F.col("length") <= SIDECAR_BYTES, F.decode("content", "UTF-8")))
    return files.select("path", F.when(F.schema_of_variant(parsed).startswith("OBJECT"), parsed).alias("metadata"))


def stage(spark: SparkSession, path: str, schema: str = RECORD) -> DataFrame:
    """A stage file of JSON lines; blank lines are skipped."""
    return spark.read.schema(schema).json(path)


def demo(spark: SparkSession, session: str = "demo", start_ns: int = 1_700_000_000_000_000_000) -> DataFrame:
    """Records of four streams at three times 33 ms apart."""
    streams = [("rgb", "cam_left", "jpg"), ("depth", "depth", "npy"), ("imu", "imu", "json"), ("pose", "pose", "json")]
    rows = [(session, f"{m}:{s}", m, s, start_ns + i * 33_000_000, f"{s}/{start_ns + i * 33_000_000}.{e}", None, '{"label":"pick","confidence":0.96}') for m, s, e in streams for i in range(3)]
    return spark.createDataFrame(rows, RECORD)
