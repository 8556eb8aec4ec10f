"""Takes recorded sessions in: finds them, checks them, aligns them to their RGB frames and writes them in normal form.

Every step works on all sessions at once; a session with errors isn't written
unless that is asked for.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandweave.config import Strict, dataclasses
from strandweave.operators import ingest
from strandweave.operators.align import in_intervals, positional
from strandweave.sources import normal, sessions, sinks


@dataclasses.dataclass(frozen=True)
class Settings(Strict):
    """Names of a session's files, and how frames are paired."""

    manifest: str = "config.json"
    task: str = "task_info.json"
    rgb: str = "rgb_head.mp4"
    rgb_times: str = "rgb_head.csv"
    depth: str = "depth_head.mkv"
    depth_times: str = "depth_head.csv"
    imu: str = "imu.txt"
    hands: str = "hands_keypoint_3d.json"
    pose: str = "head_hands_sixdof.*.csv"
    calibration: str = "camera_params/head_param.json"
    fps: float = 30.0
    copy: bool = False
    tail: bool = True


CAMERA = "rgb_camera struct<intrinsic:struct<fx:double,fy:double,ppx:double,ppy:double,width:int,height:int>>"


def _read(spark: SparkSession, pattern: str, read: Callable[[SparkSession, str], DataFrame], schema: str) -> DataFrame:
    """What ``read`` makes of the files that fit; empty if none does."""
    at = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at):
        return spark.createDataFrame([], schema)
    return read(spark, pattern)


def times(spark: SparkSession, root: str, name: str) -> DataFrame:
    """session_id, row (from 0, as in the file), frame_index, t of the time files called ``name``."""
    rows = _read(spark, f"{root}/*/{name}", sessions.timestamps, "frame_index long, timestamp_s double, session_id string")
    w = Window.partitionBy("session_id").orderBy("_at")
    rows = rows.withColumn("_at", F.monotonically_increasing_id())  # a session's file is one split, or several in order
    return rows.select("session_id", (F.row_number().over(w) - 1).cast("long").alias("row"), "frame_index", F.col("timestamp_s").alias("t"))


def calibrations(spark: SparkSession, root: str, name: str) -> DataFrame:
    def read(spark: SparkSession, pattern: str) -> DataFrame:
        depth = name.count("/") + 2
        rows = spark.read.option("multiLine", True).schema(CAMERA).json(pattern).withColumn("session_id", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -depth))
        k = F.col("rgb_camera.intrinsic")
        return rows.select("session_id", k["fx"].alias("fx"), k["fy"].alias("fy"), k["ppx"].alias("cx"), k["ppy"].alias("cy"), k["width"].alias("width"), k["height"].alias("height"))

    return _read(spark, f"{root}/*/{name}", read, f"session_id string, {normal.TABLES['calibration']}")


def declared(spark: SparkSession, root: str, found: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """Each session's declared counts and duration, and the declared files that aren't there (name, note, actual)."""
    items = sessions.manifests(spark, f"{root}/*/{settings.manifest}")
    of = lambda name: F.max(F.when(F.col("name") == name, F.col("count")))
    counts = items.groupBy("session_id").agg(of("rgb_head").alias("rgb_count"), of("depth_head").alias("depth_count"), F.max("duration").alias("duration_s"))
    names = found.select("session_id", F.explode("files").alias("file"))
    lost = items.where("file is not null").select("session_id", "name", "file").join(names, ["session_id", "file"], "left_anti")
    stem = F.regexp_replace("file", r"\.[^.]*$", "")
    others = names.select("session_id", F.col("file").alias("actual"))
    near = lost.join(others, [lost.session_id == others.session_id, F.col("actual").startswith(stem)], "left").groupBy(lost.session_id, "name", "file").agg(F.max("actual").alias("actual"))
    note = F.concat(F.col("file"), F.lit(" isn't there"), F.when(F.col("actual").isNotNull(), F.concat(F.lit("; found "), F.col("actual"))).otherwise(""))
    return counts, near.select("session_id", "name", note.alias("note"), "actual")


def run(spark: SparkSession, root: str, output: str, settings: Settings = Settings(), even_with_errors: bool = False) -> dict:
    """Takes in all sessions under ``root``; returns the report, which is written too.

    Under ``output``: issues (JSON lines), the tables of ``normal`` and
    report.  Head poses and depth frames are paired by their places, hands by
    the time in their keys, IMU samples cropped to the frames' time.
    """
    root, output = root.rstrip("/"), output.rstrip("/")
    found = sessions.found(spark, root, (settings.manifest, settings.rgb))
    ids = found.select("session_id")
    has = lambda name: F.array_contains("files", name)
    rgb, depth = (times(spark, root, n).join(ids, "session_id", "left_semi") for n in (settings.rgb_times, settings.depth_times))
    camera = calibrations(spark, root, settings.calibration)
    counts, mismatches = declared(spark, root, found, settings)
    facts = (
        found.select("session_id", has(settings.rgb_times).alias("rgb_file"), has(settings.depth_times).alias("depth_file"), has(settings.imu).alias("has_imu"))
        .join(counts, "session_id", "left")
        .join(camera.select("session_id", "fx", "fy"), "session_id", "left")
        .withColumn("notes", F.array().cast("array<string>"))
    )
    frames = rgb.withColumn("stream", F.lit("rgb")).unionByName(depth.withColumn("stream", F.lit("depth")))
    sinks.write_jsonl(ingest.issues(facts, frames, mismatches.join(ids, "session_id", "left_semi"), settings.fps), f"{output}/issues")
    issues = spark.read.schema("session_id string, code string, severity string, message string").json(f"{output}/issues")
    bad = issues.where("severity = 'error'").select("session_id").distinct()
    good = ids if even_with_errors else ids.join(bad, "session_id", "left_anti")
    own = rgb.join(good, "session_id", "left_semi")
    paired = positional(own.select("session_id", "row", "frame_index", "t"), depth.select("session_id", F.col("row").alias("_row"), F.col("t").alias("depth_t")).withColumnRenamed("_row", "row").select("session_id", "row", "depth_t"), ["session_id"], ["row"])
    index = paired.select("session_id", "frame_index", F.col("t").alias("rgb_timestamp_s"), F.col("depth_t").alias("depth_timestamp_s"))
    kind = "timestamp_s double, tx double, ty double, tz double, qx double, qy double, qz double, qw double, session_id string"
    pose = _read(spark, f"{root}/*/{settings.pose.replace('.*', '*')}", sessions.head_poses, kind)
    at = F.row_number().over(Window.partitionBy("session_id").orderBy("timestamp_s")) - 1
    poses = pose.withColumn("row", at.cast("long")).join(own.select("session_id", "row", "frame_index"), ["session_id", "row"])
    hand_kind = "session_id string, key string, excluded boolean, exclude_reason string, pos int, is_right boolean, confidence string, keypoints_3d_cam_m map<string,array<double>>"
    hands = _read(spark, f"{root}/*/{settings.hands}", sessions.key_points, hand_kind)
    kept = hands.where("is_right is not null") if not settings.tail else hands.where("is_right is not null and not coalesce(excluded, false)")
    keyed = own.select("session_id", F.format_string("%.6f", "t").alias("key"), "frame_index")
    flat = F.flatten(F.transform(F.array_sort(F.map_entries("keypoints_3d_cam_m")), lambda e: e["value"]))
    points = kept.join(keyed, ["session_id", "key"]).select(
        "session_id", "frame_index", F.when(F.col("is_right"), "right").otherwise("left").alias("hand"), F.lit(True).alias("present"), (F.size(flat) == normal.POINTS).alias("valid"), flat.alias("points")
    )
    spans = own.groupBy("session_id").agg(F.min("t").alias("first"), (F.max("t") + 1 / settings.fps).alias("last"))
    micro = lambda c: F.round(F.col(c) * 1e6).cast("long")
    motion = _read(spark, f"{root}/*/{settings.imu}", sessions.imu, "session_id string, ts double, acc array<double>, gyr array<double>")
    imu = in_intervals(motion.withColumn("_t", micro("ts")), spans.select("session_id", micro("first").alias("_s"), micro("last").alias("_e")), ["session_id"], "_t", "_s", "_e", 60_000_000)
    media = found.join(good, "session_id", "left_semi").select("session_id", F.explode("files").alias("name")).where(F.col("name").isin(settings.rgb, settings.depth))
    media = media.withColumn("path", F.concat(F.lit(root.removeprefix("file:") + "/"), "session_id", F.lit("/"), "name"))
    tasks = _read(spark, f"{root}/*/{settings.task}", sessions.tasks, f"{sessions.TASK}, session_id string").join(good, "session_id", "left_semi")
    document = F.to_json(F.struct(*[c for c in tasks.columns if c != "session_id"]))
    normal.write(
        {
            "frame_index": index,
            "head_pose": poses,
            "hand_keypoints": points,
            "imu": imu,
            "calibration": camera.join(good, "session_id", "left_semi"),
            "task": tasks.select("session_id", document.alias("document")),
            "media": normal.materialised(media, f"{output}/files", settings.copy),
        },
        output,
    )
    counted = issues.groupBy("severity", "code").count().orderBy("severity", "code").collect()  # 14 codes
    written = normal.frame_counts(normal.read(spark, output, "frame_index")).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("n_frames"), F.lit(0)).alias("frames")).first()
    report = {"sessions": found.count(), "written": written["n"], "frames": written["frames"], "issues": {f"{r['severity']}:{r['code']}": r["count"] for r in counted}}
    sinks.write_document(report, f"{output}/report", spark)
    return report
