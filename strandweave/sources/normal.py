"""Sessions in normal form: one Parquet table for each kind of data, parted by session, with documents and media beside them.

Writing a session again replaces its parts; other sessions stay.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandweave.functions import rotation as R
from strandweave.functions.text import rate

#: The tables of a session, and their columns.
TABLES = {
    "frame_index": "frame_index long, rgb_timestamp_s double, depth_timestamp_s double",
    "head_pose": "frame_index long, tx double, ty double, tz double, qx double, qy double, qz double, qw double",
    "hand_keypoints": "frame_index long, hand string, present boolean, valid boolean, points array<double>, pose array<double>, betas array<double>, orient array<double>",
    "imu": "ts double, acc array<double>, gyr array<double>",
    "audio": "frame long, samples array<int>",
    "calibration": "fx double, fy double, cx double, cy double, width int, height int",
    "task": "document string",
    "media": "name string, kind string, path string",
}
POINTS, POSE, BETAS, ORIENT = 63, 45, 10, 3
PROBE = "fps double, n_frames long, width int, height int, duration_s double"


def write(parts: dict[str, DataFrame], root: str) -> None:
    """Writes ``parts`` (name: session_id and the table's columns); columns that lack are null.  Sessions there are replaced."""
    for name, df in parts.items():
        kinds = {f.name: f.dataType for f in df.sparkSession.createDataFrame([], TABLES[name]).schema}
        columns = [F.col(c).cast(k).alias(c) if c in df.columns else F.lit(None).cast(k).alias(c) for c, k in kinds.items()]
        out = df.select(F.col("session_id").cast("string").alias("session_id"), *columns).repartition("session_id")
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("session_id").parquet(f"{root}/{name}")


def read(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of all sessions; empty if there is none of its kind."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
    schema = f"{TABLES[name]}, session_id string"
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root}/{name}")


def frame_counts(frames: DataFrame) -> DataFrame:
    """session_id, n_frames and fps (from the first to the last time; 30 where that tells nothing)."""
    span = F.max_by("rgb_timestamp_s", "frame_index") - F.min_by("rgb_timestamp_s", "frame_index")
    n = F.count(F.lit(1))
    return frames.groupBy("session_id").agg(n.alias("n_frames"), F.when((n >= 2) & (span > 1e-9), (n - 1) / span).otherwise(30.0).alias("fps"))


def poses(frames: DataFrame, head: DataFrame) -> DataFrame:
    """session_id, frame_index, rotation (nine numbers) and place of the camera: a frame's own or the last one before it, else none moved."""
    own = head.select("session_id", "frame_index", F.struct(R.matrix_of_quaternion(F.array("qw", "qx", "qy", "qz")).alias("rotation"), F.array("tx", "ty", "tz").alias("place")).alias("own"))
    last = F.last("own", ignorenulls=True).over(Window.partitionBy("session_id").orderBy("frame_index").rowsBetween(Window.unboundedPreceding, 0))
    still = F.struct(F.array(*[F.lit(float(i % 4 == 0)) for i in range(9)]).alias("rotation"), F.array(*[F.lit(0.0)] * 3).alias("place"))
    rows = frames.select("session_id", "frame_index").join(own, ["session_id", "frame_index"], "left")
    return rows.select("session_id", "frame_index", F.coalesce(last, still).alias("pose")).select("session_id", "frame_index", "pose.rotation", "pose.place")


def _finite(c: str, n: int) -> Column:
    return F.when((F.size(c) == n) & F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.col(c))


def hands(keypoints: DataFrame) -> DataFrame:
    """session_id, frame_index, hand, valid and points, pose, betas, orient, each null unless whole and finite."""
    kept = {c: _finite(c, n) for c, n in (("points", POINTS), ("pose", POSE), ("betas", BETAS), ("orient", ORIENT))}
    present = F.coalesce("present", F.lit(False))
    rows = keypoints.select("session_id", "frame_index", "hand", *[F.when(present, v).alias(c) for c, v in kept.items()])
    return rows.withColumn("valid", F.col("points").isNotNull())


def visible(frames: DataFrame, keypoints: DataFrame) -> DataFrame:
    """session_id, frame_index and whether a hand is valid there; all frames of a session without any hand's rows are."""
    known = keypoints.groupBy("session_id", "frame_index").agg(F.bool_or(F.coalesce("valid", F.lit(False))).alias("seen"))
    told = keypoints.select("session_id").distinct().withColumn("told", F.lit(True))
    rows = frames.select("session_id", "frame_index").join(known, ["session_id", "frame_index"], "left").join(told, "session_id", "left")
    return rows.select("session_id", "frame_index", F.when(F.col("told"), F.coalesce("seen", F.lit(False))).otherwise(True).alias("visible"))


def intrinsics(calibration: DataFrame, videos: DataFrame, fov: float | None = None) -> DataFrame:
    """session_id, width, height, fx, fy, cx, cy, hfov, vfov (degrees) at the videos' (session_id, width, height) resolution.

    A session without a calibration gets its middle as centre, and as focal
    lengths that of ``fov`` degrees across, else its width and height.
    """
    c = calibration.select("session_id", "fx", "fy", "cx", "cy", F.nullif("width", F.lit(0)).alias("_w"), F.nullif("height", F.lit(0)).alias("_h"))
    rows = videos.select("session_id", "width", "height").join(c, "session_id", "left")
    sides = {"x": ("width", "_w"), "y": ("height", "_h")}
    out = {}
    for a, (size, own) in sides.items():
        ratio = F.coalesce(F.col(size) / F.col(own), F.lit(1.0))
        out[f"f{a}"] = F.coalesce(F.col(f"f{a}"), F.col(size).cast("double") if fov is None else F.col("width") / (2 * math.tan(math.radians(fov) / 2))) * ratio
        out[f"c{a}"] = F.coalesce(F.col(f"c{a}"), F.col(size) / 2) * ratio
    fov = lambda size, f: F.when(f != 0, F.degrees(F.atan(F.col(size) / 2 / f)) * 2).otherwise(0.0)
    return rows.select("session_id", "width", "height", *[v.alias(k) for k, v in out.items()], fov("width", out["fx"]).alias("hfov"), fov("height", out["fy"]).alias("vfov"))


def probed(text: Column) -> Column:
    """A video's probe document as a struct PROBE; null if it names no stream.

    Lacking frames or duration follow from the others.
    """
    of = F.from_json(text, "streams array<struct<width:int,height:int,r_frame_rate:string,avg_frame_rate:string,nb_frames:string,nb_read_frames:string,duration:string>>, format struct<duration:string>")
    s = F.get(of["streams"], F.lit(0))
    fps = F.coalesce(rate(F.coalesce(s["r_frame_rate"], s["avg_frame_rate"])), F.lit(0.0))
    counted = F.coalesce(F.coalesce(s["nb_frames"], s["nb_read_frames"]).try_cast("long"), F.lit(0))
    stated = F.coalesce(s["duration"], of["format"]["duration"]).try_cast("double")
    duration = F.coalesce(stated, F.when(fps > 0, counted / fps).otherwise(0.0))
    n = F.when((counted == 0) & (fps > 0), F.bround(fps * duration, 0).cast("long")).otherwise(counted)
    return F.when(s.isNotNull(), F.struct(fps.alias("fps"), n.alias("n_frames"), F.coalesce(s["width"], F.lit(0)).alias("width"), F.coalesce(s["height"], F.lit(0)).alias("height"), duration.alias("duration_s")))


def _asked(videos: DataFrame, run, arguments: list[str], binary: str) -> DataFrame:
    """Adds ``_text``, what a program says of each ``path``, and ``probe_error``."""
    import pandas as pd

    def call(path: str) -> str:
        import subprocess

        return subprocess.run([binary, "-v", "error", "-select_streams", "v:0", *arguments, "-of", "json", path], check=True, capture_output=True, text=True, timeout=60).stdout

    ask = run or call

    def asked(batches):
        for rows in batches:
            texts, errors = [], []
            for path in rows["path"]:
                try:
                    texts.append(ask(path))
                    errors.append(None)
                except Exception as e:  # one broken file doesn't end the job
                    texts.append(None)
                    errors.append(f"{type(e).__name__}: {e}"[:500])
            yield pd.DataFrame({**{c: rows[c] for c in rows}, "_text": texts, "probe_error": errors})

    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in videos.schema)
    return videos.mapInPandas(asked, f"{columns}, _text string, probe_error string")


def probe(videos: DataFrame, run=None, binary: str = "ffprobe") -> DataFrame:
    """Adds PROBE's columns to ``videos`` (path), and ``probe_error``; ``run`` takes a path and gives the document's text.

    By default ``binary`` is called on the executor that has the row; a
    video that fails has an error and nulls.
    """
    shown = ["-show_entries", "stream=width,height,r_frame_rate,avg_frame_rate,nb_frames,duration,nb_read_frames:format=duration"]
    found = _asked(videos, run, shown, binary).withColumn("_p", probed(F.col("_text")))
    none = F.when(F.col("_p").isNull(), F.coalesce("probe_error", F.lit("no video stream")))
    return found.select(*videos.columns, "_p.*", none.alias("probe_error"))


def key_first(videos: DataFrame, run=None, binary: str = "ffprobe") -> DataFrame:
    """Adds ``keyframe_first``, whether a video's first packet is a key frame (null where that can't be told), and ``probe_error``."""
    found = _asked(videos, run, ["-show_entries", "packet=flags", "-read_intervals", "%+#1"], binary)
    flags = F.get(F.from_json("_text", "packets array<struct<flags:string>>")["packets"], F.lit(0))["flags"]
    return found.select(*videos.columns, flags.startswith("K").alias("keyframe_first"), "probe_error")


def materialised(media: DataFrame, folder: str, copy: bool) -> DataFrame:
    """session_id, name, kind (copied or referenced), path and bytes of ``media`` (session_id, name, path).

    Copies go to ``folder``/<session>/<name>, a folder that all executors
    mount; a file appears whole or not at all.
    """
    import pandas as pd

    def placed(batches):
        import os
        import shutil
        import uuid

        for rows in batches:
            out = []
            for session, name, path in zip(rows["session_id"], rows["name"], rows["path"], strict=True):
                to = os.path.abspath(path)
                if copy:
                    to = f"{folder}/{session}/{name}"
                    os.makedirs(os.path.dirname(to), exist_ok=True)
                    shutil.copyfile(path, part := f"{to}.{uuid.uuid4().hex}")
                    os.replace(part, to)
                out.append((session, name, "copied" if copy else "referenced", to, os.path.getsize(path)))
            yield pd.DataFrame(out, columns=["session_id", "name", "kind", "path", "bytes"])

    return media.select("session_id", "name", "path").mapInPandas(placed, "session_id string, name string, kind string, path string, bytes long")
