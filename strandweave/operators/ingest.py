"""Rules for recorded sessions before they are taken in: 14 coded issues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Seconds by which the declared duration may differ, and frames a second.
MOST_SECONDS, FPS = 0.5, 30.0
OUT = ["session_id", "code", "severity", "message"]


def _issue(rows: DataFrame, code: str | Column, severity: str | Column, test: Column, message: Column) -> DataFrame:
    lit = lambda x: F.lit(x) if isinstance(x, str) else x
    return rows.where(test).select("session_id", lit(code).alias("code"), lit(severity).alias("severity"), message.alias("message"))


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(x) if isinstance(x, str) else x.cast("string") for x in parts])


def frame_checks(frames: DataFrame) -> DataFrame:
    """Of each session and stream: n, first_gap and first_fall (rows from 0, else null), span (seconds from the first row to the last).

    ``frames``: session_id, stream, row, frame_index, t (seconds).  A gap is
    a row whose frame_index isn't its place, a fall one whose time isn't
    after that of the row before.  Rows without numbers aren't counted.
    """
    w = Window.partitionBy("session_id", "stream").orderBy("row")
    rows = frames.where("frame_index is not null and t is not null").withColumn("place", F.row_number().over(w) - 1).withColumn("old", F.lag("t").over(w))
    return rows.groupBy("session_id", "stream").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(F.col("frame_index") != F.col("place"), F.col("place"))).alias("first_gap"),
        F.min(F.when(F.col("t") <= F.col("old"), F.col("place"))).alias("first_fall"),
        (F.max_by("t", "row") - F.min_by("t", "row")).alias("span"),
    )


def issues(sessions: DataFrame, frames: DataFrame, mismatches: DataFrame, fps: float = FPS, most_seconds: float = MOST_SECONDS) -> DataFrame:
    """session_id, code, severity, message of each rule that a session breaks.

    ``sessions``: session_id, rgb_file and depth_file (whether the stream's
    times are there), rgb_count and depth_count (declared, null if not),
    duration_s, fx, fy, notes (array: where two calibrations differ), has_imu.
    ``frames``: see ``frame_checks``; streams rgb and depth.  ``mismatches``:
    session_id, name, note, actual (the file found instead, null if none).
    """
    checks = frame_checks(frames)
    side = lambda s: checks.where(F.col("stream") == s).select(F.col("session_id").alias(f"{s}_id"), *[F.col(c).alias(f"{s}_{c}") for c in ("n", "first_gap", "first_fall", "span")])
    rows = sessions
    for s in ("rgb", "depth"):
        rows = rows.join(side(s), (F.col("session_id") == F.col(f"{s}_id")) & F.col(f"{s}_file"), "left")
    found = [
        _issue(mismatches, "DISCOVERY_MISMATCH", F.when(F.col("actual").isNull(), "error").otherwise("warn"), F.lit(True), _text(F.col("name"), ": ", F.col("note"))),
        _issue(rows, "MISSING_RGB_TIMESTAMPS", "error", ~F.col("rgb_file"), F.lit("no RGB times; cannot align")),
        _issue(rows, "MISSING_DEPTH_TIMESTAMPS", "warn", ~F.col("depth_file"), F.lit("no depth times; frames are paired one by one")),
        _issue(rows, "RGB_DEPTH_FRAME_COUNT_MISMATCH", "error", F.col("rgb_n") != F.col("depth_n"), _text(F.col("rgb_n"), " RGB and ", F.col("depth_n"), " depth frames")),
        _issue(rows, "DURATION_MISMATCH", "warn", (F.col("duration_s") > 0) & (F.abs(F.col("rgb_span") + 1 / fps - F.col("duration_s")) > most_seconds), _text("declared ", F.format_string("%.3f", "duration_s"), " s, observed ", F.format_string("%.3f", F.col("rgb_span") + 1 / fps), " s")),
        _issue(rows, "CALIBRATION_INVALID_INTRINSICS", "error", (F.col("fx") <= 0) | (F.col("fy") <= 0), _text("fx ", F.format_string("%.3f", "fx"), ", fy ", F.format_string("%.3f", "fy"))),
        _issue(rows.select("session_id", F.explode("notes").alias("note")), "CALIBRATION_CROSS_CHECK", "warn", F.lit(True), F.col("note")),
        _issue(rows, "CALIBRATION_NO_IMU", "warn", ~F.col("has_imu"), F.lit("no IMU calibration; defaults are used")),
    ]
    for s in ("rgb", "depth"):
        code = s.upper()
        found += [
            _issue(rows, f"{code}_FRAME_INDEX_NON_CONTIGUOUS", "error", F.col(f"{s}_first_gap").isNotNull(), _text("first gap at row ", F.col(f"{s}_first_gap"))),
            _issue(rows, f"{code}_TIMESTAMPS_NON_MONOTONIC", "error", F.col(f"{s}_first_fall").isNotNull(), _text("first violation at row ", F.col(f"{s}_first_fall"))),
            _issue(rows, f"{code}_FRAME_COUNT_MISMATCH", "warn", F.col(f"{s}_count") != F.col(f"{s}_n"), _text("declared ", F.col(f"{s}_count"), ", found ", F.col(f"{s}_n"))),
        ]
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return out.select(*OUT)
