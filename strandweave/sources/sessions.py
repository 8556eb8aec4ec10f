"""Recorded sessions: manifests, time series, audio, key-points, calibration."""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "version string, type string, duration double, items array<struct<name:string,file:string,description:string,fps:double,count:long,width:int,height:int,sample_rate:int>>"
TASK = "task_id string, name string, scene string, task_scene string, success int, duration double, modality array<string>, steps array<string>, tags array<string>, items array<string>, hints array<string>, actor struct<gender:string,height:double,weight:double,age:int>, version string, request_id string"
HANDS = "map<string,struct<excluded:boolean,exclude_reason:string,hands:array<struct<is_right:boolean,confidence:string,keypoints_3d_cam_m:map<string,array<double>>>>>>"


def _session(path: str = "path"):
    return F.element_at(F.split(path, "/"), -2)


def found(spark: SparkSession, root: str, needed: tuple[str, ...] = ("config.json", "rgb_head.mp4")) -> DataFrame:
    """Folders under ``root`` that hold all of ``needed``: session_id, files (names); Spark lists no empty files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
    by = files.select(_session().alias("session_id"), F.element_at(F.split("path", "/"), -1).alias("name"))
    sessions = by.groupBy("session_id").agg(F.array_sort(F.collect_set("name")).alias("files"))
    return sessions.where(F.size(F.array_except(F.array(*map(F.lit, needed)), "files")) == 0)


def _json(spark: SparkSession, paths: str, schema: str) -> DataFrame:
    return spark.read.option("multiLine", True).schema(schema).json(paths).withColumn("session_id", _session_of_file())


def _session_of_file():
    return F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)


def manifests(spark: SparkSession, paths: str) -> DataFrame:
    """One row per declared item of each session's manifest."""
    return _json(spark, paths, MANIFEST).select("session_id", "version", "type", "duration", F.inline("items"))


def tasks(spark: SparkSession, paths: str) -> DataFrame:
    return _json(spark, paths, TASK)


def latest(files: DataFrame, pattern: str) -> DataFrame:
    """Of the names that fit, the last one by name of each session."""
    names = files.select("session_id", F.explode("files").alias("name")).where(F.col("name").rlike(pattern))
    return names.groupBy("session_id").agg(F.max("name").alias("name"))


def timestamps(spark: SparkSession, paths: str) -> DataFrame:
    """frame_index and timestamp_s of CSV files with a header; lines that don't fit are dropped."""
    rows = spark.read.option("header", True).option("comment", "#").option("mode", "DROPMALFORMED").schema("frame_index long, timestamp_s double").csv(paths)
    return rows.withColumn("session_id", _session_of_file()).where("timestamp_s is not null")


def head_poses(spark: SparkSession, paths: str) -> DataFrame:
    columns = "timestamp_s double, tx double, ty double, tz double, qx double, qy double, qz double, qw double"
    return spark.read.option("header", True).schema(columns).csv(paths).withColumn("session_id", _session_of_file())


def imu(spark: SparkSession, paths: str) -> DataFrame:
    """Time, acceleration and turn rate of lines with seven numbers at least."""
    rows = spark.read.text(paths).select(_session_of_file().alias("session_id"), F.trim("value").alias("value"))
    parts = rows.where(~F.col("value").startswith("#")).select("session_id", F.split("value", r"\s+").alias("p")).where(F.size("p") >= 7)
    number = lambda i: F.col("p")[i].try_cast("double")
    return parts.select("session_id", number(0).alias("ts"), F.array(*map(number, (1, 2, 3))).alias("acc"), F.array(*map(number, (4, 5, 6))).alias("gyr")).where("ts is not null")


def samples(data: bytes) -> tuple[int, np.ndarray]:
    """Rate, and frames by channels in [-1, 1), of PCM with 8, 16 or 32 bits."""
    at, rate, channels, bits, body = 12, 0, 1, 16, b""
    while at + 8 <= len(data):
        name, size = data[at : at + 4], struct.unpack_from("<I", data, at + 4)[0]
        if name == b"fmt ":
            _, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", data, at + 8)
        elif name == b"data":
            body = data[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    kind, scale, shift = {8: ("u1", 2**7, 2**7), 16: ("<i2", 2**15, 0), 32: ("<i4", 2**31, 0)}[bits]
    whole = len(body) // (bits // 8 * channels) * channels
    return rate, ((np.frombuffer(body, kind, whole).astype(float) - shift) / scale).reshape(-1, channels)


def wav(data: bytes) -> tuple[int, list[list[float]]]:
    rate, frames = samples(data)
    return rate, frames.tolist()


def audio_energy(spark: SparkSession, paths: str, frame_s: float = 1 / 30) -> DataFrame:
    """The mean square of the first channel in each frame of each WAV file: session_id, frame, energy.

    A file is decoded in one task and leaves it as its frames.
    """

    def decoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for session, content in zip(rows.session_id, rows.content, strict=True):
                rate, frames = samples(content)
                step = max(1, round(rate * frame_s))
                x = frames[:, 0] ** 2 if frames.size else np.zeros(0)
                starts = np.arange(0, len(x), step)
                energy = np.add.reduceat(x, starts) / np.diff(np.r_[starts, len(x)]) if len(x) else x
                yield pd.DataFrame({"session_id": session, "frame": range(len(energy)), "energy": energy})

    files = spark.read.format("binaryFile").load(paths).select(_session().alias("session_id"), "content")
    return files.mapInPandas(decoded, "session_id string, frame long, energy double")


def key_points(spark: SparkSession, paths: str) -> DataFrame:
    """One row per hand and time of the key-point files: session_id, key (time as text), excluded, hand fields."""
    rows = spark.read.option("wholetext", True).text(paths).select(_session_of_file().alias("session_id"), F.from_json("value", f"frames {HANDS}").alias("j"))
    frames = rows.select("session_id", F.explode("j.frames").alias("key", "f"))
    return frames.select("session_id", "key", "f.excluded", "f.exclude_reason", F.posexplode_outer("f.hands").alias("pos", "hand")).select("session_id", "key", "excluded", "exclude_reason", "pos", "hand.*")


def _scalar(text: str):
    text = text.strip()
    if text[:1] in "'\"" and text[-1:] == text[:1] and len(text) > 1:
        return text[1:-1]
    if text.startswith("["):
        parts, level, start = [], 0, 1
        for i, c in enumerate(text):
            level += (c == "[") - (c == "]")
            if (c == "," and level == 1) or (c == "]" and level == 0):
                parts.append(text[start:i])
                start = i + 1
        return [_scalar(x) for x in parts if x.strip()]
    for kind in (int, float):
        try:
            return kind(text)
        except ValueError:
            pass
    return {"": None, "~": None, "null": None, "true": True, "false": False}.get(text.lower(), text)


def plain_yaml(text: str):
    """The YAML of calibration files: nested maps and lists by indentation, lists in brackets over one or more lines, plain values."""
    rows: list[tuple[int, str]] = []
    for line in text.splitlines():
        body = re.sub(r"(^|\s)#.*$", "", line).rstrip()
        if not body.strip() or body.startswith(("%", "---", "...")):
            continue
        if rows and rows[-1][1].count("[") > rows[-1][1].count("]"):  # a list goes on
            rows[-1] = (rows[-1][0], f"{rows[-1][1]} {body.strip()}")
        else:
            rows.append((len(body) - len(body.lstrip()), body.strip()))

    def block(i: int, indent: int):
        out = [] if rows[i][1].startswith("- ") or rows[i][1] == "-" else {}
        while i < len(rows) and rows[i][0] >= indent:
            at, body = rows[i]
            if isinstance(out, list):
                if not (body == "-" or body.startswith("- ")):
                    break
                rest = body[1:].strip()
                if rest and not re.match(r"[^\[\"']*:(\s|$)", rest):
                    out.append(_scalar(rest))
                    i += 1
                    continue
                rows[i] = (at + 2, rest)
                value, i = block(i if rest else i + 1, at + 1)
                out.append(value)
            else:
                key, _, rest = body.partition(":")
                key, rest = str(_scalar(key)), re.sub(r"^!!\S+", "", rest.strip()).strip()
                nested = i + 1 < len(rows) and (rows[i + 1][0] > at or (rows[i + 1][0] == at and rows[i + 1][1].startswith("-")))
                if not rest and nested:
                    out[key], i = block(i + 1, rows[i + 1][0])
                else:
                    out[key], i = _scalar(rest), i + 1
        return out, i

    return block(0, rows[0][0])[0] if rows else {}


def calibration_yaml(text: str) -> dict:
    """Cameras from a calibration file, whose %YAML line parsers don't take; by ``plain_yaml`` where no parser is there."""
    body = "\n".join(x for x in text.splitlines() if not x.startswith("%YAML"))
    try:
        import yaml
    except ImportError:
        return plain_yaml(body) or {}
    return yaml.safe_load(body) or {}


def intrinsics(primary: dict, fallback: dict) -> dict[str, float]:
    """fx, fy, cx, cy from the first source, else from the other one."""
    first = primary.get("cam0", {}).get("intrinsics")
    if first:
        return dict(zip(("fx", "fy", "cx", "cy"), map(float, first), strict=True))
    other = fallback.get("rgb_camera", {}).get("intrinsic", {})
    return {a: float(other[b]) for a, b in (("fx", "fx"), ("fy", "fy"), ("cx", "ppx"), ("cy", "ppy")) if b in other}
