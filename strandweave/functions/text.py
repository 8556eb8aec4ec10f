"""Columns over texts, paths and times in them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Keyword in a path -> modality, in this order; then the extension, whose first modality counts.
KEYWORDS = {"depth": "depth", "imu": "imu", "pose": "pose", "6dof": "pose", "tf": "pose", "pointcloud": "pointcloud", "point_cloud": "pointcloud", "lidar": "pointcloud"}
EXTENSIONS = {
    "rgb": [".jpg", ".jpeg", ".png", ".bmp", ".webp"],
    "depth": [".npy", ".npz", ".pfm", ".exr", ".tiff", ".tif"],
    "audio": [".wav", ".flac", ".mp3", ".aac"],
    "imu": [".json", ".jsonl", ".csv"],
    "pose": [".json", ".jsonl", ".csv", ".txt"],
    "pointcloud": [".pcd", ".ply", ".bin", ".las", ".laz"],
}
#: Folder names that say nothing of the sensor, beside that of the file's own modality.
PLAIN_FOLDERS = ["data", "raw", "frames"]
#: Action words, and other words for them, each list in the order of search.
ACTIONS = ["reach", "grasp", "lift", "move", "rotate", "place", "release"]
ALIASES = {"伸手": "reach", "靠近": "reach", "抓": "grasp", "握": "grasp", "捏": "grasp", "抬": "lift", "举": "lift", "移动": "move", "推": "move", "拉": "move", "旋转": "rotate", "拧": "rotate", "转": "rotate", "放": "place", "放置": "place", "松": "release", "放开": "release", "释放": "release"}


def first_of(cases: list[tuple[Column, Column]], default: Column) -> Column:
    out = default
    for test, value in reversed(cases):
        out = F.when(test, value).otherwise(out)
    return out


def modality(path: Column, extensions: dict[str, list[str]] = EXTENSIONS) -> Column:
    """From a keyword anywhere in the path, else from the extension, else null."""
    low = F.lower(path)
    extension = F.regexp_extract(low, r"(\.[^./]+)$", 1)
    cases = [(low.contains(k), F.lit(v)) for k, v in KEYWORDS.items()]
    cases += [(extension.isin([x.lower() for x in of]), F.lit(m)) for m, of in extensions.items()]
    return first_of(cases, F.lit(None).cast("string"))


def sensor(path: Column, modality: Column) -> Column:
    """The first folder that says something and isn't named like the file's ``modality``, else the modality."""
    named = F.split(path, "/")
    folders = F.filter(F.slice(named, 1, F.size(named) - 1), lambda x: (x != "") & ~F.lower(x).isin(PLAIN_FOLDERS) & ~F.lower(x).eqNullSafe(modality))
    return F.coalesce(F.get(folders, F.lit(0)), modality)


def digits_to_ns(name: Column) -> Column:
    """A time from the first run of ten digits and more, its unit by their number; else null."""
    run = F.regexp_extract(name, r"(\d{10,})", 1)
    n, value = F.length(run), run.try_cast("long")
    return F.when(n >= 18, value).when(n >= 16, value * 1000).when(n >= 13, value * 1_000_000).when(n >= 10, value * 1_000_000_000)


def safe_name(text: Column, default: str = "item") -> Column:
    """Letters, digits, ``-``, ``_`` and ``.``; all else as ``_``, none of ``._`` at the ends."""
    kept = F.regexp_replace(text, r"[^\p{L}\p{N}._-]", "_")
    return F.coalesce(F.nullif(F.regexp_replace(kept, r"^[._]+|[._]+$", ""), F.lit("")), F.lit(default))


def sample_id(session: Column, timestamp: Column, path: Column) -> Column:
    tail = F.substring(F.sha1(F.concat_ws(":", session.cast("string"), timestamp.cast("string"), path)), 1, 10)
    return F.concat_ws("-", safe_name(session.cast("string")), timestamp.cast("string"), tail)


def slug(text: Column, most: int = 40) -> Column:
    return F.substring(F.regexp_replace(F.trim(F.regexp_replace(text, r"[^\p{L}\p{N} ]", "")), " +", "-"), 1, most)


def action(text: Column) -> Column:
    """The first action word that the text holds, else the first alias, else move."""
    low = F.lower(text)
    cases = [(low.contains(a), F.lit(a)) for a in ACTIONS] + [(text.contains(a), F.lit(v)) for a, v in ALIASES.items()]
    return first_of(cases, F.lit("move"))


def rate(text: Column) -> Column:
    """"num/den" or a number as double; null if it is neither or the denominator is 0."""
    parts = F.split(text, "/")
    return F.try_divide(parts[0].try_cast("double"), F.coalesce(F.get(parts, F.lit(1)).try_cast("double"), F.lit(1.0)))


def unfenced(text: Column) -> Column:
    """Without a Markdown fence around it."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.trim(text), r"^```[a-zA-Z]*\s*", ""), r"\s*```$", ""))


def json_field(text: Column, name: str) -> Column:
    """A field of the whole text as JSON, else of its first-brace-to-last-brace block, else by its spelling."""
    plain = unfenced(text)
    block = F.regexp_extract(plain, r"(?s)(\{.*\})", 1)
    path = f"$.{name}"
    spelled = F.nullif(F.regexp_extract(plain, rf'"{name}"\s*:\s*"?([^",}}]*)', 1), F.lit(""))
    of = lambda x: F.try_variant_get(F.try_parse_json(x), path, "string")
    return F.coalesce(of(plain), of(F.nullif(block, F.lit(""))), F.trim(spelled))


def one_line(text: Column, most: int = 60) -> Column:
    return F.coalesce(F.nullif(F.substring(F.translate(text, "\r\n", "  "), 1, most), F.lit("")), F.lit("[empty]"))
