"""Sinks: JSON lines, shards, frame tables, dataset documents."""

from __future__ import annotations

import io
import json
import tarfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: What the dataset's information must hold.
INFO_KEYS = ["codebase_version", "robot_type", "fps", "total_episodes", "total_frames", "total_tasks", "total_videos", "features", "chunks_size"]


def write_jsonl(df: DataFrame, path: str) -> int:
    """JSON lines with sorted keys; returns their number, counted as they are written."""
    from pyspark.sql import Observation

    seen = Observation("rows")
    rows = df.select(*[F.col(f"`{c}`") for c in sorted(df.columns)]).observe(seen, F.count(F.lit(1)).alias("n"))
    rows.write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return seen.get["n"]


def write_frames(df: DataFrame, path: str, rows_per_file: int = 0) -> None:
    """A frame table by session, zstd-compressed; a session that is written again replaces itself."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("session_id")
    (writer.option("maxRecordsPerFile", rows_per_file) if rows_per_file else writer).parquet(path)


def tar(members: list[tuple[str, bytes]]) -> bytes:
    """A tar archive that depends on names and contents alone."""
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w", format=tarfile.USTAR_FORMAT) as f:
        for name, data in sorted(members):
            info = tarfile.TarInfo(name)
            info.size, info.mtime, info.uid, info.gid, info.mode = len(data), 0, 0, 0, 0o644
            f.addfile(info, io.BytesIO(data))
    return out.getvalue()


def tar_shards(df: DataFrame, by: list[str], name: str, data: str) -> DataFrame:
    """One archive per ``by`` as a row: the columns of ``by``, archive, bytes, members.

    A group is a shard, whose size the packing bounds.
    """
    kinds = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in by)

    def packed(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        archive = tar(list(zip(rows[name], map(bytes, rows[data]), strict=True)))
        return pd.DataFrame([[*key, archive, len(archive), len(rows)]], columns=[*by, "archive", "bytes", "members"])

    return df.select(*by, name, data).groupBy(*by).applyInPandas(packed, f"{kinds}, archive binary, bytes long, members long")


def info(frames: DataFrame, fps: float, robot: str = "unknown") -> dict:
    """The dataset's information from its frame table (episode_index, task_index)."""
    r = frames.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("episode_index").alias("e"), F.count_distinct("task_index").alias("t")).first()
    return {
        "codebase_version": "v3.0", "robot_type": robot, "fps": fps, "total_episodes": r["e"], "total_frames": r["n"], "total_tasks": r["t"],
        "total_videos": 0, "chunks_size": 1000, "splits": {"train": f"0:{r['e']}"}, "features": {f.name: f.dataType.simpleString() for f in frames.schema},
    }


def missing_info(found: dict) -> list[str]:
    return [k for k in INFO_KEYS if k not in found]


def write_document(df_or_dict, path: str, spark=None) -> None:
    """One JSON document through Spark's committed writes, as a folder with one file."""
    text = json.dumps(df_or_dict, sort_keys=True)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def write_json(document: dict, path: str) -> None:
    """One JSON document as a file that appears whole or not at all."""
    import os
    import uuid

    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    with open(part := f"{path}.{uuid.uuid4().hex}.tmp", "w", encoding="utf-8") as f:
        json.dump(document, f, ensure_ascii=False, indent=2, sort_keys=True)
        f.write("\n")
    os.replace(part, path)


def upsert(rows: DataFrame, path: str, key: str = "key", when: str = "created_at") -> DataFrame:
    """Adds ``rows`` to the table at ``path``, where each ``key`` has its latest row, and returns that table.

    A version is a folder of its own, which counts once it is written whole;
    readers of the one before aren't disturbed.  The one before that goes.
    """
    spark = rows.sparkSession
    had = versions(spark, path)
    old = spark.read.schema(rows.schema).parquet(f"{path}/v={had[-1]}") if had else rows.limit(0)
    newest = Window.partitionBy(key).orderBy(F.col(when).desc_nulls_last(), F.col("_new").desc())
    both = old.withColumn("_new", F.lit(0)).unionByName(rows.withColumn("_new", F.lit(1)))
    now = (had[-1] if had else 0) + 1
    both.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank", "_new").write.mode("overwrite").parquet(f"{path}/v={now}")
    for v in had[:-1]:
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/v={v}")
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return spark.read.schema(rows.schema).parquet(f"{path}/v={now}")


def versions(spark, path: str) -> list[int]:
    """The numbers of the versions at ``path`` that were written whole, in order."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return []
    names = [x.getPath().getName() for x in fs.listStatus(at)]
    done = lambda n: fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))
    return sorted(int(n[2:]) for n in names if n.startswith("v=") and n[2:].isdigit() and done(n))


def size_by_kind(spark, root: str) -> DataFrame:
    """Bytes and files under each top folder of ``root``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")
    top = F.get(F.split(F.element_at(F.split("path", root.rstrip("/") + "/", 2), -1), "/"), F.lit(0))
    return files.groupBy(top.alias("kind")).agg(F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("files"))


def exported(archives: DataFrame, folder: str, name: str = "shard") -> DataFrame:
    """Writes archives as files in a folder that all executors mount; each appears whole or not at all.

    ``name`` is a column of numbers or of names, which may have folders.
    """

    def written(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os
        import uuid

        for rows in batches:
            for key, data in zip(rows[name], rows["archive"], strict=True):
                path = f"{folder}/{key if isinstance(key, str) else format(int(key), '06d')}.tar"
                os.makedirs(os.path.dirname(path), exist_ok=True)
                with open(part := f"{path}.{uuid.uuid4().hex}", "wb") as f:
                    f.write(data)
                os.replace(part, path)
                yield pd.DataFrame({"path": [path], "bytes": [len(data)]})

    return archives.select(name, "archive").mapInPandas(written, "path string, bytes long")
