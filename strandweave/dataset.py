"""Learning datasets of episodes: frames, episodes, tasks, statistics, information; written, read and validated."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandweave.operators.segment import numbered
from strandweave.operators.stats import vector_stats
from strandweave.sources import sinks

#: Where the parts lie, and the columns that frames get.
PARTS = ["data", "meta/episodes", "meta/tasks", "meta/stats", "meta/info"]
FRAME = ["index", "episode_index", "frame_index", "task_index", "timestamp"]


def write(frames: DataFrame, root: str, fps: float, robot: str = "unknown", vectors: tuple[str, ...] = ()) -> dict:
    """Writes a dataset from ``frames`` (session_id, frame, task and any more) and returns its information.

    A session is an episode with the task of its first frame; episodes are in
    order of their sessions' ids, tasks in that of their first episode.
    Frames are numbered within an episode and over all.  Frames of equal
    number are in order of no rule.  The numbers over all episodes come from
    sums by file of a sorted table, so that no task sees all episodes.
    """
    spark = frames.sparkSession
    sizes = frames.groupBy("session_id").agg(F.count(F.lit(1)).alias("length"), F.min_by("task", "frame").alias("task"))
    sizes.orderBy("session_id").write.mode("overwrite").parquet(f"{root}/meta/plan")
    plan = spark.read.schema(sizes.schema).parquet(f"{root}/meta/plan").select("*", F.col("_metadata.file_name").alias("cell"))
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = plan.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("s"))
    cells = cells.select("cell", *[F.coalesce(F.sum(a).over(before), F.lit(0)).alias(b) for a, b in (("n", "base"), ("s", "start"))])
    own = Window.partitionBy("cell").orderBy("session_id")
    to = F.col("start") + F.sum("length").over(own.rowsBetween(Window.unboundedPreceding, 0))
    episodes = plan.join(F.broadcast(cells), "cell").select(  # a row for each file
        (F.col("base") + F.row_number().over(own) - 1).alias("episode_index"), "session_id", "task", "length", (to - F.col("length")).alias("dataset_from_index"), to.alias("dataset_to_index")
    )
    tasks = episodes.where("task is not null").groupBy("task").agg(F.min("episode_index").alias("first"))
    tasks = numbered(tasks, "first", ["first"], "task_index").select("task_index", "task")
    tasks.write.mode("overwrite").parquet(f"{root}/meta/tasks")
    tasks = spark.read.schema("task_index long, task string").parquet(f"{root}/meta/tasks")
    episodes = episodes.join(tasks, "task", "left")
    episodes.select("episode_index", "session_id", F.array_compact(F.array("task")).alias("tasks"), "task_index", "length", "dataset_from_index", "dataset_to_index").write.mode("overwrite").parquet(f"{root}/meta/episodes")
    known = episodes_of(spark, root).select(F.col("session_id").alias("_s"), "episode_index", "task_index", "dataset_from_index")
    number = (F.row_number().over(Window.partitionBy("session_id").orderBy("frame")) - 1).cast("long")
    rest = [c for c in frames.columns if c not in ("frame", "task", *FRAME)]
    data = (
        frames.withColumn("frame_index", number)
        .join(known, F.col("session_id").eqNullSafe(F.col("_s")))
        .select((F.col("dataset_from_index") + F.col("frame_index")).alias("index"), "episode_index", "frame_index", "task_index", (F.col("frame_index") / fps).alias("timestamp"), *rest)
    )
    data.write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/data")
    data = frames_of(spark, root)
    found = None
    for c in vectors:
        one = vector_stats(data, c).select(F.lit(c).alias("feature"), "*")
        found = one if found is None else found.unionByName(one)
    found = found if found is not None else spark.createDataFrame([], "feature string, dim int, mean double, std double, min double, max double, n long")
    sinks.write_jsonl(found, f"{root}/meta/stats")
    info = sinks.info(data, fps, robot)
    sinks.write_document(info, f"{root}/meta/info", spark)
    return info


class Writer:
    """A dataset that is written over several calls: tasks are registered, episodes added, and ``finalize`` writes all.

    Episodes are staged as they come, so that nothing waits in memory.
    """

    def __init__(self, spark: SparkSession, root: str, fps: float, robot: str = "unknown", vectors: tuple[str, ...] = ()):
        self.spark, self.root, self.fps, self.robot, self.vectors = spark, root.rstrip("/"), fps, robot, vectors
        self.tasks: dict[str, int] = {}
        self.episodes = 0
        self.schema = None
        self.done = False

    def register_task(self, text: str) -> int:
        """The task's index, in the order in which tasks are first named."""
        return self.tasks.setdefault(text, len(self.tasks))

    def add_episode(self, frames: DataFrame, task: str) -> int:
        """Stages an episode's frames (frame and any more); all episodes have the same columns.  Returns its index."""
        if self.done:
            raise ValueError("the dataset is finished")
        rows = frames.drop("session_id", "task")
        if self.schema is not None and rows.schema != self.schema:
            raise ValueError(f"episode {self.episodes} has other columns than the ones before: {rows.schema.simpleString()}")
        self.register_task(task)
        rows.select("*", F.lit(f"{self.episodes:09d}").alias("session_id"), F.lit(task).alias("task")).write.mode("overwrite").parquet(f"{self.root}/_staged/{self.episodes:09d}")
        self.schema, self.episodes = rows.schema, self.episodes + 1
        return self.episodes - 1

    def finalize(self) -> dict:
        """Writes the dataset, lets go of what was staged, and returns the information."""
        if self.done:
            raise ValueError("the dataset is finished")
        if not self.episodes:
            raise ValueError("there is no episode")
        staged = self.spark.read.option("recursiveFileLookup", True).parquet(f"{self.root}/_staged")
        info = write(staged, self.root, self.fps, self.robot, self.vectors)
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/_staged")
        at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)
        self.done = True
        return info


def frames_of(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/data")


def episodes_of(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/meta/episodes")


def info_of(spark: SparkSession, root: str) -> dict:
    import json

    return json.loads(spark.read.option("wholetext", True).text(f"{root}/meta/info").first()["value"])


def _there(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def validate(spark: SparkSession, root: str, columns: tuple[str, ...] = (), widths: dict[str, int] | None = None) -> list[tuple[str, str, str]]:
    """(code, severity, message) of each finding: missing parts, columns, vectors' widths, counts, tasks, information.

    Only counts come to the driver.
    """
    found = [("MISSING_FILE", "error", f"{p} is not there") for p in PARTS if not _there(spark, f"{root}/{p}")]
    if found:
        return found
    data, episodes, info = frames_of(spark, root), episodes_of(spark, root), info_of(spark, root)
    expected = [*FRAME, *columns]
    if missing := [c for c in expected if c not in data.columns]:
        found.append(("DATA_SCHEMA_MISSING_COLUMNS", "error", ", ".join(missing)))
    if columns and (extra := [c for c in data.columns if c not in expected]):
        found.append(("DATA_SCHEMA_EXTRA_COLUMNS", "warn", ", ".join(extra)))
    if missing := sinks.missing_info(info):
        found.append(("INFO_MISSING_KEYS", "error", ", ".join(missing)))
    widths = {c: n for c, n in (widths or {}).items() if c in data.columns}
    seen = data.agg(F.count(F.lit(1)).alias("n"), *[F.count(F.when(~F.size(c).eqNullSafe(F.lit(n)), 1)).alias(f"_{c}") for c, n in widths.items()]).first()
    found += [("VECTOR_WIDTH_MISMATCH", "error", f"{seen[f'_{c}']} rows of {c} have no {n} values") for c, n in widths.items() if seen[f"_{c}"]]
    told = episodes.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("frames"), F.count(F.when(F.size("tasks") == 0, 1)).alias("idle")).first()
    if abs(seen["n"] - told["frames"]) > 1 or abs(seen["n"] - info.get("total_frames", -2)) > 1:
        found.append(("FRAME_COUNT_MISMATCH", "error", f"{seen['n']} frames, {told['frames']} in episodes, {info.get('total_frames')} in the information"))
    if told["n"] != info.get("total_episodes"):
        found.append(("EPISODE_COUNT_MISMATCH", "error", f"{told['n']} episodes, {info.get('total_episodes')} in the information"))
    if told["idle"]:
        found.append(("EPISODE_WITHOUT_TASK", "warn", f"{told['idle']} episodes"))
    if not info.get("fps", 0) > 0:
        found.append(("INFO_FPS", "error", f"fps is {info.get('fps')}"))
    return found
