"""Joins in time: nearest and backward as-of, bins, intervals, positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def nearest(anchors: DataFrame, records: DataFrame, by: Sequence[str], ts: str, payload: Sequence[str], order: str) -> DataFrame:
    """The nearest record of each anchor within ``by``: ``anchors`` with ``found`` (ts and payload, null if none) and ``delta``.

    Of two equally near the later one; of equal times the first by ``order``
    on the later side, the last on the earlier.  One shuffle and two windows,
    each from the start to the current row; no pairs are made.
    """
    own = [c for c in anchors.columns if c not in (*by, ts)]
    kinds = {f.name: f.dataType for f in anchors.schema}
    record = F.struct(F.col(ts), *payload)
    kind = records.select(record.alias("r")).schema["r"].dataType
    both = anchors.select(*by, ts, F.lit(0).alias("_k"), F.lit(None).cast(kind).alias("_r"), *own, F.lit(None).cast("string").alias("_o")).unionByName(
        records.select(*by, ts, F.lit(1).alias("_k"), record.alias("_r"), *[F.lit(None).cast(kinds[c]).alias(c) for c in own], F.col(order).cast("string").alias("_o"))
    )
    w = Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.last("_r", ignorenulls=True).over(w.orderBy(ts, "_k", "_o"))
    after = F.last("_r", ignorenulls=True).over(w.orderBy(F.desc(ts), F.desc("_k"), F.desc("_o")))
    picked = both.select("*", before.alias("_b"), after.alias("_a")).where("_k = 0")
    later = F.col("_a").isNotNull() & (F.col("_b").isNull() | (F.col(f"_a.{ts}") - F.col(ts) <= F.col(ts) - F.col(f"_b.{ts}")))
    found = F.when(later, F.col("_a")).otherwise(F.col("_b"))
    return picked.select(*by, ts, *own, found.alias("found"), F.abs(found[ts] - F.col(ts)).alias("delta"))


def align(records: DataFrame, anchor: str, expected: Sequence[str], tolerance_ns: int) -> DataFrame:
    """One row per anchor record and expected stream, matched within the tolerance or missing.

    ``records``: session_id, stream, timestamp_ns, path.  Columns: session_id,
    timestamp_ns, anchor_path, stream, path (null if missing), delta_ms.
    """
    at = records.where(F.col("stream") == anchor).select(
        "session_id", "timestamp_ns", F.col("path").alias("anchor_path"), F.explode(F.array(*map(F.lit, expected))).alias("stream")
    )
    others = records.where(F.col("stream").isin(list(expected))).select("session_id", "stream", "timestamp_ns", "path")
    near = nearest(at, others, ["session_id", "stream"], "timestamp_ns", ["path"], "path")
    kept = F.col("delta") <= tolerance_ns
    return near.select(
        "session_id",
        "timestamp_ns",
        "anchor_path",
        "stream",
        F.when(kept, F.col("found.path")).alias("path"),
        F.when(kept, F.round(F.col("delta") / 1e6, 6)).alias("delta_ms"),
    )


def samples(aligned: DataFrame, by: Sequence[str] = ("session_id", "timestamp_ns", "anchor_path")) -> DataFrame:
    """Aligned samples: ``streams`` (a map of structs, sorted by stream) and ``missing_streams``."""
    entry = F.struct("stream", F.struct("path", "delta_ms").alias("v"))
    return aligned.groupBy(*by).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("path").isNotNull(), entry)))).alias("streams"),
        F.array_sort(F.collect_list(F.when(F.col("path").isNull(), F.col("stream")))).alias("missing_streams"),
    )


def last_before(df: DataFrame, value: Column, by: Sequence[str], order: Sequence[str]) -> Column:
    """The last value that isn't null up to the current row."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.last(value, ignorenulls=True).over(w)


def looked_up(df: DataFrame, entries: DataFrame, key: str, at: str, spread: str) -> DataFrame:
    """Each row with the ``entries`` whose ``at`` is its ``key``, if any.

    Rows without a key, which match nothing, are dealt out by ``spread``; by
    the key alone they would all go to one task.
    """
    return df.join(entries, (F.col(key) == F.col(at)) & (F.coalesce(key, spread) == F.col(at)), "left")


def positional(left: DataFrame, right: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Pairs the i-th row of each side within ``by``; rows of the right side beyond the left's number go."""
    number = F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1
    return left.withColumn("position", number).join(right.withColumn("position", number), [*by, "position"], "left")


def in_intervals(points: DataFrame, intervals: DataFrame, by: Sequence[str], at: str, start: str, end: str, width: int) -> DataFrame:
    """Points within half-open intervals, by an equi-join on buckets of ``width``; each pair once.

    An interval goes to each bucket it touches, a point to its own one.
    """
    bucket = lambda c: F.floor(F.col(c) / width)
    wide = intervals.where(F.col(end) > F.col(start)).withColumn("_bucket", F.explode(F.sequence(bucket(start), F.floor((F.col(end) - 1) / width))))
    return (
        points.withColumn("_bucket", bucket(at))
        .join(wide, [*by, "_bucket"])
        .where((F.col(at) >= F.col(start)) & (F.col(at) < F.col(end)))
        .drop("_bucket")
    )


def overlaps(left: DataFrame, right: DataFrame, by: Sequence[str], width: int) -> DataFrame:
    """Overlaps of the intervals (s, e) of ``left`` with (start, end) of ``right``, cut to both; once for each pair."""
    cells = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / width), F.floor((F.col(b) - 1) / width)))
    one = left.where("e > s").withColumn("_bucket", cells("s", "e"))
    two = right.where("end > start").withColumn("_bucket", cells("start", "end"))
    first = F.greatest(F.floor(F.col("s") / width), F.floor(F.col("start") / width))
    return (
        one.join(two, [*by, "_bucket"])
        .where((F.col("e") > F.col("start")) & (F.col("s") < F.col("end")) & (F.col("_bucket") == first))
        .withColumn("cut_start", F.greatest("s", "start"))
        .withColumn("cut_end", F.least("e", "end"))
        .drop("_bucket")
    )


def bin_mean(frames: DataFrame, samples: DataFrame, by: str, half: int) -> DataFrame:
    """The mean of the samples within [t - half, t + half) of each frame, else the nearest sample's value, else 0.

    ``frames``: by, t; ``samples``: by, t, value, sample_id.
    """
    spans = frames.select(by, "t", (F.col("t") - half).alias("_s"), (F.col("t") + half).alias("_e"))
    inside = in_intervals(samples.select(by, F.col("t").alias("_t"), "value"), spans, [by], "_t", "_s", "_e", 2 * half)
    means = inside.groupBy(by, "t").agg(F.avg("value").alias("mean"), F.count("value").alias("n"))
    near = nearest(frames.select(by, "t"), samples.select(by, "t", "value", "sample_id"), [by], "t", ["value"], "sample_id")
    return near.join(means, [by, "t"], "left").select(
        by, "t", F.coalesce("mean", F.col("found.value"), F.lit(0.0)).alias("value"), F.coalesce("n", F.lit(0)).cast("long").alias("n")
    )
