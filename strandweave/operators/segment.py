"""Ordered sequences: gaps, runs, interpolation, smoothing, cut points, clips, blends.

Every operator takes the columns that part the sequences (``by``) and a
complete order; windows reach from the start to the current row, never on to
the end.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema


def ordered(by: Sequence[str], order: Sequence[str]) -> Window:
    return Window.partitionBy(*by).orderBy(*order)


def numbered(df: DataFrame, at: str, order: Sequence[str], name: str, cells: int = 1024) -> DataFrame:
    """Adds each row's number from 0 in the order of ``order``, which starts with the whole number ``at``.

    Rows are numbered within ranges of ``at``; only the ranges' sums, at most
    ``cells`` and one, are in one task.
    """
    low, high = df.agg(F.min(at), F.max(at)).first()
    width = max(1, ((high or 0) - (low or 0)) // cells + 1)
    rows = df.withColumn("_cell", F.floor((F.col(at) - F.lit(low or 0)) / width))
    before = Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("_cell").agg(F.count(F.lit(1)).alias("_n")).select("_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    number = (F.col("_base") + F.row_number().over(ordered(["_cell"], order)) - 1).cast("long")
    return rows.join(F.broadcast(sums), "_cell").withColumn(name, number).drop("_cell", "_base")


def gaps(df: DataFrame, by: Sequence[str], order: Sequence[str], at: Column, most: Column) -> DataFrame:
    """Rows that come more than ``most`` after the one before, with their position and the interval."""
    w = ordered(by, order)
    found = df.withColumn("position", F.row_number().over(w) - 1).withColumn("interval", at - F.lag(at).over(w))
    return found.where(F.col("interval") > most)


def runs(df: DataFrame, by: Sequence[str], order: Sequence[str], flag: Column) -> DataFrame:
    """Adds ``position``, ``flag`` and ``run``, a number for each stretch of equal flags."""
    w = ordered(by, order)
    marked = df.withColumn("flag", flag).withColumn("position", F.row_number().over(w) - 1)
    new = (~F.col("flag").eqNullSafe(F.lag("flag").over(w))).cast("int")
    return marked.withColumn("_new", new).withColumn("run", F.sum("_new").over(w)).drop("_new")


def run_lengths(df: DataFrame, by: Sequence[str], order: Sequence[str], flag: Column) -> DataFrame:
    return runs(df, by, order, flag).groupBy(*by, "run", "flag").agg(
        F.min("position").alias("start"), (F.max("position") + 1).alias("end"), F.count(F.lit(1)).alias("length")
    )


def interpolate(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, valid: Column, most: int = 5) -> DataFrame:
    """Fills invalid stretches of up to ``most`` rows that have a valid one on either side, linearly; adds ``kept`` and ``filled``."""
    w = ordered(by, order)
    back = Window.partitionBy(*by).orderBy(*[F.desc(c) for c in order])
    spot = F.struct(F.col("position").alias("i"), F.col(value).alias("v"))
    marked = df.withColumn("kept", valid).withColumn("position", F.row_number().over(w) - 1)
    found = marked.withColumn("_l", F.last(F.when(F.col("kept"), spot), True).over(w)).withColumn("_r", F.last(F.when(F.col("kept"), spot), True).over(back))
    left, right, i = F.col("_l"), F.col("_r"), F.col("position")
    short = (right["i"] - left["i"] - 1) <= most
    part = (i - left["i"]) / (right["i"] - left["i"])
    inner = F.when(short, left["v"] * (1 - part) + right["v"] * part)
    return found.withColumn("filled", F.when(F.col("kept"), F.col(value)).otherwise(inner)).drop("_l", "_r")


def moving_mean(value: Column, by: Sequence[str], order: Sequence[str], width: int = 5) -> Column:
    """The centred mean of ``width`` rows, the ends' values repeated beyond them."""
    half, w = width // 2, ordered(by, order)
    i, n = F.row_number().over(w), F.count(F.lit(1)).over(Window.partitionBy(*by))
    first = F.first(value).over(w.rowsBetween(Window.unboundedPreceding, 0))
    last = F.first(value).over(Window.partitionBy(*by).orderBy(*[F.desc(c) for c in order]).rowsBetween(Window.unboundedPreceding, 0))
    zero = F.lit(0)
    before, after = F.greatest(half - i + 1, zero), F.greatest(i + half - n, zero)
    return (F.sum(value).over(w.rowsBetween(-half, half)) + before * first + after * last) / width


def local_minima(value: str, by: Sequence[str], order: Sequence[str], below: float) -> Column:
    """True where the value is under both neighbours and ``below``."""
    w = ordered(by, order)
    v = F.col(value)
    return F.coalesce((v < F.lag(v).over(w)) & (v < F.lead(v).over(w)) & (v < below), F.lit(False))


def atomic_segments(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, below: float, least: int = 5) -> DataFrame:
    """Stretches between local minima; those of fewer than ``least`` rows go, and the rest are numbered.

    Sequences shorter than ``least`` have none.  Where no stretch is long
    enough, the whole sequence is one, from the source ``fallback``.
    """
    w = ordered(by, order)
    rows = df.withColumn("position", F.row_number().over(w) - 1).withColumn("cut", local_minima(value, by, order, below))
    sizes = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count_if("cut").alias("minima")).where(F.col("n") >= least)
    cuts = (
        sizes.select(*by, F.explode(F.array(F.lit(0).cast("long"), F.col("n"))).alias("a"))
        .unionByName(rows.where("cut").select(*by, F.col("position").cast("long").alias("a")))
        .distinct()
    )
    pieces = cuts.withColumn("b", F.lead("a").over(Window.partitionBy(*by).orderBy("a"))).where(F.col("b") - F.col("a") >= least)
    source = F.when(F.col("a").isNull(), "fallback").when(F.col("minima") > 0, "velocity_min").otherwise("label_json")
    return (
        sizes.join(pieces, list(by), "left")
        .select(*by, F.coalesce("a", F.lit(0)).alias("start"), F.coalesce("b", "n").alias("end"), source.alias("source"))
        .withColumn("idx", (F.row_number().over(Window.partitionBy(*by).orderBy("start")) - 1).cast("long"))
    )


def overlapping_clips(n: Column, length: int, overlap: int) -> Column:
    """(start, end, left, right) of clips over n rows: one if it holds all, else a new one every ``length - overlap``, the last cut."""
    step = length - overlap
    more = F.greatest(F.ceil((n - length) / step), F.lit(0))
    return F.transform(
        F.sequence(F.lit(0).cast("long"), more),
        lambda k: F.struct(
            (k * step).alias("start"),
            F.least(k * step + length, n).alias("end"),
            F.when(k == 0, 0).otherwise(overlap).alias("left"),
            F.when(k == more, 0).otherwise(overlap).alias("right"),
        ),
    )


def blend(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """One value per row of ``by`` from the clips that hold it, ramped over the overlaps and divided by the weights.

    ``parts``: by, i (place in the clip), n (rows of the clip), left, right, value, valid.
    """
    up = F.when(F.col("i") < F.col("left"), (F.col("i") + 1) / F.col("left")).otherwise(1.0)
    k = F.col("i") - (F.col("n") - F.col("right"))
    down = F.when((k >= 0) & (F.col("right") > 0), 1 - k / F.col("right")).otherwise(1.0)
    weight = F.sum("_w")
    return (
        parts.withColumn("_w", F.when(F.col("i") < F.col("left"), up).otherwise(down))
        .groupBy(*by)
        .agg((F.sum(F.col("_w") * F.col("value")) / F.when(weight <= 1e-6, 1.0).otherwise(weight)).alias("value"), F.bool_or("valid").alias("valid"))
    )


def folded(df: DataFrame, by: str, order: Sequence[str], inputs: Sequence[str], out: str, start: Callable[[], Any], step: Callable[..., tuple[Any, tuple]]) -> DataFrame:
    """Adds the columns ``out`` (name and type) that ``step`` makes of a state and a row's ``inputs``, in order.

    The state is ``start()`` in each ``by``.  Rows are streamed, sorted, so
    that a task holds one batch and one state, and time is linear in the
    length of a sequence.
    """
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
    made = df.sparkSession.createDataFrame([], out).schema

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = to_arrow_schema(made)
        at, state = object(), None
        for b in batches:
            rows = []
            for key, *values in zip(*(b.column(c).to_pylist() for c in (by, *inputs)), strict=True):
                if key != at:
                    at, state = key, start()
                state, row = step(state, *values)
                rows.append(row)
            new = zip(*rows, strict=True) if rows else [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(c, f.type) for c, f in zip(new, kinds, strict=True)]], names=[*b.schema.names, *kinds.names])

    return df.repartition(by).sortWithinPartitions(by, *order).mapInArrow(fold, f"{columns}, {out}")


def one_euro(df: DataFrame, by: str, order: Sequence[str], value: str, fps: float = 30.0, least: float = 2.0, beta: float = 0.7, slope: float = 1.0) -> DataFrame:
    """The One-Euro low-pass filter along each sequence: by, position, value, smooth.

    Each value depends on the one before, so that a sequence is streamed in
    order, in one task.  A null stays null and changes nothing.
    """
    share = lambda cutoff: 1 / (1 + fps / (2 * math.pi * cutoff))

    def step(state, x):
        place, old, y, d = state
        if x is None:
            return (place + 1, old, y, d), (place, None)
        if y is None:
            return (place + 1, x, x, 0.0), (place, x)
        d = share(slope) * (x - old) * fps + (1 - share(slope)) * d
        y += share(least + beta * abs(d)) * (x - y)
        return (place + 1, x, y, d), (place, y)

    found = folded(df.select(by, *order, F.col(value).cast("double").alias("value")), by, order, ["value"], "position long, smooth double", lambda: (0, None, None, 0.0), step)
    return found.select(by, "position", "value", "smooth")


def peaks(df: DataFrame, by: str, order: Sequence[str], speed: str, n: int, least: float = 1e-3) -> DataFrame:
    """Up to ``n`` positions per sequence: the fastest rows at a distance from each other, then an even grid; sorted.

    Flat and short sequences take the grid alone.  Each is handled whole, in
    one task; it is a session's frames, not a corpus.
    """
    kind = df.schema[by].dataType.simpleString()

    def grid(size: int, k: int) -> list[int]:
        k = max(1, min(k, size))
        return [round((size - 1) * i / max(1, k - 1)) for i in range(k)]

    def pick(frames: pd.DataFrame) -> pd.DataFrame:
        frames = frames.sort_values(list(order), kind="stable")
        v, size = frames[speed].fillna(0.0).to_numpy(), len(frames)
        if size < 2 * n or v.max() < least:
            kept = grid(size, n)
        else:
            apart, kept = max(1, size // (2 * n)), []
            top = sorted(range(size), key=lambda i: (-v[i], i))[: 2 * n]
            for i in top + grid(size, n):
                if len(kept) < n and all(abs(i - j) >= apart for j in kept):
                    kept.append(i)
        kept = sorted(set(kept))
        return pd.DataFrame({by: frames[by].iloc[0], "idx": range(len(kept)), "position": kept})

    return df.select(by, *order, speed).groupBy(by).applyInPandas(pick, f"{by} {kind}, idx long, position long")


def smooth_rotations(df: DataFrame, by: str, order: str, quaternion: str, alpha: float = 0.5) -> DataFrame:
    """Low-passes unit quaternions (w, x, y, z) along each sequence by spherical interpolation, on one hemisphere: by, order, smooth.

    Rows are streamed in order; a null stays null and changes nothing.
    """

    def unit(q: list[float]) -> list[float]:
        size = max(math.sqrt(sum(x * x for x in q)), 1e-12)
        return [x / size for x in q]

    def step(y, q):
        if q is None:
            return y, (None,)
        x = unit(q)
        if y is None:
            return x, (x,)
        dot = sum(a * b for a, b in zip(x, y, strict=True))
        x, angle = ([-a for a in x] if dot < 0 else x), math.acos(min(abs(dot), 1.0))
        u, v = (1 - alpha, alpha) if angle < 1e-6 else (math.sin((1 - alpha) * angle) / math.sin(angle), math.sin(alpha * angle) / math.sin(angle))
        y = unit([u * a + v * b for a, b in zip(y, x, strict=True)])
        return y, (y,)

    rows = df.select(by, order, F.col(quaternion).cast("array<double>").alias("_q"))
    return folded(rows, by, [order], ["_q"], "smooth array<double>", lambda: None, step).drop("_q")


def shards(df: DataFrame, by: str, order: Sequence[str], size: str, most: int, header: int | str = 0) -> DataFrame:
    """Greedy packing in order: a new shard when the next payload would pass ``most``; headers count after the test.

    A header is a number of bytes or the column that holds it.

    Adds ``shard``, numbered from 0 in each ``by``.  Sizes are streamed in
    order, one at a time.
    """
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, shard, full = None, 0, 0
        for b in batches:
            out = []
            heads = b[header].tolist() if isinstance(header, str) else [header] * len(b)
            for k, s, head in zip(b[by].tolist(), b[size].tolist(), heads, strict=True):
                if k != at:
                    at, shard, full = k, 0, 0
                if full > 0 and full + s > most:
                    shard, full = shard + 1, 0
                full += head + s
                out.append(shard)
            yield b.assign(shard=out)

    return df.repartition(by).sortWithinPartitions(by, *order).mapInPandas(packed, f"{columns}, shard long")
