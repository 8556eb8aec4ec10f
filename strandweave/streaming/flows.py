"""Streaming forms of the operators in time, for Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def windows(stream: DataFrame, ts: str, length: str, slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """Count and sum per window and type; what comes later than ``late`` goes."""
    w = F.window(ts, length, slide) if slide else F.window(ts, length)
    return stream.withWatermark(ts, late).groupBy(w.alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


def sessions(stream: DataFrame, ts: str, gap: str, by: str, late: str = "1 hour") -> DataFrame:
    """Runs of rows of one ``by`` that follow each other within ``gap``."""
    return stream.withWatermark(ts, late).groupBy(F.session_window(ts, gap).alias("w"), by).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


def distinct(stream: DataFrame, ts: str, keys: list[str], late: str = "1 hour") -> DataFrame:
    """The first row of each key within the watermark."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def aligned(left: DataFrame, right: DataFrame, on: Column, within: Column, ts: tuple[str, str], late: str) -> DataFrame:
    """Pairs of two streams within a tolerance; both sides' state goes once the watermark has passed it."""
    return left.withWatermark(ts[0], late).join(right.withWatermark(ts[1], late), on & within)


def low_pass(stream: DataFrame, by: str, ts: str, value: str, alpha: float = 0.5) -> DataFrame:
    """An exponential low-pass per key, whose last value is kept as state between batches: by, ts, value, smooth.

    A batch's rows of one key are put in order together, so a worker holds
    those of one key at a time.
    """
    import numpy as np
    import pandas as pd
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def smooth(key: tuple, frames, state: GroupState):
        y = state.get[0] if state.exists else None
        # frames are cut wherever an Arrow batch is full, so each by itself has no order that counts
        parts = [(rows[ts].to_numpy(), rows[value].to_numpy()) for rows in frames]
        at, x = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.lexsort((x, at))
        at, x = at[order], x[order]
        out = np.empty(len(x))
        for i in range(len(x)):
            y = out[i] = float(x[i]) if y is None else alpha * float(x[i]) + (1 - alpha) * y
        if y is not None:
            state.update((float(y),))
        for start in range(0, len(x), 10_000):
            some = slice(start, start + 10_000)
            yield pd.DataFrame({by: key[0], ts: at[some], value: x[some], "smooth": out[some]})

    kind = stream.schema[by].dataType.simpleString()
    return stream.groupBy(by).applyInPandasWithState(
        smooth, f"{by} {kind}, {ts} timestamp, {value} double, smooth double", "y double", "append", GroupStateTimeout.NoTimeout
    )


def run_to_end(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Feeds all that is there, batch by batch, to ``sink``; a second run goes on from the checkpoint."""
    query = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(sink).trigger(availableNow=True).start()
    query.awaitTermination()


def collected(spark: SparkSession, stream: DataFrame, folder: str, mode: str = "append") -> DataFrame:
    """The rows that ``stream`` gives until its input ends, from a table under ``folder`` that batches overwrite by number."""

    def sink(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{folder}/out/batch={batch}")

    run_to_end(stream, sink, f"{folder}/checkpoint", mode)
    return spark.read.schema(stream.schema).parquet(f"{folder}/out").drop("batch")
