"""Ties, tolerances and edges of the joins in time, on small fixtures, under any partitioning."""

import pytest
from pyspark.sql import functions as F

from strandweave.operators import align, segment
from strandweave.plans import alignment

MS = 1_000_000


def records(spark, rows, parts=1):
    return spark.createDataFrame(rows, "session_id string, stream string, timestamp_ns long, path string").repartition(parts)


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_nearest(spark, parts):
    rows = [("s", "a", t * MS, f"a{t}") for t in (0, 100, 200, 1000)]
    rows += [("s", "b", 90 * MS, "b90"), ("s", "b", 110 * MS, "b110"), ("s", "b", 250 * MS, "b250"), ("s", "b", 200 * MS, "x1"), ("s", "b", 200 * MS, "x2")]
    rows += [("u", "a", 0, "u0"), ("u", "b", 50 * MS + 1, "ub")]
    found = align.align(records(spark, rows, parts), "a", ["b", "c"], 50 * MS).collect()
    got = {(r.anchor_path, r.stream): (r.path, r.delta_ms) for r in found}
    assert got["a100", "b"] == ("b110", 10.0)  # a tie goes to the later one
    assert got["a200", "b"] == ("x1", 0.0)  # of equal times the first
    assert got["a0", "b"] == (None, None)
    assert got["a1000", "b"] == (None, None)
    assert got["u0", "b"] == (None, None)  # just above the tolerance
    assert all(got[a, "c"] == (None, None) for a in ("a0", "u0"))
    sample = align.samples(align.align(records(spark, rows, parts), "a", ["b", "c"], 50 * MS)).where("anchor_path = 'a100'").first()
    assert sample.missing_streams == ["c"] and sample.streams["b"].path == "b110"


def test_tolerance_is_inclusive(spark):
    rows = [("s", "a", 0, "a0"), ("s", "b", 50 * MS, "b")]
    assert align.align(records(spark, rows), "a", ["b"], 50 * MS).first().path == "b"


def test_bins(spark):
    frames = spark.createDataFrame([("s", 100), ("s", 1000), ("t", 5)], "k string, t long")
    samples = spark.createDataFrame([("s", 90, 1.0, 1), ("s", 109, 3.0, 2), ("s", 110, 9.0, 3), ("s", 600, 7.0, 4)], "k string, t long, value double, sample_id long")
    got = {(r.k, r.t): (r.value, r.n) for r in align.bin_mean(frames, samples, "k", 10).collect()}
    assert got == {("s", 100): (2.0, 2), ("s", 1000): (7.0, 0), ("t", 5): (0.0, 0)}


def test_overlaps_are_single(spark):
    one = spark.createDataFrame([("s", 0, 100), ("s", 10, 10)], "k string, s long, e long")
    two = spark.createDataFrame([("s", 90, 300), ("s", 100, 200)], 'k string, start long, end long')
    assert [(r.cut_start, r.cut_end) for r in align.overlaps(one, two, ["k"], 7).collect()] == [(90, 100)]


def frames(spark, values):
    return spark.createDataFrame([("s", i, v) for i, v in enumerate(values)], "k string, i long, v double").repartition(5)


def test_interpolation(spark):
    rows = frames(spark, [None, 1.0, None, None, 4.0, None, None, None, None, None, None, 5.0, None])
    got = [r.filled for r in segment.interpolate(rows, ["k"], ["i"], "v", F.col("v").isNotNull()).orderBy("i").collect()]
    assert got == [None, 1.0, 2.0, 3.0, 4.0, *[None] * 6, 5.0, None]


def test_mean_repeats_the_ends(spark):
    rows = frames(spark, [1.0, 2.0, 3.0])
    got = [r.m for r in rows.select("i", segment.moving_mean(F.col("v"), ["k"], ["i"]).alias("m")).orderBy("i").collect()]
    assert got == pytest.approx([(1 + 1 + 1 + 2 + 3) / 5, (1 + 1 + 2 + 3 + 3) / 5, (1 + 2 + 3 + 3 + 3) / 5])


def test_segments(spark):
    flat = frames(spark, [1.0] * 12)
    one = segment.atomic_segments(flat, ["k"], ["i"], "v", 0.01).collect()
    assert [(r.start, r.end, r.source) for r in one] == [(0, 12, "label_json")]
    dip = frames(spark, [1.0] * 6 + [0.0] + [1.0] * 3)
    got = segment.atomic_segments(dip, ["k"], ["i"], "v", 0.01).collect()
    assert [(r.start, r.end, r.source, r.idx) for r in got] == [(0, 6, "velocity_min", 0)]  # the rest is too short
    assert segment.atomic_segments(frames(spark, [1.0] * 4), ["k"], ["i"], "v", 0.01).count() == 0


def test_runs(spark):
    rows = spark.createDataFrame([("s", i, f) for i, f in enumerate([True, True, False, True])], "k string, i long, f boolean")
    got = sorted((r.start, r.end, r.flag) for r in segment.run_lengths(rows, ["k"], ["i"], F.col("f")).collect())
    assert got == [(0, 2, True), (2, 3, False), (3, 4, True)]


def test_one_euro(spark):
    import math

    values = [0.0, 1.0, 0.5, 2.0, 2.0]
    got = [r.smooth for r in segment.one_euro(frames(spark, values), "k", ["i"], "v").orderBy("position").collect()]
    dt, a = 1 / 30, lambda c: 1 / (1 + 1 / (2 * math.pi * c / 30))
    y, d, want = values[0], 0.0, [values[0]]
    for p, x in zip(values, values[1:]):
        d = a(1.0) * (x - p) / dt + (1 - a(1.0)) * d
        c = a(2.0 + 0.7 * abs(d))
        y = c * x + (1 - c) * y
        want.append(y)
    assert got == pytest.approx(want)
    assert [r.smooth for r in segment.one_euro(frames(spark, [3.0] * 4), "k", ["i"], "v").collect()] == [3.0] * 4


def test_clips(spark):
    got = lambda n: [tuple(c) for c in spark.range(1).select(segment.overlapping_clips(F.lit(n).cast("long"), 30, 5).alias("c")).first().c]
    assert got(30) == [(0, 30, 0, 0)]
    assert got(31) == [(0, 30, 0, 5), (25, 31, 5, 0)]


def test_shards(spark):
    rows = spark.createDataFrame([("s", i, n) for i, n in enumerate([60, 40, 1, 200, 0])], "k string, i long, n long").repartition(3)
    got = [r.shard for r in segment.shards(rows, "k", ["i"], "n", 100).orderBy("i").collect()]
    assert got == [0, 0, 1, 2, 3] or got == [0, 0, 1, 2, 2]


def test_clips_of_a_long_span(spark, tmp_path):
    day, first = 86_400, 1_704_067_200
    rows = [(k, 1, first + k * day, ["view", "error"][k % 2], 1.0 + k, None) for k in range(0, 100, 7)] + [(200, 2, first, "error", 1.0, None)]
    spark.createDataFrame(rows, "event_id long, user_id long, ts long, event_type string, value double, props string").withColumn("ts", F.timestamp_seconds("ts")).write.parquet(f"{tmp_path}/events.parquet")
    span = {1: 98 * day, 2: 0}
    clips = [(u, k, first + 3 * k * day, first + (3 * k + 4) * day) for u in span for k in range(span[u] // (3 * day) + 1)]
    micros = lambda s: s * 1_000_000
    want = sorted((u, e, k, micros(max(t, a)), micros(min(t + day, b))) for e, u, t, kind, *_ in rows if kind == "error" for v, k, a, b in clips if u == v and t + day > a and t < b)
    got = alignment.interval_overlap_clip(spark, str(tmp_path)).select("user_id", "event_id", "k", "cut_start", "cut_end")
    assert sorted(map(tuple, got.collect())) == want and max(k for _, _, k, *_ in want) > 9
    got = alignment.interval_clip_quality(spark, str(tmp_path)).select("user_id", "k", "frames")
    assert sorted(map(tuple, got.collect())) == sorted((u, k, sum(v == u and a <= t < b for _, v, t, *_ in rows)) for u, k, a, b in clips)
