"""SimHash near-duplicates, linked through shards of BK-trees."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandweave.llm.common import cut, discard, small, stored

SHINGLE, SEED, RADIUS = 3, 42, 3
#: Of fingerprints within RADIUS bits, one of RADIUS + 1 blocks is the same; each block's value is a shard.
BLOCKS = RADIUS + 1
#: Shards of more fingerprints are dealt again by the blocks of their other bits, in one of which near ones agree too.
SHARD = 4096
#: Pairs of query and tree node that are compared at once.
FRONTIER = 2_000_000


def fingerprint(text: bytes) -> int:
    """64 bits, each 1 if it is set in over half of the hashes of the three-word shingles."""
    w = text.lower().split()  # bytes: A-Z only, \x20 and \x09-\x0D only
    if not w:
        return 0
    whole = [b" ".join(w)] if len(w) < SHINGLE else [b" ".join(s) for s in zip(w, w[1:], w[2:], strict=False)]
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(s, SEED) for s in whole], dtype="<u8")
    ones = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of each row of ``docs`` (doc_id, text); null text has no words."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").cast(pa.binary()).to_pylist()
            fp = np.array([fingerprint(t or b"") for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp)], names=["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(mapped, f"doc_id {kind}, fp long")


class Forest:
    """BK-trees, one for each group of distinct fingerprints; a child's key is its distance to its parent."""

    def __init__(self, fp: np.ndarray, group: np.ndarray):
        """``group`` is sorted; the first of each group is its tree's root."""
        self.fp = fp
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        self.size = np.diff(np.r_[first, len(fp)])
        self.root = np.repeat(first, self.size)
        left = np.setdiff1d(np.arange(len(fp)), first, assume_unique=True)
        at, edges, children = self.root[left], [], []
        while len(left):
            edge = at * 65 + np.bitwise_count(fp[left] ^ fp[at]).astype(np.int64)
            order = np.argsort(edge, kind="stable")
            edge, left = edge[order], left[order]
            new = np.r_[True, edge[1:] != edge[:-1]]
            edges.append(edge[new])
            children.append(left[new])
            at = left[new][np.cumsum(new) - 1][~new]
            left = left[~new]
        edge = np.concatenate(edges) if edges else np.zeros(0, np.int64)
        order = np.argsort(edge, kind="stable")
        self.edge = edge[order]
        self.child = (np.concatenate(children) if children else np.zeros(0, np.int64))[order]

    def matches(self, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All pairs (a, b), a > b, within ``radius`` in the same group, some at a time."""
        work = np.cumsum(np.repeat(self.size, self.size))
        for lo, hi in _cuts(work, FRONTIER):
            q = np.arange(lo, hi)
            node = self.root[lo:hi]
            while len(q):
                d = np.bitwise_count(self.fp[q] ^ self.fp[node]).astype(np.int64)
                near = (d <= radius) & (node < q)
                if near.any():
                    yield q[near], node[near]
                a = np.searchsorted(self.edge, node * 65 + np.maximum(d - radius, 0), "left")
                b = np.searchsorted(self.edge, node * 65 + np.minimum(d + radius, 64), "right")
                n = b - a
                q = np.repeat(q, n)
                node = self.child[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(a, n)]


def _cuts(work: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    lo = 0
    while lo < len(work):
        before = work[lo - 1] if lo else 0
        hi = max(int(np.searchsorted(work, before + most, "right")), lo + 1)
        yield lo, hi
        lo = hi


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union of a[i] and b[i] for all i; labels are roots."""
    while True:
        while (label[label] != label).any():
            label = label[label]
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        np.minimum.at(label, np.maximum(x, y)[apart], np.minimum(x, y)[apart])


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links that connect each component of a shard, as a binary tree, so that no node has many; shards come one after another."""
    names = ["shard", "sub", "fp"]
    kept: list[np.ndarray] = [np.zeros(0, np.int64) for _ in names]
    parts: list[list[np.ndarray]] = []
    size, least = 0, 100_000

    def linked(shard: np.ndarray, sub: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((sub, shard))
        shard, sub, fp = shard[order], sub[order], fp[order].view(np.uint64)
        new = np.r_[True, (shard[1:] != shard[:-1]) | (sub[1:] != sub[:-1])][: len(shard)]
        label = np.arange(len(fp))
        if len(fp):
            for a, b in Forest(fp, np.cumsum(new)).matches():
                label = merge(label, a, b)
        order = np.argsort(label, kind="stable")
        first = np.flatnonzero(np.r_[True, np.diff(label[order]) != 0][: len(fp)])
        place = np.arange(len(fp)) - np.repeat(first, np.diff(np.r_[first, len(fp)]))
        own = np.flatnonzero(place)
        parent = order[own - place[own] + (place[own] - 1) // 2]
        return pa.RecordBatch.from_arrays(
            [pa.array(fp[order[own]].view(np.int64)), pa.array(fp[parent].view(np.int64))], names=["a", "b"]
        )

    for batch in batches:
        parts.append([batch.column(n).to_numpy(zero_copy_only=False) for n in names])
        size += batch.num_rows
        if size < least:
            continue
        kept, parts = [np.concatenate(x) for x in zip(kept, *parts, strict=True)], []
        last = (kept[0] == kept[0][-1]) & (kept[1] == kept[1][-1])  # this shard may go on
        if not last.all():
            yield linked(*(k[~last] for k in kept))
            kept = [k[last] for k in kept]
        size = len(kept[0])
        least = max(100_000, 2 * size)  # so that a large shard isn't copied with each batch
    yield linked(*(np.concatenate(x) for x in zip(kept, *parts, strict=True)))


def links(distinct: DataFrame) -> DataFrame:
    """Links (a, b) that connect all of ``distinct`` (fp) that lie within RADIUS bits of each other.

    Each fingerprint goes to one shard for each of its blocks; a shard's
    BK-tree finds all pairs within the radius, of which a link for each
    fingerprint at most leaves the task, three at most with any of them.  Shards grow with the data, so they
    are dealt to tasks, not broadcast; only the numbers of the hot ones are,
    of which there are at most BLOCKS * 2**16.
    """
    bits = 64 // BLOCKS
    block = lambda k: F.shiftrightunsigned("fp", bits * k).bitwiseAND(2**bits - 1)
    dealt = distinct.select("fp", F.explode(F.array(*[(block(k) + (k << bits)).alias("s") for k in range(BLOCKS)])).alias("shard"))
    hot = dealt.groupBy("shard").count().where(F.col("count") > SHARD).select(F.col("shard").alias("hot"))
    own = F.floor(F.col("shard") / 2**bits)
    step = bits - bits // BLOCKS
    # the other three blocks' bits as one number, cut into BLOCKS pieces
    rest = F.lit(0).cast("long")
    for k in range(BLOCKS):
        shifted = F.shiftleft(block(k), 0)
        place = F.when(F.lit(k) < own, F.lit(k)).otherwise(F.lit(k - 1))
        rest = rest + F.when(own == k, F.lit(0)).otherwise(shifted * F.pow(F.lit(2.0), place * bits).cast("long"))
    piece = lambda j: F.shiftrightunsigned("rest", step * j).bitwiseAND(2**step - 1) + (j << step)
    subs = F.when(F.col("hot").isNull(), F.array(F.lit(-1).cast("long"))).otherwise(F.array(*[piece(j) for j in range(BLOCKS)]))
    return (
        dealt.join(F.broadcast(hot), F.col("shard") == F.col("hot"), "left")
        .withColumn("rest", rest)
        .select("shard", F.explode(subs).alias("sub"), "fp")
        .repartition("shard", "sub")
        .sortWithinPartitions("shard", "sub")
        .mapInArrow(_links, "a long, b long")
        .where("a != b")
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node of its component) of each node of ``edges`` (a, b).

    Each round takes the smallest root's root among the neighbours for the
    node and for the node's old root too, and halves the ways to the roots.
    Roots only ever get smaller; rounds go on until none does, when
    neighbours have the same root.  Paths, trees and caterpillars of n nodes,
    in order and numbered at random, took no more than log2(n) + 4 rounds up
    to n = 1,000,000.  Roots are joined only where they are no roots any more,
    so the root of a large component, which is in many rows, isn't.
    """
    both = cut(edges.select("a", "b").union(edges.select("b", "a")).toDF("a", "b").distinct())
    after = cut(both.groupBy("a").agg(F.least("a", F.min("b")).alias("root")).withColumnRenamed("a", "node"))
    while True:
        ups = small(after.where("root != node").select(F.col("node").alias("n"), F.col("root").alias("to")))
        at = after.join(ups, F.col("root") == F.col("n"), "left").select("node", "root", F.coalesce("to", "root").alias("up"))
        near = both.join(at.select("node", "up"), F.col("b") == F.col("node")).groupBy("a").agg(F.min("up").alias("near"))
        better = cut(at.join(near, F.col("node") == F.col("a")).select("node", "root", F.least("up", "near").alias("to")))
        hooked = better.where("to < root").groupBy(F.col("root").alias("h")).agg(F.min("to").alias("hooked"))
        new = F.least("to", F.coalesce("hooked", "to"))
        step = cut(better.join(small(hooked), F.col("node") == F.col("h"), "left").select("node", new.alias("root"), (new < F.col("root")).alias("less")))
        for old in (after, better):
            discard(old)
        after = step
        if after.where("less").isEmpty():
            discard(both)
            return after.select("node", "root")


def classes(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, fingerprint, component_id.

    Null text has no words and so the fingerprint zero, which links like any
    other.  component_id is the smallest doc_id that is not null, null if
    there is none.  Repeated rows have the same result.
    """
    marked = stored(fingerprints(docs), "fingerprints")
    least = marked.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(links(least.select("fp")))
    of_root = (
        least.join(roots, F.col("fp") == F.col("node"))
        .groupBy("root")
        .agg(F.min("first").alias("component"))
        .withColumnRenamed("root", "r")
    )
    linked = roots.join(of_root, F.col("root") == F.col("r")).select("node", "component")
    by_fp = least.join(linked, F.col("fp") == F.col("node"), "left").select(
        F.col("fp").alias("f"), F.coalesce("component", "first").alias("component_id")
    )
    by_fp = stored(by_fp, "classes")  # a fingerprint of many documents can then be split in the join
    return marked.join(by_fp, F.col("fp") == F.col("f"), "left").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is their component's smallest, with all their columns.

    A row without a doc_id goes if a row with one is in its component.  Rows
    that repeat the smallest doc_id stay together.
    """
    first = classes(docs).where("doc_id <=> component_id").select(F.col("doc_id").alias("__sw_first")).distinct()
    return docs.join(first, F.col("doc_id").eqNullSafe(F.col("__sw_first")), "left_semi")
