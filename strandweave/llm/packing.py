"""Vector best-fit packing of tokenized documents.

A piece's vector (tokens, documents, tiles of attention) follows from its length
alone, so bins are planned over the number of pieces of each length, which has
at most as many rows as a sequence has tokens, whatever the number of
documents.  The plan places runs of equally long pieces; each piece then finds
its place by its rank among those of its length.
"""

from __future__ import annotations

import heapq
import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandweave.llm.common import stored

SEQUENCE = 2048
VOCABULARY = "byte_bpe_50k"
END_ID = 0
#: Attention is worked out in tiles of so many tokens each way.
TILE = 64

Vector = tuple[int, int, int]


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds at most, and how bins are chosen.

    A piece of n tokens takes n tokens, one document and ceil(n / TILE)**2
    tiles of attention.  A piece of a full sequence takes 1024 tiles, so the
    least capacities with which each piece fits are a document and 1024 tiles.
    """

    tokens: int = SEQUENCE
    documents: int = 256
    tiles: int = (SEQUENCE // TILE) ** 2 + 64
    #: Weights of the three, each as a share of its capacity, in the score.
    weights: tuple[float, float, float] = (1.0, 0.5, 0.5)
    #: "dot": the largest weighted dot product of a piece and what is left; "norm": the smallest weighted norm of what would be left.
    rule: str = "norm"


def plan(counts: dict[int, int], capacity: Capacity = Capacity()) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Places for ``counts`` (length: pieces), and the number of sequences.

    Rows (length, first rank, pieces, first sequence, offset): the pieces of
    these ranks lie in consecutive sequences from the first one on.  Longest
    first, each into the bins with the best score among those that hold it
    under every constraint.  Bins with the same rest are alike and go
    together, so that the work depends on the lengths, not on the pieces.
    """
    full = (capacity.tokens, capacity.documents, capacity.tiles)
    weights = np.array(capacity.weights) / np.array(full, float) ** 2
    places: list[tuple[int, int, int, int, int]] = []
    bins: dict[Vector, list[tuple[int, int]]] = {}  # rest: runs of sequences (first, number)
    made = 0

    def score(rests: np.ndarray, need: Vector) -> np.ndarray:
        if capacity.rule == "dot":
            return -(rests * np.array(need)) @ weights
        return (rests - np.array(need)) ** 2 @ weights

    def fits(need: Vector, rest: Vector) -> bool:
        return all(n <= r for n, r in zip(need, rest, strict=True))

    for length in sorted(counts, reverse=True):
        left, rank, need = counts[length], 0, (length, 1, (-(-length // TILE)) ** 2)
        if not fits(need, full):
            raise ValueError(f"a piece of {length} tokens fits no sequence")
        open_bins = [r for r in bins if r[0] >= length and r[1] and r[2] >= need[2]]
        best = list(zip(score(np.array(open_bins), need).tolist(), open_bins, strict=True)) if open_bins else []
        heapq.heapify(best)

        def put(rest: Vector, run: tuple[int, int]) -> None:
            if min(rest) > 0:
                bins.setdefault(rest, []).append(run)
                if fits(need, rest):
                    heapq.heappush(best, (float(score(np.array(rest), need)), rest))

        while left:
            if not best:
                # as many pieces as fit together open bins of their own
                each = min(f // x for f, x in zip(full, need, strict=True))
                n = -(-left // each)
                for k in range(each):
                    here = min(n, left)
                    if not here:
                        break
                    places.append((length, rank, here, made, k * length))
                    rank, left = rank + here, left - here
                    if here < n or k + 1 == each or not left:
                        used = lambda m: tuple(f - m * x for f, x in zip(full, need, strict=True))
                        put(used(k + 1), (made, here))
                        if here < n and k:
                            put(used(k), (made + here, n - here))
                made += n
                continue
            rest = best[0][1]
            if rest not in bins:  # all of its bins have been used
                heapq.heappop(best)
                continue
            first, n = bins[rest].pop()
            here = min(n, left)
            if here < n:
                bins[rest].append((first + here, n - here))
            if not bins[rest]:
                del bins[rest]
            places.append((length, rank, here, first, full[0] - rest[0]))
            put(tuple(r - x for r, x in zip(rest, need, strict=True)), (first, here))
            rank, left = rank + here, left - here
    return places, made


def pieces_of(n: int, most: int = SEQUENCE) -> list[tuple[int, int]]:
    """(start, length) of each piece of ``n`` ids; the first one may be shorter."""
    first = n % most
    return ([(0, first)] if first else []) + [(i, most) for i in range(first, n, most)]


class Encoder:
    """Ids as ``tokenizers`` gives them for a vocabulary file.

    Texts of Latin letters go to ``tiktoken`` with the same vocabulary, which
    takes a quarter of the time and gives the same ids; all others, those that
    spell a special token and those with very long runs of blanks or other
    characters, which make ``tiktoken`` panic, go to ``tokenizers`` itself.
    """

    other = re.compile("[^\\x00-\\u024f]|<\\|endoftext\\|>|\\s{1000}|\\S{20000}")

    def __init__(self, name: str = VOCABULARY):
        import base64

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        if self.other.search(text):
            return self.exact.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


def _cut(vocabulary: str, most: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder, task, seen = Encoder(vocabulary), TaskContext.get().partitionId(), {}
        for b in batches:
            rows = []
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                ids = np.array([*encoder.encode(text or ""), END_ID], dtype="<u4")
                for piece, (start, length) in enumerate(pieces_of(len(ids), most)):
                    rank = seen[length] = seen.get(length, -1) + 1
                    rows.append((doc_id, piece, start, length, zlib.crc32(ids[start : start + length].tobytes()), task, rank))
            kinds = [b.schema.field("doc_id").type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            columns = zip(*rows, strict=True) if rows else [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank"])

    return cut


def pack(docs: DataFrame, capacity: Capacity = Capacity(), vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per piece of ``docs`` (doc_id, text): doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null text is empty: the end's id alone.  Rows that repeat a doc_id are
    documents of their own.  An empty table has no pieces.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    cut = docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        _cut(vocabulary, capacity.tokens),
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, task int, rank long",
    )
    # the rank is within the task, so what is written here is never made anew with other tasks
    pieces = stored(cut, "pieces")
    by_task = pieces.groupBy(F.col("task").alias("t"), F.col("length").alias("n")).count()
    before = F.sum("count").over(Window.partitionBy("n").orderBy("t").rowsBetween(Window.unboundedPreceding, -1))
    bases = by_task.select("t", "n", F.coalesce(before, F.lit(0)).alias("base"))
    places, _ = plan({r["n"]: r["total"] for r in by_task.groupBy("n").agg(F.sum("count").alias("total")).collect()}, capacity)
    # a plan has as many rows as lengths and rests allow, not as there are pieces
    table = np.array(sorted(places) or [(0, 0, 0, 0, 0)], dtype=np.int64)
    shared = spark.sparkContext.broadcast(table)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shared.value
        key = t[:, 0] * 2**44 + t[:, 1]
        for b in batches:
            length, rank = (b.column(c).to_numpy() for c in ("length", "rank"))
            k = np.searchsorted(key, length * 2**44 + rank, "right") - 1
            columns = [b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(t[k, 3] + rank - t[k, 1]), pa.array(t[k, 4])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return (
        pieces.join(bases, (F.col("task") == F.col("t")) & (F.col("length") == F.col("n")))
        .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("base")).alias("rank"))
        .mapInArrow(placed, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    )
