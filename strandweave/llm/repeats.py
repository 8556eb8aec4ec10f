"""Substring dedup: recurring passages, found with sharded Aho-Corasick automata.

1.  Every window of 20 words has one anchor, the eight words of it with the
    smallest hash.  Equal windows have equal anchors at the same place, so
    windows need comparing only where their anchor recurs.
2.  The text around each recurring anchor, a segment, goes to the shard of its
    anchor; no other part of a document can hold a window that recurs.  In
    each shard the passages that recur are confirmed and compiled to automata,
    through which all of its segments, so all documents' parts that can match,
    are streamed to locate every occurrence, word by word.
3.  A segment's windows are removed but at the place where they occur first.

Anchors of many documents are hot: their segments are cut into single windows,
which are dealt by their own words, and equal ones are put together before
they are shuffled.
"""

from __future__ import annotations

import itertools
import struct
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandweave.llm.common import discard, stored

WINDOW, ANCHOR = 20, 8
#: Occurrences from which on an anchor is hot.
HOT = 1000
#: Bits of a text's second hash that go with each run.
TAG = 28
#: Anchors in a shard; the recurring ones of them are in a task's memory at once.
SHARD = 100_000
#: Bytes of text that are hashed at once, and segments that one automaton covers.
BYTES, SEGMENTS = 4_000_000, 10_000

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64, a public-domain mixing function."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _salt(n: int, seed: int) -> np.ndarray:
    return _mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


_BYTE, _PLACE = _salt(256, 1), _salt(ANCHOR, 2) | np.uint64(1)


def anchors(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """For each run of windows with the same anchor: text, hash of the anchor, place of it, first window, number of windows."""
    none = tuple(np.zeros(0, k) for k in (np.int64, np.uint64, np.int64, np.int64, np.int64))
    buf = np.frombuffer(b" ".join([b"", *texts, b""]), np.uint8)
    space = _SPACE[buf]
    start = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    if len(start) < WINDOW:
        return none
    ends = np.cumsum([len(t) + 1 for t in texts])  # of each text, in buf
    text = np.searchsorted(ends, start, "right")
    within = np.arange(len(buf)) - np.repeat(np.r_[0, start], np.diff(np.r_[0, start, len(buf)]))
    weight = np.uint64(0x9E3779B97F4A7C15) * (2 * within.astype(np.uint64) + np.uint64(1))
    value = np.where(space, np.uint64(0), _mix(_BYTE[buf] ^ weight))
    word = _mix(np.add.reduceat(value, start))
    n = len(word) - ANCHOR + 1
    h = np.zeros(n, np.uint64)
    for j in range(ANCHOR):
        h += word[j : j + n] * _PLACE[j]
    h = _mix(h)
    n = len(word) - WINDOW + 1
    best, place = h[:n].copy(), np.arange(n)
    for j in range(1, WINDOW - ANCHOR + 1):
        other = h[j : j + n]
        less = other < best
        np.copyto(best, other, where=less)
        np.copyto(place, np.arange(j, j + n), where=less)
    whole = np.flatnonzero(text[:n] == text[WINDOW - 1 :])  # windows within one text
    if not len(whole):
        return none
    new = np.r_[True, (place[whole][1:] != place[whole][:-1]) | (text[whole][1:] != text[whole][:-1])]
    first = whole[new]
    windows = np.diff(np.r_[np.flatnonzero(new), len(whole)])
    origin = np.searchsorted(text, text[first], "left")  # first word of the text
    return text[first], best[first], place[first] - origin, first - origin, windows


def _blocks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    lo, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > BYTES:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if texts:
        yield lo, len(texts)


def _anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document with windows: the hashes of its anchors, and their runs packed as (first window, number, tag)."""
    for b in batches:
        texts = [t or b"" for t in b.column("text").cast(pa.binary()).to_pylist()]
        tags = b.column("x2").to_numpy() & (2**TAG - 1)
        for lo, hi in _blocks(texts):
            text, h, _, first, windows = anchors(texts[lo:hi])
            own, at = np.unique(text, return_index=True)
            packed = (first << (TAG + 4)) | (windows << TAG) | tags[text + lo]
            offsets = pa.array(np.r_[at, len(text)].astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(c)) for c in (h.view(np.int64), packed)]
            yield pa.RecordBatch.from_arrays([b.column("x1").take(pa.array(own + lo)), *lists], names=["x1", "h", "run"])


def _key(doc_id: int | None, x1: int, x2: int) -> bytes:
    """Sorts as documents do: by doc_id, none last, and of equal ones by the hashes of the text."""
    return struct.pack(">BQqq", doc_id is None, ((doc_id or 0) + 2**63) % 2**64, x1, x2)


def _unpacked(run: int, x2: int) -> tuple[int, int]:
    """First window and number of windows; none if the run is of another text with the same first hash."""
    return run >> (TAG + 4), run >> TAG & 15 if run & (2**TAG - 1) == x2 & (2**TAG - 1) else 0


KEY = struct.calcsize(">BQqq")


def _shards(rows: list[tuple], shards: int) -> pa.RecordBatch:
    """Segments (h, sub, text, document, first window, occurrences) as one compressed row for each shard."""
    squeeze = zstandard.ZstdCompressor(level=3)
    numbers = np.array([(r[0], r[1], r[4], r[5], len(r[2])) for r in rows], dtype=np.int64).reshape(-1, 5)
    shard = (_mix(numbers[:, 0].view(np.uint64) ^ _mix(numbers[:, 1].view(np.uint64))) % np.uint64(shards)).astype(np.int64)
    order = np.lexsort((numbers[:, 0], shard))
    bounds = np.flatnonzero(np.r_[True, shard[order][1:] != shard[order][:-1], True]) if len(rows) else np.zeros(1, np.int64)
    names, blobs = [], []
    for lo, hi in itertools.pairwise(bounds.tolist()):
        own = order[lo:hi].tolist()
        head = numbers[own].T.tobytes() + b"".join(rows[i][3] for i in own)
        names.append(int(shard[own[0]]))
        blobs.append(struct.pack("<I", len(own)) + squeeze.compress(head + b"".join(rows[i][2] for i in own)))
    return pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(blobs, pa.binary())], names=["shard", "segments"])


def _opened(blob: bytes) -> Iterator[tuple[int, int, bytes, bytes, int, int]]:
    (n,) = struct.unpack_from("<I", blob)
    data = zstandard.ZstdDecompressor().decompressobj().decompress(blob[4:])
    h, sub, first, times, size = np.frombuffer(data, np.int64, 5 * n).reshape(5, n).tolist()
    at = 40 * n + KEY * n
    for i in range(n):
        yield h[i], sub[i], data[at : at + size[i]], data[40 * n + KEY * i : 40 * n + KEY * (i + 1)], first[i], times[i]
        at += size[i]


def _hash_of(text: bytes) -> int:
    words = np.frombuffer(text.ljust(-(-len(text) // 8) * 8, b"\0"), "<u8").astype(np.uint64)
    return int(_mix(words ^ _salt(len(words), 3)).sum() >> np.uint64(1))


def _segments(shards: int):
    """The text around each recurring anchor; of equal texts in a task one, with the place of the first and their number."""

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, bytes, bool], list] = {}

        def out() -> pa.RecordBatch:
            rows = [(h, _hash_of(text) if hot else -1, text, *v) for (h, text, hot), v in seen.items()]
            seen.clear()
            return _shards(rows, shards)

        def add(h: int, text: bytes, hot: bool, key: bytes, first: int) -> None:
            old = seen.get((h, text, hot))
            if old is None:
                seen[h, text, hot] = [key, first, 1]
                return
            old[2] += 1
            if (key, first) < (old[0], old[1]):
                old[:2] = key, first

        size = 0
        for b in batches:
            for doc_id, x1, x2, text, runs in zip(*(b.column(c).to_pylist() for c in ("doc_id", "x1", "x2", "text", "runs")), strict=True):
                words, key = text.encode("utf-8", "surrogatepass").split(), _key(doc_id, x1, x2)
                for r in runs:
                    first, windows = _unpacked(r["run"], x2)
                    if r["hot"]:
                        for i in range(first, first + windows):
                            add(r["h"], b" ".join(words[i : i + WINDOW]), True, key, i)
                    elif windows:
                        add(r["h"], b" ".join(words[first : first + windows + WINDOW - 1]), False, key, first)
                size += len(text)
                if size > 4 * BYTES:
                    yield out()
                    size = 0
        yield out()

    return segments


def _confirm(rows: Iterable[tuple[int, int, bytes, bytes, int, int]]) -> Iterator[tuple[bytes, int, int]]:
    """(document, first window, bits of the windows to keep there) for each distinct segment of whole anchors."""
    anchored: dict[tuple[int, int], dict[bytes, list]] = {}
    for h, sub, text, key, first, n in rows:
        old = anchored.setdefault((h, sub), {}).setdefault(text, [key, first, 0])
        old[2] += n
        if (key, first) < (old[0], old[1]):
            old[:2] = key, first
    some: list[tuple[bytes, bytes, int, int, bool]] = []
    while anchored:  # what has been streamed is let go
        _, variants = anchored.popitem()
        some += [(text, *v, len(variants) == 1) for text, v in variants.items()]
        if len(some) >= SEGMENTS:
            yield from _stream(some)
            some = []
    if some:
        yield from _stream(some)


def _passages(coded: list[str], times: list[int], alone: list[bool]) -> list[str]:
    """What recurs in ``coded`` segments: whole ones that are alone with their anchor, of others the windows.

    Windows are told apart by a hash.  Of unequal ones with the same hash one
    counts too many, which does no harm: the automaton goes by their words.
    """
    found = {s for s, n, x in zip(coded, times, alone, strict=True) if x and n > 1}
    many = [(s, n) for s, n, x in zip(coded, times, alone, strict=True) if not x]
    if many:
        codes = np.frombuffer("".join(s for s, _ in many).encode("utf-32-le", "surrogatepass"), "<u4")
        place = _salt(WINDOW, 4) | np.uint64(1)
        word, n = _mix(codes.astype(np.uint64)), len(codes) - WINDOW + 1
        h = np.zeros(n, np.uint64)
        for j in range(WINDOW):
            h += word[j : j + n] * place[j]
        sizes = np.array([len(s) for s, _ in many])
        ends = np.cumsum(sizes)
        within = np.flatnonzero(np.arange(n) + WINDOW <= np.repeat(ends, sizes)[:n])  # windows of one segment
        _, at, same = np.unique(h[within], return_index=True, return_inverse=True)
        total = np.bincount(same, np.repeat([n for _, n in many], sizes)[within])
        segment = np.searchsorted(ends, within[at], "right")
        for k in np.flatnonzero(total > 1).tolist():
            s = many[segment[k]][0]
            j = int(within[at[k]] - (ends[segment[k]] - sizes[segment[k]]))
            found.add(s[j : j + WINDOW])
    return list(found)


def _stream(segments: list[tuple[bytes, bytes, int, int, bool]]) -> Iterator[tuple[bytes, int, int]]:
    """Compiles the passages that recur in ``segments`` to an automaton and streams all of these through it.

    The automaton's matches are all occurrences of each passage; of a window
    the first one stays.
    """
    codes: dict[bytes, str] = {}

    def code(word: bytes) -> str:
        if word not in codes:
            k = len(codes) + 1
            codes[word] = chr(k if k < 0xD800 else k + 0x800)  # no surrogates
        return codes[word]

    coded = ["".join(map(code, text.split(b" "))) for text, *_ in segments]
    passages = _passages(coded, [x[3] for x in segments], [x[4] for x in segments])
    automaton = ahocorasick.Automaton()
    for k, passage in enumerate(passages):
        automaton.add_word(passage, k)
    matches: list[tuple[int, int, int]] = []  # passage, segment, place
    if passages:
        automaton.make_automaton()
        for i, s in enumerate(coded):
            matches += [(k, i, end - len(passages[k]) + 1) for end, k in automaton.iter(s)]
    first: dict[int, tuple[bytes, int]] = {}
    for k, i, j in matches:
        _, key, at, _, _ = segments[i]
        if k not in first or (key, at + j) < first[k]:
            first[k] = key, at + j
    bits = [(1 << (len(s) - WINDOW + 1)) - 1 for s in coded]
    for k, i, j in matches:
        _, key, at, _, _ = segments[i]
        if len(passages[k]) == WINDOW and first[k] != (key, at + j):
            bits[i] &= ~(1 << j)
    for (_, key, at, _, _), kept in zip(segments, bits, strict=True):
        if kept:
            yield key, at, kept


def _located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows to keep, shard by shard."""

    def out(blobs: list[bytes]) -> pa.RecordBatch:
        kept = list(_confirm(itertools.chain.from_iterable(map(_opened, blobs))))
        docs = [struct.unpack(">BQqq", x[0]) for x in kept]
        columns = [[d[2] for d in docs], [d[3] for d in docs], [None if d[0] else d[1] - 2**63 for d in docs], *([x[i] for x in kept] for i in (1, 2))]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["x1", "x2", "doc_id", "first", "bits"])

    at, blobs = None, []
    for b in batches:
        for shard, blob in zip(b.column("shard").to_pylist(), b.column("segments").to_pylist(), strict=True):
            if shard != at and blobs:
                yield out(blobs)
                blobs = []
            at = shard
            blobs.append(blob)
    yield out(blobs)


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, texts, sizes, removed = b.column("doc_id"), [], [], []
        for doc_id, x2, text, runs, keeps in zip(*(b.column(c).to_pylist() for c in ("doc_id", "x2", "text", "runs", "keeps")), strict=True):
            words = (text or "").encode("utf-8", "surrogatepass").split()
            sizes.append(len(words))
            if runs:
                gone = np.zeros(len(words) + 1, np.int32)  # windows, then words
                for r in runs:
                    first, windows = _unpacked(r["run"], x2)
                    gone[first : first + windows] = 1
                for k in keeps or ():
                    if (k["doc_id"], k["x2"]) != (doc_id, x2):
                        continue
                    for j in range(k["bits"].bit_length()):
                        if k["bits"] >> j & 1:
                            gone[k["first"] + j] = 0
                step = np.zeros(len(words) + WINDOW + 1, np.int32)
                at = np.flatnonzero(gone)
                np.add.at(step, at, 1)
                np.add.at(step, at + WINDOW, -1)
                covered = np.cumsum(step)[: len(words)] > 0
                removed.append(int(covered.sum()))
                words = [w for w, x in zip(words, covered.tolist(), strict=True) if not x]
            else:
                removed.append(0)
            texts.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept"],
        )


def dedup(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id long, text): doc_id, n_words, n_removed, kept (the words left, joined by one space).

    Each word goes that a window covers whose words also start earlier, in a
    smaller doc_id or before in the same text; windows are judged on the
    input.  Null text has no words.  Rows without a doc_id come last.  Rows
    with the same doc_id and text count as one document and have the same
    result; of equal doc_ids with other texts the smaller hash comes first.
    """
    keyed = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    keyed = keyed.select("*", F.xxhash64("text").alias("x1"), F.xxhash64(F.lit(1), "text").alias("x2"))
    runs = stored(keyed.select("x1", "x2", "text").mapInArrow(_anchored, "x1 long, h array<long>, run array<long>"), "anchors")
    shards = max(1, (runs.agg(F.sum(F.size("h"))).first()[0] or 0) // SHARD)
    # tables that stand on the other side of a join are written first: a hot anchor or text can then be split
    recurring = stored(_recurring(runs), "recurring")
    by_text = stored(_by_text(runs, recurring), "runs")
    discard(runs)
    keeps = (
        keyed.join(by_text, F.col("x1") == F.col("t"))
        .select("doc_id", "x1", "x2", "text", "runs")
        .mapInArrow(_segments(shards), "shard long, segments binary")
        .repartition("shard")
        .sortWithinPartitions("shard")
        .mapInArrow(_located, "x1 long, x2 long, doc_id long, first int, bits int")
        .groupBy(F.col("x1").alias("k"))
        .agg(F.collect_list(F.struct("doc_id", "x2", "first", "bits")).alias("keeps"))
    )
    known = stored(by_text.join(keeps, F.col("t") == F.col("k"), "left").select("t", "runs", "keeps"), "known")
    discard(by_text)
    return (
        keyed.join(known, F.col("x1") == F.col("t"), "left")
        .select("doc_id", "x2", "text", "runs", "keeps")
        .mapInArrow(_applied, "doc_id long, n_words long, n_removed long, kept string")
    )


def _each(runs: DataFrame) -> DataFrame:
    return runs.select("x1", F.inline(F.arrays_zip("h", "run")))


def _recurring(runs: DataFrame) -> DataFrame:
    """r (hash of an anchor that recurs) and hot."""
    counts = _each(runs).groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    return counts.where("n > 1").select(F.col("h").alias("r"), (F.col("n") >= HOT).alias("hot"))


def _by_text(runs: DataFrame, recurring: DataFrame) -> DataFrame:
    """t (hash of a text) and its runs around recurring anchors; all that follows goes by text, so that equal ones meet."""
    return (
        _each(runs)
        .join(recurring, F.col("h") == F.col("r"))
        .groupBy(F.col("x1").alias("t"))
        .agg(F.collect_set(F.struct("h", "run", "hot")).alias("runs"))
    )
