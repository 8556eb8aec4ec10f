"""Quality rules: word and line counts, and compression bands."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Least number of words, and most of them (percent) in repeated three-word windows.
LEAST_WORDS, MOST_REPEATED = 50, 50
SYMBOLS = b"#*$%&|<>"
LEVEL = 3
#: By script (ASCII mostly, letters of two bytes, of three): length in bytes from which on a limit holds, and the least
#: ratio. It lies over that of random characters where prose of that length compresses better: for ASCII base64 from
#: 300 bytes and a-z from 1000, for Cyrillic and the like from 5000, for Chinese from 3000.
LEAST = [
    [(0, 0.0), (300, 1.2), (500, 1.3), (1000, 1.65), (1500, 1.7), (2500, 1.75), (4096, 1.85), (7000, 1.95), (30000, 2.0)],
    [(0, 0.0), (300, 1.1), (1000, 1.5), (3000, 1.95), (5000, 2.1), (7000, 2.2), (30000, 2.5)],
    [(0, 0.0), (300, 1.0), (1000, 1.25), (3000, 1.42), (7000, 1.5), (30000, 1.6)],
]
#: Least share of the characters that has two or three bytes in a text of these scripts.
WIDE = 0.3
#: Length from which on a limit holds; most compression ratio of the whole text.
MOST = [(0, float("inf")), (300, 5.0), (1000, 5.5), (3000, 6.0), (10000, 7.0)]
#: Chunks of so many bytes are judged by LEAST and a limit of their own; a last one of under a quarter isn't judged.
CHUNK, MOST_OF_CHUNK = 4096, 7.0
#: A text fails if more than this share of its chunks lies outside.
MOST_CHUNKS = 0.25
TWO, THREE, INNER = bytes(range(0xC2, 0xE0)), bytes(range(0xE0, 0xF0)), bytes(range(0x80, 0xC0))

OUT = pa.schema(
    [("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("ratio", pa.float64()), ("n_chunks", pa.int64()), ("n_odd_chunks", pa.int64())]
)


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that stand twice or more in ``words``."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    covered, end = 0, 0
    for i, x in enumerate(windows):
        if times[x] > 1:
            covered += i + 3 - max(i, end)
            end = i + 3
    return covered


def least_ratio(text: bytes) -> float:
    """The lower limit for the length and script of ``text``."""
    two, three, inner = (len(text) - len(text.translate(None, x)) for x in (TWO, THREE, INNER))
    script = 0 if two + three < WIDE * (len(text) - inner) else 1 if two >= three else 2
    return next(x for least, x in reversed(LEAST[script]) if len(text) >= least)


def judge_text(text: bytes, squeeze: zstandard.ZstdCompressor) -> tuple:
    words = text.split()  # bytes: splits at \x20 and \x09-\x0D only
    lines = [x for x in text.split(b"\n") if x.strip()]
    n, repeated = len(words), repeated_words(words)
    failed = n < LEAST_WORDS or 100 * repeated > MOST_REPEATED * n
    ratio = len(text) / len(squeeze.compress(text)) if text else 0.0
    low, high = least_ratio(text), next(x for least, x in reversed(MOST) if len(text) >= least)
    chunks = [c for i in range(0, len(text), CHUNK) if len(c := text[i : i + CHUNK]) >= CHUNK // 4]
    odd = sum(not least_ratio(c) <= len(c) / len(squeeze.compress(c)) <= MOST_OF_CHUNK for c in chunks)
    kept = not failed and low <= ratio <= high and odd <= MOST_CHUNKS * len(chunks)
    return (
        n,
        len(b"".join(words).decode("utf-8", "surrogatepass")),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated,
        failed,
        kept,
        ratio,
        len(chunks),
        odd,
    )


def judge_batch(texts: pa.Array) -> pa.RecordBatch:
    squeeze = zstandard.ZstdCompressor(level=LEVEL)
    rows = [judge_text(t or b"", squeeze) for t in texts.cast(pa.binary()).to_pylist()]
    columns = zip(*rows, strict=True) if rows else [[] for _ in OUT]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, OUT, strict=True)], schema=OUT)


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, the counts, base_failed, kept, ratio, n_chunks, n_odd_chunks.

    Null text is empty and fails.  No row depends on another one, so repeated
    rows have the same result; very long texts are judged whole.
    """

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = judge_batch(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *out.columns], names=["doc_id", *OUT.names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        judged,
        f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, ratio double, n_chunks long, n_odd_chunks long",
    )


def is_kept(text: Column) -> Column:
    def kept(texts: pa.Array) -> pa.Array:
        return judge_batch(texts).column("kept")

    return F.arrow_udf(kept, "boolean")(text)


def keep(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text is kept, with all their columns."""
    return docs.where(is_kept(F.col("text")))
