"""WARC archives as seekable Zstandard bundles.

A bundle is a run of independent Zstandard frames, each holding whole WARC
records, and a seek table in a skippable frame at its end (the public seekable
format).  The index maps a record to its bundle, frame and offset within the
frame, so one record is read by decompressing one frame.

Bundles travel as rows with a binary column, so that Spark's committed writes
put them into any store that Spark can write to; ``export`` makes files of them.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandweave.llm.common import stored

#: Bytes of records from which on a frame, and of frames from which on a bundle, is closed.
FRAME, BUNDLE = 256_000, 4_000_000
LEVEL = 3
#: Records of equal payloads of at least so many bytes are revisits of one of them.
LEAST_REVISIT = 0

#: Fixed values of the seekable format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1

BUNDLES = "bundle string, data binary, n_records long"
INDEX = "bundle string, frame int, at int, length int, page_id long"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None, date: str) -> bytes:
    """A WARC/1.1 record; a revisit has no block."""
    name = lambda i: f"<urn:page:{'' if i is None else i}>"
    block = payload if kind == "response" else b""
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c.isprintable() and c != "%" else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in url))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if kind == "revisit":
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {name(refers_to)}",
        ]
    head += [f"X-Payload-Bytes: {len(payload)}", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record at ``at``."""
    stop = data.index(b"\r\n\r\n", at)
    lines = data[at:stop].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record at {at}")
    head = dict(x.split(": ", 1) for x in lines[1:])
    end = stop + 4 + int(head["Content-Length"])
    return head, data[stop + 4 : end], end + 4


class Bundle:
    """Writes records into frames."""

    def __init__(self) -> None:
        self.squeeze = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self.frames: list[bytes] = []
        self.table: list[tuple[int, int]] = []
        self.index: list[tuple[int, int, int, int | None]] = []
        self.open: list[bytes] = []
        self.size = self.total = 0

    def add(self, page_id: int | None, data: bytes) -> None:
        self.index.append((len(self.frames), self.size, len(data), page_id))
        self.open.append(data)
        self.size += len(data)
        self.total += len(data)
        if self.size >= FRAME:
            self.close_frame()

    def close_frame(self) -> None:
        if self.open:
            frame = self.squeeze.compress(b"".join(self.open))
            self.frames.append(frame)
            self.table.append((len(frame), self.size))
            self.open, self.size = [], 0

    def finish(self) -> bytes:
        self.close_frame()
        rows = b"".join(struct.pack("<II", *x) for x in self.table)
        foot = rows + struct.pack("<IBI", len(self.table), 0, SEEKABLE)
        return b"".join(self.frames) + struct.pack("<II", SKIPPABLE, len(foot)) + foot


def seek_table(data: bytes) -> list[tuple[int, int, int]]:
    """(offset, compressed size, size) of each frame, from the footer."""
    n, flags, magic = struct.unpack("<IBI", data[-9:])
    if magic != SEEKABLE or flags & 0x80:
        raise ValueError("no seek table of this kind")
    rows = data[-9 - 8 * n : -9]
    out, at = [], 0
    for i in range(n):
        packed, size = struct.unpack_from("<II", rows, 8 * i)
        out.append((at, packed, size))
        at += packed
    return out


def read_frame(data: bytes, frame: int) -> bytes:
    at, packed, size = seek_table(data)[frame]
    return zstandard.ZstdDecompressor().decompress(data[at : at + packed], max_output_size=max(size, 1))


def read_record(data: bytes, frame: int, at: int) -> tuple[dict[str, str], bytes]:
    """One record through the index, from one frame."""
    head, block, _ = parse(read_frame(data, frame), at)
    return head, block


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def with_kinds(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """page_id, url, payload, kind (response or revisit), refers_to of each row of ``pages`` (page_id long, url, html)."""
    payload: Column = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    keyed = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    keyed = keyed.withColumn("digest", F.sha2("payload", 256))
    # written first, so that a payload of many pages can be split in the join
    last = stored(keyed.groupBy(F.col("digest").alias("d")).agg(F.max("page_id").alias("last")), "payloads")
    revisit = (F.octet_length("payload") >= least) & (F.col("page_id") < F.col("last"))
    return keyed.join(last, F.col("digest") == F.col("d")).select(
        "page_id",
        "url",
        "payload",
        F.when(revisit, "revisit").otherwise("response").alias("kind"),
        F.when(revisit, F.col("last")).alias("refers_to"),
    )


def _written(date: str):
    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle = Bundle()

        def out() -> pa.RecordBatch:
            index = [dict(zip(("frame", "at", "length", "page_id"), x, strict=True)) for x in bundle.index]
            kind = pa.list_(pa.struct([("frame", pa.int32()), ("at", pa.int32()), ("length", pa.int32()), ("page_id", pa.int64())]))
            return pa.RecordBatch.from_arrays(
                [pa.array([uuid.uuid4().hex]), pa.array([bundle.finish()], pa.binary()), pa.array([len(bundle.index)], pa.int64()), pa.array([index], kind)],
                names=["bundle", "data", "n_records", "index"],
            )

        for b in batches:
            for i in range(b.num_rows):
                page_id, url, payload, kind, refers_to = (b.column(k)[i].as_py() for k in range(5))
                bundle.add(page_id, record(page_id, url, payload, base32_sha1(payload), kind, refers_to, date))
                if bundle.total >= BUNDLE:
                    yield out()
                    bundle = Bundle()
        if bundle.index:
            yield out()

    return written


def write(pages: DataFrame, date: str = "1970-01-01T00:00:00Z", least: int = LEAST_REVISIT) -> DataFrame:
    """Bundles (bundle, data, n_records, index) of one record per row of ``pages`` (page_id long, url, html), stored in the shared folder.

    Of records with equal payloads of at least ``least`` bytes that with the
    largest page_id is a response, and so are those that share it; others are
    revisits of it.  Null html is empty.  A record without a page_id is a
    response.  An empty table makes no bundle.  Rows that repeat a page_id have
    a record each; further columns stay out, whatever their names.
    """
    rows = with_kinds(pages, least)
    made = rows.mapInArrow(
        _written(date),
        "bundle string, data binary, n_records long, index array<struct<frame:int,at:int,length:int,page_id:bigint>>",
    )
    return stored(made, "warc")


def index_of(bundles: DataFrame) -> DataFrame:
    """page_id, bundle, frame, at, length of each record."""
    return bundles.select("bundle", F.inline("index")).select("page_id", "bundle", "frame", "at", "length")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All records, each at the place that the index names, in frames that the seek table finds."""
    number = lambda x: int(v) if (v := x.removeprefix("<urn:page:").removesuffix(">")) else None
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    for b in batches:
        for name, data, index in zip(*(b.column(c).to_pylist() for c in ("bundle", "data", "index")), strict=True):
            for frame, own in itertools.groupby(index, key=lambda x: x["frame"]):
                block, rows = read_frame(data, frame), []
                for entry in own:
                    head, payload, end = parse(block, entry["at"])
                    kind, digest, page = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha1:"), number(head["WARC-Record-ID"])
                    if page != entry["page_id"] or end - entry["at"] != entry["length"]:
                        raise ValueError(f"record {head['WARC-Record-ID']} in bundle {name} isn't where the index has it")
                    if kind == "response" and (base32_sha1(payload) != digest or len(payload) != int(head["X-Payload-Bytes"])):
                        raise ValueError(f"record {head['WARC-Record-ID']} in bundle {name} doesn't match its digest")
                    refers_to = number(head["WARC-Refers-To"]) if kind == "revisit" else None
                    rows.append((page, int(head["X-Payload-Bytes"]), digest, kind, refers_to, payload if kind == "response" else None))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                    names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"],
                )


def read(bundles: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, payload (null for revisits) of each record in ``bundles``."""
    return bundles.select("bundle", "data", "index").mapInArrow(
        _read,
        "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary",
    )


def export(bundles: DataFrame, folder: str) -> DataFrame:
    """Writes each bundle as ``folder``/<bundle>.warc.zst, a folder that all executors mount; returns path and bytes.

    A file appears whole or not at all, and a repeated task writes the same
    names again.
    """

    def exported(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.makedirs(folder, exist_ok=True)
        for b in batches:
            paths, sizes = [], []
            for name, data in zip(b.column("bundle").to_pylist(), b.column("data").to_pylist(), strict=True):
                path = f"{folder}/{name}.warc.zst"
                with open(part := f"{path}.{uuid.uuid4().hex}", "wb") as f:
                    f.write(data)
                os.replace(part, path)
                paths.append(path)
                sizes.append(len(data))
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], names=["path", "bytes"])

    return bundles.select("bundle", "data").mapInArrow(exported, "path string, bytes long")
