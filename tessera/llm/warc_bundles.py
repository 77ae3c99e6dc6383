"""WARC archives as seekable Zstandard bundles.

A bundle is one ``.warc.zst`` file: records are gathered into groups of about
``frame_bytes``, each group is compressed as a Zstandard frame of its own, and
a skippable frame with the seek table (compressed and raw size of each frame)
closes the file, as in the Zstandard seekable format. Any reader of Zstandard
can read the whole file; one who knows the seek table decompresses only the
frame that holds a record. The index maps a record identifier to its bundle,
frame, and offset inside the raw frame.

Of records with equal payloads the one with the largest page id is written as
``response``; the others are ``revisit`` records, whose block holds the HTTP
header only. Equal payloads are found by SHA-1 and length; a payload shared by
many pages is counted by partial aggregation, and its group's row is copied to
``SALTS`` salts before the join, so no task gets all pages of a payload.

Bundles are written by Spark as rows of a Parquet table (name, content, index)
in the shared checkpoint folder: tasks never open paths themselves, and lost
tasks are repeated under Spark's commit rules. ``export_bundles`` gives files.

Defined results: a null html is an empty payload; a null url leaves the target
header out; a null page id is the smallest one; of rows equal in page id and
payload one is the response and the others revisit it; an empty table gives an
empty archive.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm._text import arrow_map
from tessera.session import ensure_checkpoint_dir

SALTS = 32
FRAME_BYTES = 128 << 10
BUNDLE_BYTES = 4 << 20
#: fixed values of the Zstandard seekable format and of WARC 1.1
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

BUNDLE_SCHEMA = (
    "bundle string, content binary, "
    "records array<struct<record_id: string, frame: int, offset: long, length: long>>"
)
RECORD_SCHEMA = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "record_id string, url string, bundle string, frame int, offset long"
)


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The closing skippable frame for (compressed, raw) sizes of the frames."""
    body = b"".join(struct.pack("<II", *f) for f in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


def read_seek_table(content: bytes) -> list[tuple[int, int, int]]:
    """(start, compressed, raw) of each frame, from the end of a bundle."""
    n, flags, magic = struct.unpack("<IBI", content[-9:])
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table at the end of the bundle")
    width = 12 if flags & 0x80 else 8  # entries may carry a checksum
    at, start, out = len(content) - 9 - n * width, 0, []
    for i in range(n):
        packed, raw = struct.unpack_from("<II", content, at + i * width)
        out.append((start, packed, raw))
        start += packed
    return out


def read_frame(content: bytes, frame: tuple[int, int, int]) -> bytes:
    start, packed, raw = frame
    return zstandard.ZstdDecompressor().decompress(content[start : start + packed], max_output_size=raw)


def read_record(content: bytes, frame: int, offset: int, length: int) -> bytes:
    """One record by its index entry; only its frame is decompressed."""
    return read_frame(content, read_seek_table(content)[frame])[offset : offset + length]


class BundleWriter:
    """Collects records into frames and bundles."""

    def __init__(self, name: str, frame_bytes: int, bundle_bytes: int):
        self.name, self.frame_bytes, self.bundle_bytes = name, frame_bytes, bundle_bytes
        self.packer, self.number = zstandard.ZstdCompressor(level=3), 0
        self._open()

    def _open(self):
        self.frames, self.parts, self.index, self.raw, self.size = [], [], [], bytearray(), 0

    def _close_frame(self):
        if self.raw:
            packed = self.packer.compress(bytes(self.raw))
            self.frames.append((len(packed), len(self.raw)))
            self.parts.append(packed)
            self.size += len(packed)
            self.raw = bytearray()

    def add(self, record_id: str, record: bytes) -> Iterator[tuple]:
        """Take a record; yields a bundle when one is full."""
        if self.raw and len(self.raw) + len(record) > self.frame_bytes:
            self._close_frame()
            if self.size >= self.bundle_bytes:
                yield self.close()
        self.index.append(
            {"record_id": record_id, "frame": len(self.frames), "offset": len(self.raw), "length": len(record)}
        )
        self.raw += record

    def close(self) -> tuple | None:
        self._close_frame()
        if not self.frames:
            return None
        done = (f"{self.name}-{self.number:05d}.warc.zst", b"".join([*self.parts, seek_table(self.frames)]), self.index)
        self.number += 1
        self._open()
        return done


def _record(kind: str, record_id: str, url, digest: str, payload: bytes, date: str, refers) -> bytes:
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = head.encode() + (payload if kind == "response" else b"")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", url))
    if kind == "revisit":
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <{refers}>"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _record_id(page_id, digest: str, twin: int = 1) -> str:
    return f"urn:page:{'null' if page_id is None else page_id}:{digest}" + (f":{twin}" if twin > 1 else "")


def _page_of(record_id: str):
    page = record_id.split(":")[2]
    return None if page == "null" else int(page)


def plan_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, _kind, _refers, _twin) for each page."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumn("_digest", F.unhex(F.sha1("payload"))).withColumn(
        "_salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int")
    )
    groups = (
        rows.where(F.octet_length("payload") >= min_bytes)
        .groupBy("_digest")
        .agg(F.max("page_id").alias("_top"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
        .select("_digest", "_top", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"), F.lit(True).alias("_shared"))
    )
    joined = rows.join(groups, ["_digest", "_salt"], "left")
    twin = F.row_number().over(Window.partitionBy("_digest", "_salt", "page_id").orderBy("url"))
    first = F.col("_shared").isNull() | (F.col("page_id").eqNullSafe(F.col("_top")) & (F.col("_twin") == 1))
    return joined.withColumn("_twin", twin).select(
        "page_id", "url", "payload", "_twin",
        F.when(first, "response").otherwise("revisit").alias("_kind"), F.col("_top").alias("_refers"),
    )


def write_bundles(
    pages: DataFrame,
    path: str,
    *,
    min_bytes: int = 0,
    frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES,
    date: str = "2024-01-01T00:00:00Z",
) -> None:
    """Archive ``pages(page_id, url, html)`` into bundles below ``path``. Of
    payloads of at least ``min_bytes`` only one copy is stored."""

    def run(batches):
        writer = BundleWriter(f"part-{TaskContext.get().partitionId():05d}", frame_bytes, bundle_bytes)
        schema = pa.schema([
            ("bundle", pa.string()), ("content", pa.binary()),
            ("records", pa.list_(pa.struct([
                ("record_id", pa.string()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())
            ]))),
        ])

        def out(bundle):
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(bundle, schema.types)], schema=schema)

        for batch in batches:
            for i in range(batch.num_rows):
                page_id, url, payload, twin, kind, refers = (c[i].as_py() for c in batch.columns)
                digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                name = _record_id(page_id, digest, twin)
                record = _record(kind, name, url, digest, payload, date, _record_id(refers, digest))
                for bundle in writer.add(name, record):
                    yield out(bundle)
        if last := writer.close():
            yield out(last)

    arrow_map(plan_records(pages, min_bytes), run, BUNDLE_SCHEMA).write.option("compression", "none").parquet(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the bundles below ``path``, parsed from its frame by the
    index (``RECORD_SCHEMA``)."""

    def run(batches):
        names = [f.split()[0] for f in RECORD_SCHEMA.split(", ")]
        for batch in batches:
            for i in range(batch.num_rows):
                name, content = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                frames, at, raw, rows = read_seek_table(content), -1, b"", []
                for entry in batch.column(2)[i].as_py():
                    if entry["frame"] != at:
                        at, raw = entry["frame"], read_frame(content, frames[entry["frame"]])
                    rows.append((*_parsed(raw[entry["offset"] : entry["offset"] + entry["length"]]), name, at, entry["offset"]))
                types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return spark.read.schema(BUNDLE_SCHEMA).parquet(path).mapInArrow(run, RECORD_SCHEMA)


def _parsed(record: bytes) -> tuple:
    head, _, block = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response":
        size = len(payload)
        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"digest of {fields['WARC-Record-ID']} doesn't match its payload")
        refers = None
    else:  # the HTTP header of a revisit tells the length of the payload
        size = int(re.search(rb"Content-Length: (\d+)", http)[1])
        refers = _page_of(fields["WARC-Refers-To"].strip("<>"))
    record_id = fields["WARC-Record-ID"].strip("<>")
    return _page_of(record_id), size, digest, kind, refers, record_id, fields.get("WARC-Target-URI")


def record_index(spark: SparkSession, path: str) -> DataFrame:
    """record_id -> bundle, frame, offset (in the raw frame), length."""
    rows = spark.read.schema(BUNDLE_SCHEMA).parquet(path).select("bundle", F.explode("records").alias("r"))
    return rows.select("r.record_id", "bundle", "r.frame", "r.offset", "r.length")


def export_bundles(spark: SparkSession, path: str, folder: str) -> int:
    """Write the bundles as files into a folder of this machine, one by one."""
    import os

    n = 0
    for row in spark.read.schema(BUNDLE_SCHEMA).parquet(path).select("bundle", "content").toLocalIterator():
        with open(os.path.join(folder, row.bundle), "wb") as f:
            f.write(row.content)
        n += 1
    return n


def archive_pages(pages: DataFrame) -> DataFrame:
    """Archive the ``pages`` table in the shared folder and read it back."""
    spark = pages.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_bundles(pages, path)
    return read_records(spark, path)
