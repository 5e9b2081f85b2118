"""WARC archives as seekable Zstandard bundles.

Records are grouped into independent frames of about ``FRAME_BYTES``; a bundle ends with a
seek table in a skippable frame (sizes of every frame, the public seekable format), so a
reader finds any frame from the end of the file. The index maps record identifiers to
(bundle, frame, place in the frame). Payloads that occur more than once are written once
(response), the other rows are revisit records that refer to it.

Bundles are written by the tasks with ``pyarrow.fs`` below the shared folder, under a name
of their own per attempt; only bundles named in the written index count, so files of failed
or repeated attempts are never read. Readers take the bundles named in the index, one
frame in memory at a time, and check every payload against its digest.

Defined results: a null payload is empty. Records with equal payloads of ``min_bytes`` or
more: those with the smallest page_id are responses (also where that id repeats), the rest
revisit it; smaller ones are all responses. A null page_id is larger than any other; where
all are null, all are responses. Records larger than a frame get a frame of their own.
An empty table gives an empty index. Extra columns are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.llm.common import stored, table, work_path

# ---- fixed values of the seekable format ----------------------------------------------
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
# ---------------------------------------------------------------------------------------
FRAME_BYTES, BUNDLE_BYTES, LEVEL, SALTS = 256 << 10, 64 << 20, 3, 16
WARC_DATE = "1970-01-01T00:00:00Z"  # of the records; the tables carry no fetch time

INDEX_TYPE = "page_id bigint, bundle string, frame int, offset int, length int"
RECORD_TYPE = ("page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, "
               "refers_to bigint, payload binary")


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 SHA-1 of a binary column: 8 groups of 20 bits, 4 digits each."""
    hexed = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``pages`` (page_id, url, html) plus payload, digest, record_type and refers_to.

    Only digests that occur twice or more are joined back, over ``SALTS`` sub-keys each, so
    one payload of a third of all pages spreads over as many tasks.
    """
    rows = (pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
            .withColumn("digest", base32_sha1(F.col("payload"))))
    first = (rows.filter(F.octet_length("payload") >= min_bytes).groupBy("digest")
             .agg(F.count(F.lit(1)).alias("_n"), F.min("page_id").alias("_first")).filter("_n > 1")
             .select("digest", "_first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")))
    both = rows.withColumn("_salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")).join(
        first, ["digest", "_salt"], "left")
    again = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first")) & (
        F.octet_length("payload") >= min_bytes)
    return both.select("page_id", "url", "payload", "digest",
                       F.when(again, "revisit").otherwise("response").alias("record_type"),
                       F.when(again, F.col("_first")).alias("refers_to"))


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _id_of(value: str | None) -> int | None:
    number = (value or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def _header_value(text: str) -> str:
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in text)


def warc_record(r: dict) -> bytes:
    """One WARC/1.1 record; ``WARC-X-Payload-Length`` is an extension field for revisits."""
    payload = r["payload"]
    head = [b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=UTF-8", b"Content-Length: %d" % len(payload)]
    block = b"\r\n".join(head) + b"\r\n\r\n" + (payload if r["record_type"] == "response" else b"")
    fields = [("WARC-Type", r["record_type"]), ("WARC-Record-ID", record_id(r["page_id"])), ("WARC-Date", WARC_DATE),
              ("WARC-Payload-Digest", f"sha1:{r['digest']}"), ("WARC-X-Payload-Length", str(len(payload))),
              ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    if r["url"] is not None:
        fields.append(("WARC-Target-URI", _header_value(r["url"])))
    if r["record_type"] == "revisit":
        fields += [("WARC-Refers-To", record_id(r["refers_to"])),
                   ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    lines = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return lines.encode() + block + b"\r\n\r\n"


def parse_record(data: bytes, at: int) -> tuple[dict, int]:
    """The record at ``at`` as a row of ``RECORD_TYPE`` and the place after it."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    field = dict(line.split(": ", 1) for line in lines[1:])
    size = int(field["Content-Length"])
    block = data[end + 4:end + 4 + size]
    digest, revisit = field["WARC-Payload-Digest"].removeprefix("sha1:"), field["WARC-Type"] == "revisit"
    payload = None if revisit else block[block.index(b"\r\n\r\n") + 4:]
    if payload is not None and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        raise ValueError(f"payload of {field['WARC-Record-ID']} doesn't match its digest")
    row = {"page_id": _id_of(field["WARC-Record-ID"]), "url": field.get("WARC-Target-URI"),
           "payload_bytes": int(field["WARC-X-Payload-Length"]) if revisit else len(payload),
           "payload_digest": digest, "record_type": field["WARC-Type"],
           "refers_to": _id_of(field.get("WARC-Refers-To")), "payload": payload}
    return row, end + 4 + size + 4


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """Skippable frame: (compressed, decompressed) size per frame, number of frames, flags, magic."""
    body = b"".join(struct.pack("<II", c, d) for c, d in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


def read_seek_table(f: io.IOBase, size: int) -> list[tuple[int, int, int]]:
    """(place, compressed size, decompressed size) of every frame, from the end of a bundle."""
    f.seek(size - 9)
    n, _, magic = struct.unpack("<IBI", f.read(9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table at the end of the bundle")
    f.seek(size - 9 - 8 * n)
    sizes = struct.unpack(f"<{2 * n}I", f.read(8 * n))
    out, at = [], 0
    for c, d in zip(sizes[::2], sizes[1::2]):
        out.append((at, c, d))
        at += c
    return out


class BundleWriter:
    """Writes records into frames and frames into bundles; ``rows`` are index rows of closed bundles."""

    def __init__(self, folder: str, frame_bytes: int, bundle_bytes: int) -> None:
        self.fs, self.folder = pyarrow.fs.FileSystem.from_uri(folder) if "://" in folder else (
            pyarrow.fs.LocalFileSystem(), folder)
        self.uri, self.frame_bytes, self.bundle_bytes = folder, frame_bytes, bundle_bytes
        self.zstd = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self.out, self.buffer, self.rows = None, bytearray(), []

    def add(self, page_id: int | None, record: bytes) -> None:
        if self.buffer and len(self.buffer) + len(record) > self.frame_bytes:
            self.end_frame()
        if self.out is None:
            self.name = f"pages-{uuid.uuid4().hex}.warc.zst"
            self.fs.create_dir(self.folder, recursive=True)
            self.out, self.frames, self.written = self.fs.open_output_stream(
                f"{self.folder}/{self.name}", compression=None), [], 0
        self.rows.append((page_id, f"{self.uri}/{self.name}", len(self.frames), len(self.buffer), len(record)))
        self.buffer += record

    def end_frame(self) -> None:
        if self.buffer:
            packed = self.zstd.compress(bytes(self.buffer))
            self.out.write(packed)
            self.frames.append((len(packed), len(self.buffer)))
            self.written += len(packed)
            self.buffer = bytearray()
            if self.written >= self.bundle_bytes:
                self.close()

    def close(self) -> None:
        if self.out is not None:
            out, self.out = self.out, None
            if self.buffer:
                packed = self.zstd.compress(bytes(self.buffer))
                out.write(packed)
                self.frames.append((len(packed), len(self.buffer)))
                self.buffer = bytearray()
            out.write(seek_table(self.frames))
            out.close()

    def index(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        types = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32()]
        cols = list(zip(*rows)) or [()] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                          ["page_id", "bundle", "frame", "offset", "length"])


def write_archives(records: DataFrame, folder: str, frame_bytes: int = FRAME_BYTES,
                   bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Writes the bundles below ``folder`` and returns the (written) index."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = BundleWriter(folder, frame_bytes, bundle_bytes)
        for b in batches:
            for i in range(b.num_rows):  # one payload as Python bytes at a time
                r = {c: b.column(k)[i].as_py() for k, c in enumerate(b.schema.names)}
                w.add(r["page_id"], warc_record(r))
            if w.out is None and w.rows:
                yield w.index()
        w.close()
        if w.rows:
            yield w.index()

    return stored(records.select("page_id", "url", "payload", "digest", "record_type", "refers_to")
                  .mapInArrow(write, INDEX_TYPE), "warc-index")


def _open(uri: str):
    fs, path = pyarrow.fs.FileSystem.from_uri(uri) if "://" in uri else (pyarrow.fs.LocalFileSystem(), uri)
    return fs.open_input_file(path)


def read_archives(index: DataFrame, payloads: bool = True) -> DataFrame:
    """Every record of the bundles named in ``index``, frame by frame."""
    names = [f.split(" ")[0] for f in RECORD_TYPE.split(", ")]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri in b.column(0).to_pylist():
                with _open(uri) as f:
                    for at, packed, size in read_seek_table(f, f.size()):
                        f.seek(at)
                        data = zstandard.ZstdDecompressor().decompress(f.read(packed), max_output_size=size)
                        rows, place = [], 0
                        while place < len(data):
                            r, place = parse_record(data, place)
                            rows.append(r if payloads else r | {"payload": None})
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([r[c] for r in rows], t) for c, t in zip(names, types)], names)

    return index.select("bundle").distinct().mapInArrow(read, RECORD_TYPE)


def read_record(bundle: str, frame: int, offset: int, length: int) -> dict:
    """One record by its index entry: reads the seek table and a single frame."""
    with _open(bundle) as f:
        at, packed, size = read_seek_table(f, f.size())[frame]
        f.seek(at)
        data = zstandard.ZstdDecompressor().decompress(f.read(packed), max_output_size=size)
    return parse_record(data[offset:offset + length], 0)[0]


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = write_archives(with_revisits(table(spark, sf_dir, "pages")), work_path(spark, "warc"))
    return read_archives(index, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
