"""Helpers shared by the operators: tables, shared folders, empty-safe columns, word rules."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.session import ensure_checkpoint_dir

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def work_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder (driver and executors see it)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet below the shared folder and read back.

    Cuts the lineage and survives lost executors: the files are in the shared folder.
    """
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_text(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def crc_mod(col: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % n


def column_bytes(col: pa.Array) -> list[bytes]:
    """Values of a string column as UTF-8 bytes; null is empty."""
    if not pa.types.is_binary(col.type) and not pa.types.is_large_binary(col.type):
        col = col.cast(pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary())
    return [v or b"" for v in col.to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], col: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose ``col`` holds about ``max_bytes`` at most (one row at least)."""
    for b in batches:
        total = b.column(b.schema.get_field_index(col)).nbytes
        step = b.num_rows if total <= max_bytes else max(1, int(b.num_rows * max_bytes / total))
        for i in range(0, b.num_rows, max(1, step)):
            yield b.slice(i, step)


class WordHashes(dict):
    """word -> 64-bit hash, remembered up to ``most`` words."""

    def __init__(self, hasher, most: int = 400_000) -> None:
        super().__init__()
        self.hasher, self.most = hasher, most

    def __missing__(self, word: bytes) -> int:
        h = self[word] = self.hasher(word)
        return h

    def of(self, text: bytes) -> np.ndarray:
        """Hashes of the words of a lower-cased text, in order; long texts go piece by piece."""
        if len(self) > self.most:
            self.clear()
        parts = []
        for piece in pieces(text):
            w = piece.lower().split()  # ASCII letters and ASCII white space only
            parts.append(np.fromiter(map(self.__getitem__, w), np.uint64, len(w)))
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, np.uint64)


SPACE = re.compile(rb"[\x20\x09-\x0D]")


def pieces(text: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """The text in pieces of about ``size`` bytes, cut at white space."""
    begin = 0
    while begin < len(text):
        end = len(text)
        if end - begin > size:
            m = SPACE.search(text, begin + size)
            end = m.start() if m else end
        yield text[begin:end]
        begin = end


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (wraps around)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pack(a: np.ndarray) -> bytes:
    """A column of numbers, byte by byte plane, compressed."""
    a = np.ascontiguousarray(a)
    planes = a.view(np.uint8).reshape(-1, a.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(dtype).ravel()
