"""Line dedup: two Bloom filters pick the lines that may repeat, only those are shuffled.

1. Every task hashes the long line keys of its documents into two bit arrays: seen once
   and seen twice (a key whose once-bits were all set already). Two pairs of filters
   merge bit by bit: once = a|b, twice = a|b | (once_a & once_b), so a key of two
   documents is always in the merged twice filter, in whatever order tasks are merged.
   The arrays travel in compressed slices; one task folds each slice as it streams by.
2. The twice filter (``filter_bits`` / 8 bytes, a fixed bound) is broadcast. Keys it holds
   are suspects; only they are shuffled, counted exactly by their full text, and the
   document that keeps them is chosen. A saturated filter only means more suspects.
3. Suspects of confirmed keys become line numbers per document, joined back by row.
   Confirmed keys are replicated over ``SALTS`` sub-keys, so one line of a third of all
   documents spreads over as many tasks.

Defined results: a null text is one empty line. Rows that share a doc_id are one document;
all rows with the keeping doc_id keep their lines. A row with a null doc_id is a document of
its own, smaller than any other; where all holders are null, all keep the line. An empty
table gives an empty result; extra columns pass through, those named ``n_lines``,
``n_dropped`` and ``kept_text`` are replaced. Very long texts are split like any other; a
batch holds some megabytes of text or one text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.llm.common import DOCUMENT_COLUMNS, column_bytes, slices, stored, table, whole_text

MIN_CHARS, MIN_DOCS = 40, 5
FILTER_BITS, N_HASHES = 1 << 26, 3       # 8 MB per filter, whatever the input
SLICE_BITS, SALTS, BATCH_BYTES = 1 << 19, 16, 16 << 20


def line_keys(text: bytes, min_chars: int = MIN_CHARS) -> dict[bytes, list[int]]:
    """Keys of the long lines -> their line numbers. bytes.strip and bytes.lower know ASCII only."""
    out: dict[bytes, list[int]] = {}
    for i, line in enumerate(text.split(b"\n")):
        if len(line) >= min_chars:
            key = line.strip().lower()
            if len(key) >= 4 * min_chars or len(key.decode("utf-8", "replace")) >= min_chars:
                out.setdefault(key, []).append(i)
    return out


def bit_places(hashes: np.ndarray, bits: int, k: int = N_HASHES) -> np.ndarray:
    """k places per 64-bit hash (double hashing), shape (n, k)."""
    lo, hi = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
    return (lo[:, None] + np.arange(k, dtype=np.uint64) * hi[:, None]) & np.uint64(bits - 1)


def _hashes(keys: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64, len(keys))


def fold(hashes: Iterator[np.ndarray], bits: int) -> Iterator[pa.RecordBatch]:
    """Once- and twice-seen arrays of one task's 64-bit hashes, as rows (slice, once, twice)."""
    once, twice = np.zeros(bits, bool), np.zeros(bits, bool)
    for own in hashes:
        h, n = np.unique(own, return_counts=True)
        at = bit_places(h, bits)
        again = once[at].all(axis=1) | (n > 1)
        once[at.ravel()] = True
        twice[at[again].ravel()] = True
    step = min(bits, SLICE_BITS)
    for i in range(0, bits, step):
        if once[i:i + step].any():
            yield _slice_row(i // step, once[i:i + step], twice[i:i + step])


def _build(bits: int, min_chars: int):
    """Tasks' part of step 1."""
    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for b in slices(batches, "text", BATCH_BYTES):
            keys: list[bytes] = []
            for t in column_bytes(b.column(0)):
                keys.extend(line_keys(t, min_chars))
            yield _hashes(keys)

    return lambda batches: fold(hashes(batches), bits)


SLICE_SCHEMA = "slice int, once binary, twice binary"


def _slice_row(i: int, once: np.ndarray, twice: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([i], pa.int32()), pa.array([zlib.compress(np.packbits(once).tobytes(), 1)], pa.binary()),
         pa.array([zlib.compress(np.packbits(twice).tobytes(), 1)], pa.binary())], ["slice", "once", "twice"])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Folds the slices that stream by; memory is two arrays per slice of this partition."""
    got: dict[int, list[np.ndarray]] = {}
    for b in batches:
        for r in b.to_pylist():
            a, t = (np.frombuffer(zlib.decompress(r[c]), np.uint8) for c in ("once", "twice"))
            if r["slice"] in got:
                once, twice = got[r["slice"]]
                got[r["slice"]] = [once | a, twice | t | (once & a)]
            else:
                got[r["slice"]] = [a, t]
    for i, (once, twice) in got.items():
        yield _slice_row(i, np.unpackbits(once), np.unpackbits(twice))


def merged(parts: DataFrame, bits: int) -> bytes:
    """The packed twice-seen filter (``bits`` / 8 bytes) of all tasks' slices."""
    step = min(bits, SLICE_BITS)
    whole = parts.repartition(max(1, min(32, bits // step)), "slice").mapInArrow(_merge, SLICE_SCHEMA)
    out = np.zeros(bits // 8, np.uint8)
    for r in whole.select("slice", "twice").toLocalIterator():
        out[r.slice * step // 8:(r.slice + 1) * step // 8] = np.frombuffer(zlib.decompress(bytes(r.twice)), np.uint8)
    return out.tobytes()


def held(packed: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    """Which hashes the packed filter holds."""
    p = bit_places(hashes, bits)
    return ((packed[p >> np.uint64(3)] >> (np.uint8(7) - (p & np.uint64(7)).astype(np.uint8))) & 1).all(axis=1)


def twice_filter(docs: DataFrame, bits: int = FILTER_BITS, min_chars: int = MIN_CHARS) -> bytes:
    """The twice-seen filter of the line keys of all documents."""
    return merged(docs.select("text").mapInArrow(_build(bits, min_chars), SLICE_SCHEMA), bits)


def suspects(docs: DataFrame, bits: int = FILTER_BITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """Rows (doc_id, _row, key, lines) for the keys that the twice filter holds."""
    packed = docs.sparkSession.sparkContext.broadcast(twice_filter(docs, bits, min_chars))
    id_type = docs.schema["doc_id"].dataType
    out = T.StructType([T.StructField("doc_id", id_type), T.StructField("_row", T.LongType()),
                        T.StructField("key", T.BinaryType()), T.StructField("lines", T.ArrayType(T.IntegerType()))])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.frombuffer(packed.value, np.uint8)
        for b in slices(batches, "text", BATCH_BYTES):
            at, keys, lines = [], [], []
            for i, t in enumerate(column_bytes(b.column(b.schema.get_field_index("text")))):
                for k, n in line_keys(t, min_chars).items():
                    at.append(i), keys.append(k), lines.append(n)
            if not keys:
                continue
            hit = np.flatnonzero(held(seen, _hashes(keys), bits))
            rows = pa.array([at[i] for i in hit], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.get_field_index("doc_id")).take(rows), b.column(b.schema.get_field_index("_row")).take(rows),
                 pa.array([keys[i] for i in hit], pa.binary()), pa.array([lines[i] for i in hit], pa.list_(pa.int32()))],
                ["doc_id", "_row", "key", "lines"])

    rows = docs.select("doc_id", F.xxhash64(whole_text()).alias("_row"), "text")
    return rows.mapInArrow(probe, out)


def line_dedup(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
               bits: int = FILTER_BITS) -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped`` and ``kept_text``: lines found in ``min_docs``
    documents or more stay only in the largest doc_id that holds them."""
    docs = docs.drop("n_lines", "n_dropped", "kept_text")
    sus = stored(suspects(docs, bits, min_chars), "line-suspects")
    holders = sus.groupBy("key", "doc_id").agg(F.count(F.lit(1)).alias("_rows"))
    repeated = (holders.groupBy("key").agg(F.sum(F.when(F.col("doc_id").isNull(), F.col("_rows")).otherwise(1)).alias("n"),
                                           F.max("doc_id").alias("keeper"))
                .filter(F.col("n") >= min_docs)
                .select("key", "keeper", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")))
    lost = (sus.withColumn("_salt", F.pmod("_row", F.lit(SALTS)).cast("int"))
            .join(repeated, ["key", "_salt"])
            .filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
            .groupBy(F.col("doc_id").alias("_doc"), "_row")
            .agg(F.array_distinct(F.flatten(F.collect_list("lines"))).alias("_lost")))
    keyed = docs.withColumn("_hash", F.xxhash64(whole_text()))
    joined = keyed.join(lost, (keyed["_hash"] == lost["_row"]) & keyed["doc_id"].eqNullSafe(lost["_doc"]), "left")
    lines = joined.withColumns({
        "_lines": F.split(whole_text(), "\n", -1),
        "_lost": F.coalesce("_lost", F.expr("CAST(array() AS ARRAY<INT>)"))})
    left = lines.withColumns({
        "n_lines": F.size("_lines").cast("bigint"), "n_dropped": F.size("_lost").cast("bigint"),
        "_left": F.expr("array_except(sequence(0, size(_lines) - 1), _lost)")})
    return left.withColumn("kept_text", F.when(F.size("_lost") == 0, whole_text()).otherwise(
        F.array_join(F.transform("_left", lambda i: F.get(F.col("_lines"), i)), "\n"))
    ).drop("_hash", "_row", "_doc", "_lines", "_lost", "_left")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the text without its repeated lines; every document stays."""
    return (line_dedup(docs).withColumns({"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("bigint")})
            .select(*DOCUMENT_COLUMNS))
