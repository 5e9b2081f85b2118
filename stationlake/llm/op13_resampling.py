"""Importance resampling towards a target: array-scored weights, distributed radix sort.

1. Features are all runs of 1 to 3 words; a feature's bucket is its crc32 modulo ``BUCKETS``.
   A task adds its rows' features up in one array of counts and sends the buckets it saw;
   the sums are two arrays of ``BUCKETS`` numbers. They give one gain per bucket, and a
   text's weight is the sum of its features' entries in that array. crc32 is linear, so the
   checksum of a run comes from those of its words by table look-ups on whole arrays.
2. Score = weight + a Gumbel number from the doc_id's hash. Which scores can be drawn is known
   from counts in ``CELLS`` equal ranges of them; rows beyond the draw aren't sorted.
3. The rest is sorted by (score downwards, doc_id) with least-significant-digit radix sort.
   Rows lie in blocks, arrays of at most ``block`` rows. A pass takes one digit of
   ``DIGIT_BITS`` bits: each block brings its counts per digit; rows of smaller digits in all
   blocks and of the same digit in earlier ones are the block's offset for that digit (running
   sums by digit over blocks); a row's place is that offset plus its number within block and
   digit. Rows travel in pieces per target block, so every block is full but the last, however
   often a key repeats. Passes are as many as the real ranges of the keys need. After the last
   one a row's place is its rank.

Broadcast or sent to the driver: the two arrays of bucket counts, ``CELLS`` counts, 2^11
digit totals per pass. Tables between passes are written to the shared folder.

Defined results: null and empty texts have no feature and weight 0. Every row is a document.
A null doc_id hashes as the empty text and comes after all others in ties; rows alike in score
and doc_id keep the order in which they were read. Texts with fewer than ``MIN_WORDS`` words
get no rank. Empty tables (either one) give no rows, or gains from one side only. Extra
columns aren't read. Very long texts are worked on in pieces of some megabytes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationlake.llm.common import column_bytes, pack, slices, stored, table, unpack

BUCKETS, LONGEST, MIN_WORDS, PERCENT, SEED = 10_000, 3, 20, 5, 42
DIGIT_BITS, BLOCK, CELLS = 11, 1 << 16, 4096
BATCH_BYTES, PIECE_WORDS, MOST_WORDS, TABLED = 4 << 20, 1 << 20, 400_000, 64

#: Bytes of words stay (A-Z in lower case), all others become spaces; bytes above 0x7F belong to words.
_FOLD = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 32 for c in range(256))


# ---- features ----------------------------------------------------------------------------
def _crc_tables() -> np.ndarray:
    """table[n, j, v]: what byte j of a checksum, being v, turns into when n more bytes (zeros) follow."""
    base = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        base = np.where(base & 1, (base >> 1) ^ np.uint32(0xEDB88320), base >> 1)
    out = np.zeros((TABLED + 1, 4, 256), np.uint32)
    for j in range(4):
        out[0, j] = np.arange(256, dtype=np.uint32) << np.uint32(8 * j)
    for n in range(1, TABLED + 1):
        prev = out[n - 1]
        out[n] = (prev >> np.uint32(8)) ^ base[prev & np.uint32(0xFF)]
    return out


class Features:
    """Buckets of a text's features; words are remembered with their checksums."""

    def __init__(self, buckets: int = BUCKETS, longest: int = LONGEST) -> None:
        from zlib import crc32

        self.crc32, self.buckets, self.longest, self.tables = crc32, buckets, longest, _crc_tables()
        self.known: dict[bytes, int] = {}
        self.crc, self.spaced, self.size = (np.zeros(1024, t) for t in (np.uint32, np.uint32, np.int64))

    def _numbers(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > MOST_WORDS:
            self.known.clear()
        known, n = self.known, len(self.known)
        for w in set(words).difference(known):
            if n == len(self.crc):
                self.crc, self.spaced, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.crc, self.spaced, self.size))
            known[w] = n
            self.crc[n], self.spaced[n], self.size[n] = self.crc32(w), self.crc32(b" " + w), len(w) + 1
            n += 1
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def _followed(self, crc: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Checksums of ``crc`` after n more zero bytes each."""
        out, left = crc.copy(), n
        while True:
            step = np.minimum(left, TABLED)
            b = [((out >> np.uint32(8 * j)) & np.uint32(0xFF)).astype(np.int64) for j in range(4)]
            out = self.tables[step, 0, b[0]] ^ self.tables[step, 1, b[1]] ^ self.tables[step, 2, b[2]] ^ self.tables[step, 3, b[3]]
            left = left - step
            if not left.any():
                return out

    def of(self, texts: list[bytes]) -> Iterator[tuple[int, int, np.ndarray]]:
        """(text number, words, buckets of features), in one part or, for long texts, in several."""
        for i, t in enumerate(texts):
            words = t.translate(_FOLD).split()
            for a in range(0, max(1, len(words)), PIECE_WORDS):
                own = words[a:a + PIECE_WORDS]
                after = words[a + PIECE_WORDS:a + PIECE_WORDS + self.longest - 1]
                at, n = self._numbers(own + after), len(own)
                parts, crc = [], self.crc[at]
                for k in range(self.longest):  # runs of k + 1 words that start among ``own``
                    if k:
                        nxt = at[k:]
                        crc = self._followed(crc[:len(nxt)], self.size[nxt]) ^ self.spaced[nxt]
                    parts.append(crc[:n])
                yield i, n, np.concatenate(parts).astype(np.int64) % self.buckets


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> list[int]:
    """Features per bucket over all texts; tasks send one count per bucket they saw."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f, total = Features(buckets, longest), np.zeros(buckets, np.int64)
        for b in slices(batches, "text", BATCH_BYTES):
            for _, _, own in f.of(column_bytes(b.column(0))):
                total += np.bincount(own, minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["bucket", "n"])

    out = [0] * buckets
    for r in docs.select("text").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(source: list[int], target: list[int]) -> np.ndarray:
    """floor(1000 * ln of the ratio of smoothed shares) per bucket."""
    big_s, big_t, k = sum(source), sum(target), len(source)
    return np.asarray([math.floor(1000 * math.log((float(t + 1) * float(big_s + k)) / (float(s + 1) * float(big_t + k))))
                       for s, t in zip(source, target)], np.int64)


def gumbel(doc_id: str, seed: int = SEED) -> Column:
    """floor(-1000 ln(-ln u)) with u from the first 32 bits of sha256(``seed:doc_id``)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def scored(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score per row, and _row, a number of the row's own (a written table)."""
    sent = docs.sparkSession.sparkContext.broadcast(gain)
    names = ["doc_id", "n_words", "n_features", "weight", "_row"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_gain, row = sent.value, TaskContext.get().partitionId() << 40
        f = Features(len(own_gain), longest)
        for b in slices(batches, "text", BATCH_BYTES):
            words, features, weight = (np.zeros(b.num_rows, np.int64) for _ in range(3))
            for i, n, own in f.of(column_bytes(b.column(1))):
                words[i] += n
                features[i] += len(own)
                weight[i] += own_gain[own].sum()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words), pa.array(features), pa.array(weight),
                                              pa.array(row + np.arange(b.num_rows))], names)
            row += b.num_rows

    out = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, ", ".join(f"{c} bigint" for c in names))
    return stored(out.withColumn("score", F.col("weight") + gumbel("doc_id", seed)), "scored")


# ---- radix sort ----------------------------------------------------------------------------
BLOCK_TYPE = "block bigint, n bigint, keys binary, rows binary, digits array<int>, counts array<bigint>"
_BLOCK = [c.split(" ")[0] for c in BLOCK_TYPE.split(", ")]


def _digit(keys: np.ndarray, shift: int) -> np.ndarray:
    """The digit at bit ``shift`` of keys of two 64-bit numbers (n, 2), the second more significant; no digit spans both."""
    return (keys[:, shift // 64] >> np.uint64(shift % 64)).astype(np.int64) & ((1 << DIGIT_BITS) - 1)


def _block_row(number: int, keys: np.ndarray, rows: np.ndarray, shift: int | None) -> pa.RecordBatch:
    digits, counts = np.unique(_digit(keys, shift), return_counts=True) if shift is not None else ((), ())
    return pa.RecordBatch.from_arrays(
        [pa.array([number]), pa.array([len(rows)]), pa.array([pack(keys.ravel())], pa.binary()), pa.array([pack(rows)], pa.binary()),
         pa.array([digits], pa.list_(pa.int32())), pa.array([counts], pa.list_(pa.int64()))], _BLOCK)


def shifts(id_bits: int, score_bits: int) -> list[int]:
    """Bit places of the digits to sort by, least significant first."""
    return [*range(0, id_bits, DIGIT_BITS), *range(64, 64 + score_bits, DIGIT_BITS)]


def blocks(rows: DataFrame, first: int | None, block: int = BLOCK) -> DataFrame:
    """BLOCK_TYPE from rows (id_key, score_key, _row), in the order of tasks and rows; ``counts`` for the digit at ``first``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, n = TaskContext.get().partitionId() << 24, [], 0

        def cut(size: int) -> pa.RecordBatch:
            nonlocal held, n, number
            own = np.concatenate(held)
            held, n = [own[size:]], n - size
            number += 1
            return _block_row(number - 1, own[:size, :2], own[:size, 2].astype(np.int64), first)

        for b in batches:
            held.append(np.stack([b.column(i).to_numpy().astype(np.uint64) for i in range(3)], axis=1))
            n += b.num_rows
            while n >= block:
                yield cut(block)
        if n:
            yield cut(n)

    return rows.select("id_key", "score_key", "_row").mapInArrow(run, BLOCK_TYPE)


def _offsets(own: DataFrame) -> DataFrame:
    """block, offsets: pairs (digit, place of its first row of this block), from all blocks' counts."""
    by = own.select("block", F.explode(F.arrays_zip("digits", "counts")).alias("c")).select("block", "c.digits", "c.counts")
    total = 0
    starts = []
    for r in by.groupBy("digits").agg(F.sum("counts").alias("n")).orderBy("digits").collect():  # a row per digit
        starts.append((r.digits, total))
        total += r.n
    start = by.sparkSession.createDataFrame(starts, "digits int, _start bigint")
    earlier = F.sum("counts").over(Window.partitionBy("digits").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    return (by.withColumn("_earlier", F.coalesce(earlier, F.lit(0))).join(start, "digits")
            .groupBy("block").agg(F.collect_list(F.struct("digits", (F.col("_start") + F.col("_earlier")).alias("at"))).alias("offsets")))


def counting_pass(own: DataFrame, shift: int, then: int | None, block: int = BLOCK) -> DataFrame:
    """Blocks stably sorted by the digit at ``shift``; their counts are those of the digit at ``then``."""
    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                keys, rows = unpack(r["keys"], np.uint64).reshape(-1, 2), unpack(r["rows"], np.int64)
                digit, first = _digit(keys, shift), np.zeros(1 << DIGIT_BITS, np.int64)
                first[[x["digits"] for x in r["offsets"]]] = [x["at"] for x in r["offsets"]]
                order = np.argsort(digit, kind="stable")
                d = digit[order]
                begin = np.searchsorted(d, d)  # first row of the digit within the sorted block
                place = first[d] + np.arange(len(d)) - begin
                target = place // block
                cut = np.flatnonzero(np.diff(target, prepend=-1))
                ends = np.append(cut[1:], len(d))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(target[cut]), *(pa.array([pack(v[a:z].ravel()) for a, z in zip(cut, ends)], pa.binary())
                                              for v in (keys[order], rows[order], place))], ["target", "keys", "rows", "places"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = None, []

        def whole() -> pa.RecordBatch:
            place = np.concatenate([p for _, _, p in held])
            order = np.argsort(place)
            if (np.diff(place[order]) != 1).any() or place.min() != number * block:
                raise ValueError(f"block {number} has gaps")
            return _block_row(number, np.concatenate([k for k, _, _ in held])[order], np.concatenate([r for _, r, _ in held])[order], then)

        for b in batches:
            for r in b.to_pylist():
                if r["target"] != number and held:
                    yield whole()
                    held = []
                number = r["target"]
                held.append((unpack(r["keys"], np.uint64).reshape(-1, 2), unpack(r["rows"], np.int64), unpack(r["places"], np.int64)))
        if held:
            yield whole()

    moved = (own.select("block", "keys", "rows").join(_offsets(own), "block")
             .mapInArrow(scatter, "target bigint, keys binary, rows binary, places binary"))
    return moved.repartition("target").sortWithinPartitions("target").mapInArrow(gather, BLOCK_TYPE)


def radix_ranks(rows: DataFrame, id_bits: int, score_bits: int, block: int = BLOCK) -> DataFrame:
    """(_row, rank) of rows (id_key, score_key, _row): rank 1 has the smallest (score_key, id_key)."""
    passes = [*shifts(id_bits, score_bits), None]
    own = stored(blocks(rows, passes[0], block), "blocks")
    if len(passes) == 1:  # all keys alike: one pass of a digit that is 0 everywhere
        passes = [0, None]
        own = stored(blocks(rows, 0, block), "blocks")
    for shift, then in zip(passes, passes[1:]):
        own = stored(counting_pass(own, shift, then, block), "blocks")

    def ranks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for number, packed in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                r = unpack(packed, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(r), pa.array(number * block + 1 + np.arange(len(r)))], ["_row", "rank"])

    return own.select("block", "rows").mapInArrow(ranks, "_row bigint, rank bigint")


def draw(rows: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, block: int = BLOCK, cells: int = CELLS) -> DataFrame:
    """``rows`` (of :func:`scored`) with ``rank``: 1, 2, ... for those drawn, null for all others."""
    none = rows.withColumn("rank", F.lit(None).cast("bigint"))
    able = rows.filter(F.col("n_words") >= min_words)
    m = able.agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("lo"), F.max("score").alias("hi")).first()
    wanted = percent * m.n // 100
    if not wanted:
        return none
    width = max(1, -(-(m.hi - m.lo + 1) // cells))
    cell = ((F.lit(m.hi) - F.col("score")) / F.lit(width)).cast("bigint")
    seen, last = 0, 0
    for r in able.groupBy(cell.alias("cell")).count().orderBy("cell").collect():  # at most ``cells`` rows
        seen, last = seen + r["count"], r.cell
        if seen >= wanted:
            break
    near = able.filter(cell <= last)
    ids = near.agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).first()
    lo, hi = ids.lo or 0, ids.hi or 0
    keys = near.select(F.coalesce(F.col("doc_id") - F.lit(lo), F.lit(hi - lo + 1)).alias("id_key"),
                       (F.lit(m.hi) - F.col("score")).alias("score_key"), "_row")
    drawn = stored(radix_ranks(keys, (hi - lo + 1).bit_length(), (min(m.hi - m.lo, (last + 1) * width)).bit_length(), block)
                   .filter(F.col("rank") <= wanted), "drawn")
    return rows.join(drawn, "_row", "left")


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED,
              buckets: int = BUCKETS, longest: int = LONGEST, block: int = BLOCK) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank per row of ``docs``, drawn towards the texts of ``target``."""
    gain = gains(bucket_counts(docs, buckets, longest), bucket_counts(target, buckets, longest))
    return draw(scored(docs, gain, longest, seed), percent, min_words, block).drop("_row")


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")
