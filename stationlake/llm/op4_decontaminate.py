"""Benchmark decontamination: training passages queried against a BM25 index of test items.

The index holds the benchmark items, with impacts divided by the item's score against
itself, so one threshold (``MIN_SCORE``) fits items of any length. Passages are windows of
twice the longest item, half overlapping, so every item lies whole in some passage. All
passages of a batch are bounded at once by the sum of their terms' largest impacts, the
first test of WAND, then by the same sum per block of neighbouring items: where a bound
stays below the threshold no item can reach it. Block-max WAND runs over the blocks that
are left and returns every item at or above the threshold. A hit is a
leak when the passage holds enough of the item's question and of its answer (share of the
distinct 5-word shingles; parts under five words as a whole).

The index is built per shard of the benchmark (``SHARD_BYTES`` of text, broadcast one by
one), so no broadcast grows with the benchmark. Number of items, mean and greatest length
and the items per term are counted by Spark over the whole benchmark; a shard gets the
counts of its own terms. Scores, passages and leaks don't depend on the number of shards.

Defined results: words are compared lower-cased (A-Z) without ASCII punctuation. Null and
empty texts have no leaks; null or wordless items are never found. Rows are judged one by
one (repeated rows repeat their leaks), items with equal texts are all reported. Extra
columns pass through; a column named ``leaks`` is replaced. Very long texts are more passages.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.llm.common import DOCUMENT_COLUMNS, column_bytes, slices, stored, table

K1, B = 1.2, 0.75
MIN_SCORE, MIN_OVERLAP, SHINGLE = 0.6, 0.8, 5
BLOCK, RANGES, SHARD_BYTES, BATCH_BYTES = 32, 64, 16 << 20, 4 << 20
STEP = 512  # passages that are bounded per block at once
ANSWER_SHARE = 1 / 3  # of the words, where the item has no question mark before its end

#: A-Z to lower case; every other ASCII character that is no letter or digit to a space.
BYTE_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
                   for c in range(256))
LEAK_TYPE = ("array<struct<item_id:bigint,score:double,question_overlap:double,answer_overlap:double,"
             "first_word:bigint>>")


def words(text: bytes) -> list[bytes]:
    return text.translate(BYTE_TABLE).split()


def question_and_answer(text: bytes) -> tuple[list[bytes], list[bytes]]:
    """Up to the last question mark and what follows it; else the first two thirds of the words and the rest."""
    head, mark, tail = text.rpartition(b"?")
    if mark and words(head) and words(tail):
        return words(head), words(tail)
    w = words(text)
    cut = len(w) - int(len(w) * ANSWER_SHARE)
    return w[:cut], w[cut:]


def shingles(w: list[bytes]) -> set:
    return {tuple(w[i:i + SHINGLE]) for i in range(len(w) - SHINGLE + 1)}


class Whole(NamedTuple):
    """Counts over the whole benchmark; ``holders``: items per term, for the terms of a shard at least."""

    items: int
    words: int
    longest: int
    holders: dict[bytes, int]


class Index:
    """BM25 postings per term, with the largest impact per list and per block of postings."""

    def __init__(self, items: list[tuple[int, bytes]], whole: Whole | None = None) -> None:
        bags = [Counter(words(t)) for _, t in items]
        keep = [i for i, bag in enumerate(bags) if bag]
        self.ids = [items[i][0] for i in keep]
        self.parts = [question_and_answer(items[i][1]) for i in keep]
        bags = [bags[i] for i in keep]
        sizes = [sum(bag.values()) for bag in bags]
        if whole is None:
            whole = Whole(len(bags), sum(sizes), max(sizes, default=0), Counter(t for bag in bags for t in bag))
        mean = whole.words / max(1, whole.items)
        self.longest = whole.longest
        df = {t: whole.holders[t] for t in sorted({t for bag in bags for t in bag})}
        idf = {t: math.log(1 + (whole.items - n + 0.5) / (n + 0.5)) for t, n in df.items()}
        self.terms = {t: i for i, t in enumerate(df)}
        self.items: list[list[int]] = [[] for _ in df]
        self.impacts: list[list[float]] = [[] for _ in df]
        for i, (bag, size) in enumerate(zip(bags, sizes)):
            norm = K1 * (1 - B + B * size / mean)
            own = {t: idf[t] * n * (K1 + 1) / (n + norm) for t, n in bag.items()}
            most = sum(own.values())
            for t, v in own.items():
                self.items[self.terms[t]].append(i)
                self.impacts[self.terms[t]].append(v / most)
        self.blocks = [[max(v[k:k + BLOCK]) for k in range(0, len(v), BLOCK)] for v in self.impacts]
        self.largest = np.asarray([max(v) for v in self.impacts], np.float64)
        # the largest impact per term and range of ``width`` neighbouring items, term after term
        self.width = max(1, -(-len(self.ids) // RANGES))
        self.ranges = -(-len(self.ids) // self.width)
        term = np.repeat(np.arange(len(df)), [len(v) for v in self.items])
        at = term * self.ranges + np.concatenate([*self.items, []]).astype(np.int64) // self.width
        keys, place = np.unique(at, return_inverse=True)
        self.range_max = np.zeros(len(keys))
        np.maximum.at(self.range_max, place, np.concatenate([*self.impacts, []]))
        self.range_of = keys % max(1, self.ranges)
        self.range_start = np.searchsorted(keys, np.arange(len(df) + 1) * self.ranges)

    def bounds(self, passage: np.ndarray, term: np.ndarray, n: int) -> np.ndarray:
        """Upper bound of the scores per passage (0 .. n-1) and range of items."""
        size = self.range_start[term + 1] - self.range_start[term]
        flat = np.repeat(self.range_start[term] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        cell = np.repeat(passage, size) * self.ranges + self.range_of[flat]
        return np.bincount(cell, self.range_max[flat], n * self.ranges).reshape(n, self.ranges)

    def search(self, terms: list[int], least: float, begin: int = 0, end: int | None = None) -> list[tuple[int, float]]:
        """All (item, score) at or above ``least`` among the items ``begin`` to ``end``: document-at-a-time
        block-max WAND."""
        cursors, out = [], []  # cursor: current item, place, term
        for t in terms:
            k = bisect_left(self.items[t], begin)
            if k < len(self.items[t]):
                cursors.append([self.items[t][k], k, t])
        end = len(self.ids) if end is None else end
        cursors = [c for c in cursors if c[0] < end]
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, -1
            for i, c in enumerate(cursors):
                bound += self.largest[c[2]]
                if bound >= least:
                    pivot = i
                    break
            if pivot < 0:
                break
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            bound, jump = 0.0, cursors[pivot + 1][0] if pivot + 1 < len(cursors) else math.inf
            for c in cursors[:pivot + 1]:
                place = bisect_left(self.items[c[2]], item, c[1])
                if place < len(self.items[c[2]]):
                    k = place // BLOCK
                    bound += self.blocks[c[2]][k]
                    jump = min(jump, self.items[c[2]][min(len(self.items[c[2]]), (k + 1) * BLOCK) - 1] + 1)
            if bound >= least:
                if cursors[0][0] == item:
                    score = sum(self.impacts[t][k] for t, k in sorted((c[2], c[1]) for c in cursors[:pivot + 1]))
                    if score >= least:
                        out.append((item, score))
                    target = item + 1
                else:
                    target = item
            else:
                target = max(jump, item + 1)
            for c in cursors[:pivot + 1]:
                if c[0] < target:
                    c[1] = len(self.items[c[2]]) if target == math.inf else bisect_left(self.items[c[2]], target, c[1])
                    c[0] = self.items[c[2]][c[1]] if c[1] < len(self.items[c[2]]) else -1
            cursors = [c for c in cursors if 0 <= c[0] < end]
        return out

    def leaks(self, texts: list[bytes], least: float = MIN_SCORE, overlap: float = MIN_OVERLAP) -> list[list[dict]]:
        """Verified items per text."""
        out: list[list[dict]] = [[] for _ in texts]
        stride = max(1, self.longest)
        if not self.ids:
            return out
        tokens: list[bytes] = []
        first_token, first_chunk, chunks = [], [], 0
        for t in texts:
            first_token.append(len(tokens))
            first_chunk.append(chunks)
            w = words(t)
            tokens.extend(w)
            chunks += -(-len(w) // stride) + 1  # an empty chunk keeps texts apart
        ids = np.fromiter(map(self.terms.get, tokens, repeat(-1)), np.int64, len(tokens))
        at = np.flatnonzero(ids >= 0)
        if not len(at):
            return out
        starts, base = np.asarray(first_token), np.asarray(first_chunk)
        text = np.searchsorted(starts, at, "right") - 1
        chunk = base[text] + (at - starts[text]) // stride
        # the passage of chunk c has the chunks c and c + 1
        passage = np.concatenate([chunk, chunk[chunk > base[text]] - 1])
        term = np.concatenate([ids[at], ids[at][chunk > base[text]]])
        key = np.unique(passage * len(self.terms) + term)
        passage, term = key // len(self.terms), key % len(self.terms)
        hot = np.flatnonzero(np.bincount(passage, self.largest[term], chunks) >= least - 1e-9)
        lo, hi = np.searchsorted(passage, hot, "left"), np.searchsorted(passage, hot, "right")
        for p, a, b, ranges in self._reachable(hot, lo, hi, term, least - 1e-9):
            found = [x for r in ranges for x in self.search(term[a:b].tolist(), least - 1e-9, r * self.width,
                                                            (r + 1) * self.width)]
            if not found:
                continue
            i = int(np.searchsorted(base, p, "right") - 1)
            begin = first_token[i] + (p - first_chunk[i]) * stride
            end = min(begin + 2 * stride, first_token[i + 1] if i + 1 < len(texts) else len(tokens))
            w = tokens[begin:end]
            grams, joined = shingles(w), b" " + b" ".join(w) + b" "
            for item, score in found:
                share = [self._held(part, grams, joined) for part in self.parts[item]]
                if min(share) >= overlap:
                    out[i].append({"item_id": self.ids[item], "score": score, "question_overlap": share[0],
                                   "answer_overlap": share[1], "first_word": begin - first_token[i]})
        return [_best(x) for x in out]

    def _reachable(self, hot, lo, hi, term, least: float) -> Iterator[tuple[int, int, int, list[int]]]:
        """(passage, its first and last term, ranges whose bound reaches ``least``), passages without any left out."""
        for k in range(0, len(hot), STEP):
            a, b = lo[k:k + STEP], hi[k:k + STEP]
            size = b - a
            own = np.repeat(a - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            reach = self.bounds(np.repeat(np.arange(len(a)), size), term[own], len(a)) >= least
            for i in np.flatnonzero(reach.any(axis=1)).tolist():
                yield int(hot[k + i]), int(a[i]), int(b[i]), np.flatnonzero(reach[i]).tolist()

    @staticmethod
    def _held(part: list[bytes], grams: set, joined: bytes) -> float:
        if len(part) < SHINGLE:
            return float(b" " + b" ".join(part) + b" " in joined) if part else 1.0
        own = shingles(part)
        return len(own & grams) / len(own)


def _best(found: list[dict]) -> list[dict]:
    """One entry per item: the passage of the highest score, the first of equal ones."""
    best: dict = {}
    for x in found:
        old = best.get(x["item_id"])
        if old is None or (x["score"], -x["first_word"]) > (old["score"], -old["first_word"]):
            best[x["item_id"]] = x
    return [best[k] for k in sorted(best, key=lambda v: (v is None, v))]


def _bags(items: DataFrame) -> DataFrame:
    """shard, n_words and distinct terms per item that has words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [words(t) for t in column_bytes(b.column(1))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(w) for w in own], pa.int64()), pa.array([sorted(set(w)) for w in own], pa.list_(pa.binary()))],
                ["shard", "n_words", "terms"])

    return items.select("shard", "text").mapInArrow(run, "shard bigint, n_words bigint, terms array<binary>").filter("n_words > 0")


def _shards(benchmark: DataFrame) -> Iterator[tuple[list[tuple[int, bytes]], Whole]]:
    """Items and counts of one shard after the other; a shard is about SHARD_BYTES of text."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("binary").alias("text"))
    items = items.filter(F.col("text").isNotNull())
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, -(-size // SHARD_BYTES))
    items = items.withColumn("shard", F.pmod(F.xxhash64("text"), F.lit(n)))
    bags = stored(_bags(items), "benchmark-terms")
    whole = bags.agg(F.count(F.lit(1)).alias("items"), F.coalesce(F.sum("n_words"), F.lit(0)).alias("words"),
                     F.coalesce(F.max("n_words"), F.lit(0)).alias("longest")).first()
    terms = bags.select("shard", F.explode("terms").alias("term"))
    holders = stored(terms.groupBy("term").agg(F.count(F.lit(1)).alias("n")), "benchmark-holders")
    for shard in range(n):
        own = items.filter(F.col("shard") == shard).select("item_id", "text").collect()
        held = holders.join(terms.filter(F.col("shard") == shard), "term", "left_semi").collect()  # terms of this shard's text
        yield (sorted(((r.item_id, bytes(r.text)) for r in own), key=lambda x: (x[0] is None, x)),
               Whole(*whole, {bytes(r.term): r.n for r in held}))


def decontaminate(docs: DataFrame, benchmark: DataFrame, least: float = MIN_SCORE,
                  overlap: float = MIN_OVERLAP) -> DataFrame:
    """``docs`` plus ``leaks``: the benchmark items that each text holds."""
    spark = docs.sparkSession
    keep = [c for c in docs.columns if c != "leaks"]
    out = docs.select(*keep, F.array().cast(LEAK_TYPE).alias("leaks"))
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("leaks", T._parse_datatype_string(LEAK_TYPE))])
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("question_overlap", pa.float64()),
                               ("answer_overlap", pa.float64()), ("first_word", pa.int64())]))
    for own, whole in _shards(benchmark):
        sent = spark.sparkContext.broadcast((own, tuple(whole)))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            items, counts = sent.value
            index = Index(items, Whole(*counts))
            for b in slices(batches, "text", BATCH_BYTES):
                found = index.leaks(column_bytes(b.column(b.schema.get_field_index("text"))), least, overlap)
                k = b.schema.get_field_index("leaks")
                both = [_best(old + new) if old else new for old, new in zip(b.column(k).to_pylist(), found)]
                yield pa.RecordBatch.from_arrays([*b.columns[:k], pa.array(both, kind)], b.schema.names)

        out = out.mapInArrow(run, schema)
    return out


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", F.explode("leaks").alias("l")).select("doc_id", "l.*")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a benchmark item go."""
    out = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return out.filter(F.size("leaks") == 0).select(*DOCUMENT_COLUMNS)
