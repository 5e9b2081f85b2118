"""LM scoring: deleted interpolation of n-gram estimates.

The probability of a token is a mixture of the maximum-likelihood estimates of order n to 1
and of the uniform distribution over the vocabulary and one unknown word; the weights depend
on how often the longest context was seen (a bucket per power of two). They are learned by
expectation-maximisation on held-out counts: each training token is held out in turn, its
own occurrence deleted from every count ("deleted" estimation), over the whole corpus. The
posterior of a component depends on ratios of the estimates only, so the tokens are summed
up in cells of (bucket, quantised ratios), whose number is bounded by the quantisation, not
by the corpus; the driver gets the cells, never counts of n-grams.

1. Texts become blocks of token hashes (about ``BLOCK_TOKENS``), written to the shared folder.
2. Each block sends its distinct n-grams (52-bit hashes; words 64) with training counts, split by
   hash range, as packed columns; a range's task adds the counts up and answers each sender
   in the order of its request. An n-gram reaches a task once per sender at most, so frequent
   words and n-grams are pre-aggregated.
3. Ranges grow in number with the blocks, but no block writes to all of them: beyond ``2^FAN_BITS``
   blocks the exchange has tiers. A tier's node takes one coarse range from some 128 blocks (or nodes
   of the tier before), adds up what they have in common and sends it on in 128 finer ranges; answers
   come back the same way. A block or node sends 128 messages per order at most, so messages grow in
   proportion to the blocks (times the tiers), and a node holds about as much as one block.
4. Blocks meet their answers twice: to fill the cells, and to score.

Defined results: words are lower-cased (A-Z); null and empty texts have the end token only.
Every row counts as a document, repeated rows too; a null doc_id counts as the empty text in
the split. Without training rows every token has probability 1 (empty vocabulary, uniform).
Very long texts are a block of their own. Extra columns aren't carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.llm.common import WordHashes, column_bytes, crc_mod, mix64, pack, slices, stored, table, unpack

ORDER, BLOCK_TOKENS, BATCH_BYTES = 2, 2_000_000, 8 << 20
STEPS, BUCKETS, ITERATIONS = 4, 48, 60       # cells per doubling of a ratio, context buckets, EM steps
END, BEGIN = np.uint64(0x9E6C63D0876A9A47), np.uint64(0xC3A5C85C97CB3127)
FACTOR = np.uint64(0x9E3779B97F4A7C15)
KEY_BITS = 52  # of an n-gram's hash; words keep 64
FAN_BITS = 7   # a sender's messages per order and tier: 2^7
BLOCKS_PER_TASK = 4  # blocks' worth of messages that a task reads, where that is more tasks than the session's

BLOCK_TYPE = "block bigint, ids array<bigint>, held array<boolean>, sizes array<int>, words binary, tokens binary, n_train bigint"
REQUEST_TYPE = "sender bigint, level int, part bigint, team bigint, keys binary, counts binary"
ANSWER_TYPE = "sender bigint, level int, part bigint, totals binary, n_sum bigint, n_types bigint"
NODE = ["level", "part", "team"]
SCORE_TYPE = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double")


def token_blocks(docs: DataFrame, held: Column, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks of whole documents: distinct word hashes (sorted) and each token's place among them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, number = WordHashes(xxhash.xxh3_64_intdigest), 0
        rows: list = []
        total = 0

        def block() -> pa.RecordBatch:
            nonlocal number, rows, total
            own, at = np.unique(np.concatenate([r[2] for r in rows]), return_inverse=True)
            name = (TaskContext.get().partitionId() << 32) + number
            cols = [pa.array([name], pa.int64()), pa.array([[r[0] for r in rows]], pa.list_(pa.int64())),
                    pa.array([[r[1] for r in rows]], pa.list_(pa.bool_())),
                    pa.array([[len(r[2]) for r in rows]], pa.list_(pa.int32())),
                    pa.array([pack(np.diff(own, prepend=np.uint64(0)))], pa.binary()),
                    pa.array([pack(at.astype(np.int32))], pa.binary()),
                    pa.array([sum(not r[1] for r in rows)], pa.int64())]
            number, rows, total = number + 1, [], 0
            return pa.RecordBatch.from_arrays(cols, [c.split(" ")[0] for c in BLOCK_TYPE.split(", ")])

        for b in slices(batches, "text", BATCH_BYTES):
            ids, out = b.column(0).to_pylist(), b.column(2).to_pylist()
            for i, h, t in zip(ids, out, column_bytes(b.column(1))):
                own = np.append(words.of(t), END)
                if rows and total + len(own) > block_tokens:
                    yield block()
                rows.append((i, h, own))
                total += len(own)
        if rows:
            yield block()

    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", held.alias("_held"))
            .mapInArrow(run, BLOCK_TYPE))


class Block:
    """Tokens of one block: hashes, document of each token, first tokens, training tokens."""

    def __init__(self, row: dict) -> None:
        self.ids, self.held = row["ids"], np.asarray(row["held"], bool)
        sizes = np.asarray(row["sizes"], np.int64)
        self.words, self.at = np.cumsum(unpack(row["words"], np.uint64), dtype=np.uint64), unpack(row["tokens"], np.int32)
        self.doc = np.repeat(np.arange(len(sizes)), sizes)
        self.first = np.zeros(len(self.at), bool)
        self.first[np.cumsum(sizes) - sizes] = True
        self.train = ~self.held[self.doc]

    def levels(self, order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(sorted distinct keys, place of each token's n-gram among them) for orders 1 to ``order``."""
        key = self.words[self.at]
        yield self.words, self.at
        for _ in range(order - 1):
            before = np.concatenate((key[:1], key[:-1]))
            before[self.first] = BEGIN
            key = mix64(before * FACTOR + self.words[self.at]) >> np.uint64(64 - KEY_BITS)
            yield np.unique(key, return_inverse=True)


def tier_bits(n_blocks: int, fan_bits: int = FAN_BITS) -> list[int]:
    """Leading bits of the hash that name a range, tier by tier; more ranges than blocks in the last."""
    last = max(4, n_blocks.bit_length())
    return [*range(fan_bits, last, fan_bits), last]


def _split(sender: int, level: int, team: int, keys: np.ndarray, counts: np.ndarray, bits: int) -> list[tuple]:
    """One message per range of ``bits`` leading bits; ``keys`` are sorted."""
    part = (keys >> np.uint64((64 if level == 1 else KEY_BITS) - bits)).astype(np.int64)
    cut = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
    return [(sender, level, int(part[a]), team, pack(np.diff(keys[a:z], prepend=np.uint64(0))), pack(counts[a:z]))
            for a, z in zip(cut, [*cut[1:], len(keys)])]


def _requests(order: int, bits: list[int]):
    """Messages of the blocks to the first tier, whose teams of blocks are drawn by hash."""
    teams = np.uint64((1 << (bits[-1] - bits[0])) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                block, out = Block(row), []
                team = int(mix64(np.asarray([row["block"]], np.uint64) + FACTOR)[0] & teams)
                for level, (keys, at) in enumerate(block.levels(order), 1):
                    counts = np.bincount(at[block.train], minlength=len(keys)).astype(np.uint64)
                    out += _split(row["block"], level, team, keys, counts, bits[0])
                yield _batch(out, REQUEST_TYPE)
    return run


_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_()}


def _batch(rows: list[tuple], kind: str) -> pa.RecordBatch:
    names, types = zip(*(c.split(" ") for c in kind.split(", ")))
    cols = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[t]) for c, t in zip(cols, types)], list(names))


def _met(rows: list[dict]) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Distinct keys of a node's messages, the place of each message's keys among them, ends of the messages."""
    keys = [np.cumsum(unpack(r["keys"], np.uint64), dtype=np.uint64) for r in rows]
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    return distinct, at, np.cumsum([len(k) for k in keys]).tolist()


def _added(rows: list[dict], at: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(at, np.concatenate([unpack(r["counts"], np.uint64) for r in rows]), n).astype(np.uint64)


def _pass_on(bits: int, shift: int):
    """A node's sums, as messages to the next tier (``bits``), where 2^``shift`` teams become one."""
    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        distinct, at, _ = _met(rows)
        level, team = rows[0]["level"], rows[0]["team"]
        out = _split(team, level, team >> shift, distinct, _added(rows, at, len(distinct)), bits)
        return pa.Table.from_batches([_batch(out, REQUEST_TYPE)])
    return run


def _replies(rows: list[dict], at: np.ndarray, ends: list[int], total: np.ndarray, n_sum: int, n_types: int) -> pa.Table:
    """To every sender the counts of its keys, in its own order; the sums of the range are told once."""
    mine = total[at]
    out = [(r["sender"], r["level"], r["part"], pack(mine[a:z]), n_sum if a == 0 else 0, n_types if a == 0 else 0)
           for r, a, z in zip(rows, [0, *ends[:-1]], ends)]
    return pa.Table.from_batches([_batch(out, ANSWER_TYPE)])


def _answer(group: pa.Table) -> pa.Table:
    """The last tier: adds up the counts of one hash range and answers every sender."""
    rows = group.to_pylist()
    distinct, at, ends = _met(rows)
    total = _added(rows, at, len(distinct)).astype(np.int64)
    return _replies(rows, at, ends, total, int(total.sum()), int((total > 0).sum()))


def _hand_down(left: pa.Table, right: pa.Table) -> pa.Table:
    """A node's own requests met by the answers it got: answers for those who had asked it."""
    rows = left.to_pylist()
    _, at, ends = _met(rows)
    got = sorted(right.select(["finer", "totals"]).to_pylist(), key=lambda r: r["finer"])
    return _replies(rows, at, ends, np.concatenate([unpack(r["totals"], np.int64) for r in got]), 0, 0)


def _spread(df: DataFrame, n: int, *cols: str) -> DataFrame:
    """``df`` in ``n`` partitions by ``cols`` where the session's own number is smaller."""
    return df.repartition(n, *cols) if n > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def gram_counts(blocks: DataFrame, n_blocks: int, order: int, fan_bits: int = FAN_BITS) -> tuple[DataFrame, int, int]:
    """Training counts of every block's n-grams (one row per block, order and range of the first tier),
    number of training tokens, number of distinct ones."""
    bits, n_tasks = tier_bits(n_blocks, fan_bits), -(-n_blocks // BLOCKS_PER_TASK)
    asked = [blocks.mapInArrow(_requests(order, bits), REQUEST_TYPE)]  # made anew from the blocks, not stored
    for before, now in zip(bits, bits[1:]):
        sums = _spread(asked[-1], n_tasks, *NODE).groupBy(*NODE).applyInArrow(_pass_on(now, now - before), REQUEST_TYPE)
        asked.append(stored(sums, "gram-sums"))
    answers = stored(_spread(asked[-1], n_tasks, *NODE).groupBy(*NODE).applyInArrow(_answer, ANSWER_TYPE), "gram-counts")
    n, types = answers.filter("level = 1").agg(F.coalesce(F.sum("n_sum"), F.lit(0)),
                                               F.coalesce(F.sum("n_types"), F.lit(0))).first()
    for t in range(len(bits) - 2, -1, -1):
        up = answers.select("level", F.shiftright("part", bits[t + 1] - bits[t]).alias("part"),
                            F.col("sender").alias("team"), F.col("part").alias("finer"), "totals")
        pairs = _spread(asked[t], n_tasks, *NODE).groupBy(*NODE).cogroup(_spread(up, n_tasks, *NODE).groupBy(*NODE))
        answers = stored(pairs.applyInArrow(_hand_down, ANSWER_TYPE), "gram-counts")
    return answers.select(F.col("sender").alias("block"), "level", "part", "totals"), n, types


class Estimates:
    """Counts of a block's tokens: ``grams[k]`` of the n-gram of order k + 1, ``contexts[k]`` of its context."""

    def __init__(self, row: dict, answers: list[dict], order: int, n: int, n_docs: int) -> None:
        self.block = Block(row)
        totals: dict[int, list] = {}
        for r in sorted(answers, key=lambda r: (r["level"], r["part"])):
            totals.setdefault(r["level"], []).append(unpack(r["totals"], np.int64))
        self.grams, self.contexts = [], []
        for level, (_, at) in enumerate(self.block.levels(order), 1):
            if level == 1:
                self.contexts.append(np.full(len(at), n, np.int64))
            else:
                before = np.concatenate(([0], self.grams[-1][:-1]))
                before[self.block.first] = n_docs
                self.contexts.append(before)
            self.grams.append(np.concatenate(totals[level])[at])

    def shares(self, deleted: int) -> list[np.ndarray]:
        """Maximum-likelihood estimates, lowest order first; ``deleted`` own occurrences left out."""
        return [np.where(c > deleted, np.maximum(g - deleted, 0) / np.maximum(c - deleted, 1), 0.0)
                for g, c in zip(self.grams, self.contexts)]

    def buckets(self, deleted: int) -> np.ndarray:
        seen = np.maximum(self.contexts[-1] - deleted, 0)
        return np.minimum(np.frexp(seen.astype(np.float64))[1], BUCKETS - 1)


def _quantised(ratio: np.ndarray) -> np.ndarray:
    """0 for zero, else a positive step of the logarithm."""
    with np.errstate(divide="ignore"):
        q = np.rint(STEPS * np.log2(ratio))
    return np.where(ratio > 0, np.clip(q, -2000, 2000) + 2048, 0).astype(np.int64)


MAX_ORDER = 4  # 6 + 12 bits per order in 63


def _cells(order: int, n: int, types: int, n_docs: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        e = Estimates(left.to_pylist()[0], right.to_pylist(), order, n, n_docs)
        code = e.buckets(1)
        for p in e.shares(1):
            code = code * 4096 + _quantised(p * (types + 1))
        cells, count = np.unique(code[e.block.train], return_counts=True)
        return pa.table({"cell": pa.array(cells, pa.int64()), "n": pa.array(count, pa.int64())})
    return run


def learn_weights(cells: np.ndarray, count: np.ndarray, order: int) -> np.ndarray:
    """EM per bucket: weights of (uniform, order 1, ..., order n), shape (buckets, order + 1)."""
    ratio, code = [], cells.copy()
    for _ in range(order):
        q = code % 4096
        ratio.insert(0, np.where(q > 0, 2.0 ** ((q - 2048) / STEPS), 0.0))
        code //= 4096
    p = np.column_stack([np.ones(len(cells)), *ratio])

    def em(rows: np.ndarray, start: np.ndarray) -> np.ndarray:
        w, c = start, count[rows]
        for _ in range(ITERATIONS):
            share = p[rows] * w
            share /= share.sum(axis=1, keepdims=True)
            w = (share * c[:, None]).sum(axis=0) + 1e-3 * start
            w /= w.sum()
        return w

    even = np.full(order + 1, 1 / (order + 1))
    if not len(cells):
        return np.tile(np.eye(order + 1)[0], (BUCKETS, 1))
    common = em(np.arange(len(cells)), even)
    out = np.tile(common, (BUCKETS, 1))
    for b in np.unique(code):
        out[b] = em(np.flatnonzero(code == b), common)
    if order > 1:  # a context that was never seen gives its weight to the lower orders
        out[0, -1] = 0
        out[0] /= out[0].sum()
    return out


def _scores(order: int, n: int, types: int, n_docs: int, weights: np.ndarray):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        e = Estimates(left.to_pylist()[0], right.to_pylist(), order, n, n_docs)
        b, w = e.block, weights[e.buckets(0)]
        p = w[:, 0] / (types + 1)
        for k, share in enumerate(e.shares(0), 1):
            p = p + w[:, k] * share
        docs = len(b.ids)
        rows = zip(b.ids, b.held.tolist(), np.bincount(b.doc, minlength=docs).tolist(),
                   np.bincount(b.doc, e.grams[0] > 0, docs).astype(np.int64).tolist(),
                   np.bincount(b.doc, np.log10((e.grams[0] + 1) / (n + types + 1)), docs).tolist(),
                   np.bincount(b.doc, np.log10(p), docs).tolist())
        return pa.Table.from_batches([_batch(list(rows), SCORE_TYPE)])
    return run


def score_texts(docs: DataFrame, held: Column, order: int = ORDER, block_tokens: int = BLOCK_TOKENS,
                fan_bits: int = FAN_BITS) -> DataFrame:
    """Scores of all rows by a model of those that aren't held out: log10 probabilities per text."""
    if not 1 <= order <= MAX_ORDER:
        raise ValueError(f"orders are 1 to {MAX_ORDER}: a cell holds a bucket and 12 bits per order")
    blocks = stored(token_blocks(docs, held, block_tokens), "token-blocks")
    n_blocks, n_docs = blocks.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_train"), F.lit(0))).first()
    answers, n, types = gram_counts(blocks, n_blocks, order, fan_bits)
    n_tasks = -(-n_blocks // BLOCKS_PER_TASK)
    met = (_spread(blocks, n_tasks, "block").groupBy("block")
           .cogroup(_spread(answers, n_tasks, "block").groupBy("block")))
    cells = (met.applyInArrow(_cells(order, n, types, n_docs), "cell bigint, n bigint")
             .groupBy("cell").agg(F.sum("n").alias("n")).collect())  # bounded by the quantisation
    cells = sorted((r.cell, r.n) for r in cells)
    weights = learn_weights(np.asarray([c for c, _ in cells], np.int64), np.asarray([k for _, k in cells], np.float64), order)
    return met.applyInArrow(_scores(order, n, types, n_docs, weights), SCORE_TYPE).withColumn("train_tokens", F.lit(n).cast("bigint"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = score_texts(table(spark, sf_dir, "documents"), crc_mod("doc_id", 7) == 2)
    return out.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
