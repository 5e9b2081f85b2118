"""Toxicity: a convolutional text classifier with hashed word embeddings, trained in numpy.

A word's embedding is the mean of six rows of one hashed table (the word under two hash
functions, its first four to seven characters). Filters of widths 1, 2 and 3
slide over the whole text; their maxima feed a logistic unit.

Every labelled row is learnt from, on Spark: a fifth of them (by a hash of doc_id) calibrates the
score (Platt) and a threshold per language, all others train the network. Rows lie in blocks of
about ``BLOCK_ROWS`` texts and ``BLOCK_BYTES`` at most. The table starts at odds counted over all
blocks; in each of ``EPOCHS`` rounds every block starts from the common network, passes over its
rows and yields its changes, which are averaged by rows (a table row: over the blocks that use
it). The sums are of whole numbers, so the result doesn't depend on how tasks cut the blocks.
The driver holds the network (16 MB with its step sizes) and the labels' counts by language and
score (logits in steps of 1 / ``LOGIT_STEPS``), never a text. :func:`fit` with ``n`` learns from a
bounded sample instead, on the driver, for trials; no query does. There each row stands for its
class's labels in the whole table over those in the sample.

A language's threshold is its own best one, drawn towards that of all languages as if by
``MIN_CALIBRATION`` more toxic rows, so a language with few of them still gets one. Scores read the
text only; the language chooses nothing but the threshold of ``rejected``. The model is a few MB
whatever the input, so it is broadcast.

Defined results: null and empty texts are scored as texts without words. Labels that are
null are left out; of several labels of one doc_id the largest holds, and of several rows of one
doc_id one is learnt from. Without labels of both classes every text scores the (smoothed) share
of toxic labels. Languages that are null or have no label take the threshold of all languages.
Rows are scored one by one, so repeated rows repeat their score; very long texts are convolved in
chunks that overlap, which gives the same maxima in bounded memory (a sample learns from them last
where it is too large); extra columns pass through, those named ``score``, ``threshold`` and
``rejected`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.llm.common import DOCUMENT_COLUMNS, column_bytes, crc_mod, slices, stored, table, whole_text

MAX_PER_CLASS = 2500                      # rows of a sample for trials, per class
SAMPLE_BYTES = 128 << 20                  # bound of its texts
BLOCK_ROWS, BLOCK_BYTES = 2048, 8 << 20   # rows of a training block on average, bytes of its texts
FIXED_POINT, MOST_CHANGE = 1 << 20, 1 << 13  # changes are summed as whole numbers: steps a unit, largest one
LOGIT_STEPS = 256
TABLE_ROWS, DIM, FILTERS, WIDTHS, PREFIXES = 1 << 18, 8, 8, (1, 2, 3), (4, 5, 6, 7)
EPOCHS, BATCH, RATE, SMOOTHING, MIN_TEXTS = 4, 16, 0.05, 4.0, 3
DEFAULT_THRESHOLD, MIN_CALIBRATION = 0.7, 20
CHUNK, BATCH_BYTES, CACHE_WORDS = 1 << 18, 4 << 20, 400_000

#: A-Z to lower case, every other ASCII character that is no letter to a space.
BYTE_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(BYTE_TABLE).split()


def rows_of(word: bytes, size: int = TABLE_ROWS) -> list[int]:
    """Table rows of a word: two hashes of it, one of each prefix."""
    h = xxhash.xxh3_64_intdigest
    text = word.decode("utf-8", "replace")
    return [h(word, 1) % size, h(word, 2) % size, *(h(text[:n].encode(), 3 + n) % size for n in PREFIXES)]


@dataclass
class Model:
    table: np.ndarray = None                                 # (rows, dim); None: constant score
    filters: list = field(default_factory=list)              # per width (width, dim, filters)
    bias: list = field(default_factory=list)
    out: np.ndarray = None                                   # (widths * filters,)
    out_bias: float = 0.0
    slope: float = 1.0                                       # of the calibration
    shift: float = 0.0
    thresholds: dict = field(default_factory=dict)           # language -> threshold
    threshold: float = DEFAULT_THRESHOLD                     # of other languages

    def pooled(self, x: np.ndarray, allowed: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
        """Largest filter values per text. ``x``: embeddings of all texts in a row, ``allowed``: a
        window may start here, ``doc``: text of each row."""
        out = np.full((n, len(WIDTHS) * FILTERS), -1e9, np.float32)
        for at in range(0, len(x), CHUNK):
            end = min(len(x), at + CHUNK)
            ok, part = allowed[at:end], doc[at:end]
            first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
            for k, w in enumerate(WIDTHS):
                z = np.zeros((end - at, FILTERS), np.float32)
                for j in range(w):
                    s = x[at + j:end + j]
                    z[:len(s)] += s @ self.filters[k][j]
                z += self.bias[k]
                z[~ok] = -1e9
                cols = slice(k * FILTERS, (k + 1) * FILTERS)
                out[part[first], cols] = np.maximum(out[part[first], cols], np.maximum.reduceat(z, first, axis=0))
        return np.maximum(out, 0)

    def logits(self, x, allowed, doc, n) -> np.ndarray:
        return self.pooled(x, allowed, doc, n) @ self.out + self.out_bias

    def score(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * logits + self.shift, -30, 30)))


def layout(lengths: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of every word, where windows may start, and the text of each row.

    Each text takes one empty row, its words and two empty rows, so no window reaches the next
    text and a text without words still has a window.
    """
    n = np.asarray(lengths, np.int64)
    size = n + 3
    start = np.concatenate(([0], np.cumsum(size)))
    doc = np.repeat(np.arange(len(n)), size)
    inside = np.arange(start[-1]) - start[doc]
    return (inside >= 1) & (inside <= n[doc]), inside <= n[doc], doc


def best_windows(m: Model, rows_at, n_words: int) -> list[tuple]:
    """Per filter width: the largest values, where their windows start, the windows' embeddings.

    ``rows_at(a, b)`` gives the rows from ``a`` to ``b`` of the words' embeddings between one empty
    row and two; a long text is passed in chunks, so memory is bounded.
    """
    best = [None] * len(WIDTHS)
    for at in range(0, n_words + 1, CHUNK):
        end = min(n_words + 1, at + CHUNK)
        x = rows_at(at, end + 2)
        for k, w in enumerate(WIDTHS):
            z = sum(x[j:end - at + j] @ m.filters[k][j] for j in range(w)) + m.bias[k]
            place = z.argmax(axis=0)
            own = (z[place, np.arange(FILTERS)], place + at, np.stack([x[place + j] for j in range(w)]))
            if best[k] is not None:
                more = own[0] > best[k][0]
                own = (np.where(more, own[0], best[k][0]), np.where(more, own[1], best[k][1]),
                       np.where(more[None, :, None], own[2], best[k][2]))
            best[k] = own
    return best


def gradient_at(m: Model, best: list[tuple], n_words: int, y: int, weight: float) -> tuple:
    """Gradient of a text's weighted log loss from its :func:`best_windows`."""
    h = np.maximum(np.concatenate([top for top, _, _ in best]), 0)
    p = 1 / (1 + np.exp(-np.clip(h @ m.out + m.out_bias, -30, 30)))
    e = float((p - y) * weight)
    back = (e * m.out * (h > 0)).reshape(len(WIDTHS), FILTERS)
    g_f, of_words = [np.zeros_like(f) for f in m.filters], []
    for k, w in enumerate(WIDTHS):
        _, start, window = best[k]
        for j in range(w):
            place = start + j
            g_f[k][j] = window[j].T * back[k]
            real = (place >= 1) & (place <= n_words) & (back[k] != 0)
            if real.any():
                of_words.append((place[real] - 1, (m.filters[k][j][:, real] * back[k][real]).T))
    return g_f, list(back), e * h, e, of_words


def text_gradient(m: Model, x: np.ndarray, n_words: int, y: int, weight: float) -> tuple:
    """Gradient of a text's weighted log loss: (filters, biases, output, output bias, words).

    ``x`` holds the words' embeddings between empty rows. The last part is a list of (places of
    words, gradient of their embeddings): one pair per filter width and offset, with words repeated.
    """
    return gradient_at(m, best_windows(m, lambda a, b: x[a:b], n_words), n_words, y, weight)


#: Parameters after the table, as (shape, number): filters, biases, output, output bias.
PARTS = [(w, DIM, FILTERS) for w in WIDTHS] + [(FILTERS,) for _ in WIDTHS] + [(len(WIDTHS) * FILTERS,), (1,)]
SIZES = [int(np.prod(p)) for p in PARTS]
ROWS = TABLE_ROWS + -(-sum(SIZES) // DIM)  # of a matrix with all parameters


def parts_of(flat: np.ndarray) -> list[np.ndarray]:
    """The table and the other parameters as views of one matrix of ``ROWS`` x ``DIM``."""
    rest, ends = flat[TABLE_ROWS:].reshape(-1), np.cumsum([0, *SIZES])
    return [flat[:TABLE_ROWS], *(rest[a:b].reshape(p) for a, b, p in zip(ends, ends[1:], PARTS))]


def model_of(flat: np.ndarray) -> Model:
    table_, *others = parts_of(flat)
    n = len(WIDTHS)
    return Model(table=table_, filters=others[:n], bias=others[n:2 * n], out=others[-2], out_bias=float(others[-1][0]))


def vocabulary(texts: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
    """Numbers of each text's words, and the table rows of each numbered word."""
    vocab: dict[bytes, int] = {}
    ids = [np.fromiter((vocab.setdefault(w, len(vocab)) for w in words(t)), np.int64) for t in texts]
    return ids, np.asarray([rows_of(w) for w in vocab] or [[0] * (2 + len(PREFIXES))], np.int64)


def texts_with(ids: list[np.ndarray], feats: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For each class and table row: texts that use it."""
    seen = np.zeros((2, TABLE_ROWS), np.int64)
    for i, t in enumerate(ids):
        seen[int(y[i]), np.unique(feats[np.unique(t)])] += 1 if len(t) else 0
    return seen


def start(seen: np.ndarray, n0: int, n1: int, seed: int = 7) -> np.ndarray:
    """The parameters before training. The first embedding dimension starts at the smoothed log odds of
    the rows' texts, the other dimensions at random."""
    rng = np.random.default_rng(seed)
    odds = np.log((seen[1] / n1 * 100 + SMOOTHING / 10) / (seen[0] / n0 * 100 + SMOOTHING / 10))
    odds[seen.sum(axis=0) < MIN_TEXTS] = 0  # of a text's own rare words the label would be known
    flat = np.zeros((ROWS, DIM), np.float32)
    table_, *others = parts_of(flat)
    table_[:] = rng.normal(0, 0.05, (TABLE_ROWS, DIM))
    table_[:, 0] = odds
    for f, w in zip(others, WIDTHS):
        f[:] = rng.normal(0, 0.1, f.shape)
        f[:, 0, : FILTERS // 2] += 0.5 / w
    others[-2][:] = 0.1
    others[-1][:] = -1.0
    return flat


def one_pass(flat: np.ndarray, acc: np.ndarray, ids: list[np.ndarray], feats: np.ndarray, y: np.ndarray,
             weight: np.ndarray, order: np.ndarray) -> None:
    """Steps of Adagrad over the texts in ``order``, in place; gradients pass the maxima only."""
    m, params, sums = model_of(flat), parts_of(flat), parts_of(acc)

    def rows_at(t: np.ndarray):
        def rows(a: int, b: int) -> np.ndarray:
            x = np.zeros((b - a, DIM), np.float32)
            first, last = max(a, 1), min(b, len(t) + 1)
            if first < last:
                x[first - a:last - a] = m.table[feats[t[first - 1:last - 1]]].mean(axis=1)
            return x
        return rows

    for at in range(0, len(order), BATCH):
        total, rows, grads = [np.zeros_like(p) for p in params[1:]], [], []
        for d in order[at:at + BATCH]:
            n = len(ids[d])
            of_f, of_b, of_out, e, of_words = gradient_at(m, best_windows(m, rows_at(ids[d]), n), n, y[d], weight[d])
            for g, own in zip(total, [*of_f, *of_b, of_out, e]):
                g += own
            for place, g in of_words:
                rows.append(feats[ids[d][place]])
                grads.append(g / feats.shape[1])
        for a, p_, g in zip(sums[1:], params[1:], total):
            g /= BATCH
            a += g * g
            p_ -= RATE * g / np.sqrt(a)
        m.out_bias = float(params[-1][0])
        if rows:
            r = np.concatenate(rows)
            g = np.repeat(np.concatenate(grads), r.shape[1], axis=0) / BATCH
            u, inv = np.unique(r.ravel(), return_inverse=True)
            own = np.zeros((len(u), DIM), np.float32)
            np.add.at(own, inv, g)
            sums[0][u] += own * own
            params[0][u] -= RATE * own / np.sqrt(sums[0][u])


def class_weights(y: np.ndarray, n0: int, n1: int) -> np.ndarray:
    """Both classes weigh the same, a text one on average."""
    return np.where(y == 1, 0.5 / n1, 0.5 / n0) * (n0 + n1)


def train(texts: list[bytes], y: np.ndarray, seed: int = 7) -> Model:
    """Fits the network to one block of texts."""
    ids, feats = vocabulary(texts)
    n1, n0 = max(1, int(y.sum())), max(1, int((1 - y).sum()))
    flat, acc = start(texts_with(ids, feats, y), n0, n1, seed), np.full((ROWS, DIM), 1e-3, np.float32)
    for epoch in range(EPOCHS):
        order = np.random.default_rng([seed, epoch]).permutation(len(ids))
        one_pass(flat, acc, ids, feats, y, class_weights(y, n0, n1), order)
    return model_of(flat)


class Scorer:
    """Embeds texts with a cache of word rows and scores them."""

    def __init__(self, model: Model) -> None:
        self.model, self.cache = model, {}
        self.rows = np.zeros((1024, DIM), np.float32)

    def score(self, texts: list[bytes]) -> np.ndarray:
        return self.model.score(self.logits(texts))

    def logits(self, texts: list[bytes]) -> np.ndarray:
        if self.model.table is None:
            return np.full(len(texts), self.model.out_bias)
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        tokens: list[bytes] = []
        lengths = []
        for t in texts:
            own = words(t)
            lengths.append(len(own))
            tokens.extend(own)
        at = np.fromiter(map(self.cache.get, tokens, repeat(-1)), np.int64, len(tokens))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            new: list[bytes] = []
            for i in missing.tolist():
                w = tokens[i]
                if w not in self.cache:
                    self.cache[w] = len(self.cache)
                    new.append(w)
                at[i] = self.cache[w]
            first = len(self.cache) - len(new)
            if len(self.cache) > len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros((2 * len(self.cache) - len(self.rows), DIM), np.float32)])
            self.rows[first:len(self.cache)] = self.model.table[np.asarray([rows_of(w) for w in new])].mean(axis=1)
        is_word, allowed, doc = layout(lengths)
        x = np.zeros((len(doc), DIM), np.float32)
        x[is_word] = self.rows[at]
        return self.model.logits(x, allowed, doc, len(texts))


def labelled_sample(docs: DataFrame, labels: DataFrame, trainable: Column,
                    n: int = MAX_PER_CLASS) -> tuple[DataFrame, dict[int, int]]:
    """At most ``n`` labelled rows per class with their texts (doc_id, text, lang, toxic), one per
    doc_id; labels of each class in the whole table."""
    rows = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & trainable)
            .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    pick = [rows.filter(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for c in (0, 1)]
    ids = pick[0].unionByName(pick[1])  # 2 n rows at most
    counts = rows.filter("toxic IN (0, 1)").groupBy("toxic").count().collect()
    first = F.min(F.struct(F.xxhash64(whole_text()).alias("hash"), "text", "lang", "toxic"))
    found = docs.select("doc_id", "text", "lang").join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(first.alias("r"))
    return found.select("doc_id", "r.text", "r.lang", "r.toxic"), {int(c): k for c, k in counts}


def labelled_rows(docs: DataFrame, labels: DataFrame, trainable: Column) -> DataFrame:
    """Every labelled row with its text (doc_id, text, lang, toxic), one per doc_id."""
    rows = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & trainable)
            .groupBy("doc_id").agg(F.max("toxic").alias("toxic")).filter("toxic IN (0, 1)"))
    first = F.min(F.struct(F.xxhash64(whole_text()).alias("hash"), "text", "lang", "toxic"))
    # labels grow with the documents, so they aren't broadcast; the grouping needs no shuffle after this join
    found = (docs.select("doc_id", "text", "lang").filter(trainable).join(rows.hint("merge"), "doc_id")
             .groupBy("doc_id").agg(first.alias("r")))
    return found.select("doc_id", "r.text", "r.lang", "r.toxic")


BLOCK_TYPE = "shard int, part int, toxic binary, held binary, lang array<string>, sizes binary, texts binary"


def blocks_of(rows: DataFrame, n_shards: int) -> DataFrame:
    """Rows in blocks: a shard's rows in the order of doc_id, cut at ``BLOCK_BYTES`` of text."""
    placed = rows.select(F.pmod(F.xxhash64("doc_id"), F.lit(n_shards)).cast("int").alias("shard"), "doc_id", "toxic",
                         "held", "lang", whole_text().alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, part, held, size = None, 0, [], 0

        def block() -> pa.RecordBatch:
            y, out, langs, texts = zip(*held)
            sizes = np.asarray([len(t) for t in texts], np.int64)
            data = zstandard.ZstdCompressor(level=1).compress(b"".join(texts))
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([part], pa.int32()), pa.array([bytes(y)], pa.binary()),
                 pa.array([bytes(out)], pa.binary()), pa.array([langs], pa.list_(pa.string())),
                 pa.array([sizes.tobytes()], pa.binary()), pa.array([data], pa.binary())],
                ["shard", "part", "toxic", "held", "lang", "sizes", "texts"])

        for b in slices(batches, "text", BATCH_BYTES):
            texts = column_bytes(b.column(b.schema.get_field_index("text")))
            for own, y, out, lang, text in zip(*(b.column(b.schema.get_field_index(c)).to_pylist()
                                                 for c in ("shard", "toxic", "held", "lang")), texts):
                if held and (own != shard or size + len(text) > BLOCK_BYTES):
                    yield block()
                    part, held, size = (part + 1 if own == shard else 0), [], 0
                shard = own
                held.append((y, out, lang, text))
                size += len(text)
        if held:
            yield block()

    return stored(placed.repartition("shard").sortWithinPartitions("shard", "doc_id").mapInArrow(cut, BLOCK_TYPE),
                  "toxicity-blocks")


def read_blocks(batches: Iterator[pa.RecordBatch], held: bool | None) -> Iterator[tuple]:
    """(shard, part, labels, languages, texts) of each block; ``held``: only the rows that are kept out
    or only the others, None: all."""
    for batch in batches:
        for i in range(batch.num_rows):
            b = batch.slice(i, 1).to_pylist()[0]
            y, out = (np.frombuffer(b[c], np.int8) for c in ("toxic", "held"))
            data = zstandard.ZstdDecompressor().decompress(b["texts"]) if len(b["texts"]) else b""
            ends = np.cumsum(np.frombuffer(b["sizes"], np.int64)).tolist()
            take = np.flatnonzero((out == held) if held is not None else np.ones(len(y), bool)).tolist()
            if take:
                texts = [data[ends[k - 1] if k else 0:ends[k]] for k in take]
                yield b["shard"], b["part"], y[take].astype(np.int64), [b["lang"][k] for k in take], texts


def _numbers(*columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [f"c{i}" for i in range(len(columns))])


def _summed(blocks: DataFrame, run, n: int) -> np.ndarray:
    """Whole numbers summed by row of the parameters over all blocks: (row, ``n`` sums). Rows are ``ROWS`` at most."""
    out = blocks.mapInArrow(run, ", ".join(f"c{i} long" for i in range(n + 1)))
    sums = out.groupBy("c0").agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in range(1, n + 1)]).toArrow()
    return np.column_stack([np.asarray(sums.column(f"c{i}"), np.int64) for i in range(n + 1)])


def train_blocks(blocks: DataFrame, held: bool | None, n0: int, n1: int, seed: int = 7) -> Model:
    """Fits the network to the rows of all blocks: each round averages the changes of a pass over each block."""
    sc = blocks.sparkSession.sparkContext

    def odds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, TABLE_ROWS), np.int64)
        for _, _, y, _, texts in read_blocks(batches, held):
            seen += texts_with(*vocabulary(texts), y)
        used = np.flatnonzero(seen.any(axis=0))
        yield _numbers(used, seen[0, used], seen[1, used])

    seen = np.zeros((2, TABLE_ROWS), np.int64)
    counted = _summed(blocks, odds, 2)
    seen[:, counted[:, 0]] = counted[:, 1:].T
    flat, acc = start(seen, n0, n1, seed), np.full((ROWS, DIM), 1e-3, np.float32)
    for epoch in range(EPOCHS):
        sent = sc.broadcast((flat, acc))

        def changes(batches: Iterator[pa.RecordBatch], epoch: int = epoch, sent=sent) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((ROWS, 1 + 2 * DIM), np.int64)
            for shard, part, y, _, texts in read_blocks(batches, held):
                own = [a.copy() for a in sent.value]
                order = np.random.default_rng([seed, epoch, shard, part]).permutation(len(y))
                one_pass(*own, *vocabulary(texts), y, class_weights(y, n0, n1), order)
                change = np.hstack([a - b for a, b in zip(own, sent.value)])
                used = np.flatnonzero(change.any(axis=1))
                sums[used, 0] += len(y)
                whole = np.clip(change[used].astype(np.float64), -MOST_CHANGE, MOST_CHANGE) * (FIXED_POINT * len(y))
                sums[used, 1:] += np.rint(whole).astype(np.int64)
            used = np.flatnonzero(sums[:, 0])
            yield _numbers(used, *sums[used].T)

        total = _summed(blocks, changes, 1 + 2 * DIM)
        mean = total[:, 2:] / (total[:, 1:2] * float(FIXED_POINT))
        flat[total[:, 0]] += mean[:, :DIM].astype(np.float32)
        acc[total[:, 0]] += mean[:, DIM:].astype(np.float32)
        sent.unpersist()
    return model_of(flat)


def logit_counts(blocks: DataFrame, model: Model, held: bool | None) -> list:
    """Rows by language, label and logit in steps of 1 / ``LOGIT_STEPS``."""
    sent = blocks.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Model(**sent.value))
        for _, _, y, langs, texts in read_blocks(batches, held):
            logits = np.concatenate([scorer.logits(texts[i:i + 64]) for i in range(0, len(texts), 64)])
            step = np.rint(np.clip(logits, -100, 100) * LOGIT_STEPS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(y), pa.array(step)], ["lang", "toxic", "step"])

    return (blocks.mapInArrow(run, "lang string, toxic long, step long").groupBy("lang", "toxic", "step").count()
            .orderBy("lang", "toxic", "step").collect())


def _order(doc_id) -> int:
    return xxhash.xxh3_64_intdigest(str(doc_id))


def collected(sample: DataFrame, max_bytes: int = SAMPLE_BYTES) -> list:
    """The sample's rows in the order of a hash, with texts of ``max_bytes`` at most; where that
    is too little, texts longer than a 64th of it are the first to be left out."""
    sample = stored(sample, "toxicity-sample")  # 2 n rows at most
    sizes = sample.select("doc_id", F.octet_length(whole_text()).alias("size")).collect()
    if sum(r.size for r in sizes) > max_bytes:
        order = sorted(sizes, key=lambda r: (r.size > max_bytes // 64, _order(r.doc_id), r.doc_id))
        ends = np.cumsum([r.size for r in order])
        ids = [(r.doc_id,) for r, end in zip(order, ends) if end <= max_bytes]
        taken = sample.sparkSession.createDataFrame(ids, T.StructType([sample.schema["doc_id"]]))
        sample = sample.join(F.broadcast(taken), "doc_id")
    return sorted(sample.collect(), key=lambda r: (_order(r.doc_id), r.doc_id))


def _calibrate(m: Model, logits: np.ndarray, y: np.ndarray, langs: list, weight: np.ndarray,
               rows: np.ndarray | None = None) -> None:
    """Platt scaling by Newton steps with smoothed targets, then the threshold of best F1, per language
    drawn towards that of all rows.

    ``weight``: labels that a row stands for. Only their ratios count: how much is known, for the
    smoothing and the thresholds, depends on the rows themselves. ``rows``: equal rows that each
    entry is (one, if it isn't given); ``weight`` is then that of all of them.
    """
    rows = np.ones(len(y)) if rows is None else rows
    weight = weight * (rows.sum() / weight.sum())
    n1, n0 = (rows * y).sum(), (rows * (1 - y)).sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.column_stack([logits, np.ones(len(y))])
    v = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ v, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        v = v - np.clip(np.linalg.solve(h, x.T @ (weight * (p - t)) + 1e-3 * (v - [1, 0])), -1, 1)
    m.slope, m.shift = max(float(v[0]), 1e-3), float(v[1])
    s = m.score(logits)
    cuts = np.linspace(0.3, 0.9, 61)

    def best(own: np.ndarray) -> float:
        w, toxic, p = weight[own], y[own] == 1, s[own]
        f1 = np.asarray([2 * w[(p >= c) & toxic].sum() / (w[p >= c].sum() + w[toxic].sum()) for c in cuts])
        at = np.flatnonzero(f1 == f1.max())
        return float(cuts[at[len(at) // 2]])

    if not n1:
        return
    m.threshold = best(np.ones(len(y), bool))
    for lang in sorted({a for a in langs if a is not None}):
        own = np.asarray([a == lang for a in langs])
        n = (rows * y)[own].sum()
        cut = best(own) if n else m.threshold
        m.thresholds[lang] = float(m.threshold + n * (cut - m.threshold) / (n + MIN_CALIBRATION))


def share_model(n0: float, n1: float) -> Model:
    """Scores every text with the smoothed share of toxic labels."""
    share = (n1 + 1) / (n0 + n1 + 2)
    return Model(out_bias=float(np.log(share / (1 - share))))


def fit(docs: DataFrame, labels: DataFrame, trainable: Column, n: int | None = None) -> Model:
    """Trains on every labelled row and calibrates on a fifth of them (kept out of the training).

    With ``n`` it does so on a bounded sample of ``n`` rows per class, on the driver.
    """
    if n is not None:
        return fit_sample(docs, labels, trainable, n)
    rows = labelled_rows(docs, labels, trainable).withColumn("held", F.pmod(F.xxhash64(F.lit("held"), "doc_id"), F.lit(5)) == 0)
    rows = stored(rows, "toxicity-rows")
    counts = {(r.held, int(r.toxic)): r["count"] for r in rows.groupBy("held", "toxic").count().collect()}
    n0, n1 = (sum(k for (_, c), k in counts.items() if c == y) for y in (0, 1))
    if not n0 or not n1:
        return share_model(n0, n1)
    apart = len(counts) == 4  # both classes on both sides
    blocks = blocks_of(rows, -(-(n0 + n1) // BLOCK_ROWS))
    m = train_blocks(blocks, False if apart else None, *((counts[False, c] for c in (0, 1)) if apart else (n0, n1)))
    found = logit_counts(blocks, m, True if apart else None)
    k = np.asarray([r["count"] for r in found], np.float64)
    _calibrate(m, np.asarray([r.step for r in found]) / LOGIT_STEPS, np.asarray([r.toxic for r in found]),
               [r.lang for r in found], k, k)
    return m


def fit_sample(docs: DataFrame, labels: DataFrame, trainable: Column, n: int = MAX_PER_CLASS) -> Model:
    """:func:`fit` from the bounded sample."""
    sample, in_table = labelled_sample(docs, labels, trainable, n)
    rows = collected(sample)
    y = np.asarray([int(r.toxic) for r in rows], np.int64)
    stands_for = np.asarray([in_table.get(c, 0) / max(1, (y == c).sum()) for c in (0, 1)])
    weight = stands_for[y]
    if not len(y) or y.min() == y.max():
        return share_model(weight[y == 0].sum(), weight[y == 1].sum())
    texts = [(r.text or "").encode() for r in rows]
    held = np.arange(len(y)) % 5 == 0
    if y[~held].min() == y[~held].max() or y[held].min() == y[held].max():
        held[:] = False
    m = train([t for t, h in zip(texts, held) if not h], y[~held])
    cal = np.flatnonzero(held) if held.any() else np.arange(len(y))
    scorer = Scorer(m)
    logits = [scorer.logits([texts[k] for k in cal[i:i + 64]]) for i in range(0, len(cal), 64)]
    _calibrate(m, np.concatenate(logits), y[cal], [rows[k].lang for k in cal], weight[cal])
    return m


def toxicity(docs: DataFrame, labels: DataFrame, trainable: Column) -> DataFrame:
    """``docs`` plus ``score``, ``threshold`` (of the row's language) and ``rejected``."""
    spark = docs.sparkSession
    model = fit(docs, labels, trainable)
    sent = spark.sparkContext.broadcast(vars(model))  # plain arrays: workers need no copy of the package
    keep = [c for c in docs.columns if c not in ("score", "threshold", "rejected")]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Model(**sent.value))
        for b in slices(batches, "text", BATCH_BYTES):
            s = scorer.score(column_bytes(b.column(b.schema.get_field_index("text"))))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s.astype(np.float64))], [*b.schema.names, "score"])

    out = docs.select(*keep).mapInArrow(run, schema)
    cut = F.lit(float(model.threshold))
    if model.thresholds:
        cuts = F.create_map(*[F.lit(x) for kv in sorted(model.thresholds.items()) for x in kv])
        cut = F.coalesce(F.when(F.col("lang").isNotNull(), F.try_element_at(cuts, F.col("lang"))), cut)
    return out.withColumn("threshold", cut).withColumn("rejected", F.col("score") >= F.col("threshold"))


def trainable_rows() -> Column:
    return crc_mod("doc_id", 3) != 1


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = toxicity(docs, table(spark, sf_dir, "labels"), trainable_rows())
    return out.select("doc_id", (~trainable_rows()).alias("held_out"), "score",
                      (F.col("score") >= 0.7).cast("int").alias("predicted"), "threshold", "rejected")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents at or above their language's threshold go."""
    out = toxicity(docs, table(spark, sf_dir, "labels"), trainable_rows())
    return out.filter(~F.col("rejected")).select(*DOCUMENT_COLUMNS)
