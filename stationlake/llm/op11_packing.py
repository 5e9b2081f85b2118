"""Harmonic packing: token pieces in reciprocal-capacity classes, a fixed count per sequence.

Class k holds the pieces longer than C / (k + 1) and at most C / k, so any k of them fit a
sequence of C tokens; a sequence of class k takes exactly k pieces, whatever they are. Every
task fills the sequences of its own rows, one open sequence per class, so packing is one
pass without a shuffle and a task holds less than C tokens per class.

A piece wastes C / k less its length. Documents may be cut, so a rule made once per capacity
(:func:`cut_table`, dynamic programming over the lengths 1 .. C) says whether a length goes
whole or where it is cut: cut pieces are of the form floor(C / k), which waste less than k,
and a cut costs ``cut_cost`` tokens of padding, so that texts aren't cut for a handful of
tokens. What is longer than C gives full sequences first.

At the end of its rows a task joins what its open sequences hold (fewer than C tokens in
each of some 2 * sqrt(C) classes) into full sequences; the last tokens make sequences whose
sizes are powers of two, which need no padding.

Tokens come from a public tokenizer. Its rules look at nothing beyond white space, so the ids
of words (between ASCII white space) are remembered per worker, up to ``MOST_WORDS`` words or
8 ids for each, then forgotten.

Defined results: null and empty texts are the end id only. Every row is a document, also
where doc_ids repeat or are null (then pieces have a null doc_id). Very long texts span many
sequences. An empty table gives no rows. Extra columns aren't read. Ids, pieces and order
within a task follow the order of its rows, so a repeated task gives the same rows.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.llm.common import column_bytes, slices, table

CAPACITY, END_ID = 2048, 1
CUT_COST = 6                      # tokens of padding that a cut must save
MOST_WORDS, TOGETHER = 1_500_000, 200  # words that a worker remembers, that are encoded at once
SIGNS = ".,;:!?"                  # the tokenizer takes a run of them as one part
PART_END = "</w>"                 # fixed value of the tokenizer: the mark of a token that ends a part
BATCH_BYTES, OUT_BYTES = 2 << 20, 4 << 20
TOKENIZER = "word_bpe_49k.json"   # of the public tokenizers

PIECE = "struct<doc_id: bigint, start: bigint, length: bigint, offset: bigint, doc_tokens: bigint>"
SEQUENCE_TYPE = f"sequence_id bigint, n_tokens bigint, stored_tokens bigint, class int, ids binary, pieces array<{PIECE}>"


class Words(dict):
    """word -> number in order of first sight; ``new`` lists those not yet encoded."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self.new.append(word)
        n = self[word] = len(self)
        return n


class Tokenizer:
    """ids of texts, word by word from memory; only new words go through the tokenizer.

    New words go through it many at a time. Where each is letters, perhaps ended by signs, the
    number of its parts is known (the tokenizer parts letters from signs) and the last id of
    each part is one of a token that ends a part, so the ids are dealt back to the words.
    """

    def __init__(self, path: str, end_id: int = END_ID) -> None:
        from tokenizers import Tokenizer as Rust

        self.rust, self.end_id = Rust.from_file(path), end_id
        self.ends = np.zeros(self.rust.get_vocab_size(), bool)
        self.ends[[i for t, i in self.rust.get_vocab().items() if t.endswith(PART_END)]] = True
        self._forget()

    def _forget(self) -> None:
        self.words = Words()
        self.words[b""] = 0  # word 0 is the end id
        self.begin, self.flat = np.asarray([0, 1]), np.asarray([self.end_id], np.uint32)

    def _each(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.rust.encode_batch_fast(words, add_special_tokens=False)]

    def _learn(self) -> None:
        new, self.words.new = self.words.new, []
        words = [w.decode("utf-8", "replace") for w in new]
        cores = [w.rstrip(SIGNS) for w in words]
        plain = [c.isalpha() for c in cores]
        size = np.zeros(len(words), np.int64)
        own: list[np.ndarray] = []
        order = []
        some = [i for i, p in enumerate(plain) if p]
        groups = [some[i:i + TOGETHER] for i in range(0, len(some), TOGETHER)]
        for g, ids in zip(groups, self._each([" ".join([words[i] for i in g]) for g in groups])):
            ids = np.asarray(ids, np.uint32)
            last = np.flatnonzero(self.ends[ids]) + 1
            parts = np.cumsum([1 + (len(words[i]) > len(cores[i])) for i in g])
            if len(last) == parts[-1]:
                size[g] = np.diff(last[parts - 1], prepend=0)
                own.append(ids)
            else:
                each = self._each([words[i] for i in g])
                size[g] = list(map(len, each))
                own.append(np.concatenate([np.asarray(x, np.uint32) for x in each]))
            order += g
        rest = [i for i, p in enumerate(plain) if not p]
        for i, ids in zip(rest, self._each([words[i] for i in rest])):
            size[i] = len(ids)
            own.append(np.asarray(ids, np.uint32))
            order.append(i)
        # own holds the ids in ``order``; put them in the words' order
        order, got = np.asarray(order), np.concatenate(own)
        at = np.zeros(len(words), np.int64)
        at[order] = np.cumsum(size[order]) - size[order]
        cut = np.cumsum(size)
        ids = got[np.repeat(at - cut + size, size) + np.arange(cut[-1])]
        self.begin = np.concatenate([self.begin, self.begin[-1] + cut])
        self.flat = np.concatenate([self.flat, ids])

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each ended by the end id; ids per text."""
        if len(self.words) > MOST_WORDS or len(self.flat) > 8 * MOST_WORDS:
            self._forget()
        parts, ends = [], []
        for t in texts:
            own = t.split()
            own.append(b"")
            parts.append(np.fromiter(map(self.words.__getitem__, own), np.int64, len(own)))
            ends.append(len(own))
        if self.words.new:
            self._learn()
        at = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        n = self.begin[at + 1] - self.begin[at]
        cut = np.concatenate(([0], np.cumsum(n)))
        out = self.flat[np.repeat(self.begin[at] - cut[:-1], n) + np.arange(cut[-1])]
        return out, np.diff(cut[np.cumsum(ends, dtype=np.int64)], prepend=0)


def tokenizer_of(sent: dict) -> Tokenizer:
    """The tokenizer of a broadcast (path, end_id): kept with it, so a worker's later tasks know its words."""
    if "tokenizer" not in sent:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        sent["tokenizer"] = Tokenizer(sent["path"], sent["end_id"])
    return sent["tokenizer"]


def cut_table(capacity: int = CAPACITY, cut_cost: float = CUT_COST) -> np.ndarray:
    """For each length up to ``capacity``: the length of its first piece (itself: not cut)."""
    n = np.arange(1, capacity + 1)
    waste = capacity / (capacity // n) - n              # of a whole piece, by length - 1
    exact = np.unique(capacity // n)                    # floor(C / k), ascending
    cost, first = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for r in n:
        cost[r], first[r] = waste[r - 1], r
        s = exact[exact < r]
        if len(s):
            by = waste[s - 1] + cut_cost + cost[r - s]
            best = len(by) - 1 - int(by[::-1].argmin())  # ties: the longest first piece
            if by[best] < cost[r]:
                cost[r], first[r] = by[best], s[best]
    return first


def cuts(length: int, first: np.ndarray) -> list[int]:
    """Lengths of the pieces of a document of ``length`` tokens, in order."""
    capacity = len(first) - 1
    out = [capacity] * (length // capacity)
    rest = length % capacity
    while rest:
        out.append(int(first[rest]))
        rest -= out[-1]
    return out


class Packer:
    """Sequences of one task: ``add`` documents, then ``finish``; each gives closed sequences.

    A sequence is (class, [(doc_id, start, length, doc_tokens, ids as bytes), ...]); class 0
    names the joined rest of a task.
    """

    def __init__(self, first: np.ndarray) -> None:
        self.first, self.capacity = first, len(first) - 1
        self.open: dict[int, list] = {}

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[tuple[int, list]]:
        start = 0
        for n in cuts(len(ids), self.first):
            k = self.capacity // n
            own = self.open.setdefault(k, [])
            own.append((doc_id, start, n, len(ids), ids[start:start + n].tobytes()))
            start += n
            if len(own) == k:
                yield k, self.open.pop(k)

    def finish(self) -> Iterator[tuple[int, list]]:
        rest = [p for k in sorted(self.open) for p in self.open[k]]
        self.open.clear()
        left = sum(p[2] for p in rest)
        room, own = 0, []
        for doc_id, start, n, size, ids in rest:
            while n:
                if not room:  # full sequences first, then powers of two
                    room = self.capacity if left >= self.capacity else 1 << (left.bit_length() - 1)
                m = min(n, room)
                own.append((doc_id, start, m, size, ids[:4 * m]))
                start, n, ids, room, left = start + m, n - m, ids[4 * m:], room - m, left - m
                if not room:
                    yield 0, own
                    own = []


def sequence_batch(part: int, number: int, closed: list[tuple[int, list]], capacity: int) -> pa.RecordBatch:
    """Rows of SEQUENCE_TYPE; sequence ids are the task's partition and a running number."""
    flat = [p for _, own in closed for p in own]
    count = np.asarray([len(own) for _, own in closed])
    cut = np.concatenate(([0], np.cumsum(count))).astype(np.int32)
    length = np.asarray([p[2] for p in flat], np.int64)
    before = np.concatenate(([0], np.cumsum(length)))
    n = before[cut[1:]] - before[cut[:-1]]
    offset = before[:-1] - np.repeat(before[cut[:-1]], count)
    pieces = pa.StructArray.from_arrays(
        [pa.array([p[0] for p in flat], pa.int64()), pa.array([p[1] for p in flat], pa.int64()), pa.array(length),
         pa.array(offset), pa.array([p[3] for p in flat], pa.int64())],
        ["doc_id", "start", "length", "offset", "doc_tokens"])
    stored = np.where((n & (n - 1)) == 0, n, capacity)
    return pa.RecordBatch.from_arrays(
        [pa.array((part << 33) + number + np.arange(len(closed))), pa.array(n), pa.array(stored),
         pa.array([k for k, _ in closed], pa.int32()), pa.array([b"".join(p[4] for p in own) for _, own in closed], pa.binary()),
         pa.ListArray.from_arrays(pa.array(cut), pieces)],
        [c.split(" ")[0] for c in SEQUENCE_TYPE.split(", ")[:5]] + ["pieces"])


def packed_sequences(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
                     cut_cost: float = CUT_COST) -> DataFrame:
    """Training sequences of ``docs`` (doc_id, text): SEQUENCE_TYPE.

    ``ids`` are ``n_tokens`` little-endian unsigned 32-bit numbers; a reader pads them to
    ``stored_tokens`` (``capacity``, or ``n_tokens`` where that is a power of two). ``pieces``
    say which tokens of which document lie where.
    """
    sent = docs.sparkSession.sparkContext.broadcast(
        {"path": tokenizer or public_tokenizers.path(TOKENIZER), "end_id": end_id})
    first = cut_table(capacity, cut_cost)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = tokenizer_of(sent.value), Packer(first)
        part, number, closed, held = TaskContext.get().partitionId(), 0, [], 0

        for b in slices(batches, "text", BATCH_BYTES):
            ids, sizes = encoder.encode(column_bytes(b.column(1)))
            at = 0
            for doc_id, n in zip(b.column(0).to_pylist(), sizes.tolist()):
                for s in packer.add(doc_id, ids[at:at + n]):
                    closed.append(s)
                    held += 4 * capacity
                    if held >= OUT_BYTES:
                        yield sequence_batch(part, number, closed, capacity)
                        number, closed, held = number + len(closed), [], 0
                at += n
        closed.extend(packer.finish())
        if closed:
            yield sequence_batch(part, number, closed, capacity)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, SEQUENCE_TYPE)


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per piece; the checksum is of the piece's bytes within its sequence."""
    rows = packed_sequences(table(spark, sf_dir, "documents")).select("sequence_id", "ids", "class", F.inline("pieces"))
    crc = F.crc32(F.substring("ids", (4 * F.col("offset") + 1).cast("int"), (4 * F.col("length")).cast("int")))
    return rows.select("doc_id", "start", "length", crc.alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "class")
