"""Token shards in training order: every sequence gets a slot of a keyed permutation.

Texts are encoded (:mod:`op3_sentencepiece`), ended by the end token and packed into
sequences of ``LENGTH`` tokens per input partition; only a partition's last sequence is
padded. Sequences are numbered through (partition, place); number g goes to slot
``permute(g)``, a keyed Feistel network over the next even number of bits, walked on until
it lands below the number of sequences, so the slots are exactly 0 .. n-1 and any slot is
known from key and n alone. Slots are dealt by range: shard s holds the slots from
``s * shard_slots`` on; the sequences that a task has for one shard travel together,
compressed. One task fills a shard in memory (``shard_slots`` records) and writes it in slot
order, every record ``LENGTH`` tokens of fixed size, so a reader resumes at any slot with one
seek.

Shards are written below the shared folder under a name of their own per attempt; the
manifest (written by Spark) names the ones that count, so repeated attempts do no harm.

Defined results: null and empty texts are one end token. Every row is a document (repeated
rows repeat). An empty table gives no shards and an empty index. Very long texts span
several sequences. Extra columns aren't written. A model with ids beyond 16 bits is refused.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.llm.common import column_bytes, mix64, slices, stored, table, work_path
from stationlake.llm.op3_sentencepiece import BATCH_BYTES, encoder_of, load_model

LENGTH, SHARD_SLOTS, KEY, ROUNDS = 1024, 1 << 14, 20240229, 6
LEVEL = 5              # of Zstandard, for tokens on their way to the shards
MOST_PARTS = 1 << 20   # input partitions whose offsets are broadcast (16 MB)
HELD_BYTES = 64 << 20  # of sequences that a task gathers per shard before it sends them
END_TOKEN, PAD_TOKEN = 2, 0  # fixed values of the piece model: </s>, <unk> (never read: see n_tokens)

PACKED_TYPE = "part bigint, seq bigint, payload binary, doc_id bigint, start int, n_tokens bigint"
MANIFEST_TYPE = "shard bigint, path string, first_slot bigint, n_slots bigint, stride int"


def permute(g: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """Slots of sequence numbers ``g`` among 0 .. n-1: Feistel rounds with cycle-walking."""
    half = max(1, (max(1, n - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = mix64(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(key))

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for k in keys:
            left, right = right, left ^ (mix64(right ^ k) & mask)
        return left << np.uint64(half) | right

    out = once(g.astype(np.uint64))
    while (far := out >= n).any():
        out[far] = once(out[far])
    return out.astype(np.int64)


def packed(docs: DataFrame, model: dict | None = None, length: int = LENGTH) -> DataFrame:
    """Sequences (part, seq, payload) and documents (part, seq, doc_id, start, n_tokens) in one written table.

    A document starts at token ``start`` of sequence ``seq`` of its part.
    """
    model = model or load_model()
    if max(int(model["ids"].max()), int(model["byte_ids"].max())) > np.iinfo(np.uint16).max:
        raise ValueError("shards hold token ids of 16 bits; the model has larger ones")
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, part = encoder_of(sent.value), TaskContext.get().partitionId()
        rest, seq = np.zeros(0, np.uint16), 0

        def rows(payloads: list[bytes]) -> pa.RecordBatch:
            n = len(payloads)
            none = pa.nulls(n, pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, part)), pa.array(np.arange(seq, seq + n)), pa.array(payloads, pa.binary()),
                 none, pa.nulls(n, pa.int32()), none], names)

        names = [c.split(" ")[0] for c in PACKED_TYPE.split(", ")]
        for b in slices(batches, "text", BATCH_BYTES):
            ids = e.encode(column_bytes(b.column(1)))
            sizes = np.fromiter(map(len, ids), np.int64, len(ids)) + 1
            begin = len(rest) + np.cumsum(sizes) - sizes
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), part)), pa.array(seq + begin // length), pa.nulls(len(ids), pa.binary()),
                 b.column(0), pa.array((begin % length).astype(np.int32)), pa.array(sizes)], names)
            end = np.asarray([END_TOKEN], np.uint16)
            rest = np.concatenate([rest, *(x for t in ids for x in (t.astype(np.uint16), end))])
            whole = len(rest) // length
            if whole:
                yield rows([rest[i * length:(i + 1) * length].tobytes() for i in range(whole)])
                rest, seq = rest[whole * length:], seq + whole
        if len(rest):
            yield rows([np.concatenate([rest, np.full(length - len(rest), PAD_TOKEN, np.uint16)]).tobytes()])

    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, PACKED_TYPE)
    path = work_path(docs.sparkSession, "packed")
    own.write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", LEVEL).parquet(path)
    return docs.sparkSession.read.schema(own.schema).parquet(path)


def _numbered(rows: DataFrame) -> tuple[DataFrame, int]:
    """``rows`` of a packed table with the number of sequences before their part (``_before``); the total."""
    counts = rows.filter("payload IS NOT NULL").groupBy("part").count().orderBy("part").collect()  # a row per input partition
    before, total = [], 0
    for r in counts:
        before.append((r.part, total))
        total += r["count"]
    offsets = rows.sparkSession.createDataFrame(before, "part bigint, _before bigint")
    # 16 bytes a part; a join by shuffle beyond the bound
    return rows.join(F.broadcast(offsets) if len(before) <= MOST_PARTS else offsets, "part"), total


def write_shards(sequences: DataFrame, n: int, folder: str, key: int = KEY, length: int = LENGTH,
                 shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """Writes the shards of ``sequences`` (part, seq, payload, _before) and returns the written manifest."""
    stride = 2 * length

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zstd = zstandard.ZstdCompressor(level=LEVEL)
        kept: dict[int, tuple[list[int], list[bytes]]] = {}
        size = 0

        def send() -> pa.RecordBatch:
            cols = [pa.array(list(kept), pa.int32()), pa.array([k for k, _ in kept.values()], pa.list_(pa.int64())),
                    pa.array([zstd.compress(b"".join(v)) for _, v in kept.values()], pa.binary())]
            kept.clear()
            return pa.RecordBatch.from_arrays(cols, ["shard", "slots", "tokens"])

        for b in batches:
            slots = permute(b.column(0).to_numpy(), n, key)
            for slot, payload in zip(slots.tolist(), b.column(1).to_pylist()):
                own = kept.setdefault(slot // shard_slots, ([], []))
                own[0].append(slot)
                own[1].append(payload)
                size += stride
                if size >= HELD_BYTES:
                    yield send()
                    size = 0
        if kept:
            yield send()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pyarrow.fs.FileSystem.from_uri(folder) if "://" in folder else (pyarrow.fs.LocalFileSystem(), folder)
        done, shard, seen = [], -1, None

        def close() -> None:
            if seen is None:
                return
            if not seen.all():
                raise ValueError(f"shard {shard} has {int(seen.sum())} of {len(seen)} slots")
            file = f"tokens-{shard:08d}-{uuid.uuid4().hex}.bin"
            fs.create_dir(root, recursive=True)
            with fs.open_output_stream(f"{root}/{file}", compression=None) as out:
                out.write(records.astype("<u2", copy=False).tobytes())
            done.append((shard, f"{folder}/{file}", shard * shard_slots, len(seen), stride))

        for b in batches:
            for s, slots, tokens in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                if s != shard:
                    close()
                    shard, count = s, min(n, (s + 1) * shard_slots) - s * shard_slots
                    seen, records = np.zeros(count, bool), np.zeros((count, length), np.uint16)
                at = np.asarray(slots) - s * shard_slots
                if seen[at].any() or len(np.unique(at)) < len(at):
                    raise ValueError(f"a slot of shard {s} came twice")
                seen[at] = True
                records[at] = np.frombuffer(zstandard.ZstdDecompressor().decompress(tokens.as_py()), np.uint16).reshape(-1, length)
        close()
        if done:
            cols = [pa.array(c, t) for c, t in zip(zip(*done), (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int32()))]
            yield pa.RecordBatch.from_arrays(cols, [c.split(" ")[0] for c in MANIFEST_TYPE.split(", ")])

    shards = max(1, -(-n // shard_slots))
    placed = (sequences.select((F.col("_before") + F.col("seq")).alias("g"), "payload")
              .mapInArrow(place, "shard int, slots array<bigint>, tokens binary"))
    return stored(placed.repartitionById(shards, "shard").mapInArrow(write, MANIFEST_TYPE), "shard-manifest")


def document_slots(rows: DataFrame, n: int, key: int = KEY, length: int = LENGTH) -> DataFrame:
    """doc_id, n_tokens, start, slots: the slots of the sequences that hold a document, in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            g, start, size = (b.column(i).to_numpy() for i in (1, 2, 3))
            count = (start + size - 1) // length + 1
            cut = np.concatenate(([0], np.cumsum(count)))
            flat = np.repeat(g - cut[:-1], count) + np.arange(cut[-1])
            slots = pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(permute(flat, n, key)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(3), b.column(2), slots],
                                             ["doc_id", "n_tokens", "start", "slots"])

    own = rows.filter("payload IS NULL").select("doc_id", (F.col("_before") + F.col("seq")).alias("g"), "start", "n_tokens")
    return own.mapInArrow(run, "doc_id bigint, n_tokens bigint, start int, slots array<bigint>")


def token_shards(docs: DataFrame, folder: str, model: dict | None = None, key: int = KEY, length: int = LENGTH,
                 shard_slots: int = SHARD_SLOTS) -> tuple[DataFrame, DataFrame]:
    """Writes all shards; returns (manifest, index of documents)."""
    rows, n = _numbered(packed(docs, model, length))
    manifest = write_shards(rows.filter("payload IS NOT NULL"), n, folder, key, length, shard_slots)
    return manifest, document_slots(rows, n, key, length)


def read_slots(path: str, first_slot: int, stride: int, slot: int, count: int = 1) -> np.ndarray:
    """``count`` records of one shard from ``slot`` on, one seek and one read; shape (records, tokens)."""
    fs, file = pyarrow.fs.FileSystem.from_uri(path) if "://" in path else (pyarrow.fs.LocalFileSystem(), path)
    with fs.open_input_file(file) as f:
        f.seek((slot - first_slot) * stride)
        return np.frombuffer(f.read(count * stride), "<u2").reshape(-1, stride // 2)


def op9_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, index = token_shards(table(spark, sf_dir, "documents"), work_path(spark, "token-shards"))
    return index
