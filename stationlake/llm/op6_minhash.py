"""MinHash near-dedup: circulant signatures, banding, exact Jaccard, linked classes.

Circulant MinHash needs two permutations of the 32-bit numbers: the first scatters the
shingles, the second gives coordinate k as its smallest value over the scattered numbers
shifted by k (round the end), so 120 coordinates cost two keyed bijections. 24 bands of
5 coordinates miss a link at 0.85 (the query) with a chance of about 1e-6, one at 0.8 (the
pipeline's stage) with about 7e-5.

1. One pass over the texts gives set size, a 128-bit fingerprint of the set and the bands.
   Rows with equal sets are one class from the start; only its smallest doc_id (node) goes on.
2. Nodes that share a bucket go on with their full sets (64-bit shingle hashes). Every hash
   is sent once to the task of its range of the hashes, which counts it among all sets and
   sends back a byte. In an order of all shingles from the rarest on, two sets with a
   similarity of t share one of their first (1 - t) n + 1 shingles; every node is filed under
   those it has in common with others. Mere variants of one text have enough shingles of their
   own to be filed nowhere, and common passages come last, so they cost nothing.
3. In each file, nodes are compared with its hubs: the node with fewest shingles of its own
   (the centre of a group of variants), then the next 4, 16, ... in later rounds, always
   outside the file's largest component. A file rests as soon as its nodes are in one
   component, so a group of g copies costs about g comparisons, and in the end no pair of
   different components in a file is left out. A pair is compared only if the number of their
   shared shingles, and the numbers by ranges of the hashes, allow a link; nodes that no set
   of their file's sizes could be linked with leave it after the first round.
4. Candidates are confirmed on the full sets, links are joined into components by smallest
   label with pointer jumping. Tables between rounds are written to the shared folder. No
   step gathers a bucket, a file, a class or the links in one task.

Defined results: words are lower-cased (A-Z). Null and empty texts have an empty set and are
linked with nothing; a text of 1 to 4 words has one shingle. Rows that share a doc_id are
one document: they are compared by each of their texts. Rows with a null doc_id take the
class of their equals (null where there are none, then kept). Extra columns pass through.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.llm.common import DOCUMENT_COLUMNS, WordHashes, column_bytes, mix64, slices, stored, table

SHINGLE, BANDS, ROWS = 5, 24, 5
MIN_PERCENT = 85                      # of the union, in the intersection: the op6 query
STAGE_PERCENT = 80                    # the same in the pipeline, which the query's contract doesn't bind
SALTS, BATCH_BYTES, BLOCK = 16, 4 << 20, 4096
BLOCK_HASHES = 1 << 17                # of the sets in a row that goes to be counted
RANGE_HASHES = 1 << 20                # counted at once by a task, whatever the input
RANGES = 32                           # of the shared shingles' hashes, counted per node
PLACE = np.asarray([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                    0xA0761D6478BD642F], np.uint64)  # odd factors of a word's place in its shingle


def shingle_hashes(w: np.ndarray) -> np.ndarray:
    """Sorted distinct shingle hashes of a sequence of word hashes."""
    if len(w) == 0:
        return w
    if len(w) < SHINGLE:
        return mix64((w * PLACE[:len(w)]).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(w)))
    n = len(w) - SHINGLE + 1
    h = np.zeros(n, np.uint64)
    for j in range(SHINGLE):
        h += w[j:j + n] * PLACE[j]
    return np.unique(mix64(h))


def scatter(x: np.ndarray) -> np.ndarray:
    """First permutation: a keyed bijection of 32-bit numbers."""
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x7FEB352D)
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x846CA68B)
    return x ^ (x >> np.uint32(16))


def second(x: np.ndarray) -> np.ndarray:
    """Second permutation, worked out in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x21F0AAAD)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0xD35A2D97)
    x ^= x >> np.uint32(15)
    return x


def signature(hashes: np.ndarray, k: int = BANDS * ROWS) -> np.ndarray:
    """Coordinate j: the smallest second(scatter(x) - j) over the set, j round the end."""
    shift = np.arange(k, dtype=np.uint32)
    at = scatter((hashes ^ (hashes >> np.uint64(32))).astype(np.uint32))
    out = np.full(k, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(at), BLOCK):
        out = np.minimum(out, second(at[i:i + BLOCK, None] - shift).min(axis=0))
    return out


def bands(sig: np.ndarray) -> np.ndarray:
    """One 64-bit bucket key per band."""
    v = sig.reshape(BANDS, ROWS).astype(np.uint64)
    return mix64(mix64(v * PLACE[:ROWS]).sum(axis=1, dtype=np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64))


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, fingerprint (null for the empty set) and bands per row."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_shingles", T.LongType()),
                           T.StructField("fingerprint", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes(xxhash.xxh3_64_intdigest)
        for b in slices(batches, "text", BATCH_BYTES):
            n, prints, keys = [], [], []
            for t in column_bytes(b.column(1)):
                s = shingle_hashes(words.of(t))
                n.append(len(s))
                prints.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                keys.append(bands(signature(s)).view(np.int64) if len(s) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(prints, pa.binary()),
                                              pa.array(keys, pa.list_(pa.int64()))], schema.names)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, schema)


def full_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """:func:`blocks` of the sorted distinct shingle hashes of the documents of ``nodes``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes(xxhash.xxh3_64_intdigest)
        for b in slices(batches, "text", BATCH_BYTES):
            yield from blocks(b.column(0), [shingle_hashes(words.of(t)) for t in column_bytes(b.column(1))])

    own = docs.select(F.col("doc_id").cast("bigint").alias("node"), "text").join(nodes, "node", "left_semi")
    return own.mapInArrow(run, BLOCK_SCHEMA)


def blocks(nodes: pa.Array, sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Rows (block, total, nodes, begins, sizes, hashes) of some ``BLOCK_HASHES`` hashes, or one set, each."""
    begin = 0
    while begin < len(sets):
        end, total = begin + 1, len(sets[begin])
        while end < len(sets) and total + len(sets[end]) <= BLOCK_HASHES:
            total += len(sets[end])
            end += 1
        own, one = [len(s) for s in sets[begin:end]], pa.array([0, end - begin], pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array([uuid.uuid4().bytes], pa.binary()), pa.array([total], pa.int64()),
             pa.ListArray.from_arrays(one, nodes.slice(begin, end - begin)),
             pa.ListArray.from_arrays(one, pa.array(np.cumsum([0, *own[:-1]]), pa.int64())),
             pa.ListArray.from_arrays(one, pa.array(own, pa.int64())),
             pa.array([np.concatenate(sets[begin:end]).tobytes()], pa.binary())],
            ["block", "total", "nodes", "begins", "sizes", "hashes"])
        begin = end


BLOCK_SCHEMA = "block binary, total bigint, nodes array<bigint>, begins array<bigint>, sizes array<bigint>, hashes binary"


def set_rows(dealt: DataFrame) -> DataFrame:
    """(node, n, hashes as bytes) of the sets in blocks."""
    return (dealt.select(F.explode(F.arrays_zip("nodes", "begins", "sizes")).alias("_s"), "hashes")
            .selectExpr("_s.nodes AS node", "_s.sizes AS n",
                        "substring(hashes, CAST(8 * _s.begins + 1 AS INT), CAST(8 * _s.sizes AS INT)) AS hashes"))


def shared_buckets(nodes: DataFrame) -> DataFrame:
    """Nodes that share a bucket with another one."""
    rows = nodes.select("node", F.explode("bands").alias("bucket"))
    several = (rows.groupBy("bucket").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
               .filter("lo < hi").select("bucket", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")))
    return (rows.withColumn("_salt", F.pmod("node", F.lit(SALTS)).cast("int"))
            .join(several, ["bucket", "_salt"], "left_semi").select("node").distinct())


def frequency_class(n: np.ndarray) -> np.ndarray:
    """1 for what is there once, more for what is there more often; exact up to 16, then four classes per doubling."""
    return np.where(n <= 16, n, 16 + np.floor(4 * np.log2(np.maximum(n, 16) / 16))).astype(np.uint8)


def classed(dealt: DataFrame, parts: int) -> DataFrame:
    """``dealt`` with ``classes``, rows (part, classes) with the frequency class of each hash among all sets.

    Every hash goes once to the task of its range (one of ``parts``) of the hashes, which counts
    them all and sends back a byte each, in the order they came. No task holds more than a range.
    """
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, packed in zip(b.column(0).to_pylist(), b.column(1)):
                h = _numbers(packed)
                if not len(h):
                    continue
                part = _part(h, parts)
                order = np.argsort(part, kind="stable")
                at, begin = np.unique(part[order], return_index=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at, pa.int32()), pa.array([block] * len(at), pa.binary()),
                     pa.array([x.tobytes() for x in np.split(h[order], begin[1:])], pa.binary())], ["part", "block", "hashes"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, []
        for b in batches:
            of = b.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist(), len(of)]
            for begin, end in zip(cuts, cuts[1:]):
                if begin == end:
                    continue
                if held and of[begin] != part:
                    yield from answer(part, held)
                    held = []
                part = of[begin]
                held.append(b.slice(begin, end - begin))
        if held:
            yield from answer(part, held)

    def answer(part: int, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = [x for b in held for x in b.column(2).to_pylist()]
        _, of, n = np.unique(np.frombuffer(b"".join(pieces), np.uint64), return_inverse=True, return_counts=True)
        found, ends = frequency_class(n)[of].tobytes(), np.cumsum([0, *(len(x) // 8 for x in pieces)]).tolist()
        answers = pa.array([found[x:y] for x, y in zip(ends, ends[1:])], pa.binary())
        begin = 0
        for b in held:
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array([part] * b.num_rows, pa.int32()),
                                              answers.slice(begin, b.num_rows)], ["block", "part", "classes"])
            begin += b.num_rows

    pieces = dealt.select("block", "hashes").mapInArrow(split, "part int, block binary, hashes binary")
    answers = (pieces.repartition(parts, "part").sortWithinPartitions("part")
               .mapInArrow(count, "block binary, part int, classes binary"))
    return dealt.join(answers.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("part", "classes"))).alias("classes")), "block")


def _numbers(packed: pa.Scalar) -> np.ndarray:
    """The hashes of a value of bytes, which may be empty."""
    buffer = packed.as_buffer()
    return np.frombuffer(buffer, np.uint64) if len(buffer) else np.zeros(0, np.uint64)


def _part(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Which of ``parts`` (a power of two) ranges each hash is in."""
    return (hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)


def files(dealt: DataFrame, percent: int, size: int = RANGE_HASHES) -> DataFrame:
    """(key, node, n, own, rest, spread): each node under the shared ones of its first shingles, rarest first.

    ``own``: shingles of this node only, ``rest``: shingles from this one on, which bounds
    what the node can have in common with another node of the file that has none before.
    ``spread``: its shared shingles per ``RANGES``-th of the hashes; two nodes have at most the
    sum of the smaller counts in common, which tells variants of one text apart that lack
    different shingles of it.
    """
    names = ["key", "node", "n", "own", "rest"]
    kind = ", ".join(f"{c} bigint" for c in names) + ", spread array<int>"

    total = dealt.agg(F.sum("total")).first()[0] or 0
    parts = 1 << (max(1, -(-total // size)) - 1).bit_length()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                out: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in names]
                spread: list[np.ndarray] = [np.zeros(0, np.int32)]
                flat, ends = _numbers(b.column(2)[i]), np.cumsum(b.column(1)[i].as_py())
                found = np.frombuffer(b"".join(p["classes"] for p in b.column(3)[i].as_py()), np.uint8)
                if len(found) != len(flat):
                    raise ValueError(f"{len(found)} frequency classes of {len(flat)} shingles")
                classes = np.empty(len(flat), np.uint8)
                classes[np.argsort(_part(flat, parts), kind="stable")] = found
                for node, begin, end in zip(b.column(0)[i].as_py(), np.append(0, ends[:-1]), ends):
                    h, often = flat[begin:end], classes[begin:end]
                    more = often > 1
                    shared, n = h[more], len(h)
                    own = n - len(shared)
                    most = max(0, n - (percent * n + 99) // 100 + 1 - own)
                    if not most or not len(shared):
                        continue
                    first = shared[np.argsort(often[more], kind="stable")][:most].view(np.int64)
                    for col, v in zip(out, (first, node, n, own, n - own - np.arange(len(first)))):
                        col.append(v if isinstance(v, np.ndarray) else np.full(len(first), v, np.int64))
                    by = np.bincount((shared // np.uint64((1 << 64) // RANGES)).astype(np.int64), minlength=RANGES)
                    spread.append(np.tile(by.astype(np.int32), len(first)))
                flat = np.concatenate(spread)
                cut = pa.array(np.arange(0, len(flat) + 1, RANGES, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([*(pa.array(np.concatenate(c), pa.int64()) for c in out),
                                                  pa.ListArray.from_arrays(cut, pa.array(flat))], [*names, "spread"])

    return classed(dealt, parts).select("nodes", "sizes", "hashes", "classes").mapInArrow(run, kind)


def confirm(pairs: DataFrame, sets: DataFrame, percent: int = MIN_PERCENT) -> DataFrame:
    """Pairs (a, b) whose full sets share ``percent`` of their union; ``pairs`` is read several times."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            linked = []
            for x, y in zip(b.column(2), b.column(3)):
                x, y = _numbers(x), _numbers(y)
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
            yield b.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    ends = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    sets = sets.select("node", "hashes").join(ends, "node", "left_semi")
    x, y = (sets.withColumnsRenamed({"node": c, "hashes": f"_{c}"}) for c in ("a", "b"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "_a", "_b").mapInArrow(run, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """(id, label): smallest id reachable, for every id of ``edges`` (a, b)."""
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("id")).alias("label")), "labels")
    while True:
        near = (both.join(labels.withColumnsRenamed({"id": "b", "label": "_l"}), "b")
                .groupBy(F.col("a").alias("id")).agg(F.min("_l").alias("_near")))
        step = labels.join(near, "id", "left").select(
            "id", F.col("label").alias("_old"), F.least("label", "_near").alias("_new"))
        jump = labels.select(F.col("id").alias("_new"), F.col("label").alias("_far"))
        new = stored(step.join(jump, "_new", "left").select(
            "id", "_old", F.least("_new", F.coalesce("_far", "_new")).alias("label")), "labels")
        labels = new.select("id", "label")
        if not new.filter("label <> _old").limit(1).count():
            return labels


def _enough(common: Column, sizes: Column, percent: int) -> Column:
    """Whether ``common`` shingles are ``percent`` of the union of two sets with ``sizes`` together."""
    return (100 + percent) * common >= percent * sizes


def _open(filed: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """``filed`` with label and the file's largest component (_main), where a file has several components.

    The largest needs no hubs: those of all others meet it. Entries go that have too few
    shingles left even for the smallest set of their file.
    """
    named = (filed.join(labels.withColumnRenamed("id", "node"), "node", "left")
             .select(*filed.columns, F.coalesce("label", "node").alias("label")))
    open_ = (named.groupBy("key", "label").agg(F.count(F.lit(1)).alias("_n"), F.max("own").alias("_own"), F.min("n").alias("_least"))
             .groupBy("key").agg(F.max(F.struct("_n", "_own", "label")).alias("_most"), F.count(F.lit(1)).alias("_labels"),
                                 F.min("_least").alias("_least"))
             .filter("_labels > 1")
             .select("key", F.col("_most.label").alias("_main"), "_least",
                     F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")))
    return (named.withColumn("_salt", F.pmod("node", F.lit(SALTS)).cast("int")).join(open_, ["key", "_salt"])
            .filter(_enough(F.col("rest"), F.col("n") + F.col("_least"), percent)).drop("_salt", "_least"))


def near_duplicates(docs: DataFrame, percent: int = MIN_PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept per row of ``docs`` (doc_id, text)."""
    sigs = stored(signatures(docs), "signatures")
    classes = stored(sigs.filter("fingerprint IS NOT NULL").groupBy("fingerprint", F.col("n_shingles").alias("n"))
                     .agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands")),
                     "classes")
    # a doc_id with several texts joins their classes
    members = sigs.filter("fingerprint IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "fingerprint").distinct()
    several = members.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("doc_id")
    same_id = (members.join(several, "doc_id", "left_semi").join(classes.select("fingerprint", "node"), "fingerprint")
               .select(F.col("doc_id").alias("a"), F.col("node").alias("b")))
    nodes = shared_buckets(classes.filter("node IS NOT NULL"))
    dealt = stored(full_sets(docs, nodes), "sets")
    sets = set_rows(dealt)
    filed = stored(files(dealt, percent), "filed")
    links = stored(same_id, "links")
    labels = components(links)
    hubs = 1
    while True:
        if hubs == 1:  # of every file; its nodes are components of their own, or compared once too often
            named = filed.withColumn("label", F.col("node"))
            first = named
        else:
            named = stored(_open(filed, labels, percent), "open")
            if not named.limit(1).count():
                break
            first = named.filter("label <> _main")
        first = (first.withColumn("_r", F.row_number().over(Window.partitionBy("key").orderBy("own", "node")))
                 .filter(F.col("_r") <= hubs)
                 .select("key", F.col("node").alias("a"), F.col("n").alias("_n"), F.col("rest").alias("_rest"),
                         F.col("spread").alias("_spread"), F.col("label").alias("_label")))
        first = stored(first, "hubs")
        salts = 1 if hubs == 1 else SALTS  # one hub a file: the files' rows would outnumber the nodes, and Spark splits hot ones
        spread = first.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        common = F.aggregate(F.zip_with("spread", "_spread", lambda x, y: F.least(x, y)), F.lit(0), lambda x, y: x + y)
        pairs = (named.withColumn("_salt", F.pmod("node", F.lit(salts)).cast("int")).join(spread, ["key", "_salt"])
                 .filter((F.col("_label") != F.col("label")) & (F.col("a") != F.col("node"))
                         & _enough(F.least("rest", "_rest"), F.col("n") + F.col("_n"), percent)
                         & _enough(common, F.col("n") + F.col("_n"), percent))
                 .select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct())
        new = stored(confirm(stored(pairs, "pairs"), sets, percent), "links")
        if new.limit(1).count():
            links = links.union(new)
            labels = components(links)
        filed = stored(named.join(first.select("key", F.col("a").alias("node")), ["key", "node"], "left_anti")
                       .select(*filed.columns), "filed")
        hubs *= 4
    return _assigned(sigs, classes, labels)


def _assigned(sigs: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows with the class of their fingerprint; only classes of several rows or links are joined, salted."""
    moved = (classes.join(labels.withColumnRenamed("id", "node"), "node", "left")
             .filter("copies > 1 OR label IS NOT NULL")
             .select("fingerprint", F.coalesce("label", "node").alias("_class"),
                     F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")))
    rows = sigs.withColumn("_salt", F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(SALTS)).cast("int"))
    out = rows.join(moved, ["fingerprint", "_salt"], "left")
    component = F.coalesce("_class", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each class of linked documents the smallest doc_id stays."""
    classes = near_duplicates(docs.select("doc_id", "text"), percent=STAGE_PERCENT)
    gone = classes.filter("NOT kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*DOCUMENT_COLUMNS)
