"""Files of near-dedup: rarest shingles first, counted exactly whatever the number of ranges."""

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from stationlake.llm import op6_minhash
from stationlake.llm.op6_minhash import blocks, files, frequency_class, full_sets, near_duplicates, set_rows


def _groups(n):
    """(doc_id, text): ``n`` pairs of variants of one text, with a passage that all documents hold."""
    passage = " ".join(f"p{i}" for i in range(60))
    rows = []
    for g in range(n):
        own = [f"g{g}w{i}" for i in range(60)]
        rows += [(2 * g, " ".join(own) + " " + passage), (2 * g + 1, " ".join([*own[:30], "x", *own[31:]]) + " " + passage)]
    return rows


def _sets(rows):
    out = {}
    for d, t in rows:
        w = t.split()
        out[d] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}
    return out


def test_a_common_passage_makes_no_large_file(spark, monkeypatch):
    kept, store = [], op6_minhash.stored
    monkeypatch.setattr(op6_minhash, "stored", lambda df, name: (t := store(df, name), kept.append(t) if name == "filed" else None)[0])
    rows = _groups(30)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == {d: d // 2 * 2 for d, _ in rows}
    assert kept[0].groupBy("key").agg(F.countDistinct("node").alias("n")).agg(F.max("n")).first()[0] == 2


def test_files_count_exactly_over_many_ranges(spark):
    rng = random.Random(5)
    rows = _groups(12)
    rows += [(100 + i, " ".join(rng.choice("abcdefgh") for _ in range(rng.choice([3, 20, 90])))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    dealt = full_sets(docs, docs.select(F.col("doc_id").alias("node"))).cache()  # its blocks have random names
    sets = _sets(rows)
    seen = Counter(s for v in sets.values() for s in v)
    held = {r.node: np.frombuffer(r.hashes, np.uint64) for r in set_rows(dealt).collect()}
    assert {d: len(h) for d, h in held.items()} == {d: len(s) for d, s in sets.items()}
    count = Counter(np.concatenate(list(held.values())).view(np.int64).tolist())
    assert sorted(count.values()) == sorted(seen.values())
    found = [files(dealt, 85, size).collect() for size in (1 << 20, 50)]
    assert sorted(found[0]) == sorted(found[1]) and found[0]
    by = defaultdict(list)
    for r in found[1]:
        assert r.own == sum(seen[s] == 1 for s in sets[r.node]) and r.n == len(sets[r.node])
        by[r.node].append((r.n - r.rest, count[r.key]))
    for d, entries in by.items():
        entries.sort()
        often = sorted(c for c in map(count.get, held[d].view(np.int64).tolist()) if c > 1)
        assert [c for _, c in entries] == often[:len(entries)] if max(often) <= 16 else True
        assert len(entries) == min(len(often), len(sets[d]) - -(-85 * len(sets[d]) // 100) + 1 - sum(seen[s] == 1 for s in sets[d]))
    dealt.unpersist()


def test_frequency_classes_rise():
    got = frequency_class(np.r_[np.arange(1, 5000), 10**12])
    assert got[0] == 1 < got[1] == 2 and (np.diff(got.astype(int)) >= 0).all() and got[4998] > got[998] > got[98] > got[15]


def test_blocks_hold_every_set_once():
    sizes = [0, 3, 200_000, 70_000, 70_000, 1, 0]
    sets = [np.arange(n, dtype=np.uint64) for n in sizes]
    rows = [r for b in blocks(pa.array(range(7), pa.int64()), sets) for r in b.to_pylist()]
    assert [n for r in rows for n in r["nodes"]] == list(range(7)) and [n for r in rows for n in r["sizes"]] == sizes
    for r in rows:
        assert len(r["hashes"]) == 8 * r["total"] == 8 * sum(r["sizes"])
        assert r["total"] <= op6_minhash.BLOCK_HASHES or sum(s > 0 for s in r["sizes"]) <= 2
    assert len({r["block"] for r in rows}) == len(rows) and not list(blocks(pa.array([], pa.int64()), []))


def test_sets_without_shingles(spark):
    docs = spark.createDataFrame([(9, None), (9, ""), (8, "")], "doc_id long, text string").coalesce(1)
    dealt = full_sets(docs, docs.select(F.col("doc_id").alias("node"))).cache()
    assert files(dealt, 85).count() == 0 and set_rows(dealt).filter("n = 0 AND length(hashes) = 0").count() == 3
    dealt.unpersist()
    base = " ".join(f"w{i}" for i in range(50))
    rows = [(1, base), (1, None), (2, base + " x"), (2, "q r"), (3, ""), (4, None)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(1, 1), (2, 1), (3, 3), (4, 4)}
