"""Packing, centroid clustering and importance resampling against brute force, round trips and SQL."""

import collections
import hashlib
import math
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from stationlake.llm import op11_packing as P
from stationlake.llm import op12_centroids as C
from stationlake.llm import op13_resampling as R
from stationlake.llm.common import table
from stationlake.llm.oracle import SQL

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, ids string, pieces string, weight string, rank string, n_words string, _row string"
EDGE = [(1, None), (2, ""), (3, " \n\t "), (None, "one two three"), (None, "four five"), (4, "x"), (4, "x"),
        (5, "Long text, again and again. " * 4000), (6, "<|endoftext|> in <|STARTOFTEXT|>"), (7, "ΟΔΟΣ Σας, J̌ İstanbul é́ ²x _y"),
        (8, "x" * 70_000), (9, "I'll don't 12ab!! a...b ... \x1c \x85 é.,")]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame([(i, t, *["c"] * 6) for i, t in EDGE], DOCS).repartition(3)


# ---- 11 packing ------------------------------------------------------------------------
@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(P.TOKENIZER))


def _ids(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 1]


def _packed(rows, library, texts, capacity):
    """Checks all sequences of ``rows`` and that the pieces make up the texts; returns padding / tokens."""
    found = collections.defaultdict(list)
    tokens = padding = 0
    for r in rows:
        ids = np.frombuffer(bytes(r.ids), "<u4")
        assert len(ids) == r.n_tokens <= capacity
        assert r.stored_tokens == (r.n_tokens if r.n_tokens.bit_count() == 1 else capacity)
        at = 0
        for p in r.pieces:
            assert p.offset == at and p.length > 0
            found[p.doc_id, p.doc_tokens].append((p.start, ids[at:at + p.length].tolist()))
            at += p.length
        assert at == r.n_tokens
        k = r["class"]
        if k:  # a fixed count of pieces, each of the class's lengths
            assert len(r.pieces) == k and all(capacity // p.length == k for p in r.pieces)
        tokens, padding = tokens + r.n_tokens, padding + r.stored_tokens - r.n_tokens
    want = collections.defaultdict(list)
    for doc_id, t in texts:
        ids = _ids(library, t)
        want[doc_id, len(ids)].append(ids)
    assert found.keys() == want.keys()
    for key, docs in want.items():
        pieces = sorted(found[key])
        assert sum(len(x) for _, x in pieces) == len(docs) * key[1]
        if len(docs) == 1:
            assert [s for s, _ in pieces] == [0, *np.cumsum([len(x) for _, x in pieces])[:-1]]
            assert sum((x for _, x in pieces), []) == docs[0]
    return padding / max(1, tokens)


def test_pieces_make_up_the_texts(spark, library):
    docs = table(spark, SF, "documents")
    rows = P.packed_sequences(docs).collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    assert _packed(rows, library, [(r.doc_id, r.text) for r in docs.collect()], P.CAPACITY) < 0.01


@pytest.mark.parametrize("capacity,cut_cost", [(64, 0), (100, 3), (2048, 6), (1, 1)])
def test_packing_takes_odd_rows(spark, library, edge, capacity, cut_cost):
    some = edge.filter("doc_id IS NULL OR doc_id NOT IN (5, 8)") if capacity < 100 else edge
    rows = P.packed_sequences(some, capacity=capacity, cut_cost=cut_cost).collect()
    texts = [(r.doc_id, r.text) for r in some.select("doc_id", "text").collect()]
    _packed(rows, library, texts, capacity)
    assert P.packed_sequences(edge.limit(0)).count() == 0


def test_packing_query_is_the_sequences_digest(spark, library):
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    got = P.op11_packing(spark, SF).collect()
    places = collections.defaultdict(list)
    for r in got:
        ids = _ids(library, texts[r.doc_id])
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(np.asarray(ids[r.start:r.start + r.length], "<u4").tobytes())
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        assert [o for o, _ in sorted(own)] == [0, *np.cumsum([n for _, n in sorted(own)])[:-1]]
        assert sum(n for _, n in own) <= 2048


def test_words_are_forgotten_beyond_the_bound(library, monkeypatch):
    monkeypatch.setattr(P, "MOST_WORDS", 5)
    t = P.Tokenizer(public_tokenizers.path(P.TOKENIZER))
    for text in ("a b c d e f, g. h", "Zürich, a b; unseenword, é", "", "h g f"):
        ids, n = t.encode([text.encode(), b"a b"])
        assert ids.tolist() == _ids(library, text) + _ids(library, "a b") and n.tolist() == [len(_ids(library, text)), 3]


@pytest.mark.parametrize("capacity", [1, 7, 64, 2048])
def test_cut_table_is_the_cheapest_cut(capacity):
    first = P.cut_table(capacity, 2)
    exact = {capacity // k for k in range(1, capacity + 1)}
    cost = [0.0]
    for r in range(1, capacity + 1):
        waste = capacity / (capacity // r) - r
        cost.append(min([waste, *(capacity / (capacity // s) - s + 2 + cost[r - s] for s in exact if s < r)]))
        parts = P.cuts(r, first)
        assert sum(parts) == r or r == capacity
        assert math.isclose(sum(capacity / (capacity // p) - p for p in parts) + 2 * (len(parts) - 1), cost[r], abs_tol=1e-6)
        assert all(p in exact for p in parts[:-1])


# ---- 12 centroids ------------------------------------------------------------------------
def _kmeans(vectors, k, rounds, dimensions):
    """(vec_id, cluster, distance) and centroids in plain Python."""
    kept = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in vectors
            if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda x: (hashlib.sha256(f"1:{'' if x[0] is None else x[0]}".encode()).hexdigest(), x[1]))
    c = [q for _, q in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(q, m)), j) for j, m in enumerate(c)) for _, q in kept]

    for _ in range(rounds):
        own = collections.defaultdict(list)
        for (_, q), (_, j) in zip(kept, assign()):
            own[j].append(q)
        for j, qs in own.items():
            c[j] = [sum(x) // len(qs) for x in zip(*qs)]
    return [(i, j, d) for (i, _), (d, j) in zip(kept, assign())], c


def test_clusters_equal_brute_force(spark):
    got = C.op12_centroids(spark, SF).collect()
    rows, c = _kmeans([(r.vec_id, r.embedding) for r in table(spark, SF, "embeddings").collect()], 16, 3, 64)
    assert sorted((r.vec_id, r.cluster, r.distance) for r in got) == sorted(rows)
    by = collections.Counter()
    for _, j, d in rows:
        by[j] += d
    for r in got:
        assert r.cluster_inertia == by[r.cluster] and r.inertia == sum(by.values())
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, c[r.cluster])).encode()).hexdigest()


def test_clusters_equal_their_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF}/embeddings.parquet')")
    res = con.execute(SQL["op12_centroids"])
    cols = [d[0] for d in res.description]
    got = C.op12_centroids(spark, SF).select(*cols)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, res.fetchall()))


def test_clusters_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [(1, [0.5, -0.01]), (1, [0.5, -0.01]), (2, [-3.0, 2.0]), (None, [7.0, 7.0]), (None, [7.0, 8.0]), (3, None), (4, []),
               (5, [1.0]), (6, [1.0, 2.0, 3.0]), (7, [nan, 1.0]), (8, [1.0, -inf]), (9, [None, 1.0]), (10, [-0.0, 1e-9]), (11, [-1e-9, 0.0])]
    df = spark.createDataFrame([(i, v, 1, "x", "y") for i, v in vectors],
                               "vec_id long, embedding array<float>, label int, cluster string, q string").repartition(4)
    for k in (1, 3, 16):
        rows, c = C.clustered(df, k=k, rounds=2, dimensions=2)
        want, centroids = _kmeans([(i, [None if x is None else float(np.float32(x)) for x in v] if v else v) for i, v in vectors], k, 2, 2)
        key = lambda x: (x[0] is None, x)
        assert sorted((tuple(r) for r in rows.collect()), key=lambda x: repr(key(x))) == sorted(want, key=lambda x: repr(key(x)))
        assert c == centroids
    rows, c = C.clustered(df.limit(0), dimensions=2)
    assert rows.count() == 0 and c == [] and rows.columns == ["vec_id", "cluster", "distance"]
    with pytest.raises(Exception, match="too large"):
        C.clustered(spark.createDataFrame([(1, [3e30, 0.0])], "vec_id long, embedding array<float>"), dimensions=2)


def test_clusters_use_built_in_functions_only(spark):
    q = C.quantised(table(spark, SF, "embeddings"))
    plan = q.select(C.nearest("q", [[0] * 64, [1] * 64]))._jdf.queryExecution().executedPlan().toString()
    assert "zip_with" in plan and "aggregate" in plan and "array_min" in plan and "Python" not in plan and "Arrow" not in plan


# ---- 13 resampling ------------------------------------------------------------------------
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _features(text):
    w = WORD.findall((text or "").translate(LOWER))
    return len(w), [zlib.crc32(" ".join(w[i:i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def _resampled(docs, target, percent=5, min_words=20):
    own = [(i, *_features(t)) for i, t in docs]
    s = collections.Counter(b for _, _, f in own for b in f)
    t = collections.Counter(b for x in target for b in _features(x)[1])
    ns, nt = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (ns + 10000) / ((s[b] + 1) * (nt + 10000)))) for b in range(10000)]
    rows = []
    for n, (i, words, f) in enumerate(own):
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in f)
        rows.append((i, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words, n))
    able = sorted((r for r in rows if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[5]))
    rank = {r[5]: k + 1 for k, r in enumerate(able[:percent * len(able) // 100])}
    return [(*r[:4], rank.get(r[5])) for r in rows]


@pytest.mark.parametrize("block", [4, 1 << 16])
def test_resampling_equals_brute_force(spark, block):
    docs, target = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    want = _resampled([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()])
    got = R.resampled(docs, target, block=block).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want)) and sum(r.rank is not None for r in got) > 5


def test_resampling_query(spark):
    want = _resampled([(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()],
                      [r.text for r in table(spark, SF, "benchmark").collect()])
    got = R.op13_resampling(spark, SF)
    assert [t for _, t in got.dtypes] == ["bigint"] * 5
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def test_resampling_of_odd_rows(spark, edge):
    target = spark.createDataFrame([(None,), ("",), ("again and text",)], "text string")
    for own in (edge, edge.coalesce(1)):
        rows = [(r.doc_id, r.text) for r in own.select("doc_id", "text").collect()]
        want = _resampled(rows, [None, "", "again and text"], percent=60, min_words=1)
        got = R.resampled(own, target, percent=60, min_words=1, block=2).select("doc_id", "n_features", "weight", "score", "rank")
        # rows alike in score and doc_id share their ranks in the order they were read
        assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert R.resampled(edge.limit(0), target).count() == 0
    alone = R.resampled(edge, target.limit(0), percent=100, min_words=0)
    assert sorted(r.rank for r in alone.collect()) == list(range(1, len(EDGE) + 1))


def test_long_texts_and_words_in_pieces(monkeypatch):
    monkeypatch.setattr(R, "PIECE_WORDS", 7)
    monkeypatch.setattr(R, "MOST_WORDS", 3)
    f = R.Features()
    for text in ("a b c d e f g h i j k l m n o p", "ü" * 500 + " b " + "z" * 1000 + " ÄÖ", "one", "", "A" * 64 + " b"):
        parts = list(f.of([text.encode()]))
        assert sum(n for _, n, _ in parts) == _features(text)[0]
        assert sorted(np.concatenate([x for _, _, x in parts]).tolist()) == sorted(_features(text)[1])


def test_radix_sort_equals_sorted(spark):
    rng = np.random.default_rng(5)
    rows = [(int(a), int(b)) for a, b in zip(rng.integers(0, 1 << 14, 700), rng.choice([3, 3, 3, 70_000, 1 << 40], 700))]
    df = spark.createDataFrame([(a, b, n) for n, (a, b) in enumerate(rows)], "id_key long, score_key long, _row long").repartition(5)
    got = {r["_row"]: r["rank"] for r in R.radix_ranks(df, 14, 41, block=16).collect()}
    order = sorted(range(700), key=lambda n: (rows[n][1], rows[n][0]))
    keys = [(rows[n][1], rows[n][0]) for n in sorted(got, key=got.get)]
    assert sorted(got.values()) == list(range(1, 701)) and keys == [(rows[n][1], rows[n][0]) for n in order]
    same = spark.range(50).select(F.lit(0).alias("id_key"), F.lit(0).alias("score_key"), F.col("id").alias("_row")).coalesce(1)
    assert [r["rank"] for r in R.radix_ranks(same, 0, 0, block=8).orderBy("_row").collect()] == list(range(1, 51))
