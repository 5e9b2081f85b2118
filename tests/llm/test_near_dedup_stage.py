"""The pipeline's near-dedup stage links at a Jaccard similarity of 0.8, the op6 query at 0.85."""

from itertools import combinations

from stationlake.llm import op6_minhash
from stationlake.llm.common import table

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _left(rows, percent):
    """Smallest doc_id of each class, by all pairs."""
    sets = {}
    for d, t in rows:
        w = (t or "").encode().lower().split()
        sets[d] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    label = {d: d for d in sets}
    for a, b in combinations(sorted(sets), 2):
        n = len(sets[a] & sets[b])
        if n and 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            lo, hi = sorted((label[a], label[b]))
            label = {d: lo if c == hi else c for d, c in label.items()}
    return {d for d, c in label.items() if d == c}


def _stage(spark, docs):
    return {r.doc_id for r in op6_minhash.near_dedup_stage(spark, docs, SF).collect()}


def test_stage_links_at_80(spark):
    base = [f"w{i}" for i in range(40)]  # 36 shingles; other last k words leave (36 - k) / (36 + k)
    rows = [(k, " ".join(base[:40 - k] + [f"x{k}y{j}" for j in range(k)])) for k in (0, 2, 4, 5)]
    docs = spark.createDataFrame([(*r, "en", "s", 0) for r in rows], SCHEMA)
    assert _left(rows, 80) == _stage(spark, docs) == {0, 5}  # 0.89 and 0.8 go, 0.76 stays
    query = op6_minhash.near_duplicates(docs.select("doc_id", "text")).filter("kept").collect()
    assert _left(rows, 85) == {r.doc_id for r in query} == {0, 4, 5}


def test_stage_equals_all_pairs(spark):
    docs = table(spark, SF, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = _left(rows, 80)
    assert _stage(spark, docs) == want and len(want) < len(_left(rows, 85))
