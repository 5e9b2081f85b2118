"""The corpus pipeline against its stages worked out by brute force, and the SQL forms."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F
from test_llm_operators import SF, _classes, _kept

import corpus_pipeline
from stationlake.llm import op3_sentencepiece, op4_decontaminate, op5_toxicity, op6_minhash
from stationlake.llm.common import DOCUMENT_COLUMNS, table
from stationlake.llm.oracle import SQL
from stationlake.llm.registry import QUERIES


def _toxic(spark, docs):
    """doc_ids at or above the threshold of their language, scored one text at a time."""
    model = op5_toxicity.fit(table(spark, SF, "documents"), table(spark, SF, "labels"), op5_toxicity.trainable_rows())
    s = op5_toxicity.Scorer(model)
    return {r.doc_id for r in docs
            if s.score([(r.text or "").encode()])[0] >= model.thresholds.get(r.lang, model.threshold)}


def _leaky(spark, rows):
    items = [op4_decontaminate.question_and_answer(r.text.encode()) for r in table(spark, SF, "benchmark").collect()]
    out = set()
    for d, t in rows:
        w = op4_decontaminate.words(t.encode())
        grams, joined = op4_decontaminate.shingles(w), b" " + b" ".join(w) + b" "
        if any(min(op4_decontaminate.Index._held(p, grams, joined) for p in parts) >= 0.8 for parts in items):
            out.add(d)
    return out


def test_pipeline_equals_its_stages_by_brute_force(spark):
    docs = table(spark, SF, "documents").collect()
    gone = _toxic(spark, docs)
    rows = [(i, t) for i, _, _, t in _kept([(r.doc_id, r.text) for r in docs if r.doc_id not in gone])]
    classes, _ = _classes(rows, op6_minhash.STAGE_PERCENT)
    rows = [(i, t) for i, t in rows if classes[i] == i]
    leaky = _leaky(spark, rows)
    want = {i: t for i, t in rows if i not in leaky}
    got = corpus_pipeline.run(spark, SF)
    e = op3_sentencepiece.Encoder(op3_sentencepiece.load_model())
    assert {r.doc_id: e.decode(r.ids).decode() for r in got.collect()} == want
    assert leaky and len(want) < len(rows) < len(docs)


def test_stages_keep_the_columns_and_take_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "s", 0), (None, "a b c", "xx", "s", 5),
                                  (3, "same words here for two", "en", "s", 1), (4, "same words here for two", "en", "s", 1)], schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == DOCUMENT_COLUMNS and [t for _, t in out.dtypes] == [t for _, t in docs.dtypes]
        left = sorted(r.doc_id or 0 for r in out.collect())
        assert left == ([0, 1, 2, 3] if name == "near_dedup" else [0, 1, 2, 3, 4]), name
        assert stage(spark, docs.limit(0), SF).count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.filter("round_trip").count() == 5


@pytest.mark.parametrize("name", sorted(SQL))
def test_operator_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t + '.parquet')}')")
    res = con.execute(SQL[name])
    cols = [d[0] for d in res.description]
    got = QUERIES[name](spark, SF).select(*[F.col(c) for c in cols])
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, res.fetchall()))
