"""op5 learns from every labelled row, in blocks whose changes are averaged."""

import numpy as np
from pyspark.sql import functions as F

from stationlake.llm import op5_toxicity as op5
from stationlake.llm.common import table

DOCS = "doc_id long, text string, lang string"


def _last_by_hash(spark, n, first):
    """Ids of 0 to n - 1 beyond the ``first`` smallest hashes: those that a sample of that size leaves out."""
    ids = [r.id for r in spark.range(n).orderBy(F.xxhash64("id"), "id").collect()]
    return set(ids[first:])


def test_a_word_of_rows_beyond_any_sample_is_learnt(spark):
    n, bound = 2900, op5.MAX_PER_CLASS
    late = _last_by_hash(spark, n, bound)
    toxic = [(i, "some zork here" if i in late else "some idiot here", "fr" if i in late else "en") for i in range(n)]
    clean = [(n + i, f"some good word{i % 7} here", "en") for i in range(600)]
    docs = spark.createDataFrame(toxic + clean, DOCS)
    labels = spark.createDataFrame([(i, int(i < n)) for i in range(n + 600)], "doc_id long, toxic int")
    m = op5.fit(docs, labels, F.lit(True))
    scores = op5.Scorer(m).score([b"a zork there", b"some idiot here", b"some good word3 here"])
    assert scores[0] > 0.9 and scores[1] > 0.9 and scores[2] < 0.3
    assert set(m.thresholds) == {"en", "fr"}  # fr has none but late rows


def test_model_does_not_depend_on_how_rows_are_cut(spark, monkeypatch):
    monkeypatch.setattr(op5, "BLOCK_ROWS", 60)
    monkeypatch.setattr(op5, "BLOCK_BYTES", 1500)
    rows = [(i, ("you idiot scum " if i % 4 == 0 else "fine good day ") + f"w{i % 9} " * (i % 5), "en") for i in range(400)]
    rows += [(7, "x", "en")] * 20 + [(401, None, None), (402, "", "de")]  # one id many times, no text
    labels = [(i, int(i % 4 == 0)) for i in range(403)] + [(3, None), (None, 1), (5, 7)]
    models = []
    for parts in (1, 6):
        docs = spark.createDataFrame(rows, DOCS).repartition(parts)
        models.append(op5.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int").repartition(parts), F.lit(True)))
    a, b = (vars(m) for m in models)
    assert all(np.array_equal(x, y) for k in ("filters", "bias") for x, y in zip(a[k], b[k]))
    assert np.array_equal(a["table"], b["table"]) and np.array_equal(a["out"], b["out"])
    assert (a["slope"], a["shift"], a["thresholds"]) == (b["slope"], b["shift"], b["thresholds"])
    s = op5.Scorer(models[0]).score([b"you idiot scum", b"fine good day"])
    assert s[0] > 0.7 > 0.3 > s[1]


def test_every_row_is_in_one_block(spark, monkeypatch):
    monkeypatch.setattr(op5, "BLOCK_BYTES", 64)
    rows = spark.createDataFrame([(i, "é" * (i % 40) if i % 3 else None, "en" if i % 2 else None) for i in range(300)], DOCS)
    blocks = op5.blocks_of(rows.withColumn("toxic", F.lit(0)).withColumn("held", F.col("doc_id") % 5 == 0), 3)
    found = [t for batch in [blocks.toArrow().to_batches()] for _, _, _, _, texts in op5.read_blocks(iter(batch), None) for t in texts]
    assert sorted(found) == sorted((r.text or "").encode() for r in rows.collect())
    out = [t for _, _, _, _, texts in op5.read_blocks(iter(blocks.toArrow().to_batches()), True) for t in texts]
    assert sorted(out) == sorted((r.text or "").encode() for r in rows.filter("doc_id % 5 = 0").collect())


def test_whole_table_counts_in_the_calibration(spark):
    rng = np.random.default_rng(3)
    y = np.repeat([0, 1], [40, 30])
    logits, k, langs = rng.normal(y * 2.0 - 1, 1.0), rng.integers(1, 9, 70), ["en", "fr"] * 35
    grouped, single = op5.Model(), op5.Model()
    op5._calibrate(grouped, logits, y, langs, k, k)
    op5._calibrate(single, np.repeat(logits, k), np.repeat(y, k), list(np.repeat(langs, k)), np.ones(k.sum()))
    assert np.allclose(grouped.score(logits), single.score(logits))
    assert grouped.thresholds == single.thresholds


def test_long_text_in_chunks_gives_the_same_gradient(monkeypatch):
    texts, y = [b"good day to all of you", b"you idiot scum " * 20, b"", b"fine words here"] * 3, np.array([0, 1, 0, 0] * 3)
    whole = op5.train(texts, y)
    monkeypatch.setattr(op5, "CHUNK", 4)
    assert np.allclose(whole.table, op5.train(texts, y).table, atol=1e-5)


def test_averaged_blocks_are_as_good_as_one(spark, monkeypatch):
    sf = "/root/testdata/sf0.01"
    docs, labels, own = table(spark, sf, "documents"), table(spark, sf, "labels"), op5.trainable_rows()
    rest = labels.filter(F.col("toxic").isNotNull() & ~own).join(docs, "doc_id").select("text", "toxic").collect()
    y, texts = np.array([r.toxic for r in rest]), [(r.text or "").encode() for r in rest]
    for block in (2048, 90):
        monkeypatch.setattr(op5, "BLOCK_ROWS", block)
        s = op5.Scorer(op5.fit(docs, labels, own)).score(texts)
        assert (s[y == 1][:, None] > s[y == 0][None, :]).mean() > 0.9
