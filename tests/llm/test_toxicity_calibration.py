"""Scores and thresholds of op5 mean the same whether or not the sample's bound cuts a class."""

import numpy as np
from pyspark.sql import functions as F

from stationlake.llm import op5_toxicity
from stationlake.llm.common import table

SF = "/root/testdata/sf0.1"


def test_a_row_of_weight_five_counts_like_five_rows():
    rng = np.random.default_rng(3)
    y = np.repeat([0, 1], [400, 300])
    logits = rng.normal(np.where(y == 1, 1.5, -1.0), 1.0)
    five = np.where(y == 1, 1, 5)
    sample, table_ = op5_toxicity.Model(), op5_toxicity.Model()
    op5_toxicity._calibrate(sample, logits, y, ["en"] * len(y), five)
    op5_toxicity._calibrate(table_, np.repeat(logits, five), np.repeat(y, five), ["en"] * five.sum(), np.ones(five.sum()))
    assert np.allclose(sample.score(logits), table_.score(logits), atol=0.03)  # the smoothing knows of fewer rows; without weights 0.3
    assert abs(sample.thresholds["en"] - table_.thresholds["en"]) < 0.03
    assert abs((five * sample.score(logits)).sum() / five.sum() - 300 / 2300) < 0.01


def test_small_sample_keeps_the_share_of_toxic_labels(spark):
    docs, labels, trainable = table(spark, SF, "documents"), table(spark, SF, "labels"), op5_toxicity.trainable_rows()
    rows = labels.filter(F.col("toxic").isNotNull() & ~trainable).join(docs, "doc_id").select("text", "toxic").collect()
    y, texts = np.array([r.toxic for r in rows]), [(r.text or "").encode() for r in rows]
    mean, wrong = {}, {}
    for n in (2500, 250):  # 2,331 clean and 305 toxic labels: the second cuts both classes to the same size
        scorer = op5_toxicity.Scorer(op5_toxicity.fit(docs, labels, trainable, n))
        s = np.concatenate([scorer.score(texts[i:i + 64]) for i in range(0, len(texts), 64)])
        mean[n], wrong[n] = s.mean(), ((s >= 0.7) & (y == 0)).sum()
    assert abs(mean[2500] - y.mean()) < 0.02
    assert abs(mean[250] - mean[2500]) < 0.08  # without weights 0.19
    assert wrong[250] <= wrong[2500] + 2  # without weights 6 more


def test_one_class_beyond_the_bound(spark):
    labels = spark.createDataFrame([(i, 0) for i in range(40)], "doc_id long, toxic int")
    docs = spark.createDataFrame([(i, "x", "en") for i in range(40)], "doc_id long, text string, lang string")
    scores = [op5_toxicity.Scorer(op5_toxicity.fit(docs, labels, F.lit(True), n)).score([b"x"])[0] for n in (100, 5)]
    assert np.allclose(scores, 1 / 42)


def test_every_language_has_a_threshold_at_small_scale(spark):
    m = op5_toxicity.fit(table(spark, SF, "documents"), table(spark, SF, "labels"), op5_toxicity.trainable_rows())
    assert set(m.thresholds) >= {"de", "en", "es", "fr"}
    assert 0.3 <= min(m.thresholds.values()) <= m.threshold <= max(m.thresholds.values()) <= 0.9


def test_few_toxic_rows_move_a_threshold_a_little():
    rng = np.random.default_rng(5)
    y = np.repeat([0, 1, 0, 1], [300, 300, 20, 2])
    langs = ["en"] * 600 + ["fr"] * 22
    logits = np.concatenate([rng.normal(np.where(y[:600] == 1, 2.0, -2.0), 1.0), np.full(20, 3.0), np.full(2, 4.0)])
    m = op5_toxicity.Model()
    op5_toxicity._calibrate(m, logits, y, langs, np.ones(len(y)))
    own = op5_toxicity.Model()
    op5_toxicity._calibrate(own, np.tile(logits, 50), np.tile(y, 50), langs * 50, np.ones(50 * len(y)))
    assert m.threshold < m.thresholds["fr"] < own.thresholds["fr"]
    assert m.thresholds["fr"] - m.threshold < 0.1 * 0.6


def test_sample_is_bounded_in_bytes_and_rows_of_one_id(spark):
    docs = spark.createDataFrame([(i, "ab " * 100, "en") for i in range(40)] + [(3, "x", "en")] * 50 + [(99, "y" * 9000, "en")],
                                 "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id long, toxic int")
    sample, in_table = op5_toxicity.labelled_sample(docs, labels, F.lit(True))
    assert in_table == {0: 50, 1: 50}
    assert len(op5_toxicity.collected(sample)) == 41  # one row per doc_id
    assert {r.doc_id for r in op5_toxicity.collected(sample, 20_000)} == set(range(40))  # the long text goes first
    assert 1 <= len(op5_toxicity.collected(sample, 6_000)) <= 21


def test_gradient_equals_finite_differences():
    rng = np.random.default_rng(1)
    f8 = lambda *shape: rng.normal(0, 0.5, shape)
    m = op5_toxicity.Model(filters=[f8(w, op5_toxicity.DIM, op5_toxicity.FILTERS) for w in op5_toxicity.WIDTHS],
                           bias=[f8(op5_toxicity.FILTERS) for _ in op5_toxicity.WIDTHS],
                           out=f8(len(op5_toxicity.WIDTHS) * op5_toxicity.FILTERS), out_bias=0.3)
    n, weight = 6, 1.7
    x = np.zeros((n + 3, op5_toxicity.DIM))
    x[1:-2] = f8(n, op5_toxicity.DIM)

    def loss(y):
        top = [(sum(x[j:len(x) - 2 + j] @ f[j] for j in range(len(f))) + b).max(axis=0) for f, b in zip(m.filters, m.bias)]
        z = np.maximum(np.concatenate(top), 0) @ m.out + m.out_bias
        return weight * (np.logaddexp(0, z) - y * z)

    for y in (0, 1):
        g_f, g_b, g_out, g_ob, of_words = op5_toxicity.text_gradient(m, x, n, y, weight)
        g_x = np.zeros_like(x)
        for place, g in of_words:
            np.add.at(g_x, place + 1, g)
        for values, grads in [*zip(m.filters, g_f), *zip(m.bias, g_b), (m.out, g_out), (x[1:-2], g_x[1:-2])]:
            for at in np.ndindex(values.shape):
                kept, step = values[at], 1e-6
                values[at] = kept + step
                up = loss(y)
                values[at] = kept - step
                slope = (up - loss(y)) / (2 * step)
                values[at] = kept
                assert abs(slope - grads[at]) < 1e-5
        m.out_bias += 1e-6
        up = loss(y)
        m.out_bias -= 2e-6
        assert abs((up - loss(y)) / 2e-6 - g_ob) < 1e-5
        m.out_bias += 1e-6
