"""Text analysis (D01, D04, D07), edit distance (D05), approximate cardinality."""

import itertools
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stationlake.functions.distance import osa_distance
from stationlake.functions.text import analyze, analyze_positions, analyze_text, ngrams
from stationlake.operators import search, text_search


def _osa_brute(a, b):
    """Reference recursion of optimal string alignment (exponential; tiny words only)."""
    from functools import lru_cache

    @lru_cache(None)
    def d(i, j):
        if i == 0:
            return j
        if j == 0:
            return i
        best = min(d(i - 1, j) + 1, d(i, j - 1) + 1, d(i - 1, j - 1) + (a[i - 1] != b[j - 1]))
        if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
            best = min(best, d(i - 2, j - 2) + 1)
        return best
    return d(len(a), len(b))


@given(st.text("abcz", max_size=6), st.text("abcz", max_size=6))
@settings(max_examples=300, deadline=None)
def test_osa_matches_recursion(a, b):
    assert osa_distance(a, b) == _osa_brute(a, b)


def test_osa_transposition_and_limit():
    assert osa_distance("gizom", "gizmo") == 1
    assert osa_distance("ca", "abc") == 3   # OSA, not unrestricted Damerau
    assert osa_distance("bastile", "bastille") == 1
    assert osa_distance("abcdef", "uvwxyz", limit=2) == 3


def test_analyzer(spark):
    df = spark.createDataFrame([("  Place de la Bastille - 75011 ",), ("Rue d'Aligre",), (None,)], "n string")
    got = [r[0] for r in df.select(analyze("n")).collect()]
    assert got == [["place", "bastille", "75011"], ["rue", "aligre"], None]
    assert analyze_text("  Place de la Bastille - 75011 ") == ["place", "bastille", "75011"]
    pos = df.select(analyze_positions("n")).first()[0]
    assert [(p.pos, p.term) for p in pos] == [(0, "place"), (3, "bastille"), (4, "75011")]


def test_ngrams_no_junk_for_short_tokens(spark):
    df = spark.createDataFrame([(["ab", "tour"],), (["x"],)], "t array<string>")
    got = [sorted(r[0]) for r in df.select(ngrams(F.col("t"))).collect()]
    assert got == [sorted(["tou", "our", "tour"]), []]


def test_phrase_does_not_cross_stop_word(spark):
    df = spark.createDataFrame(
        [("Rue de la Paix", "1", 1), ("Rue Paix Bas", "2", 2), ("Paix Rue", "3", 3)],
        "name string, station_id string, k int").select(
        "name", "station_id", F.timestamp_seconds("k").alias("ts"),
        F.lit(1).alias("num_bikes_available"), F.lit("available").alias("station_status"))
    got = [r.station_id for r in text_search.phrase_prefix(df, "rue pa").collect()]
    assert got == ["2"]
    got = sorted(r.station_id for r in text_search.phrase_prefix(df, "pa").collect())
    assert got == ["1", "2", "3"]


def _named(spark, names):
    rows = [(n, str(i), i) for i, n in enumerate(names, 1)]
    return spark.createDataFrame(rows, "name string, station_id string, k int").select(
        "name", "station_id", F.timestamp_seconds("k").alias("ts"),
        F.lit(1).alias("num_bikes_available"), F.lit("available").alias("station_status"))


def test_phrase_with_stop_words_in_the_query(spark):
    df = _named(spark, ["Place de la Bastille", "Gare du Nord", "Place Bastille", "Place du Bas"])
    found = lambda q: sorted(r.station_id for r in text_search.phrase_prefix(df, q).collect())
    assert found("Place de la Bas") == ["1"]
    assert found("Gare du No") == ["2"]
    assert found("Place Bas") == ["3"]
    assert found("place du bas") == ["4"]


def test_fuzzy_and_edge_searches_have_no_caps(spark):
    names = [f"term{chr(97 + i)}{chr(97 + j)}" for i in range(26) for j in range(26)]
    df = _named(spark, names)
    assert text_search.fuzzy_match(df, "termzz", size=10_000).count() == len(names)
    long = _named(spark, ["anticonstitutionnellement", "x"])
    got = text_search.edge_ngram_match(long, "anticonstitutionnelle").collect()
    assert [r.name for r in got] == ["anticonstitutionnellement"]
    assert [r.name for r in text_search.edge_ngram_match(long, "x").collect()] == ["x"]


def test_hit_fields_and_kept_name_dimension(spark, small_readings):
    names = text_search.name_dimension(small_readings).cache()
    a = text_search.match_terms(small_readings, "gizmo", fields="*", names=names)
    assert a.columns == [*small_readings.columns, "score"]
    b = text_search.match_terms(small_readings, "gizmo")
    assert [r.station_id for r in a.collect()] == [r.station_id for r in b.collect()]


def test_fuzzy_finds_transposition_where_levenshtein_does_not(spark, small_readings):
    terms = [r.term for r in text_search.fuzzy_terms(small_readings, "gizom").collect()]
    assert terms == ["gizmo"]
    lev = small_readings.select(F.levenshtein(F.lit("gizom"), F.lit("gizmo"))).first()[0]
    assert lev == 2


def test_fuzzy_terms_equal_brute_force(spark, small_readings):
    vocab = {t for r in small_readings.select("name").distinct().collect() for t in analyze_text(r.name)}
    for q in ["gizmmo", "blt", "anvl", "rde", "wigdet"]:
        k = text_search.auto_fuzziness(len(q))
        want = sorted((osa_distance(t, q), t) for t in vocab if osa_distance(t, q) <= k)
        got = sorted((r.distance, r.term) for r in text_search.fuzzy_terms(small_readings, q).collect())
        assert got == want, q
        first = [(d, t) for d, t in want if t[:1] == q[:1]][:50]
        asked = text_search.fuzzy_terms(small_readings, q, prefix_length=1, max_expansions=50).collect()
        assert [(r.distance, r.term) for r in asked] == first, q


def test_approx_cardinality_within_error(spark, small_readings):
    exact = search.station_cardinality(small_readings, approx=False).first()[0]
    approx = search.station_cardinality(small_readings, approx=True, rsd=0.05).first()[0]
    assert abs(approx - exact) <= max(1, 0.15 * exact)


def test_ngram_match_contains_exact_match(spark, small_readings):
    """Property: for a query term of at least 3 letters, n-gram hits include all-terms hits."""
    names = [r.name for r in small_readings.select("name").distinct().collect()]
    random.seed(1)
    for q in random.sample(sorted({t for n in names for t in analyze_text(n) if len(t) >= 3}), 4):
        exact = {r.name for r in text_search.match_terms(small_readings, q, size=10_000).collect()}
        gram = {r.name for r in text_search.ngram_match(small_readings, q, size=10_000).collect()}
        assert exact <= gram, q
    assert list(itertools.islice(names, 1))
