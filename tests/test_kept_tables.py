"""Deletion neighbourhood, sketches and the table of latest readings against their plain forms."""

import glob
import itertools
import math
import os

import pytest
from pyspark.sql import functions as F

from stationlake.functions import distance as D
from stationlake.operators import panels
from stationlake.operators import predicates as P
from stationlake.operators import text_search as TS
from stationlake.plans import sketches as SK
from stationlake.streaming import state as S


# ---- D05 -----------------------------------------------------------------------------------
def test_distance_column_equals_the_plain_form(spark):
    words = ["", "a", "ab", "ba", "abc", "ca", "gizmo", "gizom", "bastille", "bastlile", "été", "tee", "😀x", "x😀", "aaaa", "abab"]
    pairs = list(itertools.product(words, words))
    df = spark.createDataFrame([*pairs, (None, "a"), ("a", None)], "a string, b string")
    got = df.select("a", "b", D.osa(F.col("a"), F.col("b")).alias("d")).collect()
    assert [(r.a, r.b, r.d) for r in got] == [*((a, b, D.osa_distance(a, b)) for a, b in pairs), (None, "a", None), ("a", None, None)]


def test_deletions_equal_the_plain_form(spark):
    words = ["", "a", "aa", "abc", "gizmo", "😀é", "abcdefgh"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    for k in (0, 1, 2, 3):
        assert [sorted(r[0]) for r in df.select(D.deletions(F.col("w"), k)).collect()] == [D.deletions_text(w, k) for w in words]


def test_all_near_words_share_a_deletion():
    words = ["".join(w) for n in range(5) for w in itertools.product("abc", repeat=n)]
    near = {w: set(D.deletions_text(w, 2)) for w in words}
    for a, b in itertools.combinations(words, 2):
        if D.osa_distance(a, b) <= 2:
            assert near[a] & near[b], (a, b)


def test_fuzzy_search_runs_no_python(spark, small_readings):
    names = TS.name_dimension(small_readings)
    vocab = [r[0] for r in names.select(F.explode("toks")).distinct().collect()]
    index = TS.deletion_index(names)
    for word in ("gizom", "Gizmmo", "widgt", "gear", "zz", "gadgte", "smll"):
        k = TS.auto_fuzziness(len(word))
        want = sorted((D.osa_distance(t, word.lower()), t) for t in vocab if D.osa_distance(t, word.lower()) <= k)
        for kept in (None, index):
            found = TS.fuzzy_terms(small_readings, word, index=kept)
            assert sorted((r.distance, r.term) for r in found.collect()) == want
            plan = found._jdf.queryExecution().executedPlan().toString()
            assert "Python" not in plan and "Arrow" not in plan
    far = TS.fuzzy_terms(small_readings, "gadgte", fuzziness=4, index=index)
    assert sorted(r.term for r in far.collect()) == sorted(t for t in vocab if D.osa_distance(t, "gadgte") <= 4)


# ---- E15, E12 ------------------------------------------------------------------------------
def test_sketches_answer_any_range(spark, scratch, small_readings):
    df = small_readings
    path = f"{scratch}/sketches"
    for k in range(3):
        own = df.filter(F.pmod(F.xxhash64("station_id", "ts"), F.lit(3)) == k)
        SK.write_sketches(own, path, f"b{k}")
        SK.write_sketches(own, path, f"b{k}")  # a retry
    kept = SK.read_sketches(spark, path)
    assert kept.agg(F.sum("n")).first()[0] == df.count()
    error = 3 * 1.04 / math.sqrt(1 << SK.LG_K)
    for since, at in (("30d", "2024-01-30T12:34:56.789Z"), ("7d", "2024-01-20T00:00:00Z"), ("40m", "2024-01-11T10:50:00Z"),
                      ("90m", "2024-01-11T10:10:00Z"), ("1h", "2024-01-11T11:00:00Z"), ("7d", "2023-01-01T00:00:00Z")):
        now = F.lit(at).cast("timestamp")
        exact = df.filter(P.time_range(since, now)).select("station_id").distinct().count()
        got = SK.cardinality(kept, since, now, df).first().total_stations
        assert abs(got - exact) <= math.ceil(error * exact), (since, at)
    days = SK.cardinality(kept, "30d", F.lit("2024-01-31T00:00:00Z").cast("timestamp"))
    files = {f.split("/sketches/")[0] for f in days.inputFiles()}
    assert len(files) == 1 and all("/sketches/" in f for f in days.inputFiles())  # reads sketch rows only
    exact = df.filter("dt >= '2024-01-01' AND dt < '2024-01-31'").select("station_id").distinct().count()
    assert abs(days.first().total_stations - exact) <= math.ceil(error * exact)


def test_hourly_stations_from_sketches(spark, scratch, small_readings):
    SK.write_sketches(small_readings, f"{scratch}/s", "b")
    got = {r.bucket: (r.doc_count, r.total_stations) for r in SK.hourly_stations(SK.read_sketches(spark, f"{scratch}/s")).collect()}
    want = {r.bucket: (r.n, r.d) for r in small_readings.groupBy(F.date_trunc("hour", "ts").alias("bucket")).agg(
        F.count("*").alias("n"), F.count_distinct("station_id").alias("d")).collect()}
    assert got == want  # an hour holds few stations: counted exactly


# ---- G01, E22 ------------------------------------------------------------------------------
def _rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


@pytest.fixture()
def parts(small_readings):
    keyed = small_readings.withColumn("_k", F.pmod(F.xxhash64("station_id", "ts"), F.lit(4))).cache()
    return [keyed.filter(F.col("_k") == k).drop("_k") for k in range(4)]


def test_latest_table_equals_the_batch_form(spark, scratch, small_readings, parts):
    path = f"{scratch}/latest"
    with pytest.raises(FileNotFoundError):
        S.read_latest(spark, path)
    assert S.upsert_latest(small_readings.limit(0), path) == 0
    for k in (3, 1, 1, 0, 2, 3):  # late and repeated batches
        S.upsert_latest(parts[k], path, 8)
    assert _rows(S.read_latest(spark, path)) == _rows(panels.latest_per_station(small_readings))
    assert _rows(panels.key_figures(S.read_latest(spark, path))) == _rows(panels.key_figures(panels.latest_per_station(small_readings)))
    assert S.upsert_latest(small_readings.limit(0), path) == 6 and len(S._versions(path)) == S.KEEP


def test_a_batch_touches_its_buckets_only(spark, scratch, small_readings):
    path = f"{scratch}/latest"
    S.upsert_latest(small_readings, path, 8)
    before = S.manifest(path)["buckets"]
    one = small_readings.filter(F.col("station_id") == small_readings.first().station_id)
    S.upsert_latest(one, path, 99)  # the number of buckets stays
    after = S.manifest(path)["buckets"]
    assert len(before) == len(after) <= 8 and sum(before[b] != after[b] for b in before) == 1
    assert _rows(S.read_latest(spark, path)) == _rows(S.read_latest(spark, path, 1)) == _rows(panels.latest_per_station(small_readings))


def test_a_writer_that_dies_before_its_manifest_changes_nothing(spark, scratch, parts, monkeypatch):
    path = f"{scratch}/latest"
    S.upsert_latest(parts[0], path, 4)
    want = _rows(S.read_latest(spark, path))
    with monkeypatch.context() as m:
        m.setattr(S, "_commit", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            S.upsert_latest(parts[1], path, 4)
    assert _rows(S.read_latest(spark, path)) == want
    S.upsert_latest(parts[1], path, 4)
    assert _rows(S.read_latest(spark, path)) == _rows(panels.latest_per_station(parts[0].union(parts[1])))
    S.upsert_latest(parts[1], path, 4)
    assert len(glob.glob(f"{path}/v*")) == S.KEEP  # what it left behind is gone


def test_latest_table_from_a_stream_with_a_restart(spark, scratch, small_readings, parts):
    source, path = f"{scratch}/in", f"{scratch}/latest"
    for k in (2, 0):
        parts[k].write.mode("append").parquet(source)
    stream = spark.readStream.schema(small_readings.schema).option("maxFilesPerTrigger", 2).parquet(source)
    S.latest_to_table(stream, path, f"{scratch}/cp", "availableNow", buckets=4).awaitTermination()
    assert _rows(S.read_latest(spark, path)) == _rows(panels.latest_per_station(parts[0].union(parts[2])))
    for k in (3, 1, 2):  # a restart with more, some of it again
        parts[k].write.mode("append").parquet(source)
    S.latest_to_table(stream, path, f"{scratch}/cp", "availableNow", buckets=4).awaitTermination()
    assert _rows(S.read_latest(spark, path)) == _rows(panels.latest_per_station(small_readings))
    assert os.path.isdir(f"{scratch}/cp/commits")
