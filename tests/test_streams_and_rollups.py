"""As-of join with versioned info, the progress log, the hourly rollup, the completion table."""

import datetime as dt
import json
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stationlake.operators import asof, panels
from stationlake.operators import text_search as TS
from stationlake.plans import rollup as R
from stationlake.sources.feeds import read_info_versions
from stationlake.sources.store import read_store
from stationlake.streaming import ingest, monitor


def _t(hour: float) -> dt.datetime:
    return dt.datetime(2024, 3, 1) + dt.timedelta(hours=hour)


def _rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


# ---- as-of join ------------------------------------------------------------------------
def test_versions_are_intervals_of_equal_values(spark):
    rows = [("a", _t(0), 10), ("a", _t(5), 10), ("a", _t(9), 12), ("a", _t(9), 11), ("a", _t(30), 10), ("b", _t(1), None), ("b", _t(2), None),
            ("b", _t(3), 4), (None, _t(1), 1), ("c", None, 1)]
    df = spark.createDataFrame(rows, "k string, seen timestamp, v long").repartition(4)
    got = {tuple(r) for r in asof.versions(df, "k", "seen").collect()}
    assert got == {("a", 10, _t(0), _t(9)), ("a", 12, _t(9), _t(30)), ("a", 10, _t(30), None), ("b", None, _t(1), _t(3)), ("b", 4, _t(3), None)}


@pytest.mark.parametrize("before_first", ["none", "first"])
@pytest.mark.parametrize("broadcast", ["-1", "10m"])
def test_asof_join_equals_brute_force(spark, before_first, broadcast):
    """A hot key with a third of all rows, times on the borders, keys without versions, joins by shuffle and by broadcast."""
    import random

    rng = random.Random(2)
    seen = [(k, _t(rng.randrange(200) / 2), rng.randrange(3)) for k in "abcde" for _ in range(12)]
    rows = [(rng.choice("aaabcdefgh"), _t(rng.randrange(-20, 300) / 2), n) for n in range(600)] + [(None, _t(1), 600), ("a", None, 601)]
    df = spark.createDataFrame(rows, "k string, at timestamp, n long").repartition(5)
    own = asof.versions(spark.createDataFrame(seen, "k string, seen timestamp, v long"), "k", "seen")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        got = {r.n: (r.k, r.at, r.v) for r in asof.asof_join(df, own, "k", "at", before_first).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = {}
    for k, at, n in rows:
        known = sorted((t, v) for key, t, v in seen if key == k)
        past = [x for x in known if at is not None and x[0] <= at]
        v = past[-1][1] if past else known[0][1] if known and at is not None and before_first == "first" else None
        if known and not past and before_first == "first" and at is not None:  # of rows at the first time the greatest value counts
            v = max(v for t, v in known if t == known[0][0])
        want[n] = (k, at, v)
    assert len(got) == len(rows) and got == want
    assert asof.asof_join(df.limit(0), own, "k", "at").count() == 0
    assert asof.asof_join(df, own.limit(0), "k", "at").filter("v IS NULL").count() == len(rows)


def test_a_change_of_capacity_during_the_stream(spark, scratch):
    """Only readings after the change have the new capacity; the stream isn't restarted."""
    def put(folder, name, at, stations):
        os.makedirs(f"{scratch}/{folder}", exist_ok=True)
        with open(f"{scratch}/{folder}/.{name}", "w") as f:
            json.dump({"last_updated": at, "data": {"stations": stations}}, f)
        os.rename(f"{scratch}/{folder}/.{name}", f"{scratch}/{folder}/{name}")

    def station(capacity):
        return {"station_id": "1", "name": "One", "lat": 1.0, "lon": 2.0, "capacity": capacity}

    def status(n):
        return {"station_id": "1", "num_bikes_available": n, "num_docks_available": 1, "is_installed": 1, "is_renting": 1, "is_returning": 1,
                "last_reported": 1_700_000_000, "num_bikes_available_types": []}

    put("info", "a.json", 1_700_000_000, [station(10)])
    put("status", "s1.json", 1_700_000_100, [status(5)])
    q = ingest.snapshots_to_store(spark, f"{scratch}/status", lambda: read_info_versions(spark, f"{scratch}/info"), f"{scratch}/store",
                                  f"{scratch}/bad", f"{scratch}/cp", "1 second")
    try:
        q.processAllAvailable()
        put("info", "b.json", 1_700_003_600, [station(20)])
        put("status", "s2.json", 1_700_003_700, [status(5), {**status(1), "station_id": "9"}])
        q.processAllAvailable()
        put("status", "s3.json", 1_700_003_500, [status(5)])  # a late snapshot
        q.processAllAvailable()
    finally:
        q.stop()
    got = read_store(spark, f"{scratch}/store").select("station_id", F.unix_seconds("ts"), "capacity", "occupation_rate", "name").collect()
    assert sorted(map(tuple, got)) == [("1", 1_700_000_100, 10, 50.0, "One"), ("1", 1_700_003_500, 10, 50.0, "One"),
                                       ("1", 1_700_003_700, 20, 25.0, "One"), ("9", 1_700_003_700, 0, 0.0, "Unknown")]


# ---- progress log ------------------------------------------------------------------------
def test_counters_of_all_streams_are_kept(spark, scratch):
    os.makedirs(f"{scratch}/in")
    for k in range(3):
        with open(f"{scratch}/in/{k}.txt", "w") as f:
            f.write("\n".join([json.dumps({"station_id": str(i), "collected_at": "2024-01-01T10:00:00Z", "capacity": 10,
                                           "num_bikes_available": 5, "num_docks_available": 5}) for i in range(4)] + ["{cut"] * k) + "\n")
    log = monitor.ProgressLog(spark, f"{scratch}/log").start()
    try:
        raw = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(f"{scratch}/in")
        for _ in range(2):  # the second run finds nothing new
            enriched, _ = ingest.enrich_stream(ingest.observe_quality(ingest.kafka.parse_messages(raw)))
            ingest.write_days(ingest.observe_cycle(enriched), f"{scratch}/store", f"{scratch}/cp", "availableNow").awaitTermination()
    finally:
        log.stop()
    rows = monitor.delivery_log(spark, f"{scratch}/log")
    assert rows.count() == 3 and rows.agg(F.sum("cycle.total_bikes")).first()[0] == 60
    r = monitor.delivery_counters(rows).first()
    assert (r.batches, r.ok, r.bad, r.bad_percent) == (3, 12, 3, 20.0)


# ---- rollup ------------------------------------------------------------------------------
def test_rollup_equals_the_panels(spark, scratch, small_readings):
    path = f"{scratch}/rollup"
    for k in (2, 0, 1, 2):  # out of order, one again
        R.write_rollup(small_readings.filter(F.pmod(F.xxhash64("station_id", "ts"), F.lit(3)) == k), path, f"b{k}")
    kept = R.read_rollup(spark, path)
    for rollup in (kept, R.merged(kept)):
        assert _rows(R.hourly_line(rollup)) == _rows(panels.hourly_line(small_readings))
        assert _rows(R.overall_occupancy(rollup)) == _rows(panels.overall_occupancy(small_readings))
        assert _rows(R.occupancy_heatmap(rollup)) == _rows(panels.occupancy_heatmap(small_readings))
    hours = small_readings.select(F.date_trunc("hour", "ts"), "station_id").distinct().count()
    assert R.merged(kept).count() == hours <= kept.count() <= 3 * hours


def test_rollup_from_a_stream_and_folded(spark, scratch, small_readings):
    small_readings.repartition(3).write.parquet(f"{scratch}/in")
    stream = spark.readStream.schema(small_readings.schema).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/in")
    for _ in range(2):
        R.rollup_stream(stream, f"{scratch}/rollup", f"{scratch}/cp", "availableNow").awaitTermination()
    kept = R.read_rollup(spark, f"{scratch}/rollup")
    R.fold(spark, f"{scratch}/rollup", f"{scratch}/folded")
    folded = R.read_rollup(spark, f"{scratch}/folded")
    assert _rows(R.hourly_histogram(folded)) == _rows(R.hourly_histogram(kept)) and folded.count() <= kept.count()
    assert _rows(R.hourly_line(folded)) == _rows(panels.hourly_line(small_readings))
    last = small_readings.agg(F.max("dt")).first()[0]
    old = folded.filter(F.col("dt") < last)
    assert old.count() == old.select(*R.KEYS).distinct().count()
    watermark = spark.range(1).select(R.final_hours(kept).alias("w")).first().w
    newest = small_readings.agg(F.date_trunc("hour", F.max("ts"))).first()[0]
    assert watermark == newest - dt.timedelta(hours=2)


def test_late_readings_correct_their_hours(spark, scratch, small_readings):
    """Shuffled input in many micro-batches and a restart; readings beyond the horizon stay out."""
    cols = ["ts", "num_bikes_available", "occupation_rate", "station_id"]
    small_readings.select(*cols).repartition(5, "station_id").write.parquet(f"{scratch}/in")
    schema = spark.read.parquet(f"{scratch}/in").schema

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/in")
        ingest.hours_to_table(stream, f"{scratch}/hours", "60 days", f"{scratch}/cp", "availableNow").awaitTermination()
        return _rows(ingest.read_hours(spark, f"{scratch}/hours").select("bucket", "doc_count", "avg_bikes"))

    want = panels.hourly_line(small_readings).select("bucket", "doc_count", "avg_bikes")
    assert run() == _rows(want)
    late = small_readings.limit(7).select(*cols)
    late.write.mode("append").parquet(f"{scratch}/in")
    small_readings.limit(1).withColumn("ts", F.lit("2020-01-01").cast("timestamp")).select(*cols).write.mode("append").parquet(f"{scratch}/in")
    assert run() == _rows(panels.hourly_line(small_readings.select(*cols).union(late)).select("bucket", "doc_count", "avg_bikes"))


def test_state_of_the_hours_keeps_its_partitions(spark, scratch, small_readings):
    """Each partition of the state runs in a task of its own; only the hours that come out are written by one."""
    small_readings.select("ts", "num_bikes_available", "occupation_rate").write.parquet(f"{scratch}/in")
    schema, before = spark.read.parquet(f"{scratch}/in").schema, spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        query = ingest.hours_to_table(spark.readStream.schema(schema).parquet(f"{scratch}/in"), f"{scratch}/hours", "60 days",
                                      f"{scratch}/cp", "availableNow")
        query.awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(str(query.runId)) for s in tracker.getJobInfo(j).stageIds]
    assert 7 in [s.numTasks for s in stages]
    assert all(len([f for f in os.listdir(f"{scratch}/hours/{d}") if f.endswith(".parquet")]) == 1
               for d in os.listdir(f"{scratch}/hours") if d.startswith(ingest.HOURS_BATCH))
    assert _rows(ingest.read_hours(spark, f"{scratch}/hours").select("bucket", "doc_count")) == \
        _rows(panels.hourly_line(small_readings).select("bucket", "doc_count"))


# ---- completions ---------------------------------------------------------------------------
def test_completions_equal_the_plain_searches(spark, scratch, small_readings):
    names = TS.name_dimension(small_readings).cache()
    TS.write_completions(names, f"{scratch}/c")
    kept = spark.read.parquet(f"{scratch}/c")
    for prefix in ("Sm", "s", "", "large g", "zzz", "SMALL GADGET"):
        assert _rows(TS.autocomplete(small_readings, prefix, 50, completions=kept)) == _rows(TS.autocomplete(small_readings, prefix, 50, names))
    for query in ("gi wid", "g", "750", "gadget gadget", "nothing", "la"):
        a = TS.edge_ngram_match(small_readings, query, 40, completions=kept).collect()
        assert a == TS.edge_ngram_match(small_readings, query, 40, names=names).collect()
    found = TS.autocomplete(small_readings, "Sm", 10, completions=kept)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(key,sm)" in plan and "LessThan(key,sn)" in plan
    assert all("/c/" in f for f in found.inputFiles())


@settings(max_examples=30, deadline=None)
@given(st.text(max_size=3), st.lists(st.text(max_size=4), max_size=8))
def test_a_prefix_is_a_range_of_keys(spark, prefix, keys):
    rows = [(k,) for k in {*keys, prefix, prefix + "a", prefix + chr(0x10FFFF)}]
    try:
        df = spark.createDataFrame(rows, "key string")
        got = {r.key for r in df.filter(TS.starts_in_range("key", prefix)).collect()}
    except UnicodeEncodeError:  # lone halves of a pair aren't text
        return
    assert got == {k for k, in rows if k.startswith(prefix)}
