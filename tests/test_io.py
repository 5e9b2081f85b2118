"""Sources and sinks: feed snapshots (A01, A15, B02), topic parse/encode (A02, A03),
day store (A04-A06, A13, A14), CSV/JSON sinks (A08, A09), the batch job."""

import datetime as dt
import glob
import json
import os

from pyspark.sql import functions as F

from stationlake.operators.enrich import enrich, to_reading
from stationlake.operators.join import join_status_info
from stationlake.sources import kafka
from stationlake.sources.feeds import corrupt_snapshots, read_info, read_snapshots, read_status, status_rows
from stationlake.sources.sinks import write_csv
from stationlake.sources.store import (day_counts, distinct_readings, drop_expired, expired_days, preview,
                                       read_store, retain, write_store)

STATUS = {"last_updated": 1706365800, "data": {"stations": [
    {"station_id": "1", "last_reported": 1706365790, "num_bikes_available": 15,
     "num_bikes_available_types": [{"mechanical": 10}, {"ebike": 5}], "num_docks_available": 25,
     "is_installed": 1, "is_returning": True, "is_renting": " Yes "},
    {"station_id": "2", "num_docks_available": 3, "is_installed": "2", "is_returning": 2, "is_renting": None},
    {"station_id": "3", "num_bikes_available": 0, "num_docks_available": 0, "is_installed": 1,
     "is_returning": 1, "is_renting": 1},
]}}
INFO = {"last_updated": 1, "data": {"stations": [
    {"station_id": "1", "name": "Rue 12 - 75011", "lat": 48.85, "lon": 2.35, "capacity": 40},
    {"station_id": "2", "name": "Old", "lat": 1.0, "lon": 1.0, "capacity": 5},
    {"station_id": "2", "name": "Quai 12", "lat": 48.86, "lon": 2.36, "capacity": 10},
]}}


def _dump(folder, name, doc):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        json.dump(doc, f)


def test_snapshot_feeds_and_cap(spark, scratch):
    _dump(f"{scratch}/status", "s1.json", STATUS)
    _dump(f"{scratch}/info", "i1.json", INFO)
    status = read_status(spark, f"{scratch}/status")
    assert status.count() == 3
    assert [r.station_id for r in read_status(spark, f"{scratch}/status", max_stations=2).collect()] == ["1", "2"]
    info = {r.station_id: r.name for r in read_info(spark, f"{scratch}/info").collect()}
    assert info == {"1": "Rue 12 - 75011", "2": "Quai 12"}  # repeated id: the later entry
    rows = {r.station_id: r for r in
            enrich(to_reading(join_status_info(status, read_info(spark, f"{scratch}/info")))).collect()}
    one, two, three = rows["1"], rows["2"], rows["3"]
    assert (one.is_installed, one.is_returning, one.is_renting) == (True, True, True)
    assert (two.is_installed, two.is_returning, two.is_renting) == (False, True, None)
    assert (one.arrondissement, two.arrondissement) == (12, None)
    assert (one.electric_bikes, one.mechanical_bikes, one.collected_at) == (5, 10, "2024-01-27T14:30:00.000000Z")
    assert three.station_status == "unknown"  # no info -> capacity 0
    assert (two.num_bikes_available, two.station_status, two.occupation_rate) == (0, "empty", 0.0)


def test_topic_parse_corrupt_side_output_and_encode(spark):
    raw = spark.createDataFrame(
        [('{"station_id":"1","collected_at":"2026-01-27T14:30:00Z","num_bikes_available":1,"num_docks_available":5,"capacity":6,'
          '"is_installed":1}', "station-readings", 0, 7, dt.datetime(2026, 1, 27, 15)),
         ('{"station_id":', "station-readings", 0, 8, dt.datetime(2026, 1, 27, 15))],
        "value string, topic string, partition int, offset long, timestamp timestamp")
    parsed = kafka.parse_messages(raw)
    bad = parsed.filter(kafka.is_corrupt()).collect()
    assert len(bad) == 1 and bad[0][kafka.CORRUPT] == '{"station_id":'
    good = parsed.filter(~kafka.is_corrupt()).drop(kafka.CORRUPT)
    out = enrich(good, kafka.ingest_time(good)).collect()
    assert len(out) == 1 and out[0].station_status == "low" and out[0].is_installed is True
    assert "kafka" not in enrich(good).columns
    encoded = kafka.encode_messages(good.drop("kafka").select("station_id", "num_bikes_available")).collect()
    assert json.loads(encoded[0].value) == {"station_id": "1", "num_bikes_available": 1}


def test_day_store_retention_and_counts(spark, scratch, small_readings):
    from stationlake.schema import ENRICHED

    def types(schema):
        return {f.name: f.dataType.simpleString() for f in schema.fields}

    assert types(small_readings.schema) == types(ENRICHED)
    path = f"{scratch}/store"
    write_store(small_readings, path)
    assert types(read_store(spark, path, schema=None).schema) == types(ENRICHED)
    assert read_store(spark, path, batches=True).select("batch").distinct().count() == 1
    days = sorted(os.path.basename(p) for p in glob.glob(f"{path}/dt=*"))
    assert len(days) == 30 and days[0] == "dt=2024-01-01"
    store = read_store(spark, path, exclude=("num_bikes_available_types",))
    assert store.count() == small_readings.count()
    assert "num_bikes_available_types" not in store.columns
    counts = day_counts(store)
    assert counts.agg(F.sum("doc_count")).first()[0] == small_readings.count()
    # pruning: a day predicate reads one folder
    plan = store.filter(F.col("dt") == "2024-01-05")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    kept = retain(store, 7, as_of="latest").select("dt").distinct().count()
    assert kept == 8
    assert expired_days(store, 7, dt.date(2024, 1, 30)).count() == 22
    p = preview(store).collect()
    assert len(p) == 5 and p[0].__fields__ == ["name", "num_bikes_available", "num_docks_available",
                                               "occupation_rate", "station_status"]
    by_time = [tuple(r) for r in small_readings.orderBy("ts", "station_id").select(*p[0].__fields__).limit(150).collect()]
    assert [tuple(r) for r in p] == by_time[:5]
    assert [tuple(r) for r in preview(store, 150).collect()] == by_time  # more than the first day holds
    victims = drop_expired(spark, path, 7, dt.date(2024, 1, 30))
    assert len(victims) == 22
    assert read_store(spark, path).select("dt").distinct().count() == 8


def test_batch_job_writes_csv_and_json(spark, scratch, small_readings):
    from stationlake.plans.batch_job import release, run_analysis

    res = run_analysis(small_readings, scratch, single_file=True)
    for name in ("station_availability", "hourly_patterns", "period_analysis", "bike_types_analysis",
                 "problematic_stations"):
        files = glob.glob(f"{scratch}/{name}/part-*.csv")
        assert len(files) == 1
        with open(files[0]) as f:
            header = f.readline().strip().split(",")
        assert header == res[name].columns
    # multi-file layout: every part has the header, rows add up
    multi = f"{scratch}/multi"
    write_csv(res["station_availability"], multi, single_file=False)
    back = spark.read.option("header", "true").csv(multi)
    assert back.count() == res["station_availability"].count()
    files = glob.glob(f"{scratch}/global_summary/part-*.json")
    assert len(files) == 1
    with open(files[0], encoding="utf-8") as f:
        doc = json.loads(f.readline())
    assert doc["analysis_period"]["total_observations"] == small_readings.count()
    assert len(doc["top_occupied_stations"]) == 10
    assert [h["hour"] for h in doc["hourly_pattern"]] == list(range(24))
    occ = [s["occupation_avg"] for s in doc["top_occupied_stations"]]
    assert occ == sorted(occ, reverse=True)
    release(res)


def test_cli_ingest_analyze_retain(spark, scratch):
    from stationlake import cli

    for i, ts in enumerate((1706365800, 1706452200)):  # two days
        doc = json.loads(json.dumps(STATUS))
        doc["last_updated"] = ts
        _dump(f"{scratch}/status", f"s{i}.json", doc)
    _dump(f"{scratch}/info", "i1.json", INFO)
    cli.main(["ingest", "--status", f"{scratch}/status", "--info", f"{scratch}/info", "--store", f"{scratch}/store"])
    store = read_store(spark, f"{scratch}/store")
    assert store.count() == 6 and store.select("dt").distinct().count() == 2
    cli.main(["ingest", "--stream", "--once", "--status", f"{scratch}/status", "--info", f"{scratch}/info",
              "--store", f"{scratch}/store2", "--checkpoint", f"{scratch}/cp"])
    assert read_store(spark, f"{scratch}/store2").count() == 6
    cli.main(["analyze", "--store", f"{scratch}/store", "--out", f"{scratch}/out"])
    assert glob.glob(f"{scratch}/out/global_summary/part-*.json")
    cli.main(["retain", "--store", f"{scratch}/store", "--days", "0", "--as-of", "2024-01-28"])
    assert read_store(spark, f"{scratch}/store").select("dt").distinct().count() == 1


def test_one_pass_job_equals_the_operators(spark, scratch, small_readings):
    """Every table of the one-pass batch job equals the stand-alone operator's result."""
    from stationlake.operators import stats
    from stationlake.plans import batch_job as J

    p = J.partials(small_readings)
    pairs = {
        "E01": (J.station_table(p), stats.station_availability(small_readings)),
        "E02": (J.hourly_table(p), stats.hourly_patterns(small_readings)),
        "E04": (J.period_table(p), stats.period_stats(small_readings)),
        "E06": (J.bike_types_table(p), stats.bike_types_by_name(small_readings)),
        "E08": (J.problems_table(J.station_table(p)), stats.problematic_stations(small_readings)),
        "E09": (J.global_table(p), stats.global_metrics(small_readings)),
    }
    for k, (a, b) in pairs.items():
        assert a.columns == b.columns, k
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, k
    # the only table built from the readings is bounded by stations x 24 hours
    assert p.count() <= small_readings.select("name", "station_id").distinct().count() * 24


def test_summary_operator_matches_batch_job(spark, small_readings):
    from stationlake.operators import stats
    from stationlake.plans import batch_job as J

    st, hr = stats.station_availability(small_readings), stats.hourly_patterns(small_readings)
    a = stats.global_summary(small_readings, st, hr).drop("generated_at").first().asDict(recursive=True)
    p = J.partials(small_readings)
    b = J.summary_document(p, J.station_table(p), J.hourly_table(p)).drop("generated_at").first().asDict(recursive=True)
    assert a == b


def test_store_writes_add_up_and_repeat_safely(spark, scratch, small_readings):
    """Later writes of a day keep the earlier ones; the same batch written again stays once."""
    path = f"{scratch}/store"
    half = F.abs(F.hash("station_id", "ts")) % 2
    first, second = small_readings.filter(half == 0), small_readings.filter(half == 1)
    write_store(first, path)
    write_store(second, path, "b")
    write_store(second, path, "b", spread=True)
    store = read_store(spark, path)
    assert store.count() == small_readings.count()
    assert store.select("station_id", "ts").exceptAll(small_readings.select("station_id", "ts")).count() == 0
    assert distinct_readings(store.union(store)).count() == small_readings.dropDuplicates(["station_id", "collected_at"]).count()


def test_broken_snapshots_go_to_the_corrupt_output(spark, scratch):
    _dump(f"{scratch}/status", "good.json", STATUS)
    os.makedirs(f"{scratch}/status", exist_ok=True)
    with open(f"{scratch}/status/cut.json", "w") as f:
        f.write(json.dumps(STATUS)[:60])
    bad = json.loads(json.dumps(STATUS))
    bad["data"]["stations"][0]["num_bikes_available"] = "x"
    _dump(f"{scratch}/status", "type.json", bad)
    feed = read_snapshots(spark, f"{scratch}/status")
    assert status_rows(feed).count() == 3
    assert sorted(os.path.basename(r.file) for r in corrupt_snapshots(feed).collect()) == ["cut.json", "type.json"]


def test_text_without_a_zone_is_utc(spark):
    from stationlake.functions.columns import parse_utc

    texts = ["2026-01-27T14:30:00Z", "2026-01-27 14:30:00", "2026-01-27T15:30:00+01:00", "2026-01-27", "x", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        got = [r[0] for r in df.select(F.unix_seconds(parse_utc("t"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [1769524200, 1769524200, 1769524200, 1769472000, None, None]
