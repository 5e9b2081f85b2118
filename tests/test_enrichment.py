"""Truth tables of the enrichment chain (C02, C03, C06, C08, C10, C12, C13, C17) and B01/B02."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.functions import columns as C
from stationlake.operators.enrich import enrich, to_reading
from stationlake.operators.join import dedup_last, join_status_info


def _one(spark, expr, schema, rows):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_occupancy_half_even_and_zero_capacity(spark):
    rows = [(1, 32), (15, 40), (3, 0), (5, None), (None, 10), (40, 40)]
    got = _one(spark, C.occupancy_rate("b", "c"), "b long, c long", rows)
    assert got == [3.12, 37.5, 0.0, 0.0, 0.0, 100.0]


def test_status_rules(spark):
    rows = [(8, 32, 40), (33, 7, 40), (0, 0, 10), (0, 5, 0), (5, 5, None), (7, 33, 40),
            (10, 0, 10), (None, None, 10), (20, 20, 40)]
    got = _one(spark, C.station_status("b", "d", "c"), "b long, d long, c long", rows)
    assert got == ["available", "almost_full", "empty", "unknown", "unknown", "low", "full", "empty",
                   "available"]


def test_period_bounds(spark):
    hours = [5, 6, 11, 12, 13, 14, 18, 19, 21, 22, 0, 23]
    got = _one(spark, C.time_period("h"), "h int", [(h,) for h in hours])
    assert got == ["night", "morning", "morning", "lunch", "lunch", "afternoon", "afternoon",
                   "evening", "evening", "night", "night", "night"]


def test_district(spark):
    names = ["Rue 12 - 75011", "Quai 12", "Gare 75011", "A-3 99999", "x 1.9 - 12345", None,
             "Bastille 750111"]
    got = _one(spark, C.district("n"), "n string", [(n,) for n in names])
    assert got == [12, None, 75011, -3, 1, None, 750111]


def test_truthy_forms_keep_json_type(spark):
    df = spark.sql("""
      SELECT parse_json(j) AS v FROM VALUES ('1'), ('0'), ('2'), ('true'), ('" Yes "'), ('"2"'),
        ('null'), ('2.5'), ('"t"'), ('false'), ('[1]') AS t(j)""")
    got = [r[0] for r in df.select(C.truthy("v", T.VariantType())).collect()]
    assert got == [True, False, True, True, True, False, None, True, True, False, False]
    s = spark.createDataFrame([(" YES ",), ("0",), (None,)], "s string")
    assert [r[0] for r in s.select(C.truthy("s", T.StringType())).collect()] == [True, False, None]


def test_bike_types_last_non_null(spark):
    df = spark.sql("""SELECT array(named_struct('mechanical', 10L, 'ebike', CAST(NULL AS BIGINT)),
                                   named_struct('mechanical', CAST(NULL AS BIGINT), 'ebike', 5L),
                                   named_struct('mechanical', 7L, 'ebike', CAST(NULL AS BIGINT))) AS a
                      UNION ALL SELECT CAST(array() AS array<struct<mechanical:bigint,ebike:bigint>>)""")
    got = df.select(C.bike_type_count("a", "mechanical").alias("m"), C.bike_type_count("a", "ebike").alias("e")).collect()
    assert [(r.m, r.e) for r in got] == [(7, 5), (None, None)]


def test_ratio_without_bikes_is_null(spark):
    got = _one(spark, C.rate_pct(F.col("e"), F.col("m") + F.col("e")), "m double, e double", [(0.0, 0.0), (1.0, 3.0)])
    assert got == [None, 75.0]


def _status(spark, rows):
    schema = ("station_id string, collected_at string, last_reported bigint, num_bikes_available bigint, "
              "num_docks_available bigint, num_bikes_available_types array<struct<mechanical:bigint,ebike:bigint>>")
    return spark.createDataFrame(rows, schema)


def test_sample_record_and_unknown_station(spark):
    """The reference's one worked example: 15 of 40 -> 37.5, available, 14 h, afternoon."""
    info = spark.createDataFrame([("42345", "Place de la Bastille", 48.8532, 2.3691, 40)],
                                 "station_id string, name string, lat double, lon double, capacity bigint")
    status = _status(spark, [
        ("42345", "2026-01-27T14:30:00Z", 1769524200, 15, 25, [(10, None), (None, 5)]),
        ("999", "bad", None, None, None, None),
    ])
    out = enrich(to_reading(join_status_info(status, info)), F.lit(dt.datetime(2026, 1, 1, 9, 0))).orderBy("station_id")
    a, b = out.collect()
    labelled = enrich(to_reading(join_status_info(status, info), labels={"source": "feed_x"}),
                      labels={"pipeline": "p1"}).select("source", "pipeline").first()
    assert (labelled.source, labelled.pipeline) == ("feed_x", "p1")
    assert (a.occupation_rate, a.station_status, a.hour_of_day, a.time_period, str(a.dt)) == \
        (37.5, "available", 14, "afternoon", "2026-01-27")
    assert (a.mechanical_bikes, a.electric_bikes, a.arrondissement) == (10, 5, None)
    assert (a.location.lat, a.location.lon, a.ts_parse_failed) == (48.8532, 2.3691, False)
    assert (a.is_installed, a.source, a.city, a.pipeline, a.data_type) == \
        (False, "station_feed", "Paris", "stationlake-ingest", "bike_sharing")
    # no info: defaults; bad timestamp: ingest time and the failure flag
    assert (b.name, b.capacity, b.occupation_rate, b.station_status) == ("Unknown", 0, 0.0, "unknown")
    assert (b.ts_parse_failed, b.hour_of_day, b.last_reported) == (True, 9, 0)


def test_dedup_last_wins(spark):
    df = spark.createDataFrame([("1", "old", 0), ("1", "new", 5), ("2", "only", 1)],
                               "station_id string, name string, pos int")
    got = {r.station_id: r.name for r in dedup_last(df, "station_id", "pos").collect()}
    assert got == {"1": "new", "2": "only"}


def test_cluster_settings_scale_with_input():
    from stationlake.session import cluster_settings

    small = cluster_settings(10 << 30, executors=10, cores_per_executor=4)
    big = cluster_settings(100 << 40, executors=1000, cores_per_executor=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 80          # two waves of 40 slots
    assert int(big["spark.sql.shuffle.partitions"]) == 40960         # 10 % of 100 TB / 256 MB
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"
