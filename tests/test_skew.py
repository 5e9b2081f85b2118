"""One station holding a third of all readings: results stay exact, plans pre-aggregate."""

import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from stationlake.operators import panels, search, stats


@pytest.fixture(scope="module")
def skewed(small_readings):
    hot = (F.abs(F.hash("ts")) % 3) == 0
    return small_readings.withColumn("station_id", F.when(hot, F.lit("hot")).otherwise(F.col("station_id"))).cache()


@pytest.fixture(scope="module")
def pdf(skewed):
    return skewed.select("station_id", "name", "ts", "last_reported", "num_bikes_available",
                         "station_status", "occupation_rate").toPandas()


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_station_holds_a_third(pdf):
    share = (pdf.station_id == "hot").mean()
    assert 0.25 < share < 0.42


def test_latest_per_station_exact_and_partial(skewed, pdf):
    got = {r.station_id: (r.ts, r.num_bikes_available) for r in panels.latest_per_station(skewed).collect()}
    order = pdf.sort_values(["ts", "last_reported", "num_bikes_available"])
    want = {k: (g.ts.iloc[-1].to_pydatetime(), g.num_bikes_available.iloc[-1])
            for k, g in order.groupby("station_id")}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][1] == want[k][1] and abs((got[k][0] - want[k][0]).total_seconds()) < 1e-3
    plan = _plan(panels.latest_per_station(skewed))
    assert "partial_max(ts" in plan and "Window" not in plan


def test_station_counts_exact(skewed, pdf):
    got = {(r.name, r.station_id): (r.nb_mesures, r.times_empty)
           for r in stats.station_availability(skewed).collect()}
    g = pdf.groupby(["name", "station_id"])
    want = {k: (len(v), int((v.station_status == "empty").sum())) for k, v in g}
    assert got == want
    assert "partial_count" in _plan(stats.station_availability(skewed))


def test_hourly_distinct_stations_exact(skewed, pdf):
    h = search.hourly_histogram(skewed, since="30d", as_of="latest").filter("doc_count > 0").collect()
    b = pd.to_datetime(pdf.ts).dt.floor("h")
    want = pdf.assign(b=b).groupby("b").station_id.nunique()
    got = {pd.Timestamp(r.bucket): r.total_stations for r in h}
    assert got == {k: v for k, v in want.items()}


def test_info_join_and_latest_rows_without_broadcast(spark):
    """With broadcasts off, B01 is a shuffle join; G01 over it gives the same rows, hot key included."""
    from stationlake.operators.enrich import enrich, to_reading
    from stationlake.operators.join import join_status_info
    from stationlake.sources.fixtures import station_info, station_status

    sf = "/root/testdata/sf0.001"
    status = station_status(spark, sf)
    hot = status.withColumn("station_id", F.when((F.abs(F.hash("collected_at")) % 3) == 0, F.lit("1"))
                            .otherwise(F.col("station_id")))

    def both():
        joined = join_status_info(hot, station_info(spark, sf))
        return joined, panels.latest_per_station(enrich(to_reading(joined)))

    cols = ["station_id", "collected_at", "name", "capacity", "latitude"]
    small, latest = ([tuple(r) for r in x.collect()] for x in (lambda j: (j[0].select(*cols), j[1]))(both()))
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    saved = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        joined, last = both()
        assert re.search(r"SortMergeJoin \[station_id", _plan(joined))
        assert "BroadcastHashJoin" not in _plan(last)
        assert sorted(tuple(r) for r in joined.select(*cols).collect()) == sorted(small)
        assert sorted(map(str, last.collect())) == sorted(map(str, both()[1].collect()))
        assert sorted(map(repr, (tuple(r) for r in last.collect()))) == sorted(map(repr, latest))
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
