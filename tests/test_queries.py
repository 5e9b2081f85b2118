"""Every registered query against its DuckDB form on sf0.001, plus plan properties."""

import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from stationlake.registry import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["part", "events"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t + '.parquet')}')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return "NULL" if v is None else str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


SQL_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
             "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "date": "DATE"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    rel = con.sql(ORACLE[name])
    otypes = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert {f.name: SQL_TYPES.get(f.dataType.simpleString()) for f in df.schema.fields} == otypes
    res = con.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(ocols, res.fetchall())


def test_every_query_has_an_oracle_or_is_listed():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "occupation_avg" in df.columns


def test_group_counts_sum_to_rows(spark, small_readings):
    from stationlake.operators import stats

    n = small_readings.count()
    assert stats.period_stats(small_readings).agg(F.sum("nb_mesures")).first()[0] == n
    assert stats.hourly_patterns(small_readings).agg(F.sum("nb_mesures")).first()[0] == n
    assert stats.station_availability(small_readings).agg(F.sum("nb_mesures")).first()[0] == n


def test_histogram_has_no_holes(spark, small_readings):
    from stationlake.operators import search

    h = search.hourly_histogram(small_readings, since="30d", as_of="latest").collect()
    gaps = {(b.bucket - a.bucket).total_seconds() for a, b in zip(h, h[1:])}
    assert gaps == {3600.0}
    assert any(r.doc_count == 0 and r.avg_bikes is None for r in h)  # sf0.001 has empty hours


def test_shares_in_range(spark, small_readings):
    bad = small_readings.filter((F.col("occupation_rate") < 0) | (F.col("occupation_rate") > 100)).count()
    assert bad == 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_prunes_columns(spark):
    from stationlake.operators import stats
    from stationlake.sources.fixtures import readings

    plan = _plan(stats.station_availability(readings(spark, SF)))
    assert "RoundRobinPartitioning" not in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double,props:string>" in plan
    # the part scan reads only what the info and status feeds need
    assert "ReadSchema: struct<p_partkey:bigint,p_size:int>" in plan


def test_appended_events_are_seen(spark, scratch):
    """A folder that gains a file after a first query is read whole by the next one."""
    import shutil

    os.makedirs(f"{scratch}/events.parquet")
    shutil.copyfile(f"{SF}/events.parquet", f"{scratch}/events.parquet/a.parquet")
    shutil.copyfile(f"{SF}/part.parquet", f"{scratch}/part.parquet")
    first = QUERIES["a10_count"](spark, scratch).first()[0]
    shutil.copyfile(f"{SF}/events.parquet", f"{scratch}/events.parquet/b.parquet")
    assert QUERIES["a10_count"](spark, scratch).first()[0] == 2 * first


def test_no_lookup_runs_while_a_query_is_built(spark):
    """Reading the tables' schemas is all the work there is before an action."""
    from stationlake.sources.fixtures import readings

    tracker = spark.sparkContext.statusTracker()

    def jobs(build, group):
        spark.sparkContext.setJobGroup(group, group)
        try:
            build(spark, SF)
            return len(tracker.getJobIdsForGroup(group))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

    schemas = jobs(readings, "schemas")
    for name in ("e12_hourly_histogram_24h", "t04_near_500m_24h", "d05_fuzzy_gizom", "a14_expired_7d"):
        assert jobs(QUERIES[name], name) <= schemas


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Tokyo"])
def test_results_do_not_depend_on_the_session_zone(spark, zone):
    """Instants are compared as such; text, hours and days must be the UTC ones."""
    def result(name):
        df = QUERIES[name](spark, SF)
        cols = [F.unix_micros(c).alias(c) if t == "timestamp" else F.col(c) for c, t in df.dtypes]
        return _rows(df.columns, [tuple(r) for r in df.select(*cols).collect()])

    some = [n for n in sorted(QUERIES)
            if n[:3] in ("c_e", "e02", "e04", "e11", "e12", "e17", "e20", "e23", "t03", "p08", "a13", "a14")]
    want = {n: result(n) for n in some}
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for n in some:
            assert result(n) == want[n], n
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("instants, as_of, counts, second", [
    (["2026-10-25T00:30:00Z", "2026-10-25T01:30:00Z", "2026-10-25T02:30:00Z"], "2026-10-25T12:00:00Z", [1, 1, 1],
     "2026-10-25 02:00:00"),   # local 02:30 twice, then 03:30
    (["2026-03-29T00:30:00Z", "2026-03-29T01:30:00Z", "2026-03-29T03:30:00Z"], "2026-03-29 12:00:00", [1, 1, 0, 1],
     "2026-03-29 03:00:00"),   # no local 02:xx
])
def test_histogram_on_clock_changes(spark, instants, as_of, counts, second):
    from stationlake.operators import search

    df = spark.createDataFrame([(t, "1", 1, 1, 1) for t in instants],
                               "t string, station_id string, num_bikes_available int, electric_bikes int, mechanical_bikes int")
    df = df.withColumn("ts", F.to_timestamp("t")).withColumn("dt", F.to_date("ts"))
    rows = search.hourly_histogram(df, since="24h", as_of=as_of).collect()
    assert [r.doc_count for r in rows] == counts
    assert rows[1].bucket_local == second


def test_geo_box_across_the_meridian(spark):
    from stationlake.operators import predicates as P

    df = spark.createDataFrame([("near", 0.0, -179.999), ("far", 0.0, -170.0), ("east", 0.0, 179.9995)],
                               "id string, latitude double, longitude double")
    got = {r.id for r in df.filter(P.geo_within("latitude", "longitude", 0.0, 179.999, 500.0)).collect()}
    assert got == {"near", "east"}


def test_latest_rows_hash_aggregate_the_readings(spark):
    """Only readings at a station's latest time reach a sort-based aggregate."""
    plan = _plan(QUERIES["g01_latest_per_station"](spark, SF))
    first = plan[plan.rindex("HashAggregate"):]
    assert "partial_max(ts" in plan and "SortAggregate" not in first


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Europe/Paris"])
@pytest.mark.parametrize("as_of", ["2024-11-06T00:00:00Z", "2024-03-13T00:00:00Z", "2024-04-02T12:30:00Z", "2024-10-29T00:00:00Z"])
def test_relative_ranges_hold_across_clock_changes(spark, zone, as_of):
    """Seven days are 168 hours also where the session's zone changes its clocks within them."""
    from stationlake.operators import predicates as P

    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        now = F.lit(as_of).cast("timestamp")
        hourly = spark.range(1_704_067_200, 1_735_689_600, 1800).select(F.timestamp_seconds("id").alias("ts"))
        for span, rows in (("7d", 337), ("24h", 49), ("30m", 2), ("500ms", 1), (0.25, 1)):
            assert hourly.filter(P.time_range(span, now, day_col=None)).count() == rows
        days = hourly.withColumn("dt", F.to_date(F.to_utc_timestamp("ts", F.current_timezone())))
        assert days.filter(P.time_range("7d", now)).count() == 337
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
