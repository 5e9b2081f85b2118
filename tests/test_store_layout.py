"""Quad-key cells and their key ranges, pruning by place, compaction killed at each step."""

import datetime as dt
import glob
import os
import shutil

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stationlake.functions.cells import LEVEL, cell_key, key_ranges, quad_key
from stationlake.operators import predicates as P
from stationlake.operators.search import near
from stationlake.schema import ENRICHED
from stationlake.sources import compaction as C
from stationlake.sources.store import drop_expired, read_store, write_store

COLS = ["station_id", "collected_at", "name", "latitude", "longitude", "num_bikes_available", "occupation_rate", "station_status", "ts", "dt"]


def _rows(df):
    return sorted(map(repr, map(tuple, df.select(*COLS).collect())))


def _scanned(df) -> int:
    """Rows that the file scans of ``df`` gave, after running it."""
    df.collect()
    plan, todo, rows = df._jdf.queryExecution().executedPlan(), [], 0
    todo.append(plan)
    while todo:
        p = todo.pop()
        if p.nodeName().startswith("Scan parquet") or p.nodeName().startswith("FileScan"):
            rows += p.metrics().apply("numOutputRows").value()
        todo += [p.children().apply(i) for i in range(p.children().size())]
    return rows


# ---- cells -----------------------------------------------------------------------------
def test_cell_column_equals_the_plain_form(spark):
    points = [(48.8584, 2.2945), (-90.0, -180.0), (90.0, 180.0), (0.0, 0.0), (-0.0, 179.9999999), (95.0, -200.0), (12.5, -45.25)]
    df = spark.createDataFrame(points, "lat double, lon double")
    assert [r[0] for r in df.select(cell_key("lat", "lon")).collect()] == [quad_key(*p) for p in points]
    assert max(quad_key(*p) for p in points) == (1 << 2 * LEVEL) - 1
    odd = spark.createDataFrame([(None, 1.0), (1.0, None), (float("nan"), 1.0)], "lat double, lon double")
    assert [r[0] for r in odd.select(cell_key("lat", "lon")).collect()] == [None] * 3


@settings(max_examples=150, deadline=None)
@given(st.floats(-90, 90), st.floats(-180, 180), st.floats(1, 12_000_000), st.floats(0, 1), st.floats(0, 360), st.integers(1, 20))
def test_ranges_hold_every_point_of_the_circle(lat, lon, radius, share, bearing, most):
    import math

    ranges = key_ranges(P.boxes(lat, lon, radius), most=most)
    assert len(ranges) <= most and all(a <= b for a, b in ranges)
    assert all(ranges[i][1] < ranges[i + 1][0] for i in range(len(ranges) - 1))
    d, la, b = share * radius / P.EARTH_RADIUS_M, lat * P.DEG, bearing * P.DEG  # a point at that distance and bearing
    y = math.asin(max(-1.0, min(1.0, math.sin(la) * math.cos(d) + math.cos(la) * math.sin(d) * math.cos(b))))
    x = lon * P.DEG + math.atan2(math.sin(b) * math.sin(d) * math.cos(la), math.cos(d) - math.sin(la) * math.sin(y))
    key = quad_key(y / P.DEG, (x / P.DEG + 540) % 360 - 180)
    assert any(a <= key <= z for a, z in ranges)


def _points(spark, n=60_000):
    """Readings of ``n`` places in an order that has nothing to do with their position."""
    h = [F.abs(F.xxhash64(F.col("id"), F.lit(k))) % 1_000_000 / 1_000_000.0 for k in (1, 2)]
    at = (F.lit(1_704_067_200) + F.col("id") % 86_400).cast("timestamp")
    own = {"station_id": F.col("id").cast("string"), "collected_at": F.lit("x"), "name": F.concat(F.lit("n"), F.col("id") % 500),
           "latitude": 48.7 + 0.3 * h[0], "longitude": 2.1 + 0.4 * h[1], "num_bikes_available": F.col("id") % 30,
           "occupation_rate": F.lit(1.0), "station_status": F.lit("normal"), "ts": at, "dt": F.lit("2024-01-01").cast("date")}
    return spark.range(n).select(*[own.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in ENRICHED.fields])


def test_a_circle_reads_a_tenth_of_a_compacted_store(spark, scratch):
    path = f"{scratch}/store"
    points = _points(spark).repartition(4)
    for k in range(4):
        write_store(points.filter(F.pmod(F.xxhash64("station_id"), F.lit(4)) == k), path, f"b{k}")
    circle = dict(lat0=48.85, lon0=2.3, radius_m=400.0)
    before = read_store(spark, path)
    want = _rows(before.filter(P.geo_within("latitude", "longitude", **circle)))
    top = near(before, 48.85, 2.3, 400.0, since="30d", as_of="latest").collect()
    plain = _scanned(before.filter(P.geo_within("latitude", "longitude", **circle)))
    assert C.compact_store(spark, path, row_group_bytes=64 << 10, target_bytes=256 << 10).keys() == {"2024-01-01"}
    store = read_store(spark, path, cells=True)
    hits = store.filter(P.geo_within("latitude", "longitude", **circle, cell="cell"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "20000")
    try:
        plan = hits._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.index("PushedFilters"):]
    assert "GreaterThanOrEqual(cell," in pushed and "LessThanOrEqual(cell," in pushed
    assert _rows(hits) == want and len(want) > 20
    assert _scanned(hits) * 10 <= plain == 60_000
    assert near(store, 48.85, 2.3, 400.0, since="30d", as_of="latest").collect() == top and len(top) == 20


def test_places_without_a_key_are_found_too(spark, scratch, small_readings):
    """A store of old files (no keys), files with keys and readings without a place."""
    path = f"{scratch}/store"
    lost = small_readings.limit(5).withColumn("latitude", F.lit(None).cast("double"))
    write_store(small_readings, path, "old")
    write_store(small_readings.union(lost), path, "new", cells=True)
    store = read_store(spark, path, cells=True)
    assert store.filter("cell IS NULL").count() == small_readings.count() + 5
    for radius in (200.0, 700.0, 3_000_000.0):
        pred = P.geo_within("latitude", "longitude", 48.8584, 2.2945, radius, "cell")
        want = 2 * small_readings.filter(P.geo_within("latitude", "longitude", 48.8584, 2.2945, radius)).count()
        assert store.filter(pred).count() == want > 0


# ---- compaction ----------------------------------------------------------------------------
@pytest.fixture()
def store(spark, scratch, small_readings):
    """Three days in six batches."""
    path = f"{scratch}/store"
    part = small_readings.filter("dt < '2024-01-04'").withColumn("_k", F.pmod(F.xxhash64("station_id", "ts"), F.lit(6))).cache()
    for k in range(6):
        write_store(part.filter(F.col("_k") == k).drop("_k"), path, f"b{k}")
    return path, part


DAY = "2024-01-02"


def test_compaction_keeps_every_row(spark, store):
    path, part = store
    want = _rows(part)
    assert len(C.compact_store(spark, path, before="2024-01-03")) == 2
    assert _rows(read_store(spark, path)) == want
    folders = {d: len(glob.glob(f"{path}/dt=2024-01-0{d}/batch=*")) for d in (1, 2, 3)}
    assert folders == {1: 1, 2: 1, 3: 6}
    assert C.compact_store(spark, path, before="2024-01-03") == {}  # nothing left to do
    assert read_store(spark, path, schema=None).count() == len(want)
    one_day = read_store(spark, path).filter(F.col("dt") == DAY)
    assert one_day.count() == part.filter(F.col("dt") == DAY).count() == _scanned(one_day.select("station_id", "dt"))


@pytest.mark.parametrize("step", ["begin", "write", "commit", "half clean"])
def test_a_compaction_that_dies_changes_nothing(spark, store, small_readings, step):
    path, part = store
    want = _rows(part)
    C.begin(path)
    batches = C._folders(path, DAY)
    if step != "begin":
        name = C.write_step(spark, path, DAY, batches)
        if step != "write":
            C.commit_step(path, DAY, batches, name)
            if step == "half clean":
                for b in batches[:3]:
                    shutil.rmtree(f"{path}/dt={DAY}/batch={b}")
    assert _rows(read_store(spark, path)) == want
    # a write that comes late, to this day and another, and an old batch that is written again
    late = small_readings.filter("dt = '2024-01-07'").withColumn("dt", F.when(F.col("num_bikes_available") > 5, F.lit(DAY)).otherwise(
        F.lit("2024-01-03")).cast("date")).cache()
    write_store(late, path, "late")
    write_store(part.filter("_k = 2").drop("_k"), path, "b2")
    want = sorted(want + _rows(late))
    assert _rows(read_store(spark, path)) == want
    # the next run finishes the work
    assert C.compact_day(spark, path, DAY) is not None
    assert _rows(read_store(spark, path)) == want
    assert len(glob.glob(f"{path}/dt={DAY}/batch=*")) == 1
    write_store(part.filter("_k = 4").drop("_k"), path, "b4")  # once more, after the compaction
    write_store(late, path, "late")
    assert _rows(read_store(spark, path)) == want
    assert C.compact_day(spark, path, DAY) is None and len(C.commits(path)) == 1


def test_a_late_write_between_the_steps_stays(spark, store, small_readings):
    path, part = store
    late = small_readings.filter("dt = '2024-01-08'").withColumn("dt", F.lit(DAY).cast("date")).cache()
    C.begin(path)
    batches = C._folders(path, DAY)
    name = C.write_step(spark, path, DAY, batches)
    write_store(late, path, "late")
    C.commit_step(path, DAY, batches, name)
    C.clean_step(path, DAY)
    assert _rows(read_store(spark, path)) == sorted(_rows(part) + _rows(late))
    assert sorted(os.listdir(f"{path}/dt={DAY}")) == sorted([f"batch={name}", "batch=late"])


def test_a_query_that_was_planned_before_still_reads_what_it_saw(spark, store):
    path, part = store
    before = read_store(spark, path)
    assert C.compact_day(spark, path, DAY, clean=False)
    assert _rows(before) == _rows(part) == _rows(read_store(spark, path))
    assert C.compact_day(spark, path, DAY) is None  # cleans up
    assert len(glob.glob(f"{path}/dt={DAY}/batch=*")) == 1 and _rows(read_store(spark, path)) == _rows(part)


def test_retention_forgets_the_compactions_of_its_days(spark, store):
    path, _ = store
    C.compact_store(spark, path)
    assert len(C.commits(path)) == 3
    assert drop_expired(spark, path, 1, dt.date(2024, 1, 3)) == ["2024-01-01"]
    assert {c["day"] for c in C.commits(path)} == {"2024-01-02", "2024-01-03"}
