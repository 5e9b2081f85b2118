"""

Every query reads the driver tables (through the fixture feeds and the enrichment
chain) and runs over the whole tables. Parameters that depend on the data, such as
"now" for relative time ranges, are the data's latest event time.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.functions import columns as C
from stationlake.functions.text import analyze_text, ngrams_text, stop_words, text_positions
from stationlake.operators import asof as AS
from stationlake.operators import enrich as EN
from stationlake.operators import join as JO
from stationlake.operators import panels, search, stats
from stationlake.operators import predicates as P
from stationlake.operators import text_search as TS
from stationlake.operators.join import dedup_last
from stationlake.oracle import avg2dp, cnt, r, r2, with_readings
from stationlake.plans import rollup as RU
from stationlake.plans import sketches as SK
from stationlake.sources import compaction as CO
from stationlake.sources import kafka as KA
from stationlake.sources import store as ST
from stationlake.session import checkpoint_path
from stationlake.sources.fixtures import readings, station_info, station_status, table
from stationlake.streaming import ingest as IN
from stationlake.streaming import monitor as MO
from stationlake.streaming import state as STATE

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)``; results don't depend on the session zone."""
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


READING_COLS = ("station_id, ts, name, latitude, longitude, capacity, num_bikes_available, "
                "num_docks_available, occupation_rate, station_status, mechanical_bikes, electric_bikes, "
                "hour_of_day, time_period, arrondissement, is_installed, is_returning, is_renting, "
                "last_reported, dt")

# Integer columns that can be NULL are reported as DOUBLE in check outputs (values are
# exact): a client converting results to pandas turns a nullable BIGINT into float64
# from Spark but into a nullable Int64 from DuckDB, so equal values would print apart.
NULLABLE_INTS = ("mechanical_bikes", "electric_bikes", "arrondissement")


def as_double(df: DataFrame, cols=NULLABLE_INTS) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) if c in cols else F.col(c) for c in df.columns])


def _reading_cols_sql() -> str:
    cols = [c.strip() for c in READING_COLS.split(",")]
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in NULLABLE_INTS else c for c in cols)


@register("c_enriched_readings", with_readings(f"SELECT {_reading_cols_sql()} FROM readings"))
def q_enriched(spark, sf):
    """B01 + C01-C13: the whole enriched table, row by row."""
    return as_double(readings(spark, sf).select(*[c.strip() for c in READING_COLS.split(",")]))


E01_SQL = with_readings(f"""
SELECT name, station_id, count(*) AS nb_mesures,
       {r2('avg(num_bikes_available)')} AS bikes_avg,
       min(num_bikes_available) AS bikes_min, max(num_bikes_available) AS bikes_max,
       avg(num_docks_available) AS docks_avg,
       {r2(avg2dp())} AS occupation_avg,
       {cnt("station_status = 'empty'")} AS times_empty,
       {cnt("station_status = 'full'")} AS times_full,
       avg(mechanical_bikes) AS mechanical_avg, avg(electric_bikes) AS electric_avg
FROM readings GROUP BY name, station_id""")


@register("e01_station_availability", E01_SQL)
def q_e01(spark, sf):
    return stats.station_availability(readings(spark, sf))


@register("e01_console_top20", f"""
SELECT name, bikes_avg, docks_avg, occupation_avg, times_empty, times_full FROM (
{E01_SQL} ORDER BY occupation_avg DESC, station_id, name LIMIT 20) x""")
def q_e01_console(spark, sf):
    """E01's console table: the 20 most occupied stations, six columns."""
    top = stats.top_by(stats.station_availability(readings(spark, sf)), "occupation_avg", 20, "station_id", "name")
    return top.select("name", "bikes_avg", "docks_avg", "occupation_avg", "times_empty", "times_full")


# ---- batch analyses -------------------------------------------------------------------
_E02 = f"""
SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS nb_mesures,
       {r2('avg(num_bikes_available)')} AS bikes_avg, avg(num_docks_available) AS docks_avg,
       {r2(avg2dp())} AS occupation_avg,
       {cnt("station_status = 'empty'")} AS stations_empty,
       {cnt("station_status = 'full'")} AS stations_full
FROM readings GROUP BY 1"""


@register("e02_hourly_patterns", with_readings(_E02))
def q_e02(spark, sf):
    return stats.hourly_patterns(readings(spark, sf))


@register("e03_peak_hours", with_readings(f"SELECT * FROM ({_E02}) h ORDER BY occupation_avg DESC, hour LIMIT 5"))
def q_e03(spark, sf):
    return stats.peak_hours(stats.hourly_patterns(readings(spark, sf)))


@register("e04_period_stats", with_readings(f"""
SELECT time_period, count(*) AS nb_mesures, {r2('avg(num_bikes_available)')} AS bikes_avg,
       {r2(avg2dp())} AS occupation_avg,
       {cnt("station_status = 'empty'")} AS empty_count, {cnt("station_status = 'full'")} AS full_count
FROM readings GROUP BY time_period"""))
def q_e04(spark, sf):
    return stats.period_stats(readings(spark, sf))


@register("e05_bike_types_overall", with_readings("""
SELECT avg(mechanical_bikes) AS mechanical_avg, avg(electric_bikes) AS electric_avg,
       CAST(sum(mechanical_bikes) AS BIGINT) AS mechanical_total,
       CAST(sum(electric_bikes) AS BIGINT) AS electric_total
FROM readings WHERE mechanical_bikes IS NOT NULL AND electric_bikes IS NOT NULL"""))
def q_e05(spark, sf):
    return stats.bike_types_overall(readings(spark, sf))


_BT = f"""
, bt AS (
  SELECT name, {r2('avg(mechanical_bikes)')} AS mechanical_avg, {r2('avg(electric_bikes)')} AS electric_avg
  FROM readings WHERE mechanical_bikes IS NOT NULL AND electric_bikes IS NOT NULL GROUP BY name)
"""
_E06 = f"""SELECT name, mechanical_avg, electric_avg,
  {r2('electric_avg / NULLIF(mechanical_avg + electric_avg, 0) * 100')} AS ratio_electric FROM bt"""
_E07 = f"""SELECT name, mechanical_avg, electric_avg, mechanical_avg + electric_avg AS total_avg,
  {r2('electric_avg / NULLIF(mechanical_avg + electric_avg, 0) * 100')} AS ratio_electric FROM bt"""


@register("e06_bike_types_by_name", with_readings(_BT + _E06))
def q_e06(spark, sf):
    return stats.bike_types_by_name(readings(spark, sf))


@register("e06_top10_electric", with_readings(_BT + f"SELECT * FROM ({_E06}) x ORDER BY electric_avg DESC NULLS LAST, name LIMIT 10"))
def q_e06_top(spark, sf):
    return stats.top_by(stats.bike_types_by_name(readings(spark, sf)), "electric_avg", 10, "name")


@register("e07_bike_types_notebook", with_readings(_BT + _E07))
def q_e07(spark, sf):
    return stats.bike_types_by_name(readings(spark, sf), with_total=True)


@register("e07_top10_ratio", with_readings(_BT + f"SELECT * FROM ({_E07}) x ORDER BY ratio_electric DESC NULLS LAST, name LIMIT 10"))
def q_e07_top(spark, sf):
    return stats.top_by(stats.bike_types_by_name(readings(spark, sf), with_total=True), "ratio_electric", 10, "name")


_PB = f"""
, pb0 AS (
  SELECT name, station_id, count(*) AS total_observations,
         {cnt("station_status = 'empty'")} AS empty_count, {cnt("station_status = 'full'")} AS full_count
  FROM readings GROUP BY name, station_id),
pb AS (
  SELECT *, {r2('empty_count / total_observations * 100')} AS empty_rate,
            {r2('full_count / total_observations * 100')} AS full_rate FROM pb0)
"""


@register("e08_problematic_stations", with_readings(_PB + "SELECT *, empty_rate + full_rate AS problem_rate FROM pb"))
def q_e08(spark, sf):
    return stats.problematic_stations(readings(spark, sf))


@register("e08_top20_problem", with_readings(_PB + """
SELECT name, station_id, empty_rate, full_rate, empty_rate + full_rate AS problem_rate FROM pb
ORDER BY problem_rate DESC, station_id, name LIMIT 20"""))
def q_e08_problem(spark, sf):
    return stats.problem_rankings(stats.problematic_stations(readings(spark, sf)))["problem"]


@register("e08_top10_empty", with_readings(_PB + "SELECT name, station_id, empty_rate FROM pb ORDER BY empty_rate DESC, station_id, name LIMIT 10"))
def q_e08_empty(spark, sf):
    return stats.problem_rankings(stats.problematic_stations(readings(spark, sf)))["empty"]


@register("e08_top10_full", with_readings(_PB + "SELECT name, station_id, full_rate FROM pb ORDER BY full_rate DESC, station_id, name LIMIT 10"))
def q_e08_full(spark, sf):
    return stats.problem_rankings(stats.problematic_stations(readings(spark, sf)))["full"]


@register("e09_global_metrics", with_readings(f"""
SELECT count(*) AS total_observations, count(DISTINCT station_id) AS total_stations,
       {r2('avg(num_bikes_available)')} AS avg_bikes_available,
       {r2('avg(num_docks_available)')} AS avg_docks_available,
       {r2(avg2dp())} AS avg_occupation_rate,
       CAST(sum(capacity) AS BIGINT) AS total_system_capacity
FROM readings"""))
def q_e09(spark, sf):
    return stats.global_metrics(readings(spark, sf))


@register("e09_top_occupied", E01_SQL + " ORDER BY occupation_avg DESC, station_id, name LIMIT 10")
def q_e09_top(spark, sf):
    return stats.top_by(stats.station_availability(readings(spark, sf)), "occupation_avg", 10, "station_id", "name")


@register("e16_distinct_stations", with_readings("SELECT count(DISTINCT station_id) AS total_stations FROM readings"))
def q_e16(spark, sf):
    return stats.distinct_stations(readings(spark, sf))


@register("e01_group_count", with_readings("SELECT count(*) AS n_groups FROM (SELECT DISTINCT name, station_id FROM readings) g"))
def q_e01_count(spark, sf):
    return stats.station_count(stats.station_availability(readings(spark, sf)))


# ---- aggregating requests and hit lists ----------------------------------------------

LATEST = "(SELECT max(ts) FROM readings)"


def since(hours: int) -> str:
    return f"ts >= {LATEST} - INTERVAL {hours} HOUR"


@register("e10_by_status", with_readings(f"""
SELECT station_status, count(*) AS doc_count, {r2('avg(num_bikes_available)')} AS avg_bikes,
       {r2(avg2dp())} AS avg_occupation
FROM readings WHERE station_status IS NOT NULL GROUP BY station_status
ORDER BY doc_count DESC, station_status LIMIT 10"""))
def q_e10(spark, sf):
    return search.by_status(readings(spark, sf))


@register("e11_by_district_24h", with_readings(f"""
SELECT arrondissement, count(*) AS doc_count, {r2('avg(num_bikes_available)')} AS avg_bikes,
       {r2('avg(num_docks_available)')} AS avg_docks, {r2(avg2dp())} AS avg_occupation,
       CAST(sum(capacity) AS BIGINT) AS total_capacity
FROM readings WHERE {since(24)} AND arrondissement IS NOT NULL GROUP BY arrondissement
ORDER BY avg_bikes DESC NULLS LAST, arrondissement LIMIT 20"""))
def q_e11(spark, sf):
    return search.by_district(readings(spark, sf), since="24h", as_of="latest")


@register("e12_hourly_histogram_24h", with_readings(f"""
, f AS (SELECT * FROM readings WHERE {since(24)} AND ts <= {LATEST}),
a AS (
  SELECT date_trunc('hour', ts) AS bucket, count(*) AS doc_count,
         {r2('avg(num_bikes_available)')} AS avg_bikes, {r2('avg(electric_bikes)')} AS avg_electric,
         {r2('avg(mechanical_bikes)')} AS avg_mechanical, count(DISTINCT station_id) AS total_stations
  FROM f GROUP BY 1),
s AS (SELECT unnest(generate_series(min(bucket), max(bucket), INTERVAL 1 HOUR)) AS bucket FROM a)
SELECT s.bucket,
       strftime(timezone('Europe/Paris', s.bucket AT TIME ZONE 'UTC'), '%Y-%m-%d %H:%M:%S') AS bucket_local,
       COALESCE(a.doc_count, 0) AS doc_count, a.avg_bikes, a.avg_electric, a.avg_mechanical,
       COALESCE(a.total_stations, 0) AS total_stations
FROM s LEFT JOIN a ON s.bucket = a.bucket"""))
def q_e12(spark, sf):
    return search.hourly_histogram(readings(spark, sf), since="24h", as_of="latest")


@register("e13_by_period_7d", with_readings(f"""
SELECT time_period, count(*) AS doc_count, {r2(avg2dp())} AS avg_occupation,
       {r2('avg(num_bikes_available)')} AS avg_bikes,
       {cnt("station_status = 'empty'")} AS stations_empty, {cnt("station_status = 'full'")} AS stations_full
FROM readings WHERE ts >= {LATEST} - INTERVAL 7 DAY AND time_period IS NOT NULL GROUP BY time_period
ORDER BY doc_count DESC, time_period LIMIT 10"""))
def q_e13(spark, sf):
    return search.by_period(readings(spark, sf), since="7d", as_of="latest")


@register("e14_top_names_occupation_24h", with_readings(f"""
, f AS (SELECT * FROM readings WHERE {since(24)} AND name IS NOT NULL),
a AS (SELECT name, count(*) AS doc_count, {r2(avg2dp())} AS avg_occupation,
             {r2('avg(num_bikes_available)')} AS avg_bikes FROM f GROUP BY name),
s AS (SELECT name, latitude AS sample_lat, longitude AS sample_lon, capacity AS sample_capacity,
             row_number() OVER (PARTITION BY name ORDER BY ts DESC, station_id DESC) AS rn FROM f)
SELECT a.name, doc_count, avg_occupation, avg_bikes, sample_lat, sample_lon, sample_capacity
FROM a JOIN s ON a.name = s.name AND s.rn = 1
ORDER BY avg_occupation DESC NULLS LAST, a.name LIMIT 20"""))
def q_e14(spark, sf):
    return search.top_names_by_occupation(readings(spark, sf), since="24h", as_of="latest")


@register("e15_cardinality_exact", with_readings("SELECT count(DISTINCT station_id) AS total_stations FROM readings"))
def q_e15(spark, sf):
    return search.station_cardinality(readings(spark, sf), approx=False)


@register("t03_recent_empty_24h", with_readings(f"""
SELECT name, station_id, latitude, longitude, num_bikes_available, num_docks_available, ts
FROM readings WHERE station_status = 'empty' AND {since(24)}
ORDER BY ts DESC, station_id LIMIT 50"""))
def q_t03(spark, sf):
    return search.recent_with_status(readings(spark, sf), "empty", since="24h", as_of="latest")


GEO_LAT, GEO_LON, GEO_R = 48.8584, 2.2945, 500.0


def haversine_sql(lat: str, lon: str, lat0: float, lon0: float) -> str:
    deg = P.DEG
    la0 = lat0 * deg
    s1 = f"sin(({lat} * {deg!r} - {la0!r}) / 2)"
    s2 = f"sin(({lon} * {deg!r} - {lon0 * deg!r}) / 2)"
    a = f"({s1} * {s1} + {math.cos(la0)!r} * cos({lat} * {deg!r}) * {s2} * {s2})"
    return f"({2 * P.EARTH_RADIUS_M!r} * asin(least(1.0, sqrt({a}))))"


_DIST = haversine_sql("latitude", "longitude", GEO_LAT, GEO_LON)


_T04 = with_readings(f"""
, f AS (SELECT *, {_DIST} AS distance FROM readings WHERE {since(24)})
SELECT name, station_id, latitude, longitude, num_bikes_available, CAST(electric_bikes AS DOUBLE) AS electric_bikes,
       CAST(mechanical_bikes AS DOUBLE) AS mechanical_bikes, {r2('distance')} AS distance_m, ts
FROM f WHERE distance <= {GEO_R} ORDER BY distance, ts DESC, station_id LIMIT 20""")


def _store(spark, sf, batches: int = 1, **options) -> str:
    """The readings written to a new day store below the shared folder, in some batches; its path."""
    path = checkpoint_path(spark, f"store-{uuid.uuid4().hex}")
    df = readings(spark, sf)
    for k in range(batches):
        own = df if batches == 1 else df.filter(F.pmod(F.xxhash64("station_id", "ts"), F.lit(batches)) == k)
        ST.write_store(own, path, f"b{k}", **options)
    return path


@register("t04_near_by_cells", _T04)
def q_t04_cells(spark, sf):
    """T04 over a store written with quad-keys: the circle's key ranges prune the scan."""
    store = ST.read_store(spark, _store(spark, sf, cells=True), cells=True)
    return as_double(search.near(store, GEO_LAT, GEO_LON, GEO_R, since="24h", as_of="latest"))


@register("t04_near_500m_24h", _T04)
def q_t04(spark, sf):
    return as_double(search.near(readings(spark, sf), GEO_LAT, GEO_LON, GEO_R, since="24h", as_of="latest"))


@register("p06_geo_radius_stations", with_readings(f"""
SELECT DISTINCT station_id, name, {r2(_DIST)} AS distance_m FROM readings WHERE {_DIST} <= {GEO_R}"""))
def q_p06(spark, sf):
    df = readings(spark, sf)
    return (df.filter(P.geo_within("latitude", "longitude", GEO_LAT, GEO_LON, GEO_R))
            .select("station_id", "name",
                    F.round(P.haversine_m("latitude", "longitude", GEO_LAT, GEO_LON), 2).alias("distance_m"))
            .distinct())


@register("p01_types_known", with_readings("""
SELECT station_id, ts, mechanical_bikes, electric_bikes FROM readings
WHERE mechanical_bikes IS NOT NULL AND electric_bikes IS NOT NULL"""))
def q_p01(spark, sf):
    return (readings(spark, sf).filter(P.not_null_all("mechanical_bikes", "electric_bikes"))
            .select("station_id", "ts", "mechanical_bikes", "electric_bikes"))


@register("p07_regex_district", with_readings(r"""
SELECT DISTINCT name, arrondissement FROM readings WHERE regexp_matches(name, '\d{5}')"""))
def q_p07(spark, sf):
    return (readings(spark, sf).filter(P.regex("name", r"\d{5}"))
            .select("name", "arrondissement").distinct())


@register("p08_dashboard_filter_7d", with_readings(f"""
SELECT station_id, name, ts, station_status, time_period FROM readings
WHERE ts >= {LATEST} - INTERVAL 7 DAY AND ts <= {LATEST}
  AND station_status IN ('empty', 'full') AND time_period = 'morning'"""))
def q_p08(spark, sf):
    df = P.filter_readings(readings(spark, sf), since="7d", as_of="latest",
                           status=["empty", "full"], period="morning")
    return df.select("station_id", "name", "ts", "station_status", "time_period")


@register("p02_term_full", with_readings("""
SELECT station_id, ts, num_docks_available FROM readings WHERE station_status = 'full'"""))
def q_p02(spark, sf):
    return (readings(spark, sf).filter(P.term("station_status", "full"))
            .select("station_id", "ts", "num_docks_available"))


# ---- dashboard panels -------------------------------------------------------------------
@register("e17_line_bikes_hourly", with_readings(f"""
SELECT date_trunc('hour', ts) AS bucket, {r2('avg(num_bikes_available)')} AS avg_bikes, count(*) AS doc_count
FROM readings GROUP BY 1"""))
def q_e17(spark, sf):
    return panels.hourly_line(readings(spark, sf))


@register("e18_metric_occupancy", with_readings(f"""
SELECT {r2(avg2dp())} AS avg_occupation, count(*) AS doc_count FROM readings"""))
def q_e18(spark, sf):
    return panels.overall_occupancy(readings(spark, sf))


_E19 = f"SELECT name, {r2('avg(num_bikes_available)')} AS avg_bikes, count(*) AS doc_count FROM readings GROUP BY name"


@register("e19_bar_most_bikes", with_readings(f"SELECT * FROM ({_E19}) x ORDER BY avg_bikes DESC, name LIMIT 15"))
def q_e19(spark, sf):
    return panels.names_by_bikes(readings(spark, sf))


@register("e19_bar_least_bikes", with_readings(f"SELECT * FROM ({_E19}) x ORDER BY avg_bikes ASC, name LIMIT 15"))
def q_e19_least(spark, sf):
    return panels.names_by_bikes(readings(spark, sf), least=True)


_PERIODS = ["morning", "lunch", "afternoon", "evening", "night"]


@register("e20_heatmap_hour_period", with_readings(
    "SELECT date_trunc('hour', ts) AS bucket, "
    + ", ".join(f"{r2(avg2dp(f'CASE WHEN time_period = {chr(39)}{p}{chr(39)} THEN occupation_rate END'))} AS {p}"
                for p in _PERIODS)
    + " FROM readings GROUP BY 1"))
def q_e20(spark, sf):
    return panels.occupancy_heatmap(readings(spark, sf))


@register("e21_problem_table", with_readings("""
SELECT name, station_id, num_bikes_available, num_docks_available, station_status, ts
FROM readings WHERE station_status IN ('empty', 'full')"""))
def q_e21(spark, sf):
    return panels.problem_table(readings(spark, sf))


_G01 = """
, g AS (SELECT *, row_number() OVER (PARTITION BY station_id
          ORDER BY ts DESC, last_reported DESC, num_bikes_available DESC) AS rn FROM readings)
"""


@register("g01_latest_per_station", with_readings(_G01 + """
SELECT station_id, name, latitude, longitude, occupation_rate, num_bikes_available, num_docks_available,
       station_status, is_installed, is_renting, ts FROM g WHERE rn = 1"""))
def q_g01(spark, sf):
    return panels.latest_per_station(readings(spark, sf))


@register("e22_key_figures", with_readings(_G01 + f"""
SELECT CAST(sum(num_bikes_available) AS BIGINT) AS bikes_available, {r2(avg2dp())} AS avg_occupation,
       {cnt('is_installed AND is_renting')} AS active_stations, count(*) AS stations
FROM g WHERE rn = 1"""))
def q_e22(spark, sf):
    return panels.key_figures(panels.latest_per_station(readings(spark, sf)))


@register("e23_cycle_totals", with_readings("""
SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS collected_at,
       CAST(sum(num_bikes_available) AS BIGINT) AS total_bikes,
       CAST(sum(num_docks_available) AS BIGINT) AS total_docks, count(*) AS stations
FROM readings GROUP BY 1"""))
def q_e23(spark, sf):
    return panels.cycle_totals(readings(spark, sf))


# ---- text search ----------------------------------------------------------------------


def _sql_list(items) -> str:
    return "[" + ", ".join("'" + s.replace("'", "''") + "'" for s in items) + "]"


_TOKENS = rf"""
, ns AS (SELECT name, count(*) AS n_docs FROM readings WHERE name IS NOT NULL GROUP BY name),
tk AS (SELECT name, n_docs,
         list_filter(string_split_regex(lower(name), '[^\p{{L}}\p{{N}}]+'),
                     lambda t: t <> '' AND NOT list_contains({_sql_list(stop_words())}, t)) AS toks
       FROM ns)
"""
_HIT = "r.name, r.station_id, r.ts, r.num_bikes_available, r.station_status"


def _bm25_sql(query: str) -> tuple[str, str]:
    """(extra CTEs, score expression over tk/st/dq) for a BM25 score of ``query``."""
    q = analyze_text(query)
    ctes = [", st AS (SELECT CAST(sum(n_docs) AS DOUBLE) AS n, sum(n_docs * len(toks)) / sum(n_docs) AS avgdl FROM tk)"]
    parts = ["CAST(0.0 AS DOUBLE)"]
    for i, t in enumerate(dict.fromkeys(q)):
        ctes.append(f", dq{i} AS (SELECT COALESCE(sum(n_docs), 0) AS df FROM tk WHERE list_contains(toks, '{t}'))")
    for t in q:
        i = list(dict.fromkeys(q)).index(t)
        tf = f"CAST(len(list_filter(toks, lambda x: x = '{t}')) AS DOUBLE)"
        idf = f"ln(1 + (st.n - dq{i}.df + 0.5) / (dq{i}.df + 0.5))"
        norm = "CAST(1.2 AS DOUBLE) * (1 - CAST(0.75 AS DOUBLE) + CAST(0.75 AS DOUBLE) * len(toks) / st.avgdl)"
        parts.append(f"({idf} * {tf} / ({tf} + {norm}))")
    froms = "tk, st" + "".join(f", dq{i}" for i in range(len(dict.fromkeys(q))))
    return "\n".join(ctes), r(" + ".join(parts), 6), froms


def _match_sql(query: str, operator: str, size: int) -> str:
    q = analyze_text(query)
    ctes, score, froms = _bm25_sql(query)
    joiner = " AND " if operator == "and" else " OR "
    cond = joiner.join(f"list_contains(toks, '{t}')" for t in q) or "false"
    return with_readings(_TOKENS + ctes + f"""
, m AS (SELECT name, {score} AS score FROM {froms} WHERE {cond})
SELECT {_HIT}, m.score FROM readings r JOIN m ON r.name = m.name
ORDER BY m.score DESC, r.ts DESC, r.station_id LIMIT {size}""")


@register("d02_match_and_gizmo", _match_sql("gizmo", "and", 10))
def q_d02(spark, sf):
    return TS.match_terms(readings(spark, sf), "gizmo", "and", 10)


@register("d02_match_and_two_terms", _match_sql("Red Gizmo", "and", 10))
def q_d02b(spark, sf):
    return TS.match_terms(readings(spark, sf), "Red Gizmo", "and", 10)


@register("d02_match_or_red_gizmo", _match_sql("red gizmo", "or", 10))
def q_d02_or(spark, sf):
    """The match request with its default operator (any term)."""
    return TS.match_terms(readings(spark, sf), "red gizmo", "or", 10)


def _scores_sql(query: str) -> str:
    q = analyze_text(query)
    ctes, score, froms = _bm25_sql(query)
    cond = " OR ".join(f"list_contains(toks, '{t}')" for t in q)
    return with_readings(_TOKENS + ctes + f"\nSELECT name, n_docs, {score} AS score FROM {froms} WHERE {cond}")


@register("d08_bm25_name_scores", _scores_sql("red gizmo"))
def q_d08(spark, sf):
    return TS.name_scores(readings(spark, sf), "red gizmo")


def _phrase_sql(query: str, size: int, tokens: str, hits: str = "readings") -> str:
    """Words with their places (stop words keep theirs); the phrase starts at some place i."""
    q = text_positions(query)
    stop = _sql_list(stop_words())
    conds = []
    for k, (pos, t) in enumerate(q):
        word = f"words[i + {pos - q[0][0]}]"
        same = f"starts_with({word}, '{t}')" if k == len(q) - 1 else f"{word} = '{t}'"
        conds.append(f"coalesce({same} AND NOT list_contains({stop}, {word}), false)")
    return with_readings(tokens + rf"""
, wd AS (SELECT name, toks, list_filter(string_split_regex(lower(name), '[^\p{{L}}\p{{N}}]+'), lambda t: t <> '') AS words
         FROM tk),
m AS (SELECT name, len(toks) AS n_tokens FROM wd
      WHERE len(list_filter(range(1, len(words) + 1), lambda i: {' AND '.join(conds)})) > 0)
SELECT {_HIT} FROM {hits} r JOIN m ON r.name = m.name
ORDER BY m.n_tokens, r.ts DESC, r.station_id LIMIT {size}""")


@register("d03_phrase_prefix_red_wid", _phrase_sql("red wid", 20, _TOKENS))
def q_d03(spark, sf):
    return TS.phrase_prefix(readings(spark, sf), "red wid", 20)


@register("d03_phrase_prefix_single", _phrase_sql("Bo", 20, _TOKENS))
def q_d03b(spark, sf):
    return TS.phrase_prefix(readings(spark, sf), "Bo", 20)


# names with stop words: every reading's name put into a French street name
_STREET_SQL = """CASE length(name) % 4 WHEN 0 THEN 'Place de la ' || name WHEN 1 THEN 'Gare du ' || name
                 WHEN 2 THEN 'Rue d''' || name ELSE name || ' Place de la Paix' END"""
_STREETS = f", streets AS (SELECT * REPLACE ({_STREET_SQL} AS name) FROM readings)" + _TOKENS.replace(
    "FROM readings WHERE", "FROM streets WHERE")


def streets(spark: SparkSession, sf: str) -> DataFrame:
    n, k = F.col("name"), F.length("name") % 4
    return readings(spark, sf).withColumn(
        "name", F.when(k == 0, F.concat(F.lit("Place de la "), n)).when(k == 1, F.concat(F.lit("Gare du "), n))
        .when(k == 2, F.concat(F.lit("Rue d'"), n)).otherwise(F.concat(n, F.lit(" Place de la Paix"))))


@register("d03_phrase_prefix_stop_words", _phrase_sql("Place de la Re", 20, _STREETS, "streets"))
def q_d03_stop(spark, sf):
    return TS.phrase_prefix(streets(spark, sf), "Place de la Re", 20)


@register("d03_phrase_prefix_gap", _phrase_sql("Gare Re", 20, _STREETS, "streets"))
def q_d03_gap(spark, sf):
    """The query has no stop word where the names have one: no hit across it."""
    return TS.phrase_prefix(streets(spark, sf), "Gare Re", 20)


@register("d01_name_tokens", with_readings(_STREETS + """
SELECT name, n_docs, array_to_string(toks, ' ') AS tokens FROM tk"""))
def q_d01(spark, sf):
    return (TS.name_dimension(streets(spark, sf))
            .select("name", "n_docs", F.array_join("toks", " ").alias("tokens")))


_GRAMS_SQL = ("list_distinct(flatten(list_transform(toks, lambda t: flatten(["
              "CASE WHEN length(t) >= 3 THEN list_transform(range(1, length(t) - 1), lambda i: substring(t, i, 3)) ELSE [] END, "
              "CASE WHEN length(t) >= 4 THEN list_transform(range(1, length(t) - 2), lambda i: substring(t, i, 4)) ELSE [] END"
              "]))))")


@register("d04_ngram_gadget", with_readings(_TOKENS + f"""
, m AS (SELECT name, len(list_intersect({_GRAMS_SQL}, {_sql_list(ngrams_text(analyze_text('gadget')))})) AS shared FROM tk)
SELECT {_HIT}, m.shared FROM readings r JOIN m ON r.name = m.name WHERE m.shared > 0
ORDER BY m.shared DESC, r.ts DESC, r.station_id LIMIT 20"""))
def q_d04(spark, sf):
    return TS.ngram_match(readings(spark, sf), "gadget", 20)


def _fuzzy_sql(value: str, size: int = 10, max_expansions: int | None = 50, prefix: int = 1,
               k: int | None = None, hit: str = _HIT) -> str:
    v = value.lower()
    k = TS.auto_fuzziness(len(v)) if k is None else k
    top = f"ORDER BY distance, term LIMIT {max_expansions}" if max_expansions else ""
    return with_readings(_TOKENS + f"""
, vocab AS (SELECT DISTINCT unnest(toks) AS term FROM tk),
ex AS (SELECT term, CAST(damerau_levenshtein(term, '{v}') AS INTEGER) AS distance FROM vocab
       WHERE abs(length(term) - {len(v)}) <= {k} AND left(term, {prefix}) = '{v[:prefix]}'
         AND damerau_levenshtein(term, '{v}') <= {k}
       {top}),
nt AS (SELECT name, unnest(list_distinct(toks)) AS term FROM tk),
m AS (SELECT nt.name, min(ex.distance) AS distance FROM nt JOIN ex ON nt.term = ex.term GROUP BY nt.name)
SELECT {hit}, m.distance FROM readings r JOIN m ON r.name = m.name
ORDER BY m.distance, r.ts DESC, r.station_id LIMIT {size}""")


@register("d05_fuzzy_gizom", _fuzzy_sql("gizom"))
def q_d05(spark, sf):
    """The request's own bounds: same first letter, the 50 closest terms."""
    return TS.fuzzy_match(readings(spark, sf), "gizom", prefix_length=1, max_expansions=50)


@register("d05_fuzzy_gizmmo", _fuzzy_sql("Gizmmo"))
def q_d05b(spark, sf):
    return TS.fuzzy_match(readings(spark, sf), "Gizmmo", prefix_length=1, max_expansions=50)


@register("d05_fuzzy_all_expansions", _fuzzy_sql(
    "gadgte", 10_000, None, 0, 5, "r.name, r.station_id, r.ts, r.latitude, r.longitude"))
def q_d05_all(spark, sf):
    """Every term within five edits, whatever its first letter, with the place of each hit."""
    return TS.fuzzy_match(readings(spark, sf), "gadgte", fuzziness=5, size=10_000,
                          fields=("name", "station_id", "ts", "latitude", "longitude"))


@register("d06_autocomplete_sm", with_readings("""
SELECT DISTINCT name FROM readings WHERE starts_with(lower(name), 'sm') ORDER BY name LIMIT 10"""))
def q_d06(spark, sf):
    return TS.autocomplete(readings(spark, sf), "Sm", 10)


@register("d07_edge_ngram_gi_wid", with_readings(_TOKENS + f"""
, m AS (SELECT name, len(list_filter({_sql_list(analyze_text('gi wid'))},
          lambda q: len(list_filter(toks, lambda t: starts_with(t, q))) > 0)) AS matched FROM tk)
SELECT {_HIT}, m.matched FROM readings r JOIN m ON r.name = m.name WHERE m.matched > 0
ORDER BY m.matched DESC, r.ts DESC, r.station_id LIMIT 10"""))
def q_d07(spark, sf):
    return TS.edge_ngram_match(readings(spark, sf), "gi wid", 10)


# ---- store upkeep, preview, build-side dedup ------------------------------------------


@register("a10_preview_first5", with_readings("""
SELECT name, num_bikes_available, num_docks_available, occupation_rate, station_status
FROM readings ORDER BY ts, station_id LIMIT 5"""))
def q_a10(spark, sf):
    return ST.preview(readings(spark, sf))


@register("a10_count", with_readings("SELECT count(*) AS total_records FROM readings"))
def q_a10_count(spark, sf):
    return readings(spark, sf).agg(F.count(F.lit(1)).alias("total_records"))


@register("a13_day_counts", with_readings("SELECT dt, count(*) AS doc_count FROM readings GROUP BY dt"))
def q_a13(spark, sf):
    return ST.day_counts(readings(spark, sf))


@register("a14_retained_7d_by_day", with_readings("""
SELECT dt, count(*) AS doc_count FROM readings
WHERE dt >= (SELECT max(dt) FROM readings) - INTERVAL 7 DAY GROUP BY dt"""))
def q_a14(spark, sf):
    return ST.day_counts(ST.retain(readings(spark, sf), 7, as_of="latest"))


@register("a14_expired_7d", with_readings("""
SELECT DISTINCT dt FROM readings WHERE dt < (SELECT max(dt) FROM readings) - INTERVAL 7 DAY"""))
def q_a14_expired(spark, sf):
    return ST.expired_days(readings(spark, sf), 7, as_of="latest")


@register("b02_dedup_last_by_name", """
WITH info AS (
  SELECT p_name || CASE WHEN p_partkey % 3 = 0 THEN ' ' || CAST(75001 + p_partkey % 20 AS VARCHAR) ELSE '' END AS name,
         CAST(p_partkey AS VARCHAR) AS station_id, p_partkey AS pos,
         CAST(CASE WHEN p_partkey % 19 = 18 THEN 0 ELSE p_size END AS BIGINT) AS capacity
  FROM part WHERE p_partkey % 17 <> 16),
ranked AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY pos DESC) AS rn FROM info)
SELECT name, station_id, capacity FROM ranked WHERE rn = 1""")
def q_b02(spark, sf):
    """B02 over info entries keyed by name: the entry with the greatest key wins."""
    info = station_info(spark, sf).select("name", "station_id", "capacity",
                                          F.col("station_id").cast("bigint").alias("pos"))
    return dedup_last(info, "name", "pos").select("name", "station_id", "capacity")


# ---- stored readings, columns beyond the core list, flags, document -------------------


@register("a04_store_scan", with_readings(f"SELECT {_reading_cols_sql()} FROM readings"))
def q_a04(spark, sf):
    """A06 then A04: the readings written to a day store below the shared folder and read back."""
    path = checkpoint_path(spark, f"store-{uuid.uuid4().hex}")
    ST.write_store(readings(spark, sf), path)
    return as_double(ST.read_store(spark, path).select(*[c.strip() for c in READING_COLS.split(",")]))


@register("a06_compacted_scan", with_readings(f"SELECT {_reading_cols_sql()} FROM readings"))
def q_a06(spark, sf):
    """All readings in three writes, compacted day by day, and a write that is repeated afterwards."""
    path = _store(spark, sf, batches=3)
    CO.compact_store(spark, path)
    ST.write_store(readings(spark, sf).filter(F.pmod(F.xxhash64("station_id", "ts"), F.lit(3)) == 1), path, "b1")
    return as_double(ST.read_store(spark, path).select(*[c.strip() for c in READING_COLS.split(",")]))


@register("c04_c07_c09_columns", with_readings("""
SELECT station_id, ts, 'station_feed' AS source, 'Paris' AS city, 'stationlake-ingest' AS pipeline,
       'bike_sharing' AS data_type, last_reported AS last_reported_epoch,
       latitude AS location_lat, longitude AS location_lon
FROM readings"""))
def q_c_columns(spark, sf):
    """C04 labels, C07 last report as a time (shown as its epoch), C09 point (flattened)."""
    return readings(spark, sf).select(
        "station_id", "ts", "source", "city", "pipeline", "data_type",
        F.unix_seconds("last_reported_date").alias("last_reported_epoch"),
        F.col("location.lat").alias("location_lat"), F.col("location.lon").alias("location_lon"))


_FLAG_FORMS = ["true", "false", "1", "0", "2", '"yes"', '" Y "', '"no"', '"2"', "null"]


@register("c06_flag_forms", f"""
SELECT event_id, CASE WHEN event_id % {len(_FLAG_FORMS)} = 9 THEN NULL
                      ELSE event_id % {len(_FLAG_FORMS)} IN (0, 2, 4, 5, 6) END AS flag,
       CASE event_id % 4 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true ELSE NULL END AS flag_text
FROM events""")
def q_c06(spark, sf):
    """C06 on every event: JSON booleans, numbers, text and null, and a plain text column."""
    i = F.col("event_id")
    forms = F.array(*[F.lit(f) for f in _FLAG_FORMS])
    texts = F.array(F.lit(" True"), F.lit("off"), F.lit("1"), F.lit(None).cast("string"))
    rows = table(spark, sf, "events").select(
        "event_id", F.parse_json(F.get(forms, (i % len(_FLAG_FORMS)).cast("int"))).alias("flag"),
        F.get(texts, (i % 4).cast("int")).alias("flag_text"))
    return rows.select("event_id", *[C.truthy(c, rows.schema[c].dataType).alias(c) for c in ("flag", "flag_text")])


@register("e09_document", with_readings("""
SELECT count(*) AS total_observations, count(DISTINCT station_id) AS total_stations,
       CAST(least(10, (SELECT count(*) FROM (SELECT DISTINCT name, station_id FROM readings) g)) AS BIGINT) AS n_top,
       count(DISTINCT hour(ts)) AS n_hours FROM readings"""))
def q_e09_document(spark, sf):
    """E09's nested document, flattened."""
    df = readings(spark, sf)
    doc = stats.global_summary(df, stats.station_availability(df), stats.hourly_patterns(df))
    return doc.select("analysis_period.total_observations", "analysis_period.total_stations",
                      F.size("top_occupied_stations").cast("bigint").alias("n_top"),
                      F.size("hourly_pattern").cast("bigint").alias("n_hours"))


@register("e12_hourly_histogram_clock_change", with_readings(f"""
, f AS (SELECT ts + INTERVAL 280 DAY AS ts, num_bikes_available, electric_bikes, mechanical_bikes, station_id
        FROM readings WHERE station_status = 'full'),
g AS (SELECT * FROM f WHERE ts >= (SELECT max(ts) FROM f) - INTERVAL 30 DAY),
a AS (SELECT date_trunc('hour', ts) AS bucket, count(*) AS doc_count,
             {r2('avg(num_bikes_available)')} AS avg_bikes, {r2('avg(electric_bikes)')} AS avg_electric,
             {r2('avg(mechanical_bikes)')} AS avg_mechanical, count(DISTINCT station_id) AS total_stations
      FROM g GROUP BY 1),
s AS (SELECT unnest(generate_series(min(bucket), max(bucket), INTERVAL 1 HOUR)) AS bucket FROM a)
SELECT s.bucket,
       strftime(timezone('Europe/Paris', s.bucket AT TIME ZONE 'UTC'), '%Y-%m-%d %H:%M:%S') AS bucket_local,
       COALESCE(a.doc_count, 0) AS doc_count, a.avg_bikes, a.avg_electric, a.avg_mechanical,
       COALESCE(a.total_stations, 0) AS total_stations
FROM s LEFT JOIN a ON s.bucket = a.bucket"""))
def q_e12_change(spark, sf):
    """E12 over full stations, moved on 280 days: empty hours and the autumn clock change."""
    df = readings(spark, sf).filter(P.term("station_status", "full"))
    moved = df.withColumn("ts", P.shifted(F.col("ts"), "6720h")).withColumn("dt", C.utc_date("ts"))
    return search.hourly_histogram(moved, since="30d", as_of="latest")


@register("e15_approx_within_error", with_readings("""
SELECT count(DISTINCT station_id) > 0 AS within_error FROM readings"""))
def q_e15_approx(spark, sf):
    """E15's approximate form stays within three standard errors of the exact count."""
    df = readings(spark, sf)
    exact = search.station_cardinality(df, approx=False).scalar()
    approx = search.station_cardinality(df, rsd=0.05)
    return approx.select((F.abs(F.col("total_stations") - exact) <= 0.15 * exact).alias("within_error"))


@register("e15_sketches_7d", with_readings("""
, e AS (SELECT count(DISTINCT station_id) AS n FROM readings
        WHERE ts >= (SELECT max(ts) FROM readings) - INTERVAL 7 DAY)
SELECT n AS exact_stations, true AS within_error FROM e"""))
def q_e15_sketches(spark, sf):
    """E15 over seven days from hourly sketches kept per write, and the readings of the cut hours; against the exact count."""
    df = readings(spark, sf)
    path = checkpoint_path(spark, f"sketches-{uuid.uuid4().hex}")
    for k, own in enumerate([df.filter("num_bikes_available % 2 = 0"), df.filter("NOT num_bikes_available % 2 <=> 0"), df]):
        SK.write_sketches(own, path, f"b{k % 2}" if k < 2 else "all")
    now = P.latest_event(df)
    exact = df.filter(P.time_range("7d", now)).agg(F.count_distinct("station_id")).scalar()
    found = SK.cardinality(SK.read_sketches(spark, path), "7d", now, df)
    error = 3 * 1.04 / math.sqrt(1 << SK.LG_K)
    return found.select(exact.alias("exact_stations"), (F.abs(F.col("total_stations") - exact) <= F.ceil(error * exact)).alias("within_error"))


def _latest_table(spark, sf) -> DataFrame:
    """The kept table of latest readings after batches in odd order, one of them repeated."""
    df = readings(spark, sf)
    path = checkpoint_path(spark, f"latest-{uuid.uuid4().hex}")
    for k in (2, 0, 1, 2):
        STATE.upsert_latest(df.filter(F.pmod(F.xxhash64("station_id", "ts"), F.lit(3)) == k), path, 8)
    return STATE.read_latest(spark, path)


@register("g01_latest_table", ORACLE["g01_latest_per_station"])
def q_g01_table(spark, sf):
    """G01 from the kept table: three micro-batches out of order and one repeated."""
    return _latest_table(spark, sf)


@register("e22_key_figures_table", ORACLE["e22_key_figures"])
def q_e22_table(spark, sf):
    """E22 from the kept table."""
    return panels.key_figures(_latest_table(spark, sf))


@register("d05_fuzzy_kept_index", ORACLE["d05_fuzzy_gizom"])
def q_d05_index(spark, sf):
    """D05 with the deletion neighbourhood written as a table, sorted by variant."""
    df = readings(spark, sf)
    path = checkpoint_path(spark, f"deletions-{uuid.uuid4().hex}")
    TS.deletion_index(TS.name_dimension(df)).repartitionByRange("variant").sortWithinPartitions("variant").write.parquet(path)
    return TS.fuzzy_match(df, "gizom", prefix_length=1, max_expansions=50, index=spark.read.parquet(path))


def _rollup(spark, sf) -> DataFrame:
    """The hourly rollup of all readings, written in three batches, one of them twice."""
    df = readings(spark, sf)
    path = checkpoint_path(spark, f"rollup-{uuid.uuid4().hex}")
    for k in (0, 1, 2, 1):
        RU.write_rollup(df.filter(F.pmod(F.xxhash64("station_id", "ts"), F.lit(3)) == k), path, f"b{k}")
    return RU.read_rollup(spark, path)


@register("e17_hourly_line_rollup", ORACLE["e17_line_bikes_hourly"])
def q_e17_rollup(spark, sf):
    """E17 from the kept rollup."""
    return RU.hourly_line(_rollup(spark, sf))


@register("e20_heatmap_rollup", ORACLE["e20_heatmap_hour_period"])
def q_e20_rollup(spark, sf):
    """E20 from the kept rollup."""
    return RU.occupancy_heatmap(_rollup(spark, sf))


@register("e12_hours_rollup", with_readings(f"""
SELECT date_trunc('hour', ts) AS bucket, count(*) AS doc_count,
       {r2('avg(num_bikes_available)')} AS avg_bikes, {r2('avg(electric_bikes)')} AS avg_electric,
       {r2('avg(mechanical_bikes)')} AS avg_mechanical, count(DISTINCT station_id) AS total_stations
FROM readings GROUP BY 1"""))
def q_e12_rollup(spark, sf):
    """E12's measures of every hour from the kept rollup."""
    return RU.hourly_histogram(_rollup(spark, sf))


def _completions(spark, sf) -> DataFrame:
    path = checkpoint_path(spark, f"completions-{uuid.uuid4().hex}")
    TS.write_completions(TS.name_dimension(readings(spark, sf)), path)
    return spark.read.parquet(path)


@register("d06_autocomplete_table", ORACLE["d06_autocomplete_sm"])
def q_d06_table(spark, sf):
    """D06 as a range of the kept completion table."""
    return TS.autocomplete(readings(spark, sf), "Sm", 10, completions=_completions(spark, sf))


@register("d07_edge_ngram_table", ORACLE["d07_edge_ngram_gi_wid"])
def q_d07_table(spark, sf):
    """D07 as ranges of the kept completion table."""
    return TS.edge_ngram_match(readings(spark, sf), "gi wid", 10, completions=_completions(spark, sf))


@register("b01_asof_info", with_readings("""
SELECT station_id, ts, CASE WHEN name <> 'Unknown' AND ts >= TIMESTAMP '2024-01-15 06:00:00' THEN capacity + 5 ELSE capacity END
  AS capacity, name FROM raw"""))
def q_b01_asof(spark, sf):
    """B01 with versioned info: the capacity grows in the middle of the month, a snapshot between changes nothing."""
    info = station_info(spark, sf).select("station_id", "name", "lat", "lon", "capacity")
    seen = [info.withColumn("seen", F.lit(t).cast("timestamp")) for t in ("2024-01-03T00:00:00Z", "2024-01-09T00:00:00Z")]
    grown = info.withColumns({"capacity": F.col("capacity") + 5, "seen": F.lit("2024-01-15T06:00:00Z").cast("timestamp")})
    status = station_status(spark, sf).withColumn("ts", C.parse_utc("collected_at"))
    joined = AS.join_status_info_asof(status, AS.versions(seen[0].union(seen[1]).union(grown), "station_id", "seen"), "ts")
    return joined.select("station_id", "ts", "capacity", "name")


# ---- streams over the readings, read back -----------------------------------------------


def _topic(spark, sf, work: str) -> DataFrame:
    """The readings as a stream of JSON messages from files; messages of disturbed stations are cut off."""
    messages = KA.encode_messages(EN.to_reading(JO.join_status_info(station_status(spark, sf), station_info(spark, sf))))
    cut = F.get_json_object("value", "$.is_renting") == "0"
    (messages.select(F.when(cut, F.left("value", F.lit(25))).otherwise(F.col("value")).alias("value"))
     .repartition(3).write.text(f"{work}/messages"))
    return spark.readStream.schema("value string").option("maxFilesPerTrigger", 2).text(f"{work}/messages")


@register("w01_topic_store_scan", with_readings(f"SELECT {_reading_cols_sql()} FROM readings WHERE is_renting"))
def q_w01(spark, sf):
    """W01, W03, A02's parse, A06: messages in micro-batches to the day store; a restart adds nothing."""
    work = checkpoint_path(spark, f"topic-{uuid.uuid4().hex}")
    raw = _topic(spark, sf, work)
    for _ in range(2):
        IN.topic_to_store(raw, f"{work}/store", f"{work}/corrupt", f"{work}/cp", "availableNow").awaitTermination()
    return as_double(ST.read_store(spark, f"{work}/store").select(*[c.strip() for c in READING_COLS.split(",")]))


@register("w01_corrupt_messages", with_readings("SELECT count(*) AS messages FROM readings WHERE NOT is_renting"))
def q_w01_corrupt(spark, sf):
    """Messages that don't parse reach the corrupt store, all of them."""
    work = checkpoint_path(spark, f"topic-{uuid.uuid4().hex}")
    IN.topic_to_store(_topic(spark, sf, work), f"{work}/store", f"{work}/corrupt", f"{work}/cp", "availableNow").awaitTermination()
    return spark.read.parquet(f"{work}/corrupt").agg(F.count(F.lit(1)).alias("messages"))


@register("e24_delivery_counters", with_readings(f"""
SELECT {cnt('is_renting')} AS ok, {cnt('NOT is_renting')} AS bad,
       {r2("100 * CAST(sum(CASE WHEN is_renting THEN 0 ELSE 1 END) AS DOUBLE) / count(*)")} AS bad_percent FROM readings"""))
def q_e24(spark, sf):
    """The counters that the stream observed, from the table that the progress log keeps."""
    work = checkpoint_path(spark, f"delivery-{uuid.uuid4().hex}")
    log = MO.ProgressLog(spark, f"{work}/log").start()
    try:
        enriched, _ = IN.enrich_stream(IN.observe_quality(KA.parse_messages(_topic(spark, sf, work))))
        IN.write_days(enriched, f"{work}/store", f"{work}/cp", "availableNow").awaitTermination()
    finally:
        log.stop()
    return MO.delivery_counters(MO.delivery_log(spark, f"{work}/log")).select("ok", "bad", "bad_percent")


def _reading_stream(spark, sf, work: str) -> DataFrame:
    readings(spark, sf).drop("num_bikes_available_types").write.parquet(f"{work}/readings")
    return spark.readStream.schema(spark.read.parquet(f"{work}/readings").schema).parquet(f"{work}/readings")


@register("w04_fan_out", with_readings("""
SELECT sink, count(*) AS doc_count, CAST(sum(num_bikes_available) AS BIGINT) AS total_bikes
FROM readings, (VALUES ('second'), ('store')) s(sink) GROUP BY sink"""))
def q_w04(spark, sf):
    """Every reading reaches the day store and the second sink once."""
    work = checkpoint_path(spark, f"fanout-{uuid.uuid4().hex}")
    IN.fan_out(_reading_stream(spark, sf, work), f"{work}/store",
               lambda batch, i: batch.write.mode("overwrite").parquet(f"{work}/second/batch={i}"), f"{work}/cp", "availableNow").awaitTermination()
    sinks = {"store": ST.read_store(spark, f"{work}/store"), "second": spark.read.parquet(f"{work}/second")}
    counted = [df.agg(F.lit(k).alias("sink"), F.count(F.lit(1)).alias("doc_count"), F.sum("num_bikes_available").alias("total_bikes"))
               for k, df in sinks.items()]
    return counted[0].union(counted[1])


@register("w05_live_hourly", with_readings(f"""
SELECT date_trunc('hour', ts) AS bucket, count(*) AS doc_count, {r2('avg(num_bikes_available)')} AS avg_bikes,
       {r2(avg2dp())} AS avg_occupation
FROM readings GROUP BY 1
HAVING date_trunc('hour', min(ts)) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM readings) - INTERVAL 10 MINUTE"""))
def q_w05(spark, sf):
    """The hours that the watermark has closed, written by the stream and read back."""
    work = checkpoint_path(spark, f"live-{uuid.uuid4().hex}")
    live = IN.live_hourly(_reading_stream(spark, sf, work))
    (live.writeStream.format("parquet").option("path", f"{work}/hours").option("checkpointLocation", f"{work}/cp")
     .trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(f"{work}/hours")


@register("w05_corrected_hours", with_readings(f"""
SELECT date_trunc('hour', ts) AS bucket, count(*) AS doc_count, {r2('avg(num_bikes_available)')} AS avg_bikes,
       {r2(avg2dp())} AS avg_occupation FROM readings GROUP BY 1"""))
def q_w05_corrected(spark, sf):
    """W05 with corrections: the readings in an order that has nothing to do with time, one file per micro-batch."""
    work = checkpoint_path(spark, f"hours-{uuid.uuid4().hex}")
    readings(spark, sf).select("ts", "num_bikes_available", "occupation_rate", "station_id").repartition(4, "station_id").write.parquet(f"{work}/in")
    stream = spark.readStream.schema(spark.read.parquet(f"{work}/in").schema).option("maxFilesPerTrigger", 1).parquet(f"{work}/in")
    IN.hours_to_table(stream, f"{work}/hours", "60 days", f"{work}/cp", "availableNow").awaitTermination()
    return IN.read_hours(spark, f"{work}/hours")


@register("a05_excluded_fields", with_readings("SELECT station_id, ts, name, station_status FROM readings"))
def q_a05(spark, sf):
    """The store without the fields that are left out."""
    keep = ("station_id", "ts", "name", "station_status")
    df = readings(spark, sf)
    return ST.read_store(spark, _store(spark, sf), exclude=[c for c in df.columns if c not in keep])


@register("e23_cycle_totals_hourly", with_readings("""
SELECT strftime(ts, '%Y-%m-%dT%H') AS collected_at, CAST(sum(num_bikes_available) AS BIGINT) AS total_bikes,
       CAST(sum(num_docks_available) AS BIGINT) AS total_docks, count(*) AS stations
FROM readings GROUP BY 1"""))
def q_e23_hourly(spark, sf):
    """E23 with cycles of an hour: groups of several stations."""
    return panels.cycle_totals(readings(spark, sf).withColumn("collected_at", F.substring("collected_at", 1, 13)))
