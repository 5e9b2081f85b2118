"""DuckDB forms of the registered queries (the correctness oracle).

``READINGS_CTE`` derives the fixture feeds and the enriched readings from the
driver tables with the same arithmetic as :mod:`stationlake.sources.fixtures` and
the enrichment chain, written independently in plain SQL.
"""

from __future__ import annotations


def r2(expr: str) -> str:
    """Half-up rounding to 2 decimals on the shortest decimal form, like Spark ``round``."""
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE)"


def r(expr: str, digits: int) -> str:
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def avg2dp(expr: str = "occupation_rate") -> str:
    """Exact mean of a 2-decimal column: whole hundredths summed, one division."""
    return (f"CAST(sum(CAST(round(({expr}) * 100) AS BIGINT)) AS DOUBLE) "
            f"/ (CAST(count({expr}) AS DOUBLE) * 100.0)")


def cnt(cond: str) -> str:
    return f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"


READINGS_CTE = r"""
WITH station_info AS (
  SELECT CAST(p_partkey AS VARCHAR) AS station_id,
         p_name || CASE WHEN p_partkey % 3 = 0 THEN ' ' || CAST(75001 + p_partkey % 20 AS VARCHAR) ELSE '' END AS name,
         CAST(48.8584 AS DOUBLE) + CAST((p_partkey * 7) % 41 - 20 AS DOUBLE) * CAST(0.0005 AS DOUBLE) AS lat,
         CAST(2.2945 AS DOUBLE) + CAST((p_partkey * 11) % 41 - 20 AS DOUBLE) * CAST(0.0005 AS DOUBLE) AS lon,
         CAST(CASE WHEN p_partkey % 19 = 18 THEN 0 ELSE p_size END AS BIGINT) AS capacity
  FROM part WHERE p_partkey % 17 <> 16
),
status AS (
  SELECT CAST(e.user_id AS VARCHAR) AS station_id, e.event_id, CAST(e.ts AS TIMESTAMP) AS ts,
         CAST(floor(epoch(e.ts)) AS BIGINT) - e.event_id % 90 AS last_reported,
         e.event_type = 'error' AS err,
         CAST(floor(e.value) AS BIGINT) % (p.p_size + 1) AS b,
         CAST(p.p_size AS BIGINT) AS p_size,
         CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS k
  FROM events e JOIN part p ON e.user_id = p.p_partkey
),
raw AS (
  SELECT s.station_id, s.ts, s.last_reported,
         COALESCE(i.name, 'Unknown') AS name,
         COALESCE(i.lat, CAST(0 AS DOUBLE)) AS latitude,
         COALESCE(i.lon, CAST(0 AS DOUBLE)) AS longitude,
         COALESCE(i.capacity, CAST(0 AS BIGINT)) AS capacity,
         CASE WHEN s.err THEN CAST(0 AS BIGINT) ELSE s.b END AS num_bikes_available,
         CASE WHEN s.err THEN CAST(0 AS BIGINT) ELSE s.p_size - s.b END AS num_docks_available,
         CASE WHEN s.err THEN NULL ELSE s.b - s.k % (s.b + 1) END AS mechanical_bikes,
         CASE WHEN s.err THEN NULL ELSE s.k % (s.b + 1) END AS electric_bikes,
         TRUE AS is_installed, NOT s.err AS is_returning, NOT s.err AS is_renting
  FROM status s LEFT JOIN station_info i ON s.station_id = i.station_id
),
readings AS (
  SELECT *,
    CAST(CASE WHEN capacity > 0 THEN round_even(num_bikes_available / capacity * 100, 2) ELSE 0 END AS DOUBLE)
      AS occupation_rate,
    CASE WHEN capacity <= 0 THEN 'unknown'
         WHEN num_bikes_available = 0 THEN 'empty'
         WHEN num_docks_available = 0 THEN 'full'
         WHEN num_bikes_available < capacity * CAST(0.2 AS DOUBLE) THEN 'low'
         WHEN num_docks_available < capacity * CAST(0.2 AS DOUBLE) THEN 'almost_full'
         ELSE 'available' END AS station_status,
    CAST(hour(ts) AS INTEGER) AS hour_of_day,
    CASE WHEN hour(ts) >= 6 AND hour(ts) < 12 THEN 'morning'
         WHEN hour(ts) >= 12 AND hour(ts) < 14 THEN 'lunch'
         WHEN hour(ts) >= 14 AND hour(ts) < 19 THEN 'afternoon'
         WHEN hour(ts) >= 19 AND hour(ts) < 22 THEN 'evening'
         ELSE 'night' END AS time_period,
    CASE WHEN regexp_matches(name, '\d{5}') THEN
      TRY_CAST(trunc(TRY_CAST(regexp_extract(name, '[+-]?([0-9]+(\.[0-9]+)?|\.[0-9]+)', 0) AS DOUBLE)) AS INTEGER)
    END AS arrondissement,
    CAST(ts AS DATE) AS dt
  FROM raw
)
"""


def with_readings(select_sql: str) -> str:
    return READINGS_CTE + select_sql
