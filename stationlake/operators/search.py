"""Aggregating requests and hit lists over the readings.

Terms aggregations are exact here (one hash aggregation with partial
pre-aggregation, then a top-k), where a sharded search engine is approximate.
Averages are rounded to 2 decimals so the order of floating-point addition cannot
show in the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.functions.columns import count_when, mean_2dp, utc_text
from stationlake.operators.predicates import (geo_within, haversine_m, resolve_as_of, term,
                                              time_range)

# fixed value: zone of the date histogram's local bucket labels
DEFAULT_TZ = "Europe/Paris"


def _avg(col: str, alias: str, decimals: int | None = 2) -> Column:
    a = mean_2dp(col) if col == "occupation_rate" else F.avg(col)
    return (F.round(a, decimals) if decimals is not None else a).alias(alias)


def terms_top(agg: DataFrame, key: str, n: int, order: str = "doc_count",
              ascending: bool = False) -> DataFrame:
    """Top ``n`` groups by a sub-metric (or by count), ties by key ascending."""
    o = F.col(order).asc_nulls_last() if ascending else F.col(order).desc_nulls_last()
    return agg.orderBy(o, F.col(key).asc()).limit(n)


def by_status(df: DataFrame, size: int = 10) -> DataFrame:
    """Readings per status with average bikes and occupancy; ``size`` largest groups."""
    agg = (df.filter(F.col("station_status").isNotNull())
           .groupBy("station_status")
           .agg(F.count(F.lit(1)).alias("doc_count"),
                _avg("num_bikes_available", "avg_bikes"),
                _avg("occupation_rate", "avg_occupation")))
    return terms_top(agg, "station_status", size)


def by_district(df: DataFrame, since="1h", as_of=None, size: int = 20) -> DataFrame:
    """Per district in the time range; ``size`` districts with most bikes on average."""
    now = resolve_as_of(df, as_of)
    agg = (df.filter(time_range(since, now, until=False) & F.col("arrondissement").isNotNull())
           .groupBy("arrondissement")
           .agg(F.count(F.lit(1)).alias("doc_count"),
                _avg("num_bikes_available", "avg_bikes"),
                _avg("num_docks_available", "avg_docks"),
                _avg("occupation_rate", "avg_occupation"),
                F.sum("capacity").alias("total_capacity")))
    return terms_top(agg, "arrondissement", size, order="avg_bikes")


def hour_bucket(ts: str = "ts", tz: str = DEFAULT_TZ) -> Column:
    """Start (instant) of the 1-hour bucket, rounded by the offset in force in zone ``tz`` at that instant.

    The two hours that share a local time on an autumn clock change stay apart.
    """
    s = F.unix_seconds(F.col(ts))
    local = F.unix_seconds(F.from_utc_timestamp(F.col(ts), tz))
    return F.timestamp_seconds(s - F.pmod(local, F.lit(3600)))


def hourly_histogram(df: DataFrame, since="24h", as_of=None, tz: str = DEFAULT_TZ,
                     approx_distinct: bool = False) -> DataFrame:
    """1-hour date histogram with empty buckets kept between the first and last.

    Empty buckets have ``doc_count`` 0, NULL averages and 0 distinct stations. The hour
    sequence between the first and the last bucket is left-joined to the hourly aggregate.
    """
    now = resolve_as_of(df, as_of)
    distinct = (F.approx_count_distinct("station_id") if approx_distinct
                else F.count_distinct("station_id"))
    agg = (df.filter(time_range(since, now))
           .groupBy(hour_bucket("ts", tz).alias("bucket"))
           .agg(F.count(F.lit(1)).alias("doc_count"),
                _avg("num_bikes_available", "avg_bikes"),
                _avg("electric_bikes", "avg_electric"),
                _avg("mechanical_bikes", "avg_mechanical"),
                distinct.alias("total_stations")))
    ends = agg.agg(F.min("bucket").alias("lo"), F.max("bucket").alias("hi"))
    hours = ends.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 HOUR"))).alias("bucket"))
    local = utc_text(F.from_utc_timestamp("bucket", tz))
    return (hours.join(agg, "bucket", "left").select(
        "bucket", F.substring(local, 1, 19).alias("bucket_local"),
        F.coalesce("doc_count", F.lit(0)).cast("bigint").alias("doc_count"),
        "avg_bikes", "avg_electric", "avg_mechanical",
        F.coalesce("total_stations", F.lit(0)).cast("bigint").alias("total_stations"))
        .orderBy("bucket"))


def by_period(df: DataFrame, since="7d", as_of=None, size: int = 10) -> DataFrame:
    """Per period of the day in the range, with empty/full counts as filtered sub-counts."""
    now = resolve_as_of(df, as_of)
    agg = (df.filter(time_range(since, now, until=False) & F.col("time_period").isNotNull())
           .groupBy("time_period")
           .agg(F.count(F.lit(1)).alias("doc_count"),
                _avg("occupation_rate", "avg_occupation"),
                _avg("num_bikes_available", "avg_bikes"),
                count_when(F.col("station_status") == "empty").alias("stations_empty"),
                count_when(F.col("station_status") == "full").alias("stations_full")))
    return terms_top(agg, "time_period", size)


def top_names_by_occupation(df: DataFrame, since="24h", as_of=None, size: int = 20) -> DataFrame:
    """Names with the highest average occupancy, with one sample reading each.

    The sample is the latest reading of the name. The averages and the latest time are one
    hash aggregate over the readings; only readings of the ``size`` top names at their latest
    time are compared further.
    """
    now = resolve_as_of(df, as_of)
    rows = df.filter(time_range(since, now, until=False) & F.col("name").isNotNull())
    agg = (rows.groupBy("name")
           .agg(F.count(F.lit(1)).alias("doc_count"),
                _avg("occupation_rate", "avg_occupation"),
                _avg("num_bikes_available", "avg_bikes"),
                F.max("ts").alias("ts")))
    top = terms_top(agg, "name", size, order="avg_occupation")  # ``size`` rows
    sample = F.max_by(F.struct("latitude", "longitude", "capacity"), "station_id").alias("s")
    latest = (rows.select("name", "ts", "station_id", "latitude", "longitude", "capacity")
              .join(F.broadcast(top), ["name", "ts"])
              .groupBy("name", "doc_count", "avg_occupation", "avg_bikes").agg(sample))
    return (terms_top(latest, "name", size, order="avg_occupation")
            .select("name", "doc_count", "avg_occupation", "avg_bikes",
                    F.col("s.latitude").alias("sample_lat"), F.col("s.longitude").alias("sample_lon"),
                    F.col("s.capacity").alias("sample_capacity")))


def station_cardinality(df: DataFrame, approx: bool = True, rsd: float = 0.05) -> DataFrame:
    """Distinct stations; HyperLogLog++ by default, exact on request."""
    f = F.approx_count_distinct("station_id", rsd) if approx else F.count_distinct("station_id")
    return df.agg(f.alias("total_stations"))


def recent_with_status(df: DataFrame, status: str = "empty", since="5m", as_of=None,
                       size: int = 50) -> DataFrame:
    """Latest readings with a given status in the range, newest first."""
    now = resolve_as_of(df, as_of)
    hits = df.filter(term("station_status", status) & time_range(since, now, until=False))
    return (hits.orderBy(F.col("ts").desc(), "station_id").limit(size)
            .select("name", "station_id", "latitude", "longitude", "num_bikes_available",
                    "num_docks_available", "ts"))


def near(df: DataFrame, lat: float, lon: float, radius_m: float = 500.0, since="10m",
         as_of=None, size: int = 20) -> DataFrame:
    """Readings within ``radius_m`` of a point in the range, nearest first (metres).

    Where ``df`` has a ``cell`` column (a store written by cells), its key ranges prune the scan.
    """
    cell = "cell" if "cell" in df.columns else None
    now = resolve_as_of(df, as_of)
    hits = (df.filter(time_range(since, now, until=False)
                      & geo_within("latitude", "longitude", lat, lon, radius_m, cell))
            .withColumn("distance", haversine_m("latitude", "longitude", lat, lon)))
    return (hits.orderBy("distance", F.col("ts").desc(), "station_id").limit(size)
            .select("name", "station_id", "latitude", "longitude", "num_bikes_available",
                    "electric_bikes", "mechanical_bikes", F.round("distance", 2).alias("distance_m"), "ts"))
