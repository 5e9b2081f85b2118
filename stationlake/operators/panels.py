"""Dashboard panels (E17-E23, G01): the data behind each chart, as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.functions.columns import PERIOD_NAMES, count_when, mean_2dp, round2, utc_hour
from stationlake.operators.join import last_rows
from stationlake.operators.predicates import terms

LATEST_COLUMNS = ["name", "latitude", "longitude", "occupation_rate", "num_bikes_available",
                  "num_docks_available", "station_status", "is_installed", "is_renting", "ts"]
LATEST_ORDER = ["ts", "last_reported", "num_bikes_available"]


def hourly_line(df: DataFrame, metric: str = "num_bikes_available", alias: str = "avg_bikes") -> DataFrame:
    """Average of one metric per UTC hour bucket (buckets with data only)."""
    return (df.groupBy(utc_hour("ts").alias("bucket"))
            .agg(round2(F.avg(metric)).alias(alias), F.count(F.lit(1)).alias("doc_count"))
            .orderBy("bucket"))


def overall_occupancy(df: DataFrame) -> DataFrame:
    """The global average occupancy, one row."""
    return df.agg(round2(mean_2dp("occupation_rate")).alias("avg_occupation"),
                  F.count(F.lit(1)).alias("doc_count"))


def names_by_bikes(df: DataFrame, n: int = 15, least: bool = False) -> DataFrame:
    """The ``n`` best (or, with ``least``, worst) supplied names by average bikes."""
    agg = df.groupBy("name").agg(round2(F.avg("num_bikes_available")).alias("avg_bikes"),
                                 F.count(F.lit(1)).alias("doc_count"))
    o = F.col("avg_bikes").asc() if least else F.col("avg_bikes").desc()
    return agg.orderBy(o, "name").limit(n)


def occupancy_heatmap(df: DataFrame) -> DataFrame:
    """Average occupancy per hour bucket x period of day (one column per period).

    The pivot values are given, so Spark plans a single aggregation without a
    distinct-values pass.
    """
    return (df.groupBy(utc_hour("ts").alias("bucket"))
            .pivot("time_period", PERIOD_NAMES)
            .agg(round2(mean_2dp("occupation_rate")))
            .orderBy("bucket"))


def problem_table(df: DataFrame) -> DataFrame:
    """Readings of empty or full stations."""
    return (df.filter(terms("station_status", ["empty", "full"]))
            .select("name", "station_id", "num_bikes_available", "num_docks_available",
                    "station_status", "ts"))


def latest_per_station(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Each station's latest reading (map layer: point, occupancy colour, tooltip).

    A hash aggregate finds each station's latest time; only readings at that time are
    compared further, so a station with a huge history is combined map-side.
    """
    cols = cols or LATEST_COLUMNS
    return latest_rows(df, cols).select("station_id", *cols)


def latest_rows(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """G01 with the columns that decide which reading is the latest, so results can be merged again."""
    rows = df.select("station_id", *dict.fromkeys([*(cols or LATEST_COLUMNS), *LATEST_ORDER]))
    return last_rows(rows, "station_id", LATEST_ORDER).select(*rows.columns)


def key_figures(latest: DataFrame) -> DataFrame:
    """Bikes available now, average occupancy now, active stations.

    "Active" (installed and renting) is this library's definition.
    """
    return latest.agg(F.sum("num_bikes_available").alias("bikes_available"),
                      round2(mean_2dp("occupation_rate")).alias("avg_occupation"),
                      count_when(F.col("is_installed") & F.col("is_renting")).alias("active_stations"),
                      F.count(F.lit(1)).alias("stations"))


def cycle_totals(df: DataFrame) -> DataFrame:
    """Bikes and docks summed per collection cycle."""
    return (df.groupBy("collected_at")
            .agg(F.sum("num_bikes_available").alias("total_bikes"),
                 F.sum("num_docks_available").alias("total_docks"),
                 F.count(F.lit(1)).alias("stations")))
