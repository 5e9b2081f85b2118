"""Batch analyses of the enriched readings.

All groupings are hash aggregations with map-side partial aggregation, so a station
or hour that holds a large share of the rows is pre-combined before the shuffle.
Rounding follows the batch job: half-up to 2 decimals on the listed columns only,
and ratios are taken of already rounded inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.functions.columns import count_when, hour_of_day, mean_2dp, rate_pct, round2


def _is(status: str):
    return F.col("station_status") == status


def station_availability(df: DataFrame) -> DataFrame:
    """Per (name, station) counts and averages, most occupied first."""
    return (df.groupBy("name", "station_id")
            .agg(F.count(F.lit(1)).alias("nb_mesures"),
                 F.avg("num_bikes_available").alias("bikes_avg"),
                 F.min("num_bikes_available").alias("bikes_min"),
                 F.max("num_bikes_available").alias("bikes_max"),
                 F.avg("num_docks_available").alias("docks_avg"),
                 mean_2dp("occupation_rate").alias("occupation_avg"),
                 count_when(_is("empty")).alias("times_empty"),
                 count_when(_is("full")).alias("times_full"),
                 F.avg("mechanical_bikes").alias("mechanical_avg"),
                 F.avg("electric_bikes").alias("electric_avg"))
            .withColumn("bikes_avg", round2("bikes_avg"))
            .withColumn("occupation_avg", round2("occupation_avg"))
            .orderBy(F.col("occupation_avg").desc(), "station_id", "name"))


def station_count(stats: DataFrame) -> DataFrame:
    """E01 side figure: number of (name, station) groups."""
    return stats.agg(F.count(F.lit(1)).alias("n_groups"))


def hourly_patterns(df: DataFrame) -> DataFrame:
    """Per hour of event time, ordered by hour."""
    return (df.groupBy(hour_of_day("ts").alias("hour"))
            .agg(F.count(F.lit(1)).alias("nb_mesures"),
                 F.avg("num_bikes_available").alias("bikes_avg"),
                 F.avg("num_docks_available").alias("docks_avg"),
                 mean_2dp("occupation_rate").alias("occupation_avg"),
                 count_when(_is("empty")).alias("stations_empty"),
                 count_when(_is("full")).alias("stations_full"))
            .withColumn("bikes_avg", round2("bikes_avg"))
            .withColumn("occupation_avg", round2("occupation_avg"))
            .orderBy("hour"))


def peak_hours(hourly: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` hours of greatest average occupancy (ties: earlier hour)."""
    return hourly.orderBy(F.col("occupation_avg").desc(), "hour").limit(n)


def period_stats(df: DataFrame) -> DataFrame:
    """Per period of the day; a NULL period forms its own group."""
    return (df.groupBy("time_period")
            .agg(F.count(F.lit(1)).alias("nb_mesures"),
                 F.avg("num_bikes_available").alias("bikes_avg"),
                 mean_2dp("occupation_rate").alias("occupation_avg"),
                 count_when(_is("empty")).alias("empty_count"),
                 count_when(_is("full")).alias("full_count"))
            .withColumn("bikes_avg", round2("bikes_avg"))
            .withColumn("occupation_avg", round2("occupation_avg")))


def _types_known(df: DataFrame) -> DataFrame:
    return df.filter(F.col("mechanical_bikes").isNotNull() & F.col("electric_bikes").isNotNull())


def bike_types_overall(df: DataFrame) -> DataFrame:
    """Averages and totals of both bike types over readings where both are known."""
    return _types_known(df).agg(
        F.avg("mechanical_bikes").alias("mechanical_avg"),
        F.avg("electric_bikes").alias("electric_avg"),
        F.sum("mechanical_bikes").alias("mechanical_total"),
        F.sum("electric_bikes").alias("electric_total"))


def bike_types_by_name(df: DataFrame, with_total: bool = False) -> DataFrame:
    """E06 (job form) / E07 (notebook form, ``with_total``): per name, electric share.

    The share is computed from the rounded averages; a name with no bikes at all gets
    a NULL share instead of a division error.
    """
    out = (_types_known(df).groupBy("name")
           .agg(F.avg("mechanical_bikes").alias("mechanical_avg"),
                F.avg("electric_bikes").alias("electric_avg"))
           .withColumn("mechanical_avg", round2("mechanical_avg"))
           .withColumn("electric_avg", round2("electric_avg")))
    total = F.col("mechanical_avg") + F.col("electric_avg")
    if with_total:
        out = out.withColumn("total_avg", total)
        total = F.col("total_avg")
    return out.withColumn("ratio_electric", rate_pct(F.col("electric_avg"), total))


def top_by(df: DataFrame, metric: str, n: int, *tie: str, ascending: bool = False) -> DataFrame:
    """Top ``n`` rows by ``metric`` with a total order (NULLs last), as a top-k."""
    order = F.col(metric).asc_nulls_last() if ascending else F.col(metric).desc_nulls_last()
    return df.orderBy(order, *tie).limit(n)


def problematic_stations(df: DataFrame) -> DataFrame:
    """Empty / full shares per (name, station); problem rate = sum of the rounded shares."""
    return (df.groupBy("name", "station_id")
            .agg(F.count(F.lit(1)).alias("total_observations"),
                 count_when(_is("empty")).alias("empty_count"),
                 count_when(_is("full")).alias("full_count"))
            .withColumn("empty_rate", F.round(F.col("empty_count") / F.col("total_observations") * 100, 2))
            .withColumn("full_rate", F.round(F.col("full_count") / F.col("total_observations") * 100, 2))
            .withColumn("problem_rate", F.col("empty_rate") + F.col("full_rate")))


def problem_rankings(problems: DataFrame) -> dict[str, DataFrame]:
    """E08 rankings: 20 by problem rate, 10 by empty rate, 10 by full rate."""
    return {
        "problem": top_by(problems, "problem_rate", 20, "station_id", "name")
        .select("name", "station_id", "empty_rate", "full_rate", "problem_rate"),
        "empty": top_by(problems, "empty_rate", 10, "station_id", "name").select("name", "station_id", "empty_rate"),
        "full": top_by(problems, "full_rate", 10, "station_id", "name").select("name", "station_id", "full_rate"),
    }


def distinct_stations(df: DataFrame, approx: bool = False, rsd: float = 0.05) -> DataFrame:
    """E16 (exact) / E15 (``approx``: HyperLogLog++ with relative error ``rsd``)."""
    f = F.approx_count_distinct("station_id", rsd) if approx else F.count_distinct("station_id")
    return df.agg(f.alias("total_stations"))


def global_metrics(df: DataFrame) -> DataFrame:
    """E09 metrics: one pass, one row (distinct stations, readings, averages, capacity)."""
    return df.agg(
        F.count(F.lit(1)).alias("total_observations"),
        F.count_distinct("station_id").alias("total_stations"),
        round2(F.avg("num_bikes_available")).alias("avg_bikes_available"),
        round2(F.avg("num_docks_available")).alias("avg_docks_available"),
        round2(mean_2dp("occupation_rate")).alias("avg_occupation_rate"),
        F.sum("capacity").alias("total_system_capacity"))


def summary_from(metrics: DataFrame, station_stats: DataFrame, hourly: DataFrame,
                 top_n: int = 10) -> DataFrame:
    """E09 document from its parts: one-row ``metrics`` (see :func:`global_metrics`), the
    per-station table and the hourly table.

    The ten most occupied stations and the hourly pattern are small by construction
    (at most ``top_n`` and 24 rows); they are gathered with ``collect_list`` inside
    Spark and attached as scalar subqueries, so nothing passes through the driver
    until the one-row result is written.
    """
    top_rows = (top_by(station_stats, "occupation_avg", top_n, "station_id", "name")
                .select(F.struct(*station_stats.columns).alias("r")))
    top = top_rows.agg(F.array_sort(F.collect_list("r"),
                                    lambda a, b: F.when(a["occupation_avg"] > b["occupation_avg"], -1)
                                    .when(a["occupation_avg"] < b["occupation_avg"], 1)
                                    .when(a["station_id"] < b["station_id"], -1)
                                    .when(a["station_id"] > b["station_id"], 1).otherwise(0)))
    hours = hourly.agg(F.array_sort(F.collect_list(F.struct(*hourly.columns))))
    return metrics.select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("generated_at"),
        F.struct("total_observations", "total_stations").alias("analysis_period"),
        F.struct("avg_bikes_available", "avg_docks_available", "avg_occupation_rate",
                 "total_system_capacity").alias("global_statistics"),
        top.scalar().alias("top_occupied_stations"),
        hours.scalar().alias("hourly_pattern"),
    )


def global_summary(df: DataFrame, station_stats: DataFrame, hourly: DataFrame,
                   top_n: int = 10) -> DataFrame:
    """The nested summary document as one row, from the readings."""
    return summary_from(global_metrics(df), station_stats, hourly, top_n)
