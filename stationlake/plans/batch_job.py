"""The batch analysis job: five analyses and the global summary, written out.

Plan: ONE pass over the readings. A partial aggregate keyed by (name, station, hour of
day) keeps counts, sums, minima and maxima (occupancy as whole hundredths, so sums are
exact); map-side combining makes a station holding a third of the rows cheap. Its size
is bounded by stations x 24, whatever the number of readings. Every analysis then
re-aggregates that small cached table: per station (E01, E08), per hour (E02), per
period of the hour (E04), per name (E06) and globally (E09). The results are the same
values the stand-alone operators in ``operators/stats.py`` compute with their own scans.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.functions.columns import hour_of_day, rate_pct, round2, time_period
from stationlake.operators.stats import summary_from
from stationlake.sources.sinks import write_csv, write_json
from stationlake.sources.store import cache_base


def _when_both(c: str) -> Column:
    both = F.col("mechanical_bikes").isNotNull() & F.col("electric_bikes").isNotNull()
    return F.when(both, F.col(c))


def partials(readings: DataFrame) -> DataFrame:
    """The one pass: additive pieces per (name, station_id, hour)."""
    occ = F.round(F.col("occupation_rate") * 100).cast("long")
    both = F.col("mechanical_bikes").isNotNull() & F.col("electric_bikes").isNotNull()
    return (readings.groupBy("name", "station_id", hour_of_day("ts").alias("hour"))
            .agg(F.count(F.lit(1)).alias("n"),
                 F.count("num_bikes_available").alias("n_bikes"),
                 F.sum("num_bikes_available").alias("s_bikes"),
                 F.min("num_bikes_available").alias("min_bikes"),
                 F.max("num_bikes_available").alias("max_bikes"),
                 F.count("num_docks_available").alias("n_docks"),
                 F.sum("num_docks_available").alias("s_docks"),
                 F.count("occupation_rate").alias("n_occ"),
                 F.sum(occ).alias("s_occ"),
                 F.sum(F.when(F.col("station_status") == "empty", 1).otherwise(0)).alias("n_empty"),
                 F.sum(F.when(F.col("station_status") == "full", 1).otherwise(0)).alias("n_full"),
                 F.count("mechanical_bikes").alias("n_mech"),
                 F.sum("mechanical_bikes").alias("s_mech"),
                 F.count("electric_bikes").alias("n_elec"),
                 F.sum("electric_bikes").alias("s_elec"),
                 F.sum(F.when(both, 1).otherwise(0)).alias("n_both"),
                 F.sum(_when_both("mechanical_bikes")).alias("s_mech_both"),
                 F.sum(_when_both("electric_bikes")).alias("s_elec_both"),
                 F.sum("capacity").alias("s_capacity")))


def _mean(s: str, n: str) -> Column:
    return F.sum(s) / F.sum(n)


def _occ_mean() -> Column:
    return F.sum("s_occ") / (F.sum("n_occ") * F.lit(100.0))


def _by(p: DataFrame, *keys) -> DataFrame:
    return p.groupBy(*keys)


def station_table(p: DataFrame) -> DataFrame:
    """E01 from the partials."""
    return (_by(p, "name", "station_id")
            .agg(F.sum("n").alias("nb_mesures"),
                 round2(_mean("s_bikes", "n_bikes")).alias("bikes_avg"),
                 F.min("min_bikes").alias("bikes_min"), F.max("max_bikes").alias("bikes_max"),
                 _mean("s_docks", "n_docks").alias("docks_avg"),
                 round2(_occ_mean()).alias("occupation_avg"),
                 F.sum("n_empty").cast("long").alias("times_empty"),
                 F.sum("n_full").cast("long").alias("times_full"),
                 _mean("s_mech", "n_mech").alias("mechanical_avg"),
                 _mean("s_elec", "n_elec").alias("electric_avg"))
            .orderBy(F.col("occupation_avg").desc(), "station_id", "name"))


def hourly_table(p: DataFrame) -> DataFrame:
    """E02 from the partials."""
    return (_by(p, "hour")
            .agg(F.sum("n").alias("nb_mesures"),
                 round2(_mean("s_bikes", "n_bikes")).alias("bikes_avg"),
                 _mean("s_docks", "n_docks").alias("docks_avg"),
                 round2(_occ_mean()).alias("occupation_avg"),
                 F.sum("n_empty").cast("long").alias("stations_empty"),
                 F.sum("n_full").cast("long").alias("stations_full"))
            .orderBy("hour"))


def period_table(p: DataFrame) -> DataFrame:
    """E04 from the partials: the period is a function of the hour."""
    return (_by(p, time_period(F.col("hour")).alias("time_period"))
            .agg(F.sum("n").alias("nb_mesures"),
                 round2(_mean("s_bikes", "n_bikes")).alias("bikes_avg"),
                 round2(_occ_mean()).alias("occupation_avg"),
                 F.sum("n_empty").cast("long").alias("empty_count"),
                 F.sum("n_full").cast("long").alias("full_count")))


def bike_types_table(p: DataFrame) -> DataFrame:
    """E06 from the partials (readings with both types known)."""
    out = (_by(p.filter(F.col("n_both") > 0), "name")
           .agg(round2(_mean("s_mech_both", "n_both")).alias("mechanical_avg"),
                round2(_mean("s_elec_both", "n_both")).alias("electric_avg")))
    return out.withColumn("ratio_electric",
                          rate_pct(F.col("electric_avg"), F.col("mechanical_avg") + F.col("electric_avg")))


def problems_table(stations: DataFrame) -> DataFrame:
    """E08 from the per-station table."""
    return (stations.select("name", "station_id", F.col("nb_mesures").alias("total_observations"),
                            F.col("times_empty").alias("empty_count"), F.col("times_full").alias("full_count"))
            .withColumn("empty_rate", F.round(F.col("empty_count") / F.col("total_observations") * 100, 2))
            .withColumn("full_rate", F.round(F.col("full_count") / F.col("total_observations") * 100, 2))
            .withColumn("problem_rate", F.col("empty_rate") + F.col("full_rate")))


def global_table(p: DataFrame) -> DataFrame:
    """E09 metrics from the partials."""
    return p.agg(F.sum("n").alias("total_observations"),
                 F.count_distinct("station_id").alias("total_stations"),
                 round2(_mean("s_bikes", "n_bikes")).alias("avg_bikes_available"),
                 round2(_mean("s_docks", "n_docks")).alias("avg_docks_available"),
                 round2(_occ_mean()).alias("avg_occupation_rate"),
                 F.sum("s_capacity").alias("total_system_capacity"))


def summary_document(p: DataFrame, stations: DataFrame, hourly: DataFrame, top_n: int = 10) -> DataFrame:
    """The nested summary as one row, from the partials and the two small tables."""
    return summary_from(global_table(p), stations, hourly, top_n)


def run_analysis(readings: DataFrame, out_dir: str, single_file: bool = False) -> dict[str, DataFrame]:
    """Compute and write every analysis from one pass; returns the result frames.

    Results with one row per station or name are written by all tasks unless
    ``single_file`` asks for the one-file layout (fine for a city-sized network).
    """
    p = cache_base(partials(readings))
    stations = cache_base(station_table(p))
    hourly = cache_base(hourly_table(p))
    results = {
        "station_availability": stations,
        "hourly_patterns": hourly,
        "period_analysis": period_table(p),
        "bike_types_analysis": bike_types_table(p),
        "problematic_stations": problems_table(stations),
    }
    bounded = {"hourly_patterns", "period_analysis"}  # at most 24 and 5 rows
    for name, df in results.items():
        write_csv(df, os.path.join(out_dir, name), single_file=single_file or name in bounded)
    summary = summary_document(p, stations, hourly)
    write_json(summary, os.path.join(out_dir, "global_summary"))
    results["global_summary"] = summary
    results["_partials"] = p
    return results


def release(results: dict[str, DataFrame]) -> None:
    for df in results.values():
        df.unpersist()
