"""Hourly rollup kept by the stream (E17, E18, E20, E12): panels read hours x stations, not readings.

A row holds counts and integer sums of one (hour, station) of one write; averages are worked
out from the sums only when they are read. Sums of different writes add up, in whatever
order they come and however late, and a write that is repeated replaces its own rows
(same (day, write) folders as the store). ``final_hours`` keeps a watermark: hours that ended
before it can be folded by ``fold``, so a day's rows don't grow with the number of writes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stationlake.functions.columns import PERIOD_NAMES, round2, utc_hour
from stationlake.sources.compaction import BATCH

#: measure -> what is summed; occupancy has two decimals and is summed in hundredths.
MEASURES = {"num_bikes_available": 1, "num_docks_available": 1, "electric_bikes": 1, "mechanical_bikes": 1, "occupation_rate": 100}
SUMS = [f"{kind}_{m}" for m in MEASURES for kind in ("sum", "n")]
SCHEMA = ("bucket timestamp, station_id string, time_period string, n bigint, "
          + ", ".join(f"{c} bigint" for c in SUMS) + ", dt date, batch string")
KEYS = ["dt", "bucket", "station_id", "time_period"]


def hourly_rows(df: DataFrame) -> DataFrame:
    """The rollup of readings: keys, ``n`` readings, sums and numbers of known values per measure."""
    sums = []
    for m, scale in MEASURES.items():
        whole = F.col(m) if scale == 1 else F.round(F.col(m) * scale).cast("bigint")
        sums += [F.sum(whole).cast("bigint").alias(f"sum_{m}"), F.count(m).alias(f"n_{m}")]
    return df.groupBy("dt", utc_hour("ts").alias("bucket"), "station_id", "time_period").agg(F.count(F.lit(1)).alias("n"), *sums)


def merged(rollup: DataFrame) -> DataFrame:
    """One row per (hour, station), whatever the number of writes."""
    return rollup.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in ["n", *SUMS]])


def write_rollup(df: DataFrame, path: str, batch: str) -> None:
    """Adds the rollup of one write; the same ``batch`` again replaces its days."""
    (hourly_rows(df).withColumn(BATCH, F.lit(batch)).sortWithinPartitions("dt", BATCH, "bucket", "station_id")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt", BATCH).parquet(path))


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path).drop(BATCH)


def _mean(measure: str) -> Column:
    scale = MEASURES[measure]
    return round2(F.try_divide(F.sum(f"sum_{measure}").cast("double"), F.sum(f"n_{measure}") * F.lit(scale)))


def hourly_line(rollup: DataFrame, metric: str = "num_bikes_available", alias: str = "avg_bikes") -> DataFrame:
    """E17 from the rollup."""
    return rollup.groupBy("bucket").agg(_mean(metric).alias(alias), F.sum("n").alias("doc_count")).orderBy("bucket")


def overall_occupancy(rollup: DataFrame) -> DataFrame:
    """E18 from the rollup."""
    return rollup.agg(_mean("occupation_rate").alias("avg_occupation"), F.coalesce(F.sum("n"), F.lit(0)).alias("doc_count"))


def occupancy_heatmap(rollup: DataFrame) -> DataFrame:
    """E20 from the rollup."""
    return rollup.groupBy("bucket").pivot("time_period", PERIOD_NAMES).agg(_mean("occupation_rate")).orderBy("bucket")


def hourly_histogram(rollup: DataFrame) -> DataFrame:
    """E12's measures per hour from the rollup, distinct stations counted exactly."""
    return (rollup.groupBy("bucket").agg(
        F.sum("n").alias("doc_count"), _mean("num_bikes_available").alias("avg_bikes"), _mean("electric_bikes").alias("avg_electric"),
        _mean("mechanical_bikes").alias("avg_mechanical"), F.count_distinct("station_id").alias("total_stations")).orderBy("bucket"))


def final_hours(rollup: DataFrame, lateness_hours: int = 2) -> Column:
    """The watermark as a scalar subquery: hours that begin before it are ended, and no later
    than ``lateness_hours`` behind the newest one."""
    return rollup.agg((F.max("bucket") - F.make_dt_interval(hours=F.lit(lateness_hours))).alias("w")).scalar()


def fold(spark: SparkSession, path: str, target: str, lateness_hours: int = 2) -> None:
    """Writes the merged rows of all days that are final as a new rollup at ``target``, other rows as they are."""
    rows = read_rollup(spark, path)
    day = final_hours(rows, lateness_hours).cast("date")
    done = merged(rows.filter(F.col("dt") < day))
    (done.unionByName(rows.filter(F.col("dt") >= day)).withColumn(BATCH, F.lit("folded"))
     .sortWithinPartitions("dt", BATCH, "bucket", "station_id").write.partitionBy("dt", BATCH).parquet(target))


def rollup_stream(enriched: DataFrame, path: str, checkpoint: str | None = None, trigger="60 seconds", name: str = "rollup") -> StreamingQuery:
    """Keeps the rollup up to date from a stream of enriched readings."""
    from stationlake.streaming.ingest import _each_batch

    return _each_batch(enriched, lambda batch, own, _: write_rollup(batch, path, own), name, checkpoint, trigger)
