"""Station feeds derived from the driver tables (``part``, ``events``).

The rules are those of FIXTURES.md §3; the DuckDB side of the checks derives the
same views with the same arithmetic (see ``stationlake.oracle``).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.functions.columns import iso_utc

# ---- fixed values of the fixture derivation (FIXTURES.md §3) ----------------------
NO_INFO_MOD, NO_INFO_REM = 17, 16          # p_partkey % 17 = 16 -> station without info
DISTRICT_MOD, DISTRICT_BASE, DISTRICT_SPAN = 3, 75001, 20
ORIGIN_LAT, ORIGIN_LON, STEP_DEG = 48.8584, 2.2945, 0.0005
NO_CAPACITY_MOD, NO_CAPACITY_REM = 19, 18  # p_partkey % 19 = 18 -> capacity 0
LAG_MOD = 90                               # last_reported = epoch(ts) - event_id % 90
# ------------------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def station_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One info row per station: station_id, name, lat, lon, capacity, rental_methods."""
    k = F.col("p_partkey")
    suffix = F.when(k % DISTRICT_MOD == 0,
                    F.concat(F.lit(" "), (F.lit(DISTRICT_BASE) + k % DISTRICT_SPAN).cast("string")))
    return (table(spark, sf_dir, "part")
            .filter(k % NO_INFO_MOD != NO_INFO_REM)
            .select(
                k.cast("string").alias("station_id"),
                F.concat(F.col("p_name"), F.coalesce(suffix, F.lit(""))).alias("name"),
                (F.lit(ORIGIN_LAT) + ((k * 7) % 41 - 20).cast("double") * F.lit(STEP_DEG)).alias("lat"),
                (F.lit(ORIGIN_LON) + ((k * 11) % 41 - 20).cast("double") * F.lit(STEP_DEG)).alias("lon"),
                F.when(k % NO_CAPACITY_MOD == NO_CAPACITY_REM, F.lit(0))
                 .otherwise(F.col("p_size")).cast("bigint").alias("capacity"),
                F.array().cast(T.ArrayType(T.StringType())).alias("rental_methods"),
            ))


def station_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status rows in the raw feed shape (flags as VARIANT), plus ``collected_at``.

    ``events`` x ``part`` on ``user_id = p_partkey``; Spark broadcasts the part side by its
    size in bytes, otherwise it is a shuffle join that adaptive execution can split when
    one station holds a large share of the events.
    """
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("user_id"), "p_size")
    j = (ev.join(parts, "user_id")
         .select("user_id", "event_id", "event_type", "p_size",
                 iso_utc(F.col("ts").cast("timestamp_ntz").cast("string")).alias("collected_at"),
                 (F.floor("value") % (F.col("p_size") + 1)).alias("b"),
                 F.get_json_object("props", "$.k").cast("bigint").alias("k")))
    err = F.col("event_type") == "error"
    b = F.col("b")
    e = F.col("k") % (b + 1)
    collected = F.col("collected_at")
    ok = F.when(err, F.lit("0")).otherwise(F.lit("1"))
    types = F.array(
        F.struct((b - e).alias("mechanical"), F.lit(None).cast("bigint").alias("ebike")),
        F.struct(F.lit(None).cast("bigint").alias("mechanical"), e.alias("ebike")),
    )
    empty_types = F.array().cast("array<struct<mechanical:bigint,ebike:bigint>>")
    return j.select(
        F.col("user_id").cast("string").alias("station_id"),
        collected.alias("collected_at"),
        (F.unix_seconds(F.try_to_timestamp(collected)) - F.col("event_id") % LAG_MOD).alias("last_reported"),
        F.when(~err, b).alias("num_bikes_available"),
        F.when(err, empty_types).otherwise(types).alias("num_bikes_available_types"),
        F.when(~err, F.col("p_size") - b).cast("bigint").alias("num_docks_available"),
        F.parse_json(F.lit("1")).alias("is_installed"),
        F.parse_json(ok).alias("is_returning"),
        F.parse_json(ok).alias("is_renting"),
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched readings: B01 over the two feeds, then the whole enrichment chain."""
    from stationlake.operators.enrich import enrich, to_reading
    from stationlake.operators.join import join_status_info

    return enrich(to_reading(join_status_info(station_status(spark, sf_dir), station_info(spark, sf_dir))))
