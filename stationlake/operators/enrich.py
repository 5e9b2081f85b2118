"""Reading construction (poller side) and enrichment (ingest side), C01-C15.

Both are pure projections: Catalyst collapses the chain into one ``Project`` that
runs inside the scan's codegen stage, in batch and in streaming alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.functions import columns as C
from stationlake.schema import BIKE_TYPES, FLAG_COLUMNS

# fields the ingest removes (Kafka metadata, Logstash event/host decorations)
DROPPED_FIELDS = ("kafka", "event", "host", "@metadata")


def _zero_flag() -> Column:
    return F.parse_json(F.lit("0"))


def to_reading(joined: DataFrame, labels: dict | None = None) -> DataFrame:
    """Status x info row -> one reading message.

    Missing or null counts become 0, a missing bike-type list becomes empty, missing
    flags become 0; occupancy uses the defaulted counts.
    """
    cols = set(joined.columns)
    bikes = F.coalesce(F.col("num_bikes_available"), F.lit(0)).cast("bigint")
    docks = F.coalesce(F.col("num_docks_available"), F.lit(0)).cast("bigint")
    types = (F.coalesce(F.col("num_bikes_available_types"), F.array().cast(BIKE_TYPES))
             if "num_bikes_available_types" in cols else F.array().cast(BIKE_TYPES))
    collected = (F.col("collected_at") if "collected_at" in cols
                 else C.iso_utc(C.utc_text(F.current_timestamp())))

    def flag(name: str) -> Column:
        if name not in cols:
            return _zero_flag().alias(name)
        c = F.col(name)
        dtype = joined.schema[name].dataType
        if isinstance(dtype, T.VariantType):
            return F.coalesce(c, _zero_flag()).alias(name)
        return F.coalesce(c, F.lit(0).cast(dtype)).alias(name)

    return joined.select(
        "station_id",
        collected.alias("collected_at"),
        F.coalesce(F.col("last_reported"), F.lit(0)).cast("bigint").alias("last_reported"),
        "name", "latitude", "longitude", "capacity",
        bikes.alias("num_bikes_available"),
        types.alias("num_bikes_available_types"),
        docks.alias("num_docks_available"),
        *[flag(n) for n in FLAG_COLUMNS],
        C.occupancy_rate(bikes, F.col("capacity")).alias("occupation_rate"),
        *C.label_columns(("source", "city"), labels),
        C.bike_type_count(types, "mechanical").alias("mechanical_bikes"),
        C.bike_type_count(types, "ebike").alias("electric_bikes"),
    )


def enrich(readings: DataFrame, ingest_time: Column | None = None, labels: dict | None = None) -> DataFrame:
    """Reading messages -> enriched readings (C06-C15, plus the ``dt`` day partition).

    ``ingest_time`` is the fallback event time for unparsable ``collected_at``
    (the Kafka record timestamp in a stream; the query time in batch).
    """
    schema = readings.schema
    flags = {n: C.truthy(n, schema[n].dataType).alias(n) for n in FLAG_COLUMNS if n in readings.columns}
    parsed = readings.withColumn("_parsed_ts", C.parse_utc("collected_at"))
    fallback = ingest_time if ingest_time is not None else F.current_timestamp()
    out = parsed.select(
        *[flags.get(c, F.col(c)) for c in readings.columns if c not in DROPPED_FIELDS],
        F.when(F.col("last_reported").isNotNull(), C.unix_to_timestamp("last_reported"))
         .alias("last_reported_date"),
        F.coalesce(F.col("_parsed_ts"), fallback).alias("ts"),
        F.col("_parsed_ts").isNull().alias("ts_parse_failed"),
        C.geo_point("latitude", "longitude").alias("location"),
        C.station_status().alias("station_status"),
        *C.label_columns(("pipeline", "data_type"), labels),
        C.district("name").alias("arrondissement"),
    )
    return (out
            .withColumn("hour_of_day", C.hour_of_day("ts"))
            .withColumn("time_period", C.time_period(F.col("hour_of_day")))
            .withColumn("dt", C.utc_date("ts")))
