"""Explicit schemas of every layer: raw feeds, reading message, enriched reading."""

from __future__ import annotations

from pyspark.sql import types as T

BIKE_TYPES = T.ArrayType(T.StructType([
    T.StructField("mechanical", T.LongType()),
    T.StructField("ebike", T.LongType()),
]))

# station_information feed: data.stations[]
INFO_STATION = T.StructType([
    T.StructField("station_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("capacity", T.LongType()),
    T.StructField("rental_methods", T.ArrayType(T.StringType())),
])
INFO_FEED = T.StructType([
    T.StructField("last_updated", T.LongType()),
    T.StructField("data", T.StructType([T.StructField("stations", T.ArrayType(INFO_STATION))])),
])

# station_status feed: data.stations[]; the three flags may be numbers, booleans or text
STATUS_STATION = T.StructType([
    T.StructField("station_id", T.StringType()),
    T.StructField("last_reported", T.LongType()),
    T.StructField("num_bikes_available", T.LongType()),
    T.StructField("num_bikes_available_types", BIKE_TYPES),
    T.StructField("num_docks_available", T.LongType()),
    T.StructField("is_installed", T.VariantType()),
    T.StructField("is_returning", T.VariantType()),
    T.StructField("is_renting", T.VariantType()),
])
STATUS_FEED = T.StructType([
    T.StructField("last_updated", T.LongType()),
    T.StructField("data", T.StructType([T.StructField("stations", T.ArrayType(STATUS_STATION))])),
])

# one reading message (what the poller publishes, one per station per cycle)
READING = T.StructType([
    T.StructField("station_id", T.StringType()),
    T.StructField("collected_at", T.StringType()),
    T.StructField("last_reported", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("capacity", T.LongType()),
    T.StructField("num_bikes_available", T.LongType()),
    T.StructField("num_bikes_available_types", BIKE_TYPES),
    T.StructField("num_docks_available", T.LongType()),
    T.StructField("is_installed", T.VariantType()),
    T.StructField("is_returning", T.VariantType()),
    T.StructField("is_renting", T.VariantType()),
    T.StructField("occupation_rate", T.DoubleType()),
    T.StructField("source", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("mechanical_bikes", T.LongType()),
    T.StructField("electric_bikes", T.LongType()),
])

LOCATION = T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())])

# columns the enrichment adds to a reading (flags become booleans)
ENRICHED_EXTRA = [
    T.StructField("last_reported_date", T.TimestampType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("ts_parse_failed", T.BooleanType()),
    T.StructField("location", LOCATION),
    T.StructField("station_status", T.StringType()),
    T.StructField("hour_of_day", T.IntegerType()),
    T.StructField("time_period", T.StringType()),
    T.StructField("arrondissement", T.IntegerType()),
    T.StructField("pipeline", T.StringType()),
    T.StructField("data_type", T.StringType()),
    T.StructField("dt", T.DateType()),
]

FLAG_COLUMNS = ("is_installed", "is_returning", "is_renting")

# the enriched reading as stored (flags coerced to booleans, enrichment columns appended)
ENRICHED = T.StructType(
    [T.StructField(f.name, T.BooleanType() if f.name in FLAG_COLUMNS else f.dataType) for f in READING.fields]
    + ENRICHED_EXTRA)
