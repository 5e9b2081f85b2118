"""Station status x station information."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.functions.columns import DEFAULT_NAME


def last_rows(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per ``key``: the one with the greatest ``order`` columns (a NULL is smallest).

    A hash aggregate finds the greatest first order column per key; only rows that hold it
    are compared further, so a key with a third of all rows is combined map-side and its
    rows are never sorted.
    """
    others = [c for c in df.columns if c != key]
    most = df.groupBy(F.col(key).alias("_key")).agg(F.max(order[0]).alias("_most"))
    last = df.join(most, df[key].eqNullSafe(F.col("_key")) & df[order[0]].eqNullSafe(F.col("_most")))
    rest = F.struct(*order[1:], *[c for c in others if c not in order and _ordered(df, c)])
    return last.groupBy(key).agg(F.max_by(F.struct(*others), rest).alias("_r")).select(key, "_r.*")


def _ordered(df: DataFrame, col: str) -> bool:
    """Whether a column can break a tie (arrays, structs and variants are left out)."""
    return df.schema[col].dataType.simpleString() in ("string", "bigint", "int", "double", "boolean", "timestamp", "date")


def dedup_last(df: DataFrame, key: str, *order: str) -> DataFrame:
    """One row per ``key``: the row with the greatest ``order`` (the last one wins)."""
    return last_rows(df, key, list(order))


def join_status_info(status: DataFrame, info: DataFrame) -> DataFrame:
    """Left outer equi-join of status rows to station info, with the poller's defaults.

    ``info`` needs ``station_id, name, lat, lon, capacity`` (one row per station, see
    :func:`dedup_last`). Spark broadcasts it when its size in bytes is below the session's
    threshold; otherwise it is a shuffle join that adaptive execution splits where one
    station is hot. Missing info gives name 'Unknown', coordinates 0, capacity 0.
    """
    side = info.select(
        "station_id",
        F.col("name").alias("_i_name"), F.col("lat").alias("_i_lat"),
        F.col("lon").alias("_i_lon"), F.col("capacity").alias("_i_capacity"),
    )
    joined = status.join(side, "station_id", "left")
    return (joined
            .withColumn("name", F.coalesce(F.col("_i_name"), F.lit(DEFAULT_NAME)))
            .withColumn("latitude", F.coalesce(F.col("_i_lat"), F.lit(0.0)))
            .withColumn("longitude", F.coalesce(F.col("_i_lon"), F.lit(0.0)))
            .withColumn("capacity", F.coalesce(F.col("_i_capacity"), F.lit(0)).cast("bigint"))
            .drop("_i_name", "_i_lat", "_i_lon", "_i_capacity"))
