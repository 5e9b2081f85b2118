"""As-of join with versioned station information (W06, B02): each reading meets the version valid at its time.

``versions`` turns the snapshots of a slowly changing table into intervals
``valid_from <= t < valid_to`` per key; a snapshot that changes nothing opens no interval.
``asof_join`` is a range merge: an interval is dealt to the UTC days it covers, within the
days that readings have, and joined to the readings by key and day, with the times as
the rest of the condition. Both sides are ordinary equi-join inputs, so Spark broadcasts the
versions where they are small and otherwise shuffles by (key, day), which adaptive
execution splits where one station is hot; no history of a station is sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationlake.functions.columns import DEFAULT_NAME, utc_date
from stationlake.operators.join import last_rows

VALID = ("valid_from", "valid_to")


def versions(snapshots: DataFrame, key: str, at: str) -> DataFrame:
    """Intervals of equal values per ``key`` from rows observed at ``at`` (timestamp).

    Of rows with the same key and time the one with the greatest values counts. Rows without a
    key or time are left out. The last interval has no end.
    """
    values = [c for c in snapshots.columns if c not in (key, at)]
    seen = snapshots.filter(F.col(key).isNotNull() & F.col(at).isNotNull()).withColumn("_at", F.struct(key, at))
    one = last_rows(seen.select("_at", *values), "_at", values).select(f"_at.{key}", f"_at.{at}", *values)
    by_time = Window.partitionBy(key).orderBy(at)  # rows per station: as many as its snapshots
    row = F.struct(*values)
    changed = one.withColumn("_new", F.coalesce(~row.eqNullSafe(F.lag(row).over(by_time)), F.lit(True)) | (F.row_number().over(by_time) == 1))
    return (changed.filter("_new").withColumns({VALID[0]: F.col(at), VALID[1]: F.lead(at).over(by_time)})
            .select(key, *values, *VALID))


def asof_join(rows: DataFrame, intervals: DataFrame, key: str, at: str, before_first: str = "none") -> DataFrame:
    """``rows`` with the columns of the interval that holds their time ``at``; without one they are null.

    ``before_first="first"`` gives rows that are earlier than their key's first version that version.
    """
    values = [c for c in intervals.columns if c != key]
    if before_first == "first":
        first = F.min(VALID[0]).over(Window.partitionBy(key))
        intervals = intervals.withColumn("_from", F.when(F.col(VALID[0]) > first, F.col(VALID[0])))
    else:
        intervals = intervals.withColumn("_from", F.col(VALID[0]))
    span = rows.agg(F.struct(F.min(at).alias("lo"), F.max(at).alias("hi")).alias("s")).scalar()
    lo = utc_date(F.greatest(F.coalesce("_from", span["lo"]), span["lo"]))
    hi = utc_date(F.least(F.coalesce(VALID[1], span["hi"]), span["hi"]))
    dealt = (intervals.filter(lo <= hi).withColumn("_day", F.explode(F.sequence(lo, hi)))
             .select(F.col(key).alias("_key"), "_day", "_from", F.struct(*values).alias("_v"), F.col(VALID[1]).alias("_to")))
    joined = rows.withColumn("_own_day", utc_date(at)).join(
        dealt, (F.col(key) == F.col("_key")) & (F.col("_own_day") == F.col("_day"))
        & (F.col("_from").isNull() | (F.col(at) >= F.col("_from"))) & (F.col("_to").isNull() | (F.col(at) < F.col("_to"))), "left")
    return joined.select(*rows.columns, *[F.col(f"_v.{c}").alias(c) for c in values])


def join_status_info_asof(status: DataFrame, intervals: DataFrame, at: str, before_first: str = "first") -> DataFrame:
    """B01 with versioned info (``versions`` of station_id, name, lat, lon, capacity): the poller's defaults where none is known."""
    own = intervals.select("station_id", F.col("name").alias("_i_name"), F.col("lat").alias("_i_lat"), F.col("lon").alias("_i_lon"),
                           F.col("capacity").alias("_i_capacity"), *VALID)
    joined = asof_join(status, own, "station_id", at, before_first)
    return (joined.withColumns({"name": F.coalesce("_i_name", F.lit(DEFAULT_NAME)), "latitude": F.coalesce("_i_lat", F.lit(0.0)),
                                "longitude": F.coalesce("_i_lon", F.lit(0.0)),
                                "capacity": F.coalesce("_i_capacity", F.lit(0)).cast("bigint")})
            .drop("_i_name", "_i_lat", "_i_lon", "_i_capacity", *VALID))
