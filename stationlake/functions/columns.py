"""Scalar column expressions of the enrichment chain.

Every function returns a ``Column`` built from ``pyspark.sql.functions`` only, so
the whole chain collapses into one codegen'd projection next to the scan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- fixed values that must equal the reference's ---------------------------------
# Text forms read as true by the flag coercion (after trim + lower-case).
TRUE_WORDS = ["1", "true", "t", "yes", "y"]
# Share of capacity below which a count is "low".
LOW_SHARE = 0.2
# Periods of the day: [start hour, end hour) -> label; every other hour is "night".
PERIODS = [(6, 12, "morning"), (12, 14, "lunch"), (14, 19, "afternoon"), (19, 22, "evening")]
NIGHT = "night"
PERIOD_NAMES = ["morning", "lunch", "afternoon", "evening", "night"]
# A name carries a district only when it holds five digits in a row.
DISTRICT_GATE = r"\d{5}"
# Number pattern of the district extraction (a grok NUMBER: optional sign, digits,
# optional fraction, not preceded by a digit, dot or sign).
NUMBER_PATTERN = r"(?<![0-9.+-])([+-]?(?:[0-9]+(?:\.[0-9]+)?|\.[0-9]+))"
DEFAULT_NAME = "Unknown"
# ------------------------------------------------------------------------------------

# Constant metadata columns (C04). They are labels for downstream consumers, not inputs
# of any analysis; pass the labels your consumers expect to ``to_reading``/``enrich``.
DEFAULT_LABELS = {"source": "station_feed", "city": "Paris", "pipeline": "stationlake-ingest",
                  "data_type": "bike_sharing"}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def occupancy_rate(bikes="num_bikes_available", capacity="capacity") -> Column:
    """Bikes / capacity in percent, 2 decimals half-even (as Python ``round``); 0 without capacity."""
    b, c = F.coalesce(_c(bikes), F.lit(0)), _c(capacity)
    return (F.when(c > 0, F.bround(b / c * 100, 2)).otherwise(F.lit(0.0))).cast(T.DoubleType())


def station_status(bikes="num_bikes_available", docks="num_docks_available",
                   capacity="capacity") -> Column:
    """Ordered status rules; null counts count as 0; no capacity -> unknown."""
    b = F.coalesce(_c(bikes), F.lit(0))
    d = F.coalesce(_c(docks), F.lit(0))
    c = F.coalesce(_c(capacity), F.lit(0))
    limit = c * F.lit(LOW_SHARE)
    return (F.when(c <= 0, F.lit("unknown"))
            .when(b == 0, F.lit("empty"))
            .when(d == 0, F.lit("full"))
            .when(b < limit, F.lit("low"))
            .when(d < limit, F.lit("almost_full"))
            .otherwise(F.lit("available")))


def time_period(hour) -> Column:
    """Period of the day from an hour 0-23."""
    h = _c(hour)
    expr = None
    for lo, hi, label in PERIODS:
        cond = (h >= lo) & (h < hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(NIGHT))


# Time parts are taken in UTC by arithmetic on the instant, whatever the session zone.
def hour_of_day(ts="ts") -> Column:
    """C11: UTC hour of event time."""
    return F.floor(F.pmod(F.unix_seconds(_c(ts)), F.lit(86400)) / 3600).cast(T.IntegerType())


def utc_date(ts="ts") -> Column:
    """UTC day of an instant."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(_c(ts)) / 86400).cast(T.IntegerType()))


def utc_hour(ts="ts") -> Column:
    """Start of the UTC hour of an instant."""
    s = F.unix_seconds(_c(ts))
    return F.timestamp_seconds(s - F.pmod(s, F.lit(3600)))


def utc_text(ts) -> Column:
    """An instant as 'yyyy-MM-dd HH:mm:ss[.ffffff]' in UTC."""
    seconds = (F.unix_micros(_c(ts)) / 1000000).cast("decimal(18,6)")
    zero = F.lit(0)
    return (F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, seconds)).cast("string")


def iso_utc(text) -> Column:
    """'yyyy-MM-dd HH:mm:ss[.ffffff]' -> 'yyyy-MM-ddTHH:mm:ss.ffffffZ'."""
    t = _c(text)
    return F.concat(F.substring(t, 1, 10), F.lit("T"), F.substring(t, 12, 8), F.lit("."),
                    F.rpad(F.substring(t, 21, 6), 6, "0"), F.lit("Z"))


def parse_utc(text) -> Column:
    """Text to an instant; text without a zone is UTC; NULL when it does not parse."""
    t = F.trim(_c(text))
    zoned = t.rlike(r"\d:\d{2}.*([A-Za-z]|[+-]\d{1,2}(:?\d{2})?)$")
    day = F.timestamp_seconds(F.unix_date(t.try_cast("date")).cast("bigint") * 86400)
    return (F.when(zoned, F.try_to_timestamp(t))
            .when(t.rlike(r"\d:\d{2}"), F.try_to_timestamp(F.concat(t, F.lit("Z"))))
            .otherwise(day))


def district(name="name") -> Column:
    """First number in the name, only if the name holds a 5-digit run.

    A fractional number is truncated like an integer conversion would; numbers that
    do not fit an int give NULL instead of an error.
    """
    n = _c(name)
    raw = F.regexp_extract(n, NUMBER_PATTERN, 1)
    value = raw.try_cast(T.DoubleType()).try_cast(T.IntegerType())
    return F.when(n.rlike(DISTRICT_GATE) & (raw != ""), value)


def truthy(col, dtype: T.DataType) -> Column:
    """Coerce a flag to boolean; null stays null.

    booleans as they are; numbers: non-zero; text: trimmed, lower-cased, in TRUE_WORDS.
    A VARIANT column keeps the JSON type, so number 2 is true while text "2" is false.
    """
    c = _c(col)
    words = [F.lit(w) for w in TRUE_WORDS]
    if isinstance(dtype, T.BooleanType):
        return c
    if isinstance(dtype, T.NumericType):
        return c.cast(T.DoubleType()) != 0
    if isinstance(dtype, T.StringType):
        return F.lower(F.trim(c)).isin(words)
    if isinstance(dtype, T.VariantType):
        # A variant cast to boolean follows SQL casts: numbers are true when non-zero,
        # text is true when trimmed and lower-cased it is one of TRUE_WORDS (Spark's
        # string-to-boolean rule accepts exactly those as true); any other text, and
        # arrays or objects, give NULL there and false here. JSON null stays NULL.
        return (F.when(c.isNull() | F.is_variant_null(c), F.lit(None).cast(T.BooleanType()))
                .otherwise(F.coalesce(F.try_variant_get(c, "$", "boolean"), F.lit(False))))
    raise TypeError(f"cannot coerce {dtype} to boolean")


def bike_type_count(types="num_bikes_available_types", kind: str = "ebike") -> Column:
    """The last non-null ``kind`` count in the bike-type array; NULL if absent."""
    vals = F.filter(F.transform(_c(types), lambda x: x[kind]), lambda v: v.isNotNull())
    return F.try_element_at(vals, F.lit(-1))


def unix_to_timestamp(seconds="last_reported") -> Column:
    """Unix seconds to timestamp; null stays null."""
    return F.timestamp_seconds(_c(seconds))


def geo_point(lat="latitude", lon="longitude") -> Column:
    """struct(lat, lon) when both are present."""
    la, lo = _c(lat), _c(lon)
    return F.when(la.isNotNull() & lo.isNotNull(),
                  F.struct(la.cast(T.DoubleType()).alias("lat"), lo.cast(T.DoubleType()).alias("lon")))


def label_columns(names: tuple[str, ...], labels: dict | None = None) -> list[Column]:
    """Constant metadata columns ``names`` with their labels."""
    merged = {**DEFAULT_LABELS, **(labels or {})}
    return [F.lit(merged[n]).alias(n) for n in names]


def round2(c) -> Column:
    """2 decimals, half-up (the batch analyses' rounding)."""
    return F.round(_c(c), 2)


def rate_pct(part, total) -> Column:
    """C17: part / total in percent, 2 decimals; NULL when total is 0."""
    return F.round(F.try_divide(_c(part), _c(total)) * 100, 2)


def mean_2dp(col="occupation_rate") -> Column:
    """Exact mean of a column whose values carry at most 2 decimals (a share in percent).

    The values are summed as whole hundredths (integers), then divided once, so the
    result does not depend on the order in which partitions are combined; a plain
    floating-point average can flip the 2nd decimal when the mean sits on a tie.
    """
    c = _c(col)
    return F.sum(F.round(c * 100).cast(T.LongType())) / (F.count(c) * F.lit(100.0))


def count_when(cond: Column) -> Column:
    """Number of rows where ``cond`` holds (0 on no rows)."""
    return F.sum(F.when(cond, 1).otherwise(0)).cast(T.LongType())
