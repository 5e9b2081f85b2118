"""Filters and predicates (P01-P08) as ``Column`` builders.

Predicates on stored columns reach the Parquet scan as pushed filters; the time
range also bounds the ``dt`` day partitions so whole days are pruned.
"""

from __future__ import annotations

import datetime as _dt
import math
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.functions.cells import key_ranges
from stationlake.functions.columns import parse_utc, utc_date

# ---- fixed values ------------------------------------------------------------------
EARTH_RADIUS_M = 6371008.7714  # mean earth radius used by the geo distance
DEG = math.pi / 180.0
# ------------------------------------------------------------------------------------

_UNITS = {"ms": 0.001, "s": 1, "m": 60, "h": 3600, "d": 86400, "w": 604800}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def not_null_all(*cols) -> Column:
    """Every column is non-null."""
    return reduce(lambda a, b: a & b, [_c(c).isNotNull() for c in cols])


def term(col, value) -> Column:
    """Exact value."""
    return _c(col) == F.lit(value)


def terms(col, values) -> Column:
    """Any of the values."""
    return _c(col).isin([F.lit(v) for v in values])


def all_of(*preds: Column) -> Column:
    """Conjunction of ``must`` and ``filter`` clauses; no clause matches everything."""
    return reduce(lambda a, b: a & b, preds, F.lit(True))


def regex(col, pattern: str) -> Column:
    """Unanchored regular-expression test."""
    return _c(col).rlike(pattern)


def span_seconds(span) -> float:
    """'5m', '10m', '1h', '24h', '7d' (or a timedelta, or seconds) -> seconds."""
    if isinstance(span, _dt.timedelta):
        return span.total_seconds()
    if isinstance(span, (int, float)):
        return float(span)
    m = re.fullmatch(r"\s*(?:now-)?(\d+)\s*(ms|s|m|h|d|w)\s*", str(span))
    if not m:
        raise ValueError(f"bad time span {span!r}")
    return int(m.group(1)) * _UNITS[m.group(2)]


def shifted(instant: Column, span, sign: int = 1) -> Column:
    """``instant`` moved by ``span`` (see :func:`span_seconds`), exactly, whatever the session zone.

    An interval would be added in the session zone, where a day can have 23 or 25 hours.
    """
    return F.timestamp_micros(F.unix_micros(instant) + F.lit(sign * round(span_seconds(span) * 1_000_000)))


_DAY = re.compile(r"dt=(\d{4}-\d{2}-\d{2})(?:/|$)")


def store_days(df: DataFrame) -> list[str]:
    """The days ('yyyy-MM-dd') of the store folders that ``df`` reads, sorted; no job and no file names.

    Only the folders right below the roots of the relations are listed: a name per day,
    however many writes and files a day has.
    """
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    hadoop = df.sparkSession._jsparkSession.sessionState().newHadoopConf()
    days = set()
    for leaf in (leaves.apply(i) for i in range(leaves.size())):
        if leaf.getClass().getSimpleName() != "LogicalRelation" or not hasattr(leaf.relation(), "location"):
            continue
        roots = leaf.relation().location().rootPaths()
        for root in (roots.apply(i) for i in range(roots.size())):
            own = _DAY.findall(root.toString())
            days.update(own or (m for f in root.getFileSystem(hadoop).listStatus(root) for m in _DAY.findall(f.getPath().getName())))
    return sorted(days)


def latest_event(df: DataFrame, ts: str = "ts") -> Column:
    """The data's greatest event time, as a scalar subquery of the query that uses it.

    On a day-partitioned store only the newest day (known from the partition folders)
    is read for it. No job runs while the plan is built; day bounds that depend on the
    subquery prune partitions once its value is known.
    """
    days = store_days(df) if "dt" in df.columns else []
    newest = df.filter(F.col("dt") == F.lit(days[-1]).cast("date")) if days else df
    return newest.agg(F.max(ts)).scalar()


def resolve_as_of(df: DataFrame, as_of=None, ts: str = "ts") -> Column:
    """The "now" of relative ranges.

    ``None``: the query time; ``"latest"``: the data's greatest event time
    (:func:`latest_event`); a ``datetime``: that instant; text: that instant, UTC unless
    it names a zone; a ``Column``: as is.
    """
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, str) and as_of == "latest":
        return latest_event(df, ts)
    return parse_utc(F.lit(as_of)) if isinstance(as_of, str) else F.lit(as_of).cast("timestamp")


def time_range(since, as_of: Column, ts: str = "ts", until: bool = True,
               day_col: str | None = "dt") -> Column:
    """``as_of - since <= ts [<= as_of]`` plus the implied bounds on the day partition."""
    lo = shifted(as_of, since, -1)
    pred = _c(ts) >= lo
    if until:
        pred = pred & (_c(ts) <= as_of)
    if day_col:
        pred = pred & (F.col(day_col) >= utc_date(lo))
        if until:
            pred = pred & (F.col(day_col) <= utc_date(as_of))
    return pred


def haversine_m(lat, lon, lat0: float, lon0: float) -> Column:
    """Great-circle distance in metres from (lat0, lon0)."""
    la, lo = _c(lat) * F.lit(DEG), _c(lon) * F.lit(DEG)
    la0, lo0 = lat0 * DEG, lon0 * DEG
    s1 = F.sin((la - F.lit(la0)) / 2)
    s2 = F.sin((lo - F.lit(lo0)) / 2)
    a = s1 * s1 + F.lit(math.cos(la0)) * F.cos(la) * s2 * s2
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def bounding_box(lat, lon, lat0: float, lon0: float, radius_m: float) -> Column:
    """Box that holds the whole circle: plain range tests Parquet can push down."""
    d = radius_m / EARTH_RADIUS_M
    dlat = d / DEG + 1e-9
    pred = _c(lat).between(lat0 - dlat, lat0 + dlat)
    c = math.cos(lat0 * DEG)
    if math.sin(d) < c:
        dlon = math.asin(math.sin(d) / c) / DEG + 1e-9
        west, east = lon0 - dlon, lon0 + dlon
        box = _c(lon).between(west, east)
        if west < -180:  # the box goes on beyond the 180th meridian
            box = box | (_c(lon) >= west + 360)
        if east > 180:
            box = box | (_c(lon) <= east - 360)
        pred = pred & box
    return pred


def boxes(lat0: float, lon0: float, radius_m: float) -> list[tuple[float, float, float, float]]:
    """(south, west, north, east) of one or two boxes that hold the whole circle, within -180 .. 180."""
    d = radius_m / EARTH_RADIUS_M
    dlat = d / DEG + 1e-9
    south, north, c = lat0 - dlat, lat0 + dlat, math.cos(lat0 * DEG)
    if math.sin(d) >= c or d >= math.pi / 2:  # a pole lies within
        return [(south, -180.0, north, 180.0)]
    dlon = math.asin(math.sin(d) / c) / DEG + 1e-9
    west, east = lon0 - dlon, lon0 + dlon
    out = [(south, max(west, -180.0), north, min(east, 180.0))]
    if west < -180:
        out.append((south, west + 360, north, 180.0))
    if east > 180:
        out.append((south, -180.0, north, east - 360))
    return out


def in_cells(cell, lat0: float, lon0: float, radius_m: float) -> Column:
    """The point's cell is in one of the few key ranges that hold the circle, or isn't known."""
    c = _c(cell)
    ranges = [c.between(F.lit(lo), F.lit(hi)) for lo, hi in key_ranges(boxes(lat0, lon0, radius_m))]
    return reduce(lambda a, b: a | b, ranges, c.isNull())


def geo_within(lat, lon, lat0: float, lon0: float, radius_m: float, cell=None) -> Column:
    """Within ``radius_m`` metres of (lat0, lon0); the box test runs first.

    ``cell``: the column of quad-keys of a store sorted by them
    (:func:`stationlake.functions.cells.cell_key`); its ranges are pushed to the scan, where
    files, row groups and pages outside them are skipped.
    """
    near = bounding_box(lat, lon, lat0, lon0, radius_m) & (haversine_m(lat, lon, lat0, lon0) <= radius_m)
    return near if cell is None else in_cells(cell, lat0, lon0, radius_m) & near


def filter_readings(df: DataFrame, since=None, as_of=None, status=None, period=None,
                    district=None) -> DataFrame:
    """The dashboard's filter set; every filter is optional.

    ``status``/``period``/``district`` take one value or a list of values.
    """
    preds = []
    if since is not None:
        preds.append(time_range(since, resolve_as_of(df, as_of)))
    for col, v in (("station_status", status), ("time_period", period), ("arrondissement", district)):
        if v is None:
            continue
        preds.append(terms(col, v) if isinstance(v, (list, tuple, set)) else term(col, v))
    return df.filter(all_of(*preds))
