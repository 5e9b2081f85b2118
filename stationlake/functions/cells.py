"""Space-filling-curve cells: a point's place on the quad-key (Z-order) curve, a box as key ranges.

``cell`` interleaves the bits of the quantised longitude and latitude, so near points mostly
have near keys. A store sorted by it keeps neighbours in the same row groups, and a circle
becomes a few ranges of keys that Parquet's minima and maxima prune
(:func:`stationlake.operators.predicates.geo_within`).
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column
from pyspark.sql import functions as F

LEVEL = 24        # bits per axis: cells of about 2.4 m by 1.2 m at the equator
MAX_RANGES = 16   # key ranges that stand for a box; fewer ranges hold more cells outside it

#: (shift, mask) that spread the low 32 bits of a number over its even bits.
_SPREAD = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
           (2, 0x3333333333333333), (1, 0x5555555555555555))


def _steps(value: float, least: float, most: float, level: int) -> int:
    """The column or row of a coordinate; what lies outside counts to the first or last one."""
    return min(max(int((value - least) / (most - least) * (1 << level)), 0), (1 << level) - 1)


def _steps_column(value: Column, least: float, most: float, level: int) -> Column:
    at = ((value - F.lit(least)) / F.lit(most - least) * F.lit(float(1 << level))).cast("bigint")
    return F.least(F.greatest(at, F.lit(0)), F.lit((1 << level) - 1)).cast("bigint")


def _spread(x: Column) -> Column:
    for shift, mask in _SPREAD:
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask))
    return x


def cell_key(lat, lon, level: int = LEVEL) -> Column:
    """The quad-key (bigint, 2 * ``level`` bits) of a point in degrees; null where a coordinate is null or NaN."""
    lat, lon = (F.nanvl(F.col(c) if isinstance(c, str) else c, F.lit(None).cast("double")) for c in (lat, lon))
    x, y = _steps_column(lon, -180.0, 180.0, level), _steps_column(lat, -90.0, 90.0, level)
    both = F.when(lat.isNotNull() & lon.isNotNull(), F.lit(True))
    return F.when(both, F.shiftleft(_spread(y), 1).bitwiseOR(_spread(x)))


def quad_key(lat: float, lon: float, level: int = LEVEL) -> int:
    """:func:`cell_key` of one point, in plain Python."""
    x, y = _steps(lon, -180.0, 180.0, level), _steps(lat, -90.0, 90.0, level)
    return sum(((x >> i & 1) | (y >> i & 1) << 1) << 2 * i for i in range(level))


def key_ranges(boxes: list[tuple[float, float, float, float]], level: int = LEVEL,
               most: int = MAX_RANGES) -> list[tuple[int, int]]:
    """At most ``most`` ranges of keys, ends included, that hold every point of the boxes.

    ``boxes``: (south, west, north, east) in degrees. Squares of the curve that a box cuts are
    quartered, largest first, while the pieces stay few; then the ranges with the smallest
    gaps between them are joined.
    """
    cut = [(_steps(w, -180.0, 180.0, level), _steps(s, -90.0, 90.0, level), _steps(e, -180.0, 180.0, level),
            _steps(n, -90.0, 90.0, level)) for s, w, n, e in boxes]

    def meets(x: int, y: int, size: int) -> bool:
        return any(x <= x1 and x + size > x0 and y <= y1 and y + size > y0 for x0, y0, x1, y1 in cut)

    def within(x: int, y: int, size: int) -> bool:
        return any(x0 <= x and x + size - 1 <= x1 and y0 <= y and y + size - 1 <= y1 for x0, y0, x1, y1 in cut)

    whole = 1 << level
    done: list[tuple[int, int]] = []
    todo = [(-whole, 0, 0, 0)]  # (-size, first key, x, y): the largest square is next
    while todo and len(done) + len(todo) <= 8 * most:
        size, key, x, y = heapq.heappop(todo)
        size = -size
        if size == 1 or within(x, y, size):
            done.append((key, key + size * size - 1))
            continue
        half = size // 2
        for q in range(4):
            qx, qy = x + half * (q & 1), y + half * (q >> 1)
            if meets(qx, qy, half):
                heapq.heappush(todo, (-half, key + q * half * half, qx, qy))
    done += [(key, key + size * size - 1) for size, key, _, _ in todo]
    ranges: list[list[int]] = []
    for lo, hi in sorted(done):
        if ranges and lo == ranges[-1][1] + 1:
            ranges[-1][1] = hi
        else:
            ranges.append([lo, hi])
    gaps = sorted(range(1, len(ranges)), key=lambda i: ranges[i][0] - ranges[i - 1][1])
    joined = set(gaps[:max(0, len(ranges) - most)])
    out: list[list[int]] = []
    for i, r in enumerate(ranges):
        if i in joined:
            out[-1][1] = r[1]
        else:
            out.append(r)
    return [(lo, hi) for lo, hi in out]
