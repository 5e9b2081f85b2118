"""Edit distance with adjacent transpositions (optimal string alignment) and its deletion neighbourhood.

Both are built-in expressions: the distance folds the rows of the alignment table with
``aggregate``, the neighbourhood takes letters out with ``transform``. Two texts within k
edits share a text that each becomes by deleting at most k letters (a substitution or a
swap deletes one letter on both sides), so terms near a word are found by equality of such
texts instead of by comparing the word with every term.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def osa_distance(a: str, b: str, limit: int | None = None) -> int:
    """Optimal string alignment distance; stops early once every cell exceeds ``limit``."""
    if a == b:
        return 0
    la, lb = len(a), len(b)
    if limit is not None and abs(la - lb) > limit:
        return limit + 1
    prev2: list[int] | None = None
    prev = list(range(lb + 1))
    for i in range(1, la + 1):
        cur = [i] + [0] * lb
        ai = a[i - 1]
        for j in range(1, lb + 1):
            cost = 0 if ai == b[j - 1] else 1
            v = min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + cost)
            if prev2 is not None and j > 1 and ai == b[j - 2] and a[i - 2] == b[j - 1]:
                v = min(v, prev2[j - 2] + 1)
            cur[j] = v
        if limit is not None and min(cur) > limit:
            return limit + 1
        prev2, prev = prev, cur
    return prev[lb]


def osa(a: Column, b: Column) -> Column:
    """Column form of :func:`osa_distance`; null where a text is null.

    The state is the last two rows of the alignment table. Meant for the few pairs that a
    cheaper test has left: the work per pair is the product of the lengths.
    """
    la, lb, one = F.length(a), F.length(b), F.lit(1)

    def row(last: Column, i: Column) -> Column:
        before, above = last["before"], last["above"]

        def cell(left: Column, j: Column) -> Column:
            x, y = a.substr(i, one), b.substr(j, one)
            plain = F.least(F.get(above, j) + 1, F.get(left, j - 1) + 1, F.get(above, j - 1) + F.when(x == y, 0).otherwise(1))
            swapped = (i > 1) & (j > 1) & (x == b.substr(j - 1, one)) & (a.substr(i - 1, one) == y)
            return F.concat(left, F.array(F.when(swapped, F.least(plain, F.get(before, j - 2) + 1)).otherwise(plain)))

        return F.struct(above.alias("before"), F.aggregate(F.sequence(one, lb), F.array(i), cell).alias("above"))

    first = F.sequence(F.lit(0), lb)
    table = F.aggregate(F.sequence(one, la), F.struct(first.alias("before"), first.alias("above")), row, lambda s: F.get(s["above"], lb))
    return F.when(la == 0, lb).when(lb == 0, la).otherwise(table)


def deletions(term: Column, k: int) -> Column:
    """The distinct texts that ``term`` becomes by deleting up to ``k`` characters, itself among them."""
    def shorter(t: Column) -> Column:
        some = F.transform(F.sequence(F.lit(1), F.length(t)),
                           lambda i: F.concat(F.substr(t, F.lit(1), i - 1), F.substr(t, i + 1)))
        return F.when(F.length(t) > 0, some).otherwise(F.array().cast("array<string>"))

    level = out = F.array(term)
    for _ in range(k):
        level = F.array_distinct(F.flatten(F.transform(level, shorter)))
        out = F.concat(out, level)
    return F.array_distinct(out)


def deletions_text(term: str, k: int) -> list[str]:
    """Python twin of :func:`deletions` for the query's word."""
    out = level = {term}
    for _ in range(k):
        level = {t[:i] + t[i + 1:] for t in level for i in range(len(t))}
        out = out | level
    return sorted(out)
