"""Exact quantiles of columns of any number of distinct values (A4).

``F.median`` and ``percentile`` keep one entry for every distinct value. Here a
quantile's rank is closed in from both sides: a quantile summary of the values
still possible gives two data values around the rank, the values below, at,
between and above them are counted, and the range that holds the rank goes into
the next round. Each round leaves some ``2 / accuracy`` of the values; ranges of
at most ``few`` values are sorted. State is bounded whatever the data: one
summary for each rank and round, and ``few`` values in the last.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACCURACY = 5000
FEW = 5000


class _Rank:
    """The value of rank ``k`` (from 0) of a column: among the ``m`` values inside (lo, hi), of which
    the first has rank ``base``."""

    def __init__(self, column: str, k: int, n: int):
        self.column, self.k, self.m, self.base = column, k, n, 0
        self.lo = self.hi = self.value = None

    def inside(self) -> Column:
        x = F.col(self.column)
        keep = x.isNotNull()
        if self.lo is not None:
            keep = keep & (x > F.lit(self.lo))
        return keep & (x < F.lit(self.hi)) if self.hi is not None else keep

    def bracket(self, accuracy: int) -> Column:
        at, slack = (self.k - self.base) / self.m, 2 / accuracy
        ends = [max(0.0, at - slack), min(1.0, at + slack)]
        return F.percentile_approx(F.when(self.inside(), F.col(self.column)), ends, accuracy)

    def counts(self, a: float, b: float) -> Column:
        x, n = F.col(self.column), lambda cond: F.count(F.when(self.inside() & cond, 1))
        return F.array(n(x < a), n(x == a), n((x > a) & (x < b)), n((x == b) & (x != F.lit(a))))

    def narrow(self, a: float, b: float, counts: list[int]) -> None:
        counts = [*counts, self.m - sum(counts)]
        ranges = [(self.lo, a), (a, a), (a, b), (b, b), (b, self.hi)]
        for (lo, hi), n in zip(ranges, counts):
            if self.k - self.base < n:
                break
            self.base += n
        if lo is not None and lo == hi:
            self.value = lo
        else:
            self.lo, self.hi, self.m = lo, hi, n


def exact_quantiles(df: DataFrame, columns, probs=(0.25, 0.5, 0.75), accuracy: int = ACCURACY, few: int = FEW) -> DataFrame:
    """(column, prob, n, value): the quantiles of each column's ``n`` values as doubles, interpolated
    between the two ranks around ``(n - 1) * prob``. Nulls and NaN are no values; a column without
    values has null quantiles. The rounds run at once, each reading ``columns`` of ``df`` twice."""
    columns = [columns] if isinstance(columns, str) else list(columns)
    names = [f"c{i}" for i in range(len(columns))]
    x = df.select(*[F.col(c).cast("double").alias(v) for c, v in zip(columns, names)])
    x = x.select(*[F.when(~F.isnan(v), F.col(v)).alias(v) for v in names])
    n = dict(zip(names, x.agg(*[F.count(v) for v in names]).head()))
    places = {(v, p): (n[v] - 1) * p for v in names for p in probs if n[v]}
    wanted = {(v, k) for (v, _), at in places.items() for k in (math.floor(at), math.ceil(at))}
    ranks = {(v, k): _Rank(v, k, n[v]) for v, k in sorted(wanted)}
    while todo := [r for r in ranks.values() if r.value is None]:
        listed = [F.sort_array(F.collect_list(F.when(r.inside(), F.col(r.column)))) for r in todo if r.m <= few]
        got = iter(x.agg(*listed, *[r.bracket(accuracy) for r in todo if r.m > few]).head())
        for r in (r for r in todo if r.m <= few):
            r.value = next(got)[r.k - r.base]
        wide = [(r, *next(got)) for r in todo if r.m > few]
        if wide:
            for (r, a, b), counts in zip(wide, x.agg(*[r.counts(a, b) for r, a, b in wide]).head()):
                r.narrow(a, b, counts)

    def value(v, p):
        at = places.get((v, p))
        if at is None:
            return None
        low, high = ranks[v, math.floor(at)].value, ranks[v, math.ceil(at)].value
        return low if low == high else low + (high - low) * (at - math.floor(at))

    rows = [(c, float(p), n[v], value(v, p)) for c, v in zip(columns, names) for p in probs]
    return df.sparkSession.createDataFrame(rows, "column string, prob double, n bigint, value double")
