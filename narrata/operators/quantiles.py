"""Exact quantiles of any column with bounded aggregate state (P6).

A quantile is one or two order statistics. Each is searched in an open
interval of values: a mergeable quantile sketch (Greenwald-Khanna,
``percentile_approx``) gives two values around its rank, an exact count of the
rows before, at, between and behind them says on which side it lies, and the
interval shrinks by some thousand times a round. What is left is sorted on the
driver once it holds ``REST`` values at most. Sketches and counts of all
searches share a pass; nothing grows with the number of distinct values.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from narrata.sources import io as IO

#: Accuracy of the sketch (its rank error is a part in so many), and values that the driver sorts for a search.
ACCURACY, REST = 10_000, 10_000


@dataclass
class _Search:
    """The value of rank ``at`` (from 0) among the ``inside`` values between ``low`` and ``high``, both excluded."""

    at: int
    inside: int
    low: float | None = None
    high: float | None = None
    value: float | None = None

    def rows(self) -> Column:
        x = F.col("x")
        inside = F.lit(True)
        if self.low is not None:
            inside = inside & (x > F.lit(self.low))
        return inside if self.high is None else inside & (x < F.lit(self.high))

    def sketch(self) -> Column:
        slack = 2 * self.inside / ACCURACY + 1
        ends = [max(0.0, (self.at - slack) / self.inside), min(1.0, (self.at + 1 + slack) / self.inside)]
        return F.percentile_approx(F.when(self.rows(), F.col("x")), ends, ACCURACY)

    def counts(self, a: float, b: float) -> list[Column]:
        x, r = F.col("x"), self.rows()
        return [F.count_if(r & c) for c in (x < a, x == a, (x > a) & (x < b), (x == b) & F.lit(b > a))]

    def narrow(self, a: float, b: float, before: int, at_a: int, between: int, at_b: int) -> None:
        low, high = self.low, self.high
        for size, found, ends in ((before, None, (low, a)), (at_a, a, None), (between, None, (a, b)), (at_b, b, None),
                                  (self.inside, None, (b, high))):
            if self.at < size:
                if found is not None:
                    self.value = found
                else:
                    self.low, self.high = ends
                    self.inside = min(size, self.inside)
                return
            self.at -= size
            self.inside -= size


def quantile_values(df: DataFrame, col: str, probabilities: list[float]) -> list[float | None]:
    """The quantiles by linear interpolation between the two nearest ranks; None where the column has no value.

    Null and not-a-number values are left out. The column is written once and
    read twice a round (three rounds for 10**12 rows).
    """
    if any(not 0 <= p <= 1 for p in probabilities):
        raise ValueError("probabilities lie between 0 and 1")
    x = F.col(col).cast("double")
    rows = IO.materialize(df.select(x.alias("x")).filter(F.col("x").isNotNull() & ~F.isnan("x")), df.sparkSession,
                          f"quantiles-{uuid.uuid4().hex}")
    n = rows.count()
    if not n:
        return [None] * len(probabilities)
    places = [p * (n - 1) for p in probabilities]
    searches = {r: _Search(r, n) for p in places for r in (math.floor(p), math.ceil(p))}
    while todo := [s for s in searches.values() if s.value is None]:
        if small := [s for s in todo if s.inside <= REST]:
            for s in small:
                own = sorted(r.x for r in rows.filter(s.rows()).collect())
                s.value = own[s.at]
            continue
        ends = rows.agg(*(s.sketch().alias(f"s{i}") for i, s in enumerate(todo))).first()
        counted = rows.agg(*(c.alias(f"c{i}_{j}") for i, s in enumerate(todo) for j, c in enumerate(s.counts(*ends[i])))).first()
        for i, s in enumerate(todo):
            s.narrow(*ends[i], *(counted[f"c{i}_{j}"] for j in range(4)))
    low_high = [(searches[math.floor(p)].value, searches[math.ceil(p)].value, p - math.floor(p)) for p in places]
    return [a if a == b else a + (b - a) * part for a, b, part in low_high]


def quantiles(df: DataFrame, col: str, probabilities: list[float]) -> DataFrame:
    """(probability, value), a row for each."""
    rows = list(zip(map(float, probabilities), quantile_values(df, col, probabilities), strict=True))
    return df.sparkSession.createDataFrame(rows, "probability double, value double")
