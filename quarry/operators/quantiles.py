"""Exact order statistics of any number, without collecting or sorting all.

A mergeable quantile sketch (``percentile_approx``) gives each wanted rank a
lower and an upper bound; one counting pass says how many values lie below
and between, which proves the bounds or widens them.  Each round narrows the
range some thousandfold, until the values between are few enough for an
exact histogram.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Values between a rank's bounds that a histogram may still hold.
EXACT_BELOW = 50_000
ACCURACY = 5_000


def _within(v: Column, lo, hi) -> Column:
    return (v >= F.lit(lo)) & (v <= F.lit(hi))


def order_statistics(df: DataFrame, c: str, ranks: Sequence[int], exact_below: int = EXACT_BELOW) -> list:
    """Values of the 0-based ``ranks`` of column ``c`` in ascending order,
    nulls left out, NaN last; None for a rank beyond the rows.

    Only bounds, counts and the answers reach the driver.  ``df`` is read
    two times a round; rounds grow with the logarithm of the rows."""
    v = F.col(c)
    known = df.where(v.isNotNull()).select(v)
    n, least, most = known.agg(F.count(v), F.min(v), F.max(v)).first()
    # rank -> (bounds, values below them, values within)
    state = {r: (least, most, 0, n) for r in set(ranks) if 0 <= r < n}
    answers: dict = {}
    while state:
        for r in [r for r, (lo, hi, _, _) in state.items() if lo == hi or lo != lo]:
            answers[r] = state.pop(r)[0]
        wide = {r: s for r, s in state.items() if s[3] > exact_below}
        if not wide:
            break
        order = list(wide)
        near = [F.percentile_approx(F.when(_within(v, wide[r][0], wide[r][1]), v), [
            max((r - wide[r][2]) / wide[r][3] - 2 / ACCURACY, 0.0), min((r - wide[r][2] + 1) / wide[r][3] + 2 / ACCURACY, 1.0)], ACCURACY) for r in order]
        bounds = known.agg(*near).first()
        counts = []
        for (a, z), r in zip(bounds, order, strict=True):
            a, z = max(a, wide[r][0]), min(z, wide[r][1])
            counts += [F.count_if(v < F.lit(a)), F.count_if(_within(v, a, z))]
        got = known.agg(*counts).first()
        for i, r in enumerate(order):
            a, z = bounds[i]
            a, z, below, inside = max(a, wide[r][0]), min(z, wide[r][1]), got[2 * i], got[2 * i + 1]
            if below <= r < below + inside and inside < wide[r][3]:
                state[r] = (a, z, below, inside)
            elif inside >= wide[r][3] or a == z:  # many equal values: the histogram below holds few distinct ones
                answers.update(_exact(known, c, {r: wide[r]}))
                state.pop(r)
            elif r < below:  # the sketch was off: go on beside its range, whose count is known
                state[r] = (wide[r][0], a, wide[r][2], below - wide[r][2] + 1)
            else:
                state[r] = (z, wide[r][1], below + inside - 1, wide[r][3] - (below + inside - wide[r][2]) + 1)
    if state:
        answers.update(_exact(known, c, state))
    return [answers.get(r) for r in ranks]


def _exact(known: DataFrame, c: str, state: dict) -> dict:
    """The ranks from histograms of the values within their bounds."""
    v = F.col(c)
    ranges = F.array(*[F.when(_within(v, lo, hi), F.lit(r)) for r, (lo, hi, _, _) in state.items()])
    hist = known.select(v.alias("v"), F.explode(F.array_compact(ranges)).alias("r")).groupBy("r", "v").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("r").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    below = F.create_map(*[F.lit(x) for r, s in state.items() for x in (r, s[2])])
    cum = hist.select("r", "v", F.sum("n").over(w).alias("cum"), below[F.col("r")].alias("below"))
    found = cum.where(F.col("below") + F.col("cum") > F.col("r")).groupBy("r").agg(F.min("v").alias("v")).collect()
    return {row.r: row.v for row in found}
