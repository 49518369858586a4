"""Column builders for the peer-relative score terms (all native expressions).

Each function returns a ``Column``; nothing here shuffles.  NULL inputs give a
NULL term (the score then drops out of ranking and shows up in
``audit_null_features``) instead of failing the job.
"""

from __future__ import annotations

from functools import reduce
from operator import add
from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _sign(a: Column, b: Column) -> Column:
    """1, -1 or 0 by comparing a with b; NULL if either is NULL."""
    return F.when(a > b, F.lit(1)).when(a < b, F.lit(-1)).when(a == b, F.lit(0))


def growth_trend(subject_cols: Sequence[ColumnOrName], group_cols: Sequence[ColumnOrName]) -> Column:
    """Growth trend score of one subject against its group (F1).

    ``n - #{h: subject_h > group_h}`` plus ``n - sum(sign(subject_h - subject_{h+1}))``
    over adjacent horizons (short minus long).  With seven horizons the range is 1..20;
    a subject that beats its group everywhere and rises with the horizon scores low.
    """
    s = [_c(x) for x in subject_cols]
    g = [_c(x) for x in group_cols]
    if len(s) != len(g) or not s:
        raise ValueError("growth_trend needs the same non-zero number of subject and group columns")
    n = len(s)
    # one sum over an array: unrolled, the comparisons make the generated method of the whole assembly too long to be compiled
    steps = [(a > b).cast("int") for a, b in zip(s, g)] + [_sign(s[i], s[i + 1]) for i in range(n - 1)]
    return (F.lit(2 * n) - F.aggregate(F.array(*steps), F.lit(0), add)).cast("int")


def pct_change_sum(pairs: Sequence[tuple[ColumnOrName, ColumnOrName]], digits: int = 6) -> Column:
    """Sum over (subject, group) pairs of ``(s - g) / g * 100``, truncated toward zero (F2).

    A pair whose group value is 0 contributes 0.  The double sum is rounded to
    ``digits`` places before truncation so that a sum that is an integer in exact
    arithmetic (e.g. 33.33… + 66.66…) does not truncate one below.
    """
    terms = []
    for s, g in pairs:
        s, g = _c(s).cast("double"), _c(g).cast("double")
        terms.append(F.when(g == 0, F.lit(0.0)).otherwise((s - g) / g * F.lit(100.0)))
    if not terms:
        raise ValueError("pct_change_sum needs at least one pair")
    total = reduce(add, terms)
    # rounding (by decimals, at a price) can only change the truncated sum beside an integer
    near = F.abs(total - F.rint(total)) < 10.0**-digits
    # NaN and what no bigint holds give NULL rather than failing the job in ANSI mode
    return F.when(near, F.round(total, digits)).otherwise(total).try_cast("bigint")


def min_max_scale(x: ColumnOrName, lo_of_frame: Column, hi_of_frame: Column, lo: float, hi: float) -> Column:
    """Rescale ``x`` from the frame range [lo_of_frame, hi_of_frame] to [lo, hi].

    A constant frame (max == min) maps to the midpoint, as a min-max scaler does.
    """
    x = _c(x).cast("double")
    span = hi_of_frame - lo_of_frame
    scaled = (x - lo_of_frame) / span * F.lit(hi - lo) + F.lit(lo)
    return F.when(span == 0, F.lit(0.5 * (hi - lo) + lo)).otherwise(scaled)


def ordinal_encode(c: ColumnOrName, mapping: dict[str, int], default: int) -> Column:
    """Map labels to codes; unmatched labels, '' and NULL take ``default``."""
    c = _c(c)
    items = list(mapping.items())
    expr = F.when(c == items[0][0], F.lit(items[0][1]))
    for label, code in items[1:]:
        expr = expr.when(c == label, F.lit(code))
    return expr.otherwise(F.lit(default))


def horizontal_sum(cols: Sequence[ColumnOrName]) -> Column:
    """Row-wise sum of a list of columns, in list order."""
    if not cols:
        raise ValueError("horizontal_sum needs at least one column")
    return reduce(add, [_c(c) for c in cols])


composite_score = horizontal_sum
