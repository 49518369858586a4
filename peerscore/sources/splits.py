"""Equal-depth scan splits (S1): predicates from quantiles of a key, so that a skewed key still gives even reads.

Equal-width ranges (``partitionColumn`` with bounds) put a hot stretch of the key into one task. Here the ranges hold about
as many rows each, a value that fills several ranges is split by a second column, and NULL keys have predicates of their
own. Every row meets exactly one predicate.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _literal(value) -> str:
    """A value as SQL text that Spark and common databases read alike."""
    if isinstance(value, _dt.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, _dt.date):
        return f"DATE '{value.isoformat()}'"
    return str(value)


def _ranges(column: str, bounds: Sequence, nulls: bool) -> list[str]:
    """Half-open ranges between rising bounds, open at both ends; the first one takes NULLs if ``nulls``."""
    texts = [_literal(b) for b in bounds]
    out = []
    for low, high in zip([None, *texts], [*texts, None], strict=True):
        parts = ([f"{column} >= {low}"] if low is not None else []) + ([f"{column} < {high}"] if high is not None else [])
        out.append(" AND ".join(parts))
    first = out[0]
    if nulls:
        out[0] = f"({first} OR {column} IS NULL)" if first else "1 = 1"
    elif not first:
        out[0] = f"{column} IS NOT NULL"
    return out


def _steps(parts: int) -> list[float]:
    return [i / parts for i in range(1, parts)]


def equal_depth_predicates(df: DataFrame, column: str, parts: int, tie: str | None = None, accuracy: int = 100_000) -> list[str]:
    """At least ``parts`` SQL predicates on ``column`` that each row meets one of, with about equal numbers of rows.

    ``column`` and ``tie`` are numbers, dates or timestamps. The quantiles are one aggregation, combined before the shuffle,
    with an error of 1/``accuracy`` of the rows. A value that holds more than a part of the rows gets a predicate alone, or,
    given ``tie``, as many as parts it fills, by quantiles of ``tie`` among its rows; so do NULL keys. At most ``parts``
    such values exist, so what the driver holds is bounded by ``parts``. Without rows there is one predicate for all.
    """
    if parts < 1:
        raise ValueError("parts must be at least 1")
    for c in [column] + ([tie] if tie is not None else []):
        if not isinstance(df.schema[c].dataType, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
            raise TypeError(f"cannot split by {c}, a column of type {df.schema[c].dataType.simpleString()}")
    if parts == 1:
        return ["1 = 1"]
    key = F.col(column)
    quantiles = F.percentile_approx(key, _steps(parts), accuracy)
    head = df.agg(F.count("*").alias("n"), F.count(key).alias("keyed"), quantiles.alias("q")).first()
    if not head["n"]:
        return ["1 = 1"]
    depth = head["n"] / parts
    bounds = list(head["q"] or [])
    at_least = max(1, round(head["keyed"] / depth)) if head["keyed"] else 0
    if 1 < at_least < parts:  # NULLs take their own share, so the keys need fewer ranges
        bounds = list(df.agg(F.percentile_approx(key, _steps(at_least), accuracy).alias("q")).first()["q"])
    elif at_least <= 1:
        bounds = []
    distinct = sorted(set(bounds))
    counts = {}
    if distinct:
        found = df.where(key.isin(distinct)).groupBy(key.alias("v")).agg(F.count("*").alias("n")).collect()  # no more than parts
        counts = {r["v"]: r["n"] for r in found}
    hot = [v for v in distinct if counts.get(v, 0) > depth]
    ties: dict = {}
    if tie is not None:
        for value, n in [(v, counts[v]) for v in hot] + [(None, head["n"] - head["keyed"])]:
            pieces = round(n / depth)
            if pieces > 1:
                rows = df.where(key.isNull() if value is None else key == F.lit(value))
                found = rows.agg(F.percentile_approx(tie, _steps(pieces), accuracy).alias("q")).first()["q"]
                ties[value] = _ranges(tie, sorted(set(found or [])), nulls=True)

    out = []
    if head["keyed"]:
        edges = _ranges(column, distinct, nulls=False)
        for value, text in zip([None, *distinct], edges, strict=True):
            if value is not None and value in hot:
                same = f"{column} = {_literal(value)}"
                out += [same if t == "1 = 1" else f"{same} AND {t}" for t in ties.get(value, ["1 = 1"])]
                text = text.replace(f"{column} >= ", f"{column} > ", 1)
            out.append(text)
    if head["n"] > head["keyed"]:
        none = f"{column} IS NULL"
        out += [none if t == "1 = 1" else f"{none} AND {t}" for t in ties.get(None, ["1 = 1"])]
    return out


def split_number(predicates: Sequence[str]) -> Column:
    """The position of the predicate that a row meets (from 0)."""
    first, *rest = [F.expr(p) for p in predicates]
    start = F.when(first, F.lit(0))
    return reduce(lambda c, p: c.when(p[1], F.lit(p[0])), enumerate(rest, 1), start)


def scan_by_predicates(df: DataFrame, predicates: Sequence[str]) -> DataFrame:
    """One filtered scan per predicate, so that a source clustered by the key prunes each of them."""
    return reduce(DataFrame.unionAll, [df.where(p) for p in predicates])
