"""Exact quantiles of a whole column without sorting it in one task."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import floor, inf, nan
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 1024


@dataclass
class _Search:
    rank: int
    low: Any
    high: Any
    below: int = 0


def exact_quantiles(
    df: DataFrame, column: str, probabilities: Sequence[float], buckets: int = BUCKETS
) -> dict[float, Any]:
    """Discrete quantiles (smallest value with at least the wanted share of values at
    or below it), as ``percentile_disc`` defines them.

    An exact percentile aggregate holds every distinct value of the column in one
    task. This narrows down instead: each round counts the values per equal-width
    bucket of the remaining range and keeps the bucket that holds the wanted rank. A
    round is one aggregate with map-side combining that returns at most ``buckets``
    rows per quantile, and it shrinks the range by that factor, so cents in a range of
    billions take four rounds. It ends on the value itself, however often it repeats.

    Decimals and integers are compared as they are, so no digit is lost; other types as
    double. Infinities are ranked by their counts, and NaN is the greatest value."""
    kind = df.schema[column].dataType
    exact = isinstance(kind, (T.DecimalType, T.IntegralType))
    values = df.select((F.col(column) if exact else F.col(column).cast("double")).alias("v"))
    values = values.where(F.col("v").isNotNull())
    below, above, beyond = 0, 0, 0
    if not exact:
        v = F.col("v")
        below, above, beyond = values.agg(
            F.count_if(v == F.lit(-inf)), F.count_if(v == F.lit(inf)), F.count_if(F.isnan(v))
        ).first()
        values = values.where(~F.isnan(v) & (F.abs(v) < F.lit(inf)))
    n, low, high = values.agg(F.count("v"), F.min("v"), F.max("v")).first()
    total = below + n + above + beyond
    if not total:
        return dict.fromkeys(probabilities)
    ranks = {p: max(1, total - floor(total - p * total)) for p in probabilities}
    found: dict[float, Any] = {}
    searches: dict[float, _Search] = {}
    for p, rank in ranks.items():
        if rank <= below:
            found[p] = -inf
        elif rank > below + n + above:
            found[p] = nan
        elif rank > below + n:
            found[p] = inf
        else:
            searches[p] = _Search(rank - below, low, high)
    while open_ := {p: s for p, s in searches.items() if s.low < s.high}:
        histograms = _histograms(values, list(open_.values()), buckets, exact)
        for search, histogram in zip(open_.values(), histograms):
            for count, lowest, highest in histogram:
                if search.below + count >= search.rank:
                    search.low, search.high = lowest, highest
                    break
                search.below += count
    return {p: found[p] if p in found else searches[p].low for p in probabilities}


def _share(s: _Search, exact: bool) -> Column:
    """Place of a value in the range, 0 at the low end and 1 at the high one. Halves keep
    the width of a range of doubles finite."""
    v = F.col("v")
    if exact:
        low, high = F.lit(s.low), F.lit(s.high)
        if isinstance(s.low, int):
            v, low, high = (c.cast("decimal(28,0)") for c in (v, low, high))
        return (v - low).cast("double") / (high - low).cast("double")
    return (v / 2 - s.low / 2) / (s.high / 2 - s.low / 2)


def _histograms(values: DataFrame, searches: list[_Search], buckets: int, exact: bool) -> list[list]:
    v = F.col("v")
    slots = []
    for i, s in enumerate(searches):
        slot = F.struct(
            F.lit(i).alias("search"),
            F.least(F.floor(_share(s, exact) * buckets), F.lit(buckets - 1).cast("bigint")).alias("bucket"),
        )
        slots.append(F.when(v.between(F.lit(s.low), F.lit(s.high)), slot))
    rows = (
        values.select("v", F.explode(F.array_compact(F.array(*slots))).alias("s"))
        .groupBy("s.search", "s.bucket")
        .agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        .collect()
    )
    out: list[list] = [[] for _ in searches]
    for r in sorted(rows, key=lambda r: (r["search"], r["bucket"])):
        out[r["search"]].append((r["n"], r["lo"], r["hi"]))
    return out
