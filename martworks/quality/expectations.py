"""Distribution expectations over one table, evaluated as Spark aggregates.

Rows never leave the executors: all counts and means of a suite come from one
aggregate, uniqueness from a grouping, quantiles from bounded histograms."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martworks.quality.checks import packed
from martworks.quality.quantiles import exact_quantiles


@dataclass(frozen=True)
class Expectation:
    kind: str
    column: str | None = None
    low: float | None = None
    high: float | None = None
    values: tuple = ()
    length: int | None = None
    other: str | None = None
    probability: float | None = None
    mostly: float = 1.0


def row_count_between(low, high):
    return Expectation("row_count_between", low=low, high=high)


def values_not_null(column, mostly=1.0):
    return Expectation("values_not_null", column, mostly=mostly)


def values_unique(column, mostly=1.0):
    return Expectation("values_unique", column, mostly=mostly)


def values_in_set(column, values, mostly=1.0):
    return Expectation("values_in_set", column, values=tuple(values), mostly=mostly)


def values_between(column, low=None, high=None, mostly=1.0):
    return Expectation("values_between", column, low, high, mostly=mostly)


def mean_between(column, low=None, high=None):
    return Expectation("mean_between", column, low, high)


def quantiles_between(column, ranges: dict[float, tuple[float, float]]):
    """One expectation per quantile."""
    return [
        Expectation("quantile_between", column, lo, hi, probability=p)
        for p, (lo, hi) in ranges.items()
    ]


def lengths_equal(column, length, mostly=1.0):
    return Expectation("lengths_equal", column, length=length, mostly=mostly)


def at_least_other(column, other, mostly=1.0):
    """``column >= other``; rows where both are NULL are left out."""
    return Expectation("at_least_other", column, other=other, mostly=mostly)


@dataclass(frozen=True)
class Suite:
    name: str
    table: str
    expectations: Sequence[Expectation]
    where: Column | None = field(default=None, compare=False)

    def columns(self) -> tuple[str, ...]:
        """What its expectations read, apart from ``where``."""
        read = [c for e in self.expectations for c in (e.column, e.other) if c]
        return tuple(dict.fromkeys(read))


def _within(value: Column, low, high) -> Column:
    ok = F.lit(True)
    if low is not None:
        ok = ok & (value >= low)
    if high is not None:
        ok = ok & (value <= high)
    return ok


def _considered(e: Expectation) -> Column:
    """Rows the expectation is about."""
    if e.kind == "values_not_null":
        return F.lit(True)
    if e.kind == "at_least_other":
        return F.col(e.column).isNotNull() | F.col(e.other).isNotNull()
    return F.col(e.column).isNotNull()


def _met(e: Expectation) -> Column:
    value = F.col(e.column)
    if e.kind == "values_not_null":
        return value.isNotNull()
    if e.kind == "values_in_set":
        return value.isin(*e.values)
    if e.kind == "lengths_equal":
        return F.length(value) == e.length
    if e.kind == "at_least_other":
        return F.coalesce(value >= F.col(e.other), F.lit(False))
    return _within(value, e.low, e.high)


_BY_ROW = ("values_not_null", "values_in_set", "values_between", "lengths_equal", "at_least_other")


def _result(e: Expectation, considered: Column, unexpected: Column, observed: Column) -> Column:
    """One result row. ``mostly`` is a share of the considered values; a table without
    any passes."""
    name = e.kind if e.probability is None else f"{e.kind}[{e.probability}]"
    share = F.when(considered > 0, unexpected / considered.cast("double"))
    if e.kind in _BY_ROW or e.kind == "values_unique":
        success = F.coalesce(share <= F.lit(1.0 - e.mostly + 1e-12), F.lit(True))
    else:
        success = F.coalesce(_within(observed, e.low, e.high), F.lit(False))
    return F.struct(
        F.lit(name).alias("expectation"),
        F.lit(e.column).cast("string").alias("column"),
        observed.cast("double").alias("observed_value"),
        considered.cast("bigint").alias("element_count"),
        unexpected.cast("bigint").alias("unexpected_count"),
        (share * 100).alias("unexpected_percent"),
        success.alias("success"),
    )


def run_suite(
    df: DataFrame, expectations: Iterable[Expectation], where: Column | None = None
) -> DataFrame:
    """One row per expectation with what was observed and whether it holds."""
    rows = df if where is None else df.where(where)
    kinds = dict(rows.dtypes)
    checks = [(f"e{i}", e) for i, e in enumerate(expectations)]
    none = F.lit(None)
    aggregates, results, parts = [F.count(F.lit(1)).alias("n")], [], []
    quantiles: dict[str, list[Expectation]] = {}
    for name, e in checks:
        if e.kind == "row_count_between":
            results.append(_result(e, F.col("n"), none, F.col("n")))
        elif e.kind == "mean_between":
            value = F.col(e.column)
            aggregates += [
                F.try_divide(F.sum(value).cast("double"), F.count(value)).alias(name),
                F.count(value).alias(f"{name}_n"),
            ]
            results.append(_result(e, F.col(f"{name}_n"), none, F.col(name)))
        elif e.kind in _BY_ROW:
            aggregates += [
                F.count_if(_considered(e)).alias(f"{name}_n"),
                F.count_if(_considered(e) & ~_met(e)).alias(f"{name}_bad"),
            ]
            results.append(_result(e, F.col(f"{name}_n"), F.col(f"{name}_bad"), none))
        elif e.kind == "values_unique":
            copies = (
                rows.where(F.col(e.column).isNotNull())
                .groupBy(packed(F.col(e.column)) if kinds[e.column] == "string" else F.col(e.column))
                .agg(F.count(F.lit(1)).alias("c"))
                .agg(
                    F.coalesce(F.sum("c"), F.lit(0)).alias("n"),
                    F.coalesce(F.sum(F.when(F.col("c") > 1, F.col("c"))), F.lit(0)).alias("bad"),
                )
            )
            parts.append(copies.select(_result(e, F.col("n"), F.col("bad"), none).alias("r")))
        elif e.kind == "quantile_between":
            quantiles.setdefault(e.column, []).append(e)
        else:
            raise ValueError(f"unknown expectation {e.kind}")
    if results:
        parts.append(
            rows.agg(*aggregates).select(F.explode(F.array(*results)).alias("r"))
        )
    for column, group in quantiles.items():
        found = exact_quantiles(rows, column, [e.probability for e in group])
        structs = [
            _result(e, none, none, F.lit(found[e.probability]).cast("double")) for e in group
        ]
        one = df.sparkSession.range(1)
        parts.append(one.select(F.explode(F.array(*structs)).alias("r")))
    return reduce(DataFrame.union, [p.select("r.*") for p in parts])


def run_suites(
    tables: dict[str, DataFrame], suites: Iterable[Suite], only: Iterable[str] | None = None
) -> DataFrame:
    """Results of several suites; an unknown suite name in ``only`` is an error."""
    suites = list(suites)
    if only is not None:
        wanted = set(only)
        suites = [s for s in suites if s.name in wanted]
        if not suites:
            raise ValueError(f"no suite matches {sorted(wanted)}")
    parts = [
        run_suite(tables[s.table], s.expectations, s.where).select(
            F.lit(s.name).alias("suite"), "*"
        )
        for s in suites
    ]
    return reduce(DataFrame.unionByName, parts)


@dataclass(frozen=True)
class Outcome:
    """A run of suites as a whole."""

    evaluated: int
    failed: tuple[str, ...]  # suite: expectation(column)

    @property
    def passed(self) -> bool:
        return not self.failed


class SuiteFailure(Exception):
    """Some expectation of a suite does not hold."""


def outcome(results: DataFrame, raise_on_failure: bool = False) -> Outcome:
    """Judge the results of suites; there is one row per expectation to read."""
    rows = results.select("suite", "expectation", "column", "success").collect()
    failed = sorted(
        f"{r['suite']}: {r['expectation']}({r['column'] or ''})" for r in rows if not r["success"]
    )
    found = Outcome(len(rows), tuple(failed))
    if raise_on_failure and failed:
        raise SuiteFailure("; ".join(failed))
    return found


def rows_validated(tables: dict[str, DataFrame], suites: Iterable[Suite]) -> DataFrame:
    """Rows that each suite looks at: (suite, rows_validated)."""
    parts = []
    for s in suites:
        rows = tables[s.table] if s.where is None else tables[s.table].where(s.where)
        parts.append(rows.agg(F.lit(s.name).alias("suite"), F.count(F.lit(1)).alias("rows_validated")))
    return reduce(DataFrame.unionByName, parts)


def summarise(results: DataFrame) -> DataFrame:
    """Per suite: evaluated, passed, failed, overall success."""
    return results.groupBy("suite").agg(
        F.count(F.lit(1)).alias("evaluated"),
        F.count_if(F.col("success")).alias("passed"),
        F.count_if(~F.col("success")).alias("failed"),
        F.every(F.col("success")).alias("success"),
    )


def write_report(spark: SparkSession, results: DataFrame, root: str, stamp: str) -> str:
    """JSON report under a time stamp and again as ``latest``; the result rows are few
    (one per expectation), so each is one file."""
    stamped = results.withColumn("generated_at", F.lit(stamp)).coalesce(1)
    path = f"{root.rstrip('/')}/validation-{stamp}"
    stamped.write.mode("overwrite").json(path)
    spark.read.schema(stamped.schema).json(path).coalesce(1).write.mode("overwrite").json(
        f"{root.rstrip('/')}/latest"
    )
    return path
