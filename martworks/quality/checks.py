"""Declarative data tests: what violates them, and how to run many at once."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROW_KINDS = ("not_null", "accepted_values", "between", "value_length")

@dataclass(frozen=True)
class Check:
    model: str
    kind: str
    columns: tuple[str, ...]
    values: tuple = ()
    low: float | None = None
    high: float | None = None
    length: int | None = None
    parent: str | None = None
    parent_column: str | None = None

    @property
    def column(self) -> str:
        return ",".join(self.columns)

def not_null(model: str, *columns: str) -> list[Check]:
    return [Check(model, "not_null", (c,)) for c in columns]

def unique(model: str, *columns: str) -> list[Check]:
    return [Check(model, "unique", (c,)) for c in columns]

def unique_combination(model: str, *columns: str) -> list[Check]:
    return [Check(model, "unique_combination", columns)]

def accepted(model: str, column: str, *values) -> list[Check]:
    return [Check(model, "accepted_values", (column,), values=values)]

def between(model: str, column: str, low=None, high=None) -> list[Check]:
    return [Check(model, "between", (column,), low=low, high=high)]

def value_length(model: str, column: str, length: int) -> list[Check]:
    return [Check(model, "value_length", (column,), length=length)]

def relationship(model: str, column: str, parent: str, parent_column: str) -> list[Check]:
    return [
        Check(model, "relationship", (column,), parent=parent, parent_column=parent_column)
    ]

def breaks(check: Check) -> Column:
    """Row condition of a row-level check. NULL passes everything but not_null."""
    value = F.col(check.columns[0])
    if check.kind == "not_null":
        return value.isNull()
    if check.kind == "accepted_values":
        return ~value.isin(*check.values)
    if check.kind == "value_length":
        return F.length(value) != check.length
    if check.kind == "between":
        bad = F.lit(False)
        if check.low is not None:
            bad = bad | (value < check.low)
        if check.high is not None:
            bad = bad | (value > check.high)
        return bad
    raise ValueError(f"{check.kind} is not a row-level check")

def duplicates(df: DataFrame, *columns: str, keep_null: bool = False) -> DataFrame:
    """Key values that occur more than once, with their number of rows."""
    rows = df
    if not keep_null:
        for c in columns:
            rows = rows.where(F.col(c).isNotNull())
    counted = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") > 1)

def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child key values without a parent, with their number of rows. Keys are counted
    before the join, so a value that fills a third of the child crosses the network as
    one row per map task."""
    keys = (
        child.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    known = parent.select(F.col(parent_column).alias(column))
    return keys.join(known, column, "left_anti")

def violations(check: Check, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The failing rows (or key values) of one check."""
    df = tables[check.model]
    if check.kind in ROW_KINDS:
        return df.where(breaks(check))
    if check.kind == "unique":
        return duplicates(df, *check.columns)
    if check.kind == "unique_combination":
        return duplicates(df, *check.columns, keep_null=True)
    return orphans(df, check.columns[0], tables[check.parent], check.parent_column)

def store_violations(check: Check, tables: Mapping[str, DataFrame], root: str) -> str:
    """Write the failing rows of a check below ``root`` for inspection."""
    name = "__".join([check.model, check.kind, *check.columns])
    path = f"{root.rstrip('/')}/{name}"
    violations(check, tables).write.mode("overwrite").parquet(path)
    return path

def _label(check: Check) -> list[Column]:
    return [
        F.lit(check.model).alias("model"),
        F.lit(check.kind).alias("check"),
        F.lit(check.column).alias("column"),
    ]

def packed(text: Column) -> Column:
    """``text`` as bytes, different for different texts. Even numbers of hex digits (hashes,
    many ids) take half of them; the first byte tells which of both it is."""
    hexed = text.rlike(r"\A[0-9a-f]+\z") & (F.length(text) % 2 == 0)
    return F.when(hexed, F.concat(F.lit(b"\x01"), F.unhex(text))).otherwise(
        F.concat(F.lit(b"\x00"), text.cast("binary"))
    )


def _key(columns: tuple[str, ...]) -> Column:
    """The values as bytes, different for different values. NULL is a value of a
    combination."""
    if len(columns) == 1:
        return packed(F.col(columns[0]).cast("string"))
    parts = []
    for c in columns:
        text = F.col(c).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return packed(F.concat(*parts))


def _entry(domain: int, key: Column | None = None, slot: int = 0, n: int = 1) -> Column:
    """What one row says: that it has a key of a domain (slot 0), that it needs one (the slot of
    its check), or, without a key, that it fails the check of that domain."""
    return F.struct(
        F.lit(domain).alias("domain"), (F.lit(None).cast("binary") if key is None else key).alias("key"),
        F.lit(slot).cast("tinyint").alias("slot"), F.lit(n).cast("bigint").alias("n"),
    )


def _places(checks: list[Check]) -> list[tuple[int, int]]:
    """Domain and slot of every check. A uniqueness check and the relations that point to the
    same column share a domain, where each relation has a slot of its own: the column's
    keys are counted once for all of them."""
    domains: dict[tuple, int] = {}
    slots: dict[int, int] = defaultdict(int)
    found = []
    for i, check in enumerate(checks):
        if check.kind == "relationship":
            of = ("keys", check.parent, (check.parent_column,))
        elif check.kind == "unique":
            of = ("keys", check.model, check.columns)
        else:
            of = (check.kind, i)
        domain = domains.setdefault(of, len(domains))
        slots[domain] += check.kind == "relationship"
        found.append((domain, slots[domain] if check.kind == "relationship" else 0))
    return found


def _entries(checks: list[Check]) -> dict[str, list[Column]]:
    """By table, what each of its rows says to all checks, NULL where it says nothing."""
    found: dict[str, list[Column]] = defaultdict(list)
    owned = set()

    def own(domain: int, model: str, columns: tuple[str, ...], null_counts: bool = False) -> None:
        if domain in owned:
            return
        owned.add(domain)
        known = F.lit(True)
        for c in () if null_counts else columns:
            known = known & F.col(c).isNotNull()
        found[model].append(F.when(known, _entry(domain, _key(columns))))

    for check, (domain, slot) in zip(checks, _places(checks)):
        if check.kind in ROW_KINDS:
            found[check.model].append(F.when(breaks(check), _entry(domain)))
        elif check.kind == "relationship":
            needed = _entry(domain, _key(check.columns), slot)
            found[check.model].append(F.when(F.col(check.column).isNotNull(), needed))
            own(domain, check.parent, (check.parent_column,))
        else:
            own(domain, check.model, check.columns, check.kind == "unique_combination")
    return found


def run_checks(tables: Mapping[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """One row per check with its number of failures. A relation check counts child
    rows, a uniqueness check counts key values.

    Every table is read once. Its rows say to each check what they add: failures of
    row checks, keys that must be unique, keys of children and of parents. All of it is
    counted by domain and key in one aggregate, which combines before it shuffles: a
    value that fills a third of a table crosses the network as one row per task. A key that
    several checks ask for crosses it once for each table."""
    checks = list(checks)
    spark = next(iter(tables.values())).sparkSession
    places = _places(checks)
    last = max((slot for _, slot in places), default=0)
    said = [
        tables[model].select(F.explode(F.array_compact(F.array(*entries))).alias("e"))
        for model, entries in _entries(checks).items()
    ]
    keys = (
        reduce(DataFrame.union, said)
        .select("e.*")
        .groupBy("domain", "key")
        .agg(*[F.sum(F.when(F.col("slot") == s, F.col("n"))).alias(f"n{s}") for s in range(last + 1)])
    )
    own = F.coalesce("n0", F.lit(0))
    by_domain = keys.groupBy("domain").agg(
        F.sum(own).alias("rows"),
        F.count_if(own > 1).alias("repeated"),
        *[F.sum(F.when(own == 0, F.col(f"n{s}"))).alias(f"orphans{s}") for s in range(1, last + 1)],
    )
    # Every check has a row, also one that no row says anything to.
    wanted = F.array(*[
        F.struct(*_label(c), F.lit(d).alias("domain"), F.lit(c.kind if not s else f"orphans{s}").alias("counts"))
        for c, (d, s) in zip(checks, places)
    ])
    counted = spark.range(1).select(F.explode(wanted).alias("r")).select("r.*").join(by_domain, "domain", "left")
    counts = F.col("counts")
    failures = F.when(counts.isin("unique", "unique_combination"), F.col("repeated"))
    for s in range(1, last + 1):
        failures = failures.when(counts == f"orphans{s}", F.col(f"orphans{s}"))
    failures = F.coalesce(failures.otherwise(F.col("rows")), F.lit(0).cast("bigint"))
    return counted.select("model", "check", "column", failures.alias("failures"))


def with_severity(
    results: DataFrame, warn_above: int | None = None, error_above: int = 0
) -> DataFrame:
    """Add ``status``: error above the one threshold, warn above the other, else pass."""
    status = F.when(F.col("failures") > error_above, "error")
    if warn_above is not None:
        status = status.when(F.col("failures") > warn_above, "warn")
    return results.withColumn("status", status.otherwise("pass"))

def severity(count: int, warn_above: int | None = None, error_above: int = 0) -> str:
    if count > error_above:
        return "error"
    return "warn" if warn_above is not None and count > warn_above else "pass"

def freshness(
    df: DataFrame,
    table: str,
    as_of,
    loaded_at: str = "_ingested_at",
    warn_hours: int = 24,
    error_hours: int = 48,
) -> DataFrame:
    """Age of the newest row against two limits; one row."""
    now = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp_ntz")
    newest = F.max(F.col(loaded_at).cast("timestamp_ntz"))
    overdue = lambda hours: F.col("max_loaded_at") < now - F.make_dt_interval(
        hours=F.lit(hours)
    )
    return (
        df.agg(newest.alias("max_loaded_at"))
        .withColumn(
            "status",
            F.when(F.col("max_loaded_at").isNull() | overdue(error_hours), "error")
            .when(overdue(warn_hours), "warn")
            .otherwise("pass"),
        )
        .select(F.lit(table).alias("table"), "max_loaded_at", "status")
    )
