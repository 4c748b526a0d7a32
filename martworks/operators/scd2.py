"""Type-2 history: snapshot by comparison, version numbering, point-in-time join and
the structural check of the intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martworks.functions.columns import surrogate_key

# Fixed value: stands for the open end of a validity interval.
OPEN_END = "9999-12-31 00:00:00"


def _timestamp(value: Column | str) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp_ntz")


def _open_end() -> Column:
    return F.lit(OPEN_END).cast("timestamp_ntz")


def first_snapshot(incoming: DataFrame, as_of: Column | str) -> DataFrame:
    return incoming.withColumn("valid_from", _timestamp(as_of)).withColumn(
        "valid_to", F.lit(None).cast("timestamp_ntz")
    )


def merge_open(
    opened: DataFrame,
    incoming: DataFrame,
    key: str,
    check_cols: Sequence[str],
    as_of: Column | str,
    close_missing: bool = True,
) -> DataFrame:
    """Compare the open versions (one per key) with the incoming rows (one per key).

    One full outer join decides per key which versions come out: unchanged stays as
    stored, changed closes the old and opens a new one, a new key opens, a key that
    disappeared closes. Both sides have one row per key, so the join cannot skew."""
    now = _timestamp(as_of)
    attributes = [c for c in incoming.columns if c != key]
    version = [key, *attributes, "valid_from", "valid_to"]
    old = opened.select(F.struct(*version).alias("old"), F.col(key).alias("_old_key"))
    new = first_snapshot(incoming, now).select(
        F.struct(*version).alias("new"), F.col(key).alias("_new_key")
    )
    has_old, has_new = F.col("_old_key").isNotNull(), F.col("_new_key").isNotNull()
    same = F.lit(True)
    for c in check_cols:
        same = same & F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))
    closed = F.col("old").withField("valid_to", now)
    gone = closed if close_missing else F.col("old")
    versions = (
        F.when(has_old & has_new & same, F.array("old"))
        .when(has_old & has_new, F.array(closed, F.col("new")))
        .when(has_old, F.array(gone))
        .otherwise(F.array("new"))
    )
    return (
        old.join(new, F.col("_old_key") == F.col("_new_key"), "full_outer")
        .select(F.explode(versions).alias("v"))
        .select("v.*")
    )


def snapshot_check(
    current: DataFrame | None,
    incoming: DataFrame,
    key: str,
    check_cols: Sequence[str],
    as_of: Column | str,
    close_missing: bool = True,
    backdate_first: Column | str | None = None,
) -> DataFrame:
    """Next state of a Type-2 table. Closed versions pass through untouched.

    Attributes outside ``check_cols`` are carried but do not open a version. With
    ``backdate_first`` the first load opens its versions at that time instead of
    ``as_of``, so that facts older than the first snapshot still find a version."""
    if current is None:
        start = as_of if backdate_first is None else backdate_first
        return first_snapshot(incoming, start)
    closed = current.where(F.col("valid_to").isNotNull())
    opened = current.where(F.col("valid_to").isNull())
    merged = merge_open(opened, incoming, key, check_cols, as_of, close_missing)
    return closed.unionByName(merged, allowMissingColumns=True)


def history(snapshot: DataFrame, key: str) -> DataFrame:
    """Version key, currency flag and version number. A key gains at most one version
    per snapshot run, which bounds the window's groups."""
    order = Window.partitionBy(key).orderBy("valid_from", F.col("valid_to").asc_nulls_last())
    return (
        snapshot.withColumn("version_key", surrogate_key(key, "valid_from"))
        .withColumn("is_current", F.col("valid_to").isNull())
        .withColumn("version_number", F.row_number().over(order))
    )


def point_in_time_join(
    fact: DataFrame, hist: DataFrame, key: str, at: str, how: str = "inner"
) -> DataFrame:
    """Attach the version that was valid at ``at``: equality on the key plus the
    half-open interval as residual. History columns that collide with fact columns
    are prefixed with ``version_``. A history small enough is broadcast by Spark's
    own size check; otherwise adaptive execution splits a hot key on the fact side."""
    taken = set(fact.columns)
    side = hist.select(
        [
            F.col(c).alias(f"version_{c}" if c in taken else c)
            for c in hist.columns
        ]
    )
    match = (
        (fact[key] == F.col(f"version_{key}"))
        & (fact[at] >= F.col("valid_from"))
        & (F.col("valid_to").isNull() | (fact[at] < F.col("valid_to")))
    )
    return fact.join(side, match, how).drop(f"version_{key}")


def history_violations(
    hist: DataFrame,
    key: str,
    version_key: str = "version_key",
    current: str = "is_current",
) -> DataFrame:
    """``(key, violation)`` for every key that breaks a Type-2 invariant.

    Overlap is found in sorted order instead of by a self-join: an interval overlaps an
    earlier one when the latest end seen before it lies after its start. A version
    whose end is not after its start is probed at its end, where it overlaps exactly
    the intervals that contain it. Copies of one version are collapsed first, so the
    window sees distinct intervals only, whatever the number of copies."""
    end = F.coalesce("valid_to", _open_end())
    rows = hist.select(
        F.col(key),
        F.col(version_key).alias("_version"),
        F.col("valid_from").alias("_from"),
        end.alias("_to"),
        F.col("valid_to").isNotNull().alias("_closed"),
        F.col(current).alias("_current"),
    )
    per_key = (
        rows.groupBy(key)
        .agg(
            F.count_if(F.col("_current")).alias("open_versions"),
            F.count_if(F.col("_closed") & (F.col("_to") <= F.col("_from"))).alias("reversed"),
        )
        .select(
            key,
            F.explode(
                F.filter(
                    F.array(
                        F.when(F.col("open_versions") > 1, "expected exactly one open version"),
                        F.when(F.col("reversed") > 0, "valid_to precedes valid_from"),
                    ),
                    lambda v: v.isNotNull(),
                )
            ).alias("violation"),
        )
    )
    proper = F.col("_to") > F.col("_from")
    probes = (
        rows.groupBy(key, "_version", "_from", "_to")
        .count()
        .select(
            key,
            "_version",
            "_from",
            F.when(proper, F.col("_to")).alias("_end"),
            F.when(proper, F.col("_from")).otherwise(F.col("_to")).alias("_at"),
            F.when(proper, F.lit(1)).otherwise(F.lit(0)).alias("_kind"),
        )
        # Same version, same start: keep the longest, a version never overlaps itself.
        .groupBy(key, "_version", "_from", "_at", "_kind")
        .agg(F.max("_end").alias("_end"))
    )
    # A key may hold a large share of all versions, so its intervals are cut into days:
    # the latest end of earlier days comes from a small aggregate (a row per key and
    # day), the rest from a window inside the day.
    sliced = probes.where(F.col("_at").isNotNull()).withColumn("_day", F.to_date("_at"))
    earlier_days = Window.partitionBy(key).orderBy("_day").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = (
        sliced.groupBy(key, "_day")
        .agg(F.max("_end").alias("_end"))
        .select(key, "_day", F.max("_end").over(earlier_days).alias("_carried"))
    )
    same_day = (
        Window.partitionBy(key, "_day")
        .orderBy("_at", "_kind", "_version")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    overlapping = (
        sliced.withColumn("_within", F.max("_end").over(same_day))
        .join(carried, [key, "_day"])
        .where(F.greatest("_carried", "_within") > F.col("_from"))
        .select(key, F.lit("versions overlap in time").alias("violation"))
        .distinct()
    )
    return per_key.unionByName(overlapping)


def history_summary(hist: DataFrame, key: str) -> DataFrame:
    return hist.agg(
        F.count(F.lit(1)).alias("versions"),
        F.count_distinct(key).alias("sellers"),
        F.count_if(F.col("is_current")).alias("current_versions"),
        F.count_if(F.col("version_number") > 1).alias("superseding_versions"),
    )


def changed_versions(hist: DataFrame, key: str, keys: int = 3) -> DataFrame:
    """All versions of the first ``keys`` keys (by key) that have more than one."""
    changed = (
        hist.groupBy(key)
        .count()
        .where(F.col("count") > 1)
        .orderBy(key)
        .limit(keys)
        .select(key)
    )
    return hist.join(changed, key, "left_semi")
