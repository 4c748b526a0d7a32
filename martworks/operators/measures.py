"""Measures per key that follow changes of their rows without being summed again.

What each order adds to a key is a contribution. When orders are computed anew, their old
contributions are taken back and the new ones added: sums and counts merge into the stored
measures by key, so only contributions of changed orders are read. The first and last day
merge as well, unless the day taken back was the bound itself; the few keys where it was
are looked up in all contributions again."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Measures:
    """``count`` is one of ``sums``: a key whose count is zero has no row. ``day`` is the
    column of the contributions that ``first`` and ``last`` bound; without it there are none."""

    keys: tuple[str, ...]
    sums: tuple[str, ...]
    count: str
    day: str | None = None

    def _bounds(self, prefix: str = "", where=None) -> list:
        if not self.day:
            return []
        day = F.col(self.day) if where is None else F.when(where, F.col(self.day))
        return [F.min(day).alias(f"{prefix}first"), F.max(day).alias(f"{prefix}last")]

    def of(self, contributions: DataFrame) -> DataFrame:
        """The measures of all contributions; those without a key count for none."""
        return self._keyed(contributions).groupBy(*self.keys).agg(
            *[F.sum(c).alias(c) for c in self.sums], *self._bounds()
        )

    def _keyed(self, rows: DataFrame) -> DataFrame:
        for key in self.keys:
            rows = rows.where(F.col(key).isNotNull())
        return rows

    def delta(self, old: DataFrame, new: DataFrame) -> DataFrame:
        """What changed orders add and take back, one row for each key among them."""
        columns = [*self.keys, *self.sums, *([self.day] if self.day else [])]
        added = self._keyed(new).select(*columns, F.lit(True).alias("_new"))
        taken = self._keyed(old).select(*columns, F.lit(False).alias("_new"))
        is_new = F.col("_new")
        signed = [F.sum(F.when(is_new, F.col(c)).otherwise(-F.col(c))).alias(c) for c in self.sums]
        return added.union(taken).groupBy(*self.keys).agg(
            *signed, *self._bounds("added_", is_new), *self._bounds("taken_", ~is_new)
        )

    def merged(self, stored: DataFrame, delta: DataFrame, contributions: DataFrame) -> DataFrame:
        """``stored`` measures after ``delta``. ``contributions`` are all of them as they are
        now; they are read for keys whose first or last day was taken back."""
        change = delta.select(*self.keys, *[F.col(c).alias(f"_{c}") for c in delta.columns if c not in self.keys])
        both = stored.join(change, list(self.keys), "full_outer")
        sums = [
            (F.coalesce(F.col(c), F.lit(0)) + F.coalesce(F.col(f"_{c}"), F.lit(0))).cast(stored.schema[c].dataType).alias(c)
            for c in self.sums
        ]
        if not self.day:
            return both.select(*self.keys, *sums).where(F.col(self.count) > 0)
        lost_first = F.col("_taken_first") <= F.col("first")
        lost_last = F.col("_taken_last") >= F.col("last")
        lost = (lost_first & ~F.coalesce(F.col("_added_first") <= F.col("first"), F.lit(False))) | (
            lost_last & ~F.coalesce(F.col("_added_last") >= F.col("last"), F.lit(False))
        )
        moved = both.select(
            *self.keys, *sums,
            F.least("first", "_added_first").alias("first"), F.greatest("last", "_added_last").alias("last"),
            F.coalesce(lost, F.lit(False)).alias("_lost"),
        ).where(F.col(self.count) > 0)
        lost_keys = moved.where("_lost").select(*self.keys)
        again = self._keyed(contributions).join(lost_keys, list(self.keys), "left_semi").groupBy(*self.keys).agg(
            *self._bounds("new_")
        )
        bound = lambda c: F.when(F.col("_lost"), F.col(f"new_{c}")).otherwise(F.col(c)).alias(c)
        return moved.join(again, list(self.keys), "left").select(*self.keys, *self.sums, bound("first"), bound("last"))
