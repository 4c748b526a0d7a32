"""Per-key selection: latest row, top n, first by order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def top_n_per_group(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], n: int
) -> DataFrame:
    """The first ``n`` rows of every group under a total order.

    Spark turns ``row_number() <= n`` into a group limit that runs before the
    exchange as well as after it: a group holding a third of all rows reaches its
    reducer as at most ``n`` rows per map task."""
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return (
        df.withColumn(_RANK, F.row_number().over(window))
        .where(F.col(_RANK) <= n)
        .drop(_RANK)
    )


def latest_by_key(
    df: DataFrame,
    keys: Sequence[str],
    loaded_at: str = "_ingested_at",
    order_by: Sequence[Column] | None = None,
    dealt_by: Sequence[str] = (),
) -> DataFrame:
    """Most recently loaded copy of every key.

    All rows of one load share one timestamp, so the load time alone is not a total
    order. Remaining columns break the tie, which makes replays deterministic.

    ``dealt_by`` names key columns that the rows are dealt by first: what follows and groups or
    joins by them needs no exchange, and map tasks, whose rows rarely hold two copies of a
    key, need not sort (and spill) theirs."""
    if dealt_by:
        df = df.repartition(*dealt_by)
    if order_by is None:
        tie = [c for c in df.columns if c not in keys and c != loaded_at]
        lineage = [c for c in tie if c == "_run_id"]
        rest = [c for c in tie if c not in lineage]
        order_by = [F.col(c).desc_nulls_last() for c in [loaded_at, *lineage, *rest]]
    return top_n_per_group(df, keys, order_by, 1)


def first_value_by(value: Column, *order: Column) -> Column:
    """Aggregate: ``value`` of the row that comes first by ``order`` (ascending).
    Used where a groupBy on the same key already exists, instead of a second
    shuffle for a ranking window and a join back."""
    return F.min_by(value, F.struct(*order))
