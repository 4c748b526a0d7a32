"""Cross-table invariants. Each returns the rows that break it; none means it holds."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martworks.functions.columns import rate
from martworks.plans.staging import EARLIEST_ORDER_DATE

TOLERANCE = 0.01


def differs(left: Column, right: Column, tolerance: float = TOLERANCE) -> Column:
    return F.abs(left - right) > F.lit(str(tolerance)).cast("decimal(18,6)")


def reconcile_totals(
    left: DataFrame,
    right: DataFrame,
    measures: Mapping[str, tuple[Column, Column]],
    tolerance: float = TOLERANCE,
    sides: tuple[str, str] = ("left", "right"),
) -> DataFrame:
    """Grand totals of two relations, kept when a measure differs beyond tolerance.

    ``measures`` maps a name to the aggregate of either side. The two one-row results
    are put under each other and folded into one row, which needs no join."""
    names = list(measures)
    first = left.agg(*[measures[n][0].alias(n) for n in names])
    second = right.agg(*[measures[n][1].alias(n) for n in names])
    tagged = first.withColumn("_side", F.lit(0)).unionByName(
        second.withColumn("_side", F.lit(1))
    )
    folded = tagged.agg(
        *[
            F.max(F.when(F.col("_side") == i, F.col(n))).alias(f"{side}_{n}")
            for n in names
            for i, side in enumerate(sides)
        ]
    )
    broken = F.lit(False)
    for n in names:
        broken = broken | differs(
            F.col(f"{sides[0]}_{n}"), F.col(f"{sides[1]}_{n}"), tolerance
        )
    return folded.where(broken)


def agg_reconciles_to_fact(line_facts: DataFrame, daily: DataFrame) -> DataFrame:
    return reconcile_totals(
        line_facts,
        daily,
        {
            "item_count": (F.count(F.lit(1)), F.sum("item_count")),
            "revenue": (F.sum("item_price"), F.sum("gross_item_revenue")),
            "total": (F.sum("item_total"), F.sum("total_revenue")),
        },
        sides=("fact", "agg"),
    )


def delivery_rate(order_facts: DataFrame) -> DataFrame:
    """Delivered and late orders with the late rate; one row."""
    return (
        order_facts.where(F.col("is_delivered"))
        .agg(
            F.count(F.lit(1)).alias("delivered_orders"),
            F.count_if(F.col("is_late")).alias("late_orders"),
        )
        .withColumn("late_rate", rate("late_orders", "delivered_orders", None))
    )


def implausible_sla(order_facts: DataFrame, low: float = 0.0, high: float = 0.60) -> DataFrame:
    share = F.col("late_rate")
    return delivery_rate(order_facts).where(
        (F.col("delivered_orders") == 0) | (share <= low) | (share >= high)
    )


def impossible_dates(
    order_facts: DataFrame, as_of, earliest: str = EARLIEST_ORDER_DATE
) -> DataFrame:
    """One row per broken rule; the three rules are evaluated in one scan."""
    now = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp_ntz")
    bought, arrived = F.col("purchased_at"), F.col("delivered_at")
    floor = F.lit(f"{earliest} 00:00:00").cast("timestamp_ntz")
    rules = F.array(
        F.when(bought > now, "purchased in the future"),
        F.when(arrived < bought, "delivered before purchase"),
        F.when(bought < floor, "purchased before the business existed"),
    )
    return order_facts.select(
        "order_key",
        "purchased_at",
        "delivered_at",
        F.explode(F.array_compact(rules)).alias("violation"),
    )


def incomplete_orders(order_facts: DataFrame) -> DataFrame:
    flags = ["is_missing_payment", "is_missing_items", "is_missing_delivery_timestamp"]
    return order_facts.where(F.col(flags[0]) | F.col(flags[1]) | F.col(flags[2])).select(
        "order_key", "order_status", "delivery_status", *flags
    )


# Any incomplete order is worth a warning, more than these an error.
INCOMPLETE_WARN_ABOVE, INCOMPLETE_ERROR_ABOVE = 0, 1500


def lines_roll_up_to_orders(line_facts: DataFrame, order_facts: DataFrame) -> DataFrame:
    """Orders whose totals differ from the sum of their lines: catches joins that
    multiply or lose rows."""
    rolled = line_facts.groupBy("order_key").agg(
        F.count(F.lit(1)).alias("rolled_item_count"),
        F.sum("item_price").alias("rolled_revenue"),
        F.sum("item_total").alias("rolled_total"),
    )
    return (
        order_facts.select(
            "order_key",
            F.col("item_count").alias("order_item_count"),
            F.col("gross_item_revenue").alias("order_revenue"),
            "order_total",
        )
        .join(rolled, "order_key", "inner")
        .where(
            (F.col("order_item_count") != F.col("rolled_item_count"))
            | differs(F.col("order_revenue"), F.col("rolled_revenue"))
            | differs(F.col("order_total"), F.col("rolled_total"))
        )
    )


def unsettled_orders(order_facts: DataFrame) -> DataFrame:
    """Orders with both sides present whose payments do not settle the total."""
    return order_facts.where(
        ~F.col("is_missing_payment")
        & ~F.col("is_missing_items")
        & differs(F.col("payment_variance"), F.lit(0))
    ).select("order_key", "order_total", "payment_total", "payment_variance")


def key_sets_differ(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys present on one side only."""
    only = lambda a, b, side: (
        a.select(key)
        .join(b.select(key), key, "left_anti")
        .distinct()
        .withColumn("only_in", F.lit(side))
    )
    return only(left, right, "left").unionByName(only(right, left, "right"))


def window_overlap(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """Keys that two slices have in common; half-open slices have none."""
    return first.select(key).intersect(second.select(key))
