"""Dashboard and monitoring queries over the marts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martworks.functions.columns import rate
from martworks.operators.keyed import top_n_per_group
from martworks.operators.scd2 import point_in_time_join
from martworks.quality.invariants import delivery_rate


def _day(as_of: Column | str) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")


def _order_measures(daily: DataFrame, once: bool, *keep: str) -> DataFrame:
    """The daily aggregate repeats the order counts of a day and state on each of its
    category rows. ``once`` reduces them to one row per day and state first, so sums
    count an order once; otherwise they are summed as they stand."""
    columns = ["purchased_date", "customer_state", *keep]
    return daily.select(*columns).distinct() if once else daily.select(*columns)


def monthly_revenue_by_region(
    daily: DataFrame, calendar: DataFrame, orders_once: bool = False
) -> DataFrame:
    month = calendar.select(F.col("date_key").alias("purchased_date"), "month_start_date")
    keys = ["month_start_date", "customer_region"]
    money = (
        daily.join(month, "purchased_date", "inner")
        .groupBy(*keys)
        .agg(
            F.sum("total_revenue").alias("revenue"),
            F.sum("gross_item_revenue").alias("product_revenue"),
            F.sum("freight_revenue").alias("shipping_revenue"),
            F.sum("orders_placed").alias("orders"),
        )
    )
    if orders_once:
        placed = (
            _order_measures(daily, True, "customer_region", "orders_placed")
            .join(month, "purchased_date", "inner")
            .groupBy(*keys)
            .agg(F.sum("orders_placed").alias("orders"))
        )
        same = [money[k].eqNullSafe(placed[k]) for k in keys]
        money = money.drop("orders").join(placed, same, "left").select(
            *[money[k] for k in keys],
            "revenue",
            "product_revenue",
            "shipping_revenue",
            "orders",
        )
    return money.orderBy(*keys)


def weekly_late_rate(
    daily: DataFrame, calendar: DataFrame, floor: int = 20, orders_once: bool = False
) -> DataFrame:
    """Late share per week and state; small denominators are left out."""
    week = calendar.select(F.col("date_key").alias("purchased_date"), "week_start_date")
    return (
        _order_measures(daily, orders_once, "orders_late", "orders_delivered")
        .join(week, "purchased_date", "inner")
        .groupBy("week_start_date", "customer_state")
        .agg(
            F.sum("orders_late").alias("late_orders"),
            F.sum("orders_delivered").alias("delivered_orders"),
        )
        .where(F.col("delivered_orders") >= floor)
        .withColumn("late_rate", rate("late_orders", "delivered_orders", None))
        .orderBy(F.desc("late_rate"), "week_start_date", "customer_state")
    )


def worst_sellers(sellers: DataFrame, floor: int = 50, n: int = 25) -> DataFrame:
    return (
        sellers.where(F.col("delivered_order_count") >= floor)
        .select(
            "seller_key",
            "seller_city",
            "seller_state",
            "delivered_order_count",
            "late_order_count",
            "late_delivery_rate",
            "avg_days_to_delivery",
        )
        .orderBy(F.desc_nulls_last("late_delivery_rate"), "seller_key")
        .limit(n)
    )


def _exact_avg(name: str, scale: int) -> Column:
    """Average of rounded values by an exact decimal sum: the order in which rows are
    added cannot change the result."""
    value = F.col(name).cast(f"decimal(18,{scale})")
    return F.try_divide(F.sum(value).cast("double"), F.count(value))


def top_categories_by_region(
    daily: DataFrame, as_of: Column | str, days: int = 365, n: int = 10
) -> DataFrame:
    recent = daily.where(F.col("purchased_date") >= F.date_sub(_day(as_of), days))
    ranked = recent.groupBy("customer_region", "category_name").agg(
        F.sum("total_revenue").alias("revenue"),
        F.sum("item_count").alias("units"),
        _exact_avg("avg_review_score", 3).alias("review_score"),
        _exact_avg("avg_freight_ratio", 4).alias("freight_ratio"),
    )
    order = [F.desc("revenue"), F.asc_nulls_last("category_name")]
    return top_n_per_group(ranked, ["customer_region"], order, n).orderBy(
        "customer_region", F.desc("revenue")
    )


def revenue_by_seller_place(line_facts: DataFrame, sellers_history: DataFrame) -> DataFrame:
    """Revenue by the state and region a seller was in when the order was placed."""
    places = sellers_history.select(
        "seller_key",
        F.col("seller_state").alias("historic_state"),
        F.col("seller_region").alias("historic_region"),
        "valid_from",
        "valid_to",
    )
    lines = line_facts.select("seller_key", "purchased_at", "item_total")
    return (
        point_in_time_join(lines, places, "seller_key", "purchased_at")
        .groupBy("historic_state", "historic_region")
        .agg(F.count(F.lit(1)).alias("lines"), F.sum("item_total").alias("revenue"))
    )


# The benchmark trio: the same questions on the line fact and on the daily aggregate.


def _revenue(df: DataFrame) -> Column:
    return F.sum("total_revenue" if "total_revenue" in df.columns else "item_total").alias(
        "revenue"
    )


def monthly_trend(facts: DataFrame) -> DataFrame:
    month = F.trunc("purchased_date", "month").alias("month_start_date")
    return facts.groupBy(month).agg(_revenue(facts)).orderBy("month_start_date")


def region_category_revenue(facts: DataFrame) -> DataFrame:
    return facts.groupBy("customer_region", "category_name").agg(_revenue(facts))


def top_states(facts: DataFrame, year: int, n: int = 10) -> DataFrame:
    """The year is a date range, not a function of the date: that prunes partitions."""
    first, last = f"{year}-01-01", f"{year}-12-31"
    return (
        facts.where(F.col("purchased_date").between(_day(first), _day(last)))
        .groupBy("customer_state")
        .agg(_revenue(facts))
        .orderBy(F.desc("revenue"), "customer_state")
        .limit(n)
    )


def load_volume(raw: DataFrame, n: int = 10) -> DataFrame:
    """Rows per load date, newest dates first."""
    return (
        raw.groupBy("ingest_date")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy(F.desc("ingest_date"))
        .limit(n)
    )


def one_row(*frames: DataFrame) -> DataFrame:
    """Several one-row relations side by side, by union and one fold: no join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def headline_metrics(
    order_facts: DataFrame, line_facts: DataFrame, sellers_history: DataFrame
) -> DataFrame:
    return one_row(
        order_facts.agg(
            F.count(F.lit(1)).alias("orders"),
            F.min("purchased_date").alias("first_date"),
            F.max("purchased_date").alias("last_date"),
        ),
        delivery_rate(order_facts).select(F.col("late_rate").alias("late_delivery_rate")),
        line_facts.agg(
            F.count(F.lit(1)).alias("order_lines"),
            F.sum("item_total").alias("gross_revenue"),
        ),
        sellers_history.agg(
            F.count(F.lit(1)).alias("scd2_versions"),
            F.count_distinct("seller_key").alias("scd2_sellers"),
        ),
    )


# Pipeline run metrics: one row per task of a run.

RUN_METRICS_SCHEMA = (
    "run_date DATE, dag_id STRING, task_id STRING, run_id STRING, "
    "started_at TIMESTAMP_NTZ, finished_at TIMESTAMP_NTZ, duration_seconds DOUBLE, "
    "status STRING, rows_processed BIGINT, details STRING"
)


def task_seconds(runs: DataFrame) -> DataFrame:
    """Runtime per task to two digits: the recorded one, else end minus start. A task
    without either stays NULL, so a missing measurement never looks like zero."""
    elapsed = F.timestamp_diff("MICROSECOND", F.col("started_at"), F.col("finished_at"))
    seconds = F.coalesce(F.col("duration_seconds"), elapsed / F.lit(1e6))
    return runs.withColumn("seconds", F.round(seconds, 2))


def run_summary(runs: DataFrame) -> DataFrame:
    total = F.sum(F.col("seconds").cast("decimal(18,2)")).cast("double")
    return (
        task_seconds(runs)
        .groupBy("run_date", "dag_id", "run_id")
        .agg(
            total.alias("total_seconds"),
            F.count(F.lit(1)).alias("tasks"),
            F.count_if(F.col("seconds").isNull()).alias("tasks_without_timing"),
            F.sum("rows_processed").alias("rows_processed"),
        )
    )


def average_durations(runs: DataFrame, as_of: Column | str, days: int = 30) -> DataFrame:
    return (
        runs.where(F.col("run_date") >= F.date_sub(_day(as_of), days))
        .groupBy("run_date", "task_id")
        .agg(F.avg("duration_seconds").alias("avg_seconds"))
        .orderBy(F.desc("run_date"), F.desc("avg_seconds"))
    )


def slowest_tasks(runs: DataFrame, n: int = 5) -> DataFrame:
    return (
        task_seconds(runs)
        .where(F.col("seconds").isNotNull())
        .orderBy(F.desc("seconds"), "run_date", "run_id", "task_id")
        .limit(n)
    )


def append_run_metrics(runs: DataFrame, path: str) -> None:
    """Append to the run history, one directory per run date."""
    runs.write.mode("append").partitionBy("run_date").parquet(path)
