"""Facts, dimensions, the calendar and the daily pre-aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martworks.functions import columns as fn
from martworks.operators.keyed import top_n_per_group
from martworks.operators.measures import Measures
from martworks.operators.scd2 import history


def _or_zero(name: str):
    return F.coalesce(F.col(name), F.lit(0))


def fct_orders(
    orders: DataFrame, items: DataFrame, payments: DataFrame, reviews: DataFrame
) -> DataFrame:
    """One row per order. ``orders`` is the output of ``rollups.order_context``, the
    other inputs are the order-grain summaries, so no join can fan out and the three
    summary joins share the partitioning by order."""
    paid = payments.withColumn("_has_payment", F.lit(True))
    sold = items.withColumn("_has_items", F.lit(True))
    cents = "decimal(18,2)"
    return (
        orders.join(sold, "order_id", "left")
        .join(paid, "order_id", "left")
        .join(reviews, "order_id", "left")
        .select(
            F.col("order_id").alias("order_key"),
            F.col("customer_id").alias("customer_key"),
            "customer_unique_id",
            F.col("purchased_date").alias("purchased_date_key"),
            F.col("estimated_delivery_date").alias("estimated_delivery_date_key"),
            F.col("delivered_date").alias("delivered_date_key"),
            "order_status",
            "delivery_status",
            "customer_state",
            "customer_region",
            "customer_zip_code_prefix",
            "primary_category",
            "primary_payment_type",
            "purchased_at",
            "approved_at",
            "shipped_at",
            "delivered_at",
            "estimated_delivery_at",
            _or_zero("item_count").alias("item_count"),
            _or_zero("distinct_product_count").alias("distinct_product_count"),
            _or_zero("distinct_seller_count").alias("distinct_seller_count"),
            _or_zero("gross_item_revenue").cast(cents).alias("gross_item_revenue"),
            _or_zero("freight_revenue").cast(cents).alias("freight_revenue"),
            _or_zero("order_item_total").cast(cents).alias("order_total"),
            _or_zero("payment_total").cast(cents).alias("payment_total"),
            _or_zero("payment_count").alias("payment_count"),
            "max_installments",
            _or_zero("review_count").alias("review_count"),
            fn.numeric("avg_review_score", 3).cast("decimal(6,3)").alias("avg_review_score"),
            "first_review_score",
            "first_review_sentiment",
            "hours_to_approval",
            "days_to_delivery",
            "days_in_transit",
            "promised_lead_days",
            "delivery_vs_promise_days",
            "is_delivered",
            "is_canceled",
            "is_late",
            (_or_zero("payment_total") - _or_zero("order_item_total"))
            .cast(cents)
            .alias("payment_variance"),
            "is_missing_delivery_timestamp",
            F.col("_has_payment").isNull().alias("is_missing_payment"),
            F.col("_has_items").isNull().alias("is_missing_items"),
            "purchased_date",
        )
    )


def fct_order_items(lines: DataFrame) -> DataFrame:
    """One row per order line; ``lines`` is the output of ``rollups.line_context``,
    which already carries the delivery outcome of the order."""
    return lines.select(
        "order_item_key",
        F.col("order_id").alias("order_key"),
        "line_number",
        F.col("product_id").alias("product_key"),
        F.col("seller_id").alias("seller_key"),
        F.col("customer_id").alias("customer_key"),
        "customer_unique_id",
        F.col("purchased_date").alias("purchased_date_key"),
        "order_status",
        "delivery_status",
        "category_name",
        "seller_state",
        "seller_region",
        "customer_state",
        "customer_region",
        "is_intrastate_shipment",
        "purchased_at",
        "shipping_limit_at",
        "item_price",
        "freight_value",
        "item_total",
        F.when(F.col("item_price") > 0, fn.rate("freight_value", "item_price")).alias(
            "freight_ratio"
        ),
        "product_weight_g",
        "product_volume_cm3",
        "is_delivered",
        "is_late",
        "days_to_delivery",
        "purchased_date",
    )


def dim_geography(geolocation: DataFrame) -> DataFrame:
    """Centroid and modal place per postcode prefix, in two aggregates.

    Samples are first collapsed to (postcode, city, state) with partial sums; the
    centroid and the most frequent place both follow from that small relation, so
    the sample table is shuffled once."""
    places = geolocation.groupBy("zip_code_prefix", "city", "state").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("latitude").alias("lat"),
        F.sum("longitude").alias("lng"),
    )
    modal = F.min_by(
        F.struct("city", "state"),
        F.struct(
            -F.col("n"),
            F.col("city").isNull(),
            F.col("city"),
            F.col("state").isNull(),
            F.col("state"),
        ),
    )
    return (
        places.groupBy("zip_code_prefix")
        .agg(
            modal.alias("place"),
            (F.sum("lat") / F.sum("n")).alias("latitude"),
            (F.sum("lng") / F.sum("n")).alias("longitude"),
            F.sum("n").alias("observation_count"),
        )
        .where(F.col("zip_code_prefix").isNotNull())
        .select(
            "zip_code_prefix",
            F.col("place.city").alias("city"),
            F.col("place.state").alias("state"),
            fn.macro_region("place.state").alias("region"),
            fn.numeric("latitude", 6).alias("latitude"),
            fn.numeric("longitude", 6).alias("longitude"),
            "observation_count",
        )
    )


def _located(people: DataFrame, geography: DataFrame, city: str) -> DataFrame:
    """Left join to the geography dimension; its city wins over the source's."""
    place = geography.select(
        "zip_code_prefix",
        F.col("city").alias("_city"),
        "latitude",
        "longitude",
        F.lit(True).alias("_located"),
    )
    return people.join(place, "zip_code_prefix", "left").withColumn(
        city, F.coalesce("_city", city)
    )


#: What orders add to a person, lines to a seller and to a product. All are kept by key and
#: merged with the changes of a run.
CUSTOMER_MEASURES = Measures(("customer_unique_id",), ("orders", "value"), "orders", "purchased_date")
SELLER_MEASURES = Measures(
    ("seller_id",),
    ("orders", "items", "price", "freight", "delivered", "late", "days", "days_known"),
    "orders",
    "purchased_date",
)
PRODUCT_MEASURES = Measures(("product_id",), ("orders", "units", "price"), "units")
PRODUCT_SELLERS = Measures(("product_id", "seller_id"), ("units",), "units")


def customer_contributions(order_facts: DataFrame) -> DataFrame:
    """``order_facts`` needs one row per order with ``customer_unique_id``, ``order_total`` and
    ``purchased_date``; the order fact is exactly that."""
    return order_facts.select(
        "customer_unique_id", F.lit(1).cast("bigint").alias("orders"), F.col("order_total").alias("value"), "purchased_date"
    )


def seller_contributions(lines: DataFrame) -> DataFrame:
    """One row per seller and order: distinct orders are then plain counts, and a seller
    with very many lines is spread over its orders. ``lines`` are order lines that have an
    order (the line fact under its source key names)."""
    flag = lambda c: F.coalesce(F.bool_or(c), F.lit(False)).cast("bigint").alias(c.removeprefix("is_"))
    return lines.groupBy("seller_id", "order_id").agg(
        F.lit(1).cast("bigint").alias("orders"),
        F.count(F.lit(1)).alias("items"),
        F.sum("item_price").alias("price"),
        F.sum("freight_value").alias("freight"),
        F.min("purchased_date").alias("purchased_date"),
        flag("is_delivered"),
        flag("is_late"),
        F.coalesce(F.sum("days_to_delivery"), F.lit(0)).alias("days"),
        F.count("days_to_delivery").alias("days_known"),
    )


def product_contributions(lines: DataFrame) -> DataFrame:
    """One row per product and order; a product with very many lines is spread over them."""
    known = F.col("order_id").isNotNull().cast("bigint")
    return lines.groupBy("product_id", "order_id").agg(F.count(F.lit(1)).alias("units"), F.sum("item_price").alias("price")).select(
        "product_id", known.alias("orders"), "units", "price"
    )


def product_seller_contributions(lines: DataFrame) -> DataFrame:
    return lines.select("product_id", "seller_id", F.lit(1).cast("bigint").alias("units"))


def dim_customers(
    customers: DataFrame, order_facts: DataFrame, geography: DataFrame
) -> DataFrame:
    """One row per ``customer_id`` with the lifetime measures of the person."""
    lifetime = CUSTOMER_MEASURES.of(customer_contributions(order_facts))
    return customers_with(customers, lifetime, geography)


def customers_with(customers: DataFrame, measures: DataFrame, geography: DataFrame) -> DataFrame:
    lifetime = measures.select(
        "customer_unique_id",
        F.col("orders").alias("lifetime_order_count"),
        F.col("value").alias("lifetime_gross_value"),
        F.col("first").alias("first_order_date"),
        F.col("last").alias("most_recent_order_date"),
    )
    return (
        _located(customers, geography, "customer_city")
        .join(lifetime, "customer_unique_id", "left")
        .select(
            F.col("customer_id").alias("customer_key"),
            "customer_unique_id",
            "zip_code_prefix",
            "customer_city",
            "customer_state",
            "customer_region",
            "latitude",
            "longitude",
            "lifetime_order_count",
            F.col("lifetime_gross_value").cast("decimal(18,2)").alias("lifetime_gross_value"),
            "first_order_date",
            "most_recent_order_date",
            (F.col("lifetime_order_count") > 1).alias("is_repeat_customer"),
            F.col("_located").isNull().alias("is_missing_geography"),
        )
    )


def dim_products(products: DataFrame, items: DataFrame) -> DataFrame:
    """Products with sales. The pairs of product and seller come from one aggregate, the
    orders from another; neither holds a product's rows together."""
    return products_with(
        products,
        PRODUCT_MEASURES.of(product_contributions(items)),
        PRODUCT_SELLERS.of(product_seller_contributions(items)),
    )


def products_with(products: DataFrame, measures: DataFrame, sellers: DataFrame) -> DataFrame:
    known = sellers.groupBy("product_id").agg(F.count(F.lit(1)).alias("seller_count"))
    sales = measures.select(
        "product_id",
        F.col("units").alias("units_sold"),
        F.col("orders").alias("orders_containing_product"),
        F.col("price").alias("gross_revenue"),
    ).join(known, "product_id", "left")
    average = F.col("gross_revenue").cast("double") / F.col("units_sold")
    return products.join(sales, "product_id", "left").select(
        F.col("product_id").alias("product_key"),
        "category_name",
        "category_name_pt",
        "product_name_length",
        "product_description_length",
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
        "product_volume_cm3",
        fn.weight_class("product_weight_g").alias("weight_class"),
        _or_zero("units_sold").alias("units_sold"),
        _or_zero("orders_containing_product").alias("orders_containing_product"),
        _or_zero("seller_count").alias("seller_count"),
        _or_zero("gross_revenue").cast("decimal(18,2)").alias("gross_revenue"),
        fn.money(average).alias("avg_selling_price"),
        (F.col("category_name") == fn.UNKNOWN).alias("is_uncategorised"),
        F.col("units_sold").isNull().alias("is_never_sold"),
    )


def dim_sellers(sellers: DataFrame, lines: DataFrame, geography: DataFrame) -> DataFrame:
    """Sellers with sales and fulfilment; both come from one aggregate over ``lines``."""
    return sellers_with(sellers, SELLER_MEASURES.of(seller_contributions(lines)), geography)


def sellers_with(sellers: DataFrame, measures: DataFrame, geography: DataFrame) -> DataFrame:
    activity = measures.select(
        "seller_id",
        F.col("orders").alias("order_count"),
        F.col("items").alias("items_sold"),
        F.col("price").alias("gross_revenue"),
        F.col("freight").alias("freight_charged"),
        F.col("first").alias("first_sale_date"),
        F.col("last").alias("most_recent_sale_date"),
        "delivered",
        "late",
        F.try_divide(F.col("days").cast("double"), F.col("days_known")).alias("avg_days"),
    )
    return (
        _located(sellers, geography, "seller_city")
        .join(activity, "seller_id", "left")
        .select(
            F.col("seller_id").alias("seller_key"),
            "seller_city",
            "seller_state",
            "seller_region",
            "zip_code_prefix",
            "latitude",
            "longitude",
            _or_zero("order_count").alias("order_count"),
            _or_zero("items_sold").alias("items_sold"),
            _or_zero("gross_revenue").cast("decimal(18,2)").alias("gross_revenue"),
            _or_zero("freight_charged").cast("decimal(18,2)").alias("freight_charged"),
            "first_sale_date",
            "most_recent_sale_date",
            _or_zero("delivered").alias("delivered_order_count"),
            _or_zero("late").alias("late_order_count"),
            fn.rate("late", "delivered").alias("late_delivery_rate"),
            fn.numeric("avg_days", 2).alias("avg_days_to_delivery"),
        )
    )


# Bounds of the conformed calendar; the end is exclusive.
CALENDAR_START, CALENDAR_END = "2022-01-01", "2027-01-01"


def date_spine(bounds: DataFrame) -> DataFrame:
    """One row per day for a one-row relation ``(start, end)``, end exclusive."""
    last = F.date_sub("end", 1)
    return bounds.where(F.col("end") > F.col("start")).select(
        F.explode(F.sequence("start", last)).alias("date_key")
    )


def dim_date(bounds: DataFrame) -> DataFrame:
    day = F.col("date_key")
    year, quarter, month = F.year(day), F.quarter(day), F.month(day)
    weekday = F.weekday(day) + 1
    return date_spine(bounds).select(
        "date_key",
        F.trunc(day, "week").alias("week_start_date"),
        F.trunc(day, "month").alias("month_start_date"),
        F.trunc(day, "quarter").alias("quarter_start_date"),
        F.trunc(day, "year").alias("year_start_date"),
        year.alias("calendar_year"),
        quarter.alias("calendar_quarter"),
        month.alias("calendar_month"),
        F.dayofmonth(day).alias("day_of_month"),
        weekday.alias("iso_day_of_week"),
        weekday.isin(6, 7).alias("is_weekend"),
        F.concat(year.cast("string"), F.lit("-Q"), quarter.cast("string")).alias(
            "year_quarter"
        ),
        (year * 100 + month).alias("year_month_key"),
    )


def calendar_bounds(spark, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    return spark.range(1).select(
        F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end")
    )


def calendar_years_of(facts: DataFrame, column: str) -> DataFrame:
    """Calendar bounds covering every year that occurs in a date column."""
    day = F.to_date(column)
    return facts.agg(
        F.trunc(F.min(day), "year").alias("start"),
        F.add_months(F.trunc(F.max(day), "year"), 12).alias("end"),
    )


def agg_daily_performance(line_facts: DataFrame, order_facts: DataFrame) -> DataFrame:
    """Day x state x region x category. Order measures are aggregated on their own
    at day x state and joined back, because they cannot be summed from lines."""
    ratio = F.col("freight_ratio").cast("decimal(18,4)")
    by_line = line_facts.groupBy(
        "purchased_date", "customer_state", "customer_region", "category_name"
    ).agg(
        F.count(F.lit(1)).alias("item_count"),
        F.count_distinct("order_key").alias("order_count"),
        F.count_distinct("seller_key").alias("seller_count"),
        F.sum("item_price").alias("gross_item_revenue"),
        F.sum("freight_value").alias("freight_revenue"),
        F.sum("item_total").alias("total_revenue"),
        F.try_divide(F.sum(ratio).cast("double"), F.count(ratio)).alias(
            "avg_freight_ratio"
        ),
    )
    score = F.col("avg_review_score")
    by_order = order_facts.groupBy("purchased_date", "customer_state").agg(
        F.count(F.lit(1)).alias("orders_placed"),
        F.count_if(F.col("is_delivered")).alias("orders_delivered"),
        F.count_if(F.col("is_late")).alias("orders_late"),
        F.avg(F.col("days_to_delivery").cast("double")).alias("avg_days"),
        F.try_divide(F.sum(score).cast("double"), F.count(score)).alias("avg_score"),
    )
    cents = "decimal(18,2)"
    return by_line.join(by_order, ["purchased_date", "customer_state"], "left").select(
        "purchased_date",
        "customer_state",
        "customer_region",
        "category_name",
        "item_count",
        "order_count",
        "seller_count",
        F.col("gross_item_revenue").cast(cents).alias("gross_item_revenue"),
        F.col("freight_revenue").cast(cents).alias("freight_revenue"),
        F.col("total_revenue").cast(cents).alias("total_revenue"),
        fn.numeric("avg_freight_ratio", 4).alias("avg_freight_ratio"),
        "orders_placed",
        "orders_delivered",
        "orders_late",
        fn.rate("orders_late", "orders_delivered").alias("late_delivery_rate"),
        fn.numeric("avg_days", 2).alias("avg_days_to_delivery"),
        fn.numeric("avg_score", 3).alias("avg_review_score"),
    )


def modal_place(geolocation: DataFrame) -> DataFrame:
    """Most frequent (city, state) per postcode prefix as a ranked selection; the
    geography dimension folds the same rule into its aggregate."""
    counted = geolocation.groupBy("zip_code_prefix", "city", "state").agg(
        F.count(F.lit(1)).alias("observations")
    )
    order = [F.desc("observations"), F.asc_nulls_last("city"), F.asc_nulls_last("state")]
    return top_n_per_group(counted, ["zip_code_prefix"], order, 1)


def dim_sellers_history(snapshot: DataFrame) -> DataFrame:
    """Seller versions from the Type-2 snapshot."""
    return history(snapshot, "seller_id").select(
        F.col("version_key").alias("seller_version_key"),
        F.col("seller_id").alias("seller_key"),
        "seller_city",
        "seller_state",
        "seller_region",
        "zip_code_prefix",
        "valid_from",
        "valid_to",
        "is_current",
        "version_number",
    )
