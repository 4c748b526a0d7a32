"""Intermediate models: one row per order, and the line with its context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martworks.functions import columns as fn
from martworks.operators.keyed import first_value_by

DELIVERY_GRACE_DAYS = 0


def _any(condition: Column) -> Column:
    """True when some row meets the condition; a NULL condition counts as not met."""
    return F.bool_or(F.coalesce(condition, F.lit(False)))


def payment_summary(payments: DataFrame) -> DataFrame:
    """The primary payment is the largest one, the earliest of equals. Payments are
    first summed by order and type, which makes the number of types a plain count."""
    kind = F.col("payment_type")
    rank = F.struct((-F.col("payment_value")).alias("less"), F.col("payment_sequential").alias("n"))
    first = F.min_by(F.struct("payment_type", "payment_installments"), rank)
    by_type = payments.groupBy("order_id", "payment_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("payment_value").alias("total"),
        F.max("payment_installments").alias("installments"),
        F.min(rank).alias("rank"),
        first.alias("first"),
    )
    return (
        by_type.groupBy("order_id")
        .agg(
            F.sum("n").alias("payment_count"),
            F.count(kind).alias("payment_type_count"),
            F.sum("total").cast("decimal(28,2)").alias("payment_total"),
            F.max("installments").alias("max_installments"),
            _any(kind == "credit_card").alias("used_credit_card"),
            _any(kind == "voucher").alias("used_voucher"),
            F.min_by("first", "rank").alias("_primary"),
        )
        .withColumn("primary_payment_type", F.col("_primary.payment_type"))
        .withColumn(
            "primary_payment_installments", F.col("_primary.payment_installments")
        )
        .drop("_primary")
    )


#: A category's place in the order of names stands in so many digits below the revenue.
_CODES = 10**9


def category_codes(products: DataFrame) -> DataFrame:
    """Categories by name, counted from 0: one small relation, whatever the products are."""
    names = products.select("category_name").where(F.col("category_name").isNotNull()).distinct()
    place = F.row_number().over(Window.orderBy("category_name")) - 1
    return names.select(F.col("category_name").alias("primary_category"), place.cast("bigint").alias("_code"))


def item_summary(items: DataFrame, products: DataFrame, dealt: bool = False) -> DataFrame:
    """Lines rolled up to the order; revenue excludes freight. The dominant category
    is the one with the most revenue, the first by name among equals.

    The lines are dealt by order once (``dealt``: they lie so already, as staging leaves
    them); totals, distinct products and distinct sellers are then groups inside a partition.
    Only order, product and price go to the products and come back with the category's
    code. The dominant category is the largest of revenue with the category's code below
    it: one number, which Spark keeps in a hash aggregate. Sides are joined by order, so
    that Spark leaves out those none of whose columns is read; lines without an order, which
    no join brings together, are folded."""
    lines = items.select("order_id", "product_id", "seller_id", "item_price", "freight_value", "item_total")
    codes = category_codes(products)
    coded = products.select("product_id", "category_name").join(
        codes.withColumnRenamed("primary_category", "category_name"), "category_name", "left"
    ).select("product_id", "_code")
    known = lines.where(F.col("order_id").isNotNull())
    if not dealt:
        known = known.repartition("order_id")
    totals, sellers, dominant = _rolled(known, coded)
    by_order = totals.join(sellers, "order_id", "left").join(dominant, "order_id", "left")
    totals, sellers, dominant = _rolled(lines.where(F.col("order_id").isNull()), coded)
    stacked = totals.unionByName(sellers, allowMissingColumns=True).unionByName(dominant, allowMissingColumns=True)
    without = stacked.groupBy("order_id").agg(*[F.max(c).alias(c) for c in stacked.columns if c != "order_id"])
    code = F.lit(_CODES - 1) - F.pmod("_first", F.lit(_CODES).cast("decimal(10,0)")).cast("bigint")
    return (
        by_order.unionByName(without)
        .withColumn("_code", code)
        .join(codes.groupBy("_code").agg(F.first("primary_category").alias("primary_category")), "_code", "left")
        .select(
            "order_id", "item_count", "distinct_product_count", "distinct_seller_count", "gross_item_revenue",
            "freight_revenue", "order_item_total", "max_item_price", "min_item_price", "primary_category",
        )
    )


def _rolled(lines: DataFrame, coded: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """By order: totals, distinct sellers, and the dominant category's code below its revenue."""
    money = lambda c: F.sum(c).alias(c)
    sellers = lines.groupBy("order_id", "seller_id").agg(F.lit(1).alias("one"))
    sellers = sellers.groupBy("order_id").agg(F.count("seller_id").alias("distinct_seller_count"))
    totals = (
        lines.groupBy("order_id", "product_id")
        .agg(
            F.count(F.lit(1)).alias("n"), money("item_price"), money("freight_value"), money("item_total"),
            F.max("item_price").alias("most"), F.min("item_price").alias("least"),
        )
        .groupBy("order_id")
        .agg(
            F.sum("n").alias("item_count"),
            F.count("product_id").alias("distinct_product_count"),
            F.sum("item_price").cast("decimal(28,2)").alias("gross_item_revenue"),
            F.sum("freight_value").cast("decimal(28,2)").alias("freight_revenue"),
            F.sum("item_total").cast("decimal(28,2)").alias("order_item_total"),
            F.max("most").alias("max_item_price"),
            F.min("least").alias("min_item_price"),
        )
    )
    place = F.lit(_CODES - 1) - F.coalesce("_code", F.lit(_CODES - 1))
    first = (F.col("item_price") * 100).cast("decimal(28,0)") * F.lit(_CODES).cast("decimal(10,0)") + place
    dominant = (
        lines.select("order_id", "product_id", "item_price")
        .join(coded, "product_id", "left")
        .select("order_id", "item_price", "_code")
        .repartition("order_id")
        .groupBy("order_id", "_code")
        .agg(money("item_price"))
        .groupBy("order_id")
        .agg(F.max(first).alias("_first"))
    )
    return totals, sellers, dominant


def review_summary(reviews: DataFrame) -> DataFrame:
    """Average over all reviews of the order, and its first review."""
    first = first_value_by(
        F.struct(
            F.col("review_score").alias("score"),
            F.col("review_sentiment").alias("sentiment"),
            F.col("review_created_at").alias("created_at"),
            fn.hours_between("review_created_at", "review_answered_at").alias("hours"),
        ),
        F.col("review_created_at").isNull(),
        F.col("review_created_at"),
        F.col("review_id"),
    )
    return (
        reviews.groupBy("order_id")
        .agg(
            F.count(F.lit(1)).alias("review_count"),
            F.avg(F.col("review_score").cast("double")).alias("avg_review_score"),
            F.min("review_score").alias("min_review_score"),
            _any(F.col("has_comment")).alias("has_any_comment"),
            first.alias("_first"),
        )
        .select(
            "order_id",
            "review_count",
            "avg_review_score",
            "min_review_score",
            "has_any_comment",
            F.col("_first.score").alias("first_review_score"),
            F.col("_first.sentiment").alias("first_review_sentiment"),
            F.col("_first.created_at").alias("first_review_created_at"),
            F.col("_first.hours").alias("review_response_hours"),
        )
    )


#: What an order learns from its customer.
BUYER_COLUMNS = ("customer_unique_id", "customer_state", "customer_region", "customer_zip_code_prefix")


def delivery_timeline(orders: DataFrame, grace_days: int = DELIVERY_GRACE_DAYS) -> DataFrame:
    """Delivery measures from the order's timestamps. ``is_late`` stays NULL until
    the order has arrived, so averages never count an order in flight as on time. Orders
    that know their customer already keep those columns."""
    delivered = F.col("delivered_at")
    overdue = F.col("delivery_vs_promise_days") > grace_days
    return (
        orders.select(
            "order_id",
            "customer_id",
            "order_status",
            "purchased_at",
            "approved_at",
            "shipped_at",
            "delivered_at",
            "estimated_delivery_at",
            "purchased_date",
            "estimated_delivery_date",
            "delivered_date",
            *[c for c in BUYER_COLUMNS if c in orders.columns],
            fn.hours_between("purchased_at", "approved_at").alias("hours_to_approval"),
            fn.hours_between("approved_at", "shipped_at").alias("hours_to_carrier"),
            fn.days_between("purchased_at", "delivered_at").alias("days_to_delivery"),
            fn.days_between("shipped_at", "delivered_at").alias("days_in_transit"),
            fn.days_between("estimated_delivery_date", "delivered_date").alias(
                "delivery_vs_promise_days"
            ),
            fn.days_between("purchased_date", "estimated_delivery_date").alias(
                "promised_lead_days"
            ),
        )
        .withColumn("is_delivered", delivered.isNotNull())
        .withColumn("is_canceled", F.col("order_status") == "canceled")
        .withColumn("is_late", F.when(delivered.isNotNull(), overdue))
        .withColumn(
            "delivery_status",
            fn.delivery_status(
                F.col("order_status"),
                F.col("approved_at"),
                F.col("shipped_at"),
                delivered,
                F.col("is_late"),
            ),
        )
        .withColumn(
            "is_missing_delivery_timestamp",
            (F.col("order_status") == "delivered") & delivered.isNull(),
        )
    )


def order_context(timeline: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders with their customer. Joining here, at order grain, keeps the wide
    customer join off the much larger line table."""
    buyer = customers.select(
        "customer_id",
        "customer_unique_id",
        "customer_state",
        "customer_region",
        F.col("zip_code_prefix").alias("customer_zip_code_prefix"),
    )
    return timeline.join(buyer, "customer_id", "left")


def order_values(orders: DataFrame, items: DataFrame, customers: DataFrame | None = None) -> DataFrame:
    """Orders with person and item total: what a person's lifetime measures need, for far
    less work than the order fact. Without ``customers`` the orders name the person
    themselves (:func:`order_context`)."""
    totals = items.groupBy("order_id").agg(F.sum("item_total").alias("order_total"))
    known = ["order_id", "customer_id", "purchased_date"]
    if customers is None:
        valued = orders.select(*known, "customer_unique_id").join(totals, "order_id", "left")
    else:
        person = customers.select("customer_id", "customer_unique_id")
        valued = orders.select(*known).join(totals, "order_id", "left").join(person, "customer_id", "inner")
    return (
        valued.withColumn("order_total", F.coalesce("order_total", F.lit(0)))
    )


def line_context(
    items: DataFrame, orders: DataFrame, products: DataFrame, sellers: DataFrame, dealt: bool = False
) -> DataFrame:
    """Lines with order, customer, product and seller attributes; ``orders`` is the
    output of :func:`order_context`.

    The lines meet products and sellers while they are narrow and their wide order last;
    where lines and orders are dealt by order already (``dealt``), these meet first, without an
    exchange. Products and sellers are told apart by their key, so that Spark leaves out a
    join none of whose columns is read. The line's key, a hash that no codec makes smaller,
    is worked out again after the joins."""
    one = lambda df, key, *columns: df.groupBy(key).agg(*[F.first(c).alias(c) for c in columns])
    goods = one(products, "product_id", "category_name", "category_name_pt", "product_weight_g", "product_volume_cm3")
    shop = one(sellers, "seller_id", "seller_state", "seller_region")
    lines = items.drop("_ingested_at", "order_item_key")
    if dealt:
        lines = lines.join(orders, "order_id", "inner")
    lines = lines.join(goods, "product_id", "left").join(shop, "seller_id", "left")
    if not dealt:
        lines = lines.join(orders, "order_id", "inner")
    return (
        lines.withColumn("order_item_key", fn.surrogate_key("order_id", "line_number"))
        .withColumn(
            "is_intrastate_shipment", F.col("seller_state") == F.col("customer_state")
        )
    )


ENRICHED_COLUMNS = (
    "order_item_key order_id line_number product_id seller_id customer_id "
    "customer_unique_id purchased_at purchased_date shipping_limit_at order_status "
    "category_name category_name_pt seller_state seller_region customer_state "
    "customer_region is_intrastate_shipment product_weight_g product_volume_cm3 "
    "item_price freight_value item_total ingest_date"
).split()


def enriched_items(
    items: DataFrame,
    timeline: DataFrame,
    products: DataFrame,
    sellers: DataFrame,
    customers: DataFrame,
) -> DataFrame:
    orders = order_context(timeline, customers)
    return line_context(items, orders, products, sellers).select(*ENRICHED_COLUMNS)
