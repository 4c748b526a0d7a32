"""Staging: rename, cast, clean and deduplicate the nine source tables.

Duplicates are removed on the *source* columns and the projection comes after. The
shuffle then carries raw, narrow values, and because every consumer of a staged
table asks for the same columns at that point, Spark reuses one exchange for all
consumers inside a query. Orders, lines and payments are dealt by order there, so that their
rollups and the joins at order grain follow without another exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martworks.functions import columns as fn
from martworks.operators.keyed import latest_by_key
from martworks.sources.registry import get_table

EARLIEST_ORDER_DATE = "2015-01-01"
LOAD_COLUMNS = ("ingest_date", "_ingested_at")


def _raw(df: DataFrame, table: str) -> DataFrame:
    """Declared source columns plus the lineage columns that are present."""
    wanted = [*get_table(table).columns, *LOAD_COLUMNS, "_run_id"]
    return df.select([c for c in wanted if c in df.columns])


def _latest(df: DataFrame, table: str, *dealt_by: str) -> DataFrame:
    return latest_by_key(df, get_table(table).primary_key, dealt_by=dealt_by)


def _place(prefix: str, side: str) -> list:
    return [
        fn.zip5(f"{prefix}_zip_code_prefix").alias("zip_code_prefix"),
        fn.title_case(f"{prefix}_city").alias(f"{side}city"),
        F.upper(F.trim(f"{prefix}_state")).alias(f"{side}state"),
    ]


def customers(raw: DataFrame) -> DataFrame:
    """``customer_id`` is minted per order; ``customer_unique_id`` is the person."""
    return _latest(_raw(raw, "customers"), "customers").select(
        "customer_id",
        "customer_unique_id",
        *_place("customer", "customer_"),
        fn.macro_region("customer_state").alias("customer_region"),
        *LOAD_COLUMNS,
    )


def sellers(raw: DataFrame) -> DataFrame:
    return _latest(_raw(raw, "sellers"), "sellers").select(
        "seller_id",
        *_place("seller", "seller_"),
        fn.macro_region("seller_state").alias("seller_region"),
        *LOAD_COLUMNS,
    )


def geolocation(raw: DataFrame) -> DataFrame:
    """Coordinate samples inside the bounding box; many per postcode by design."""
    inside = fn.in_bounds("geolocation_lat", "geolocation_lng")
    return (
        _raw(raw, "geolocation")
        .where(inside)
        .select(
            *_place("geolocation", ""),
            F.col("geolocation_lat").cast("double").alias("latitude"),
            F.col("geolocation_lng").cast("double").alias("longitude"),
            *LOAD_COLUMNS,
        )
    )


def orders(raw: DataFrame, earliest: str = EARLIEST_ORDER_DATE) -> DataFrame:
    """Orders bought before ``earliest`` or without a purchase time are bad data."""
    floor = F.lit(f"{earliest} 00:00:00").cast("timestamp_ntz")
    source = _raw(raw, "orders").where(F.col("order_purchase_timestamp") >= floor)
    return _latest(source, "orders", "order_id").select(
        "order_id",
        "customer_id",
        F.lower(F.trim("order_status")).alias("order_status"),
        F.col("order_purchase_timestamp").alias("purchased_at"),
        F.col("order_approved_at").alias("approved_at"),
        F.col("order_delivered_carrier_date").alias("shipped_at"),
        F.col("order_delivered_customer_date").alias("delivered_at"),
        F.col("order_estimated_delivery_date").alias("estimated_delivery_at"),
        F.to_date("order_purchase_timestamp").alias("purchased_date"),
        F.to_date("order_estimated_delivery_date").alias("estimated_delivery_date"),
        F.to_date("order_delivered_customer_date").alias("delivered_date"),
        *LOAD_COLUMNS,
    )


def order_items(raw: DataFrame) -> DataFrame:
    """Money is rounded once, here, so that every later sum agrees."""
    source = _raw(raw, "order_items").where(
        (F.col("price") >= 0) & (F.col("freight_value") >= 0)
    )
    price = F.col("price").cast("decimal(28,6)")
    freight = F.col("freight_value").cast("decimal(28,6)")
    return _latest(source, "order_items", "order_id").select(
        fn.surrogate_key("order_id", "order_item_id").alias("order_item_key"),
        "order_id",
        F.col("order_item_id").alias("line_number"),
        "product_id",
        "seller_id",
        F.col("shipping_limit_date").alias("shipping_limit_at"),
        fn.money("price").alias("item_price"),
        fn.money("freight_value").alias("freight_value"),
        F.round(price + freight, 2).cast("decimal(18,2)").alias("item_total"),
        *LOAD_COLUMNS,
    )


def order_payments(raw: DataFrame) -> DataFrame:
    """A purchase paid at once is recorded as 0 instalments upstream; it counts as 1."""
    source = _raw(raw, "order_payments").where(F.col("payment_value") >= 0)
    return _latest(source, "order_payments", "order_id").select(
        "order_id",
        "payment_sequential",
        F.lower(F.trim("payment_type")).alias("payment_type"),
        F.greatest(F.col("payment_installments"), F.lit(1).cast("bigint")).alias(
            "payment_installments"
        ),
        fn.money("payment_value").alias("payment_value"),
        *LOAD_COLUMNS,
    )


def order_reviews(raw: DataFrame) -> DataFrame:
    source = _raw(raw, "order_reviews").where(F.col("review_score").between(1, 5))
    message = fn.text_or_null("review_comment_message")
    return _latest(source, "order_reviews").select(
        "review_id",
        "order_id",
        "review_score",
        fn.text_or_null("review_comment_title").alias("review_title"),
        message.alias("review_message"),
        F.col("review_creation_date").alias("review_created_at"),
        F.col("review_answer_timestamp").alias("review_answered_at"),
        message.isNotNull().alias("has_comment"),
        fn.review_sentiment("review_score").alias("review_sentiment"),
        *LOAD_COLUMNS,
    )


def category_translation(raw: DataFrame) -> DataFrame:
    """Keyed on the trimmed name, so the projection has to come before the dedup."""
    named = (
        _raw(raw, "product_category_translation")
        .where(fn.text_or_null("product_category_name").isNotNull())
        .withColumn("category_name_pt", F.trim("product_category_name"))
        .withColumn("category_name_en", F.trim("product_category_name_english"))
        .drop("product_category_name", "product_category_name_english")
    )
    return latest_by_key(named, ["category_name_pt"]).select(
        "category_name_pt", "category_name_en", *LOAD_COLUMNS
    )


def products(raw: DataFrame, translation: DataFrame) -> DataFrame:
    """``translation`` is the staged table (one row per category name)."""
    names = translation.select(
        F.col("category_name_pt").alias("_name"), "category_name_en"
    )
    category = fn.text_or_null("product_category_name")
    volume = (
        F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm")
    )
    return (
        _latest(_raw(raw, "products"), "products")
        .withColumn("_category", category)
        .join(names, F.col("_category") == F.col("_name"), "left")
        .select(
            "product_id",
            F.coalesce("_category", F.lit(fn.UNKNOWN)).alias("category_name_pt"),
            F.coalesce("category_name_en", F.lit(fn.UNKNOWN)).alias("category_name"),
            F.col("product_name_lenght").alias("product_name_length"),
            F.col("product_description_lenght").alias("product_description_length"),
            "product_photos_qty",
            "product_weight_g",
            "product_length_cm",
            "product_height_cm",
            "product_width_cm",
            fn.money(volume).alias("product_volume_cm3"),
            *LOAD_COLUMNS,
        )
    )
