"""The declared tests of every layer: 148 in all."""

from __future__ import annotations

from martworks.functions.columns import (
    LATITUDE_RANGE,
    LONGITUDE_RANGE,
    REGION_STATES,
    UNKNOWN,
    UNKNOWN_REGION,
    WEIGHT_LABELS,
)
from martworks.quality.checks import (
    accepted,
    between,
    not_null,
    relationship,
    unique,
    unique_combination,
    value_length,
)

# Accepted sets.
ORDER_STATUSES = (
    "delivered",
    "shipped",
    "canceled",
    "unavailable",
    "invoiced",
    "processing",
    "created",
    "approved",
)
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card", "not_defined")
SENTIMENTS = ("promoter", "passive", "detractor")
DELIVERY_STATUSES = (
    "delivered_on_time",
    "delivered_late",
    "in_transit",
    "approved",
    "pending",
    "canceled",
)
REGIONS = (*REGION_STATES, UNKNOWN_REGION)
WEIGHT_CLASSES = (*WEIGHT_LABELS, UNKNOWN)


def _key(model: str, column: str):
    return unique(model, column) + not_null(model, column)


SOURCE_CHECKS = (
    _key("raw_orders", "order_id")
    + not_null("raw_orders", "customer_id")
    + accepted("raw_orders", "order_status", *ORDER_STATUSES)
    + unique_combination("raw_order_items", "order_id", "order_item_id")
    + not_null("raw_order_items", "order_id", "price")
    + unique_combination("raw_order_payments", "order_id", "payment_sequential")
    + _key("raw_customers", "customer_id")
    + _key("raw_products", "product_id")
    + _key("raw_sellers", "seller_id")
    + _key("raw_product_category_translation", "product_category_name")
)

STAGING_CHECKS = (
    _key("stg_orders", "order_id")
    + not_null(
        "stg_orders", "customer_id", "order_status", "purchased_at", "estimated_delivery_at"
    )
    + relationship("stg_orders", "customer_id", "stg_customers", "customer_id")
    + accepted("stg_orders", "order_status", *ORDER_STATUSES)
    + unique_combination("stg_order_items", "order_id", "line_number")
    + _key("stg_order_items", "order_item_key")
    + not_null("stg_order_items", "order_id", "item_price", "freight_value", "item_total")
    + relationship("stg_order_items", "order_id", "stg_orders", "order_id")
    + between("stg_order_items", "item_price", low=0)
    + unique_combination("stg_payments", "order_id", "payment_sequential")
    + not_null("stg_payments", "order_id")
    + relationship("stg_payments", "order_id", "stg_orders", "order_id")
    + accepted("stg_payments", "payment_type", *PAYMENT_TYPES)
    + between("stg_payments", "payment_installments", low=1)
    + not_null("stg_reviews", "review_score")
    + accepted("stg_reviews", "review_score", 1, 2, 3, 4, 5)
    + accepted("stg_reviews", "review_sentiment", *SENTIMENTS)
    + relationship("stg_reviews", "order_id", "stg_orders", "order_id")
    + _key("stg_customers", "customer_id")
    + not_null("stg_customers", "customer_unique_id", "customer_state")
    + value_length("stg_customers", "customer_state", 2)
    + accepted("stg_customers", "customer_region", *REGIONS)
    + _key("stg_products", "product_id")
    + not_null("stg_products", "category_name")
    + _key("stg_sellers", "seller_id")
    + not_null("stg_sellers", "seller_state")
    + not_null("stg_geolocation", "zip_code_prefix")
    + between("stg_geolocation", "latitude", *LATITUDE_RANGE)
    + between("stg_geolocation", "longitude", *LONGITUDE_RANGE)
    + _key("stg_translation", "category_name_pt")
    + not_null("stg_translation", "category_name_en")
)

INTERMEDIATE_CHECKS = (
    _key("payment_summary", "order_id")
    + not_null("payment_summary", "payment_total")
    + between("payment_summary", "payment_count", low=1)
    + _key("item_summary", "order_id")
    + not_null("item_summary", "item_count", "gross_item_revenue", "primary_category")
    + between("item_summary", "item_count", low=1)
    + _key("review_summary", "order_id")
    + between("review_summary", "avg_review_score", 1, 5)
    + _key("delivery_timeline", "order_id")
    + not_null("delivery_timeline", "customer_id", "delivery_status", "promised_lead_days")
    + accepted("delivery_timeline", "delivery_status", *DELIVERY_STATUSES)
    + _key("items_enriched", "order_item_key")
    + not_null("items_enriched", "order_id", "purchased_date")
)

MART_CHECKS = (
    _key("fct_orders", "order_key")
    + not_null(
        "fct_orders",
        "customer_key",
        "purchased_date_key",
        "order_status",
        "delivery_status",
        "item_count",
        "gross_item_revenue",
        "order_total",
    )
    + relationship("fct_orders", "customer_key", "dim_customers", "customer_key")
    + relationship("fct_orders", "purchased_date_key", "dim_date", "date_key")
    + accepted("fct_orders", "delivery_status", *DELIVERY_STATUSES)
    + between("fct_orders", "gross_item_revenue", low=0)
    + between("fct_orders", "avg_review_score", 1, 5)
    + between("fct_orders", "days_to_delivery", 0, 400)
    + _key("fct_order_items", "order_item_key")
    + not_null(
        "fct_order_items",
        "order_key",
        "product_key",
        "seller_key",
        "customer_key",
        "purchased_date_key",
        "item_price",
        "item_total",
    )
    + relationship("fct_order_items", "order_key", "fct_orders", "order_key")
    + relationship("fct_order_items", "product_key", "dim_products", "product_key")
    + relationship("fct_order_items", "seller_key", "dim_sellers", "seller_key")
    + relationship("fct_order_items", "customer_key", "dim_customers", "customer_key")
    + relationship("fct_order_items", "purchased_date_key", "dim_date", "date_key")
    + _key("dim_customers", "customer_key")
    + not_null("dim_customers", "customer_unique_id", "customer_state", "lifetime_order_count")
    + accepted("dim_customers", "customer_region", *REGIONS)
    + between("dim_customers", "lifetime_order_count", low=1)
    + _key("dim_products", "product_key")
    + not_null("dim_products", "category_name", "units_sold")
    + accepted("dim_products", "weight_class", *WEIGHT_CLASSES)
    + _key("dim_sellers", "seller_key")
    + not_null("dim_sellers", "seller_state")
    + between("dim_sellers", "late_delivery_rate", 0, 1)
    + _key("dim_geography", "zip_code_prefix")
    + not_null("dim_geography", "state")
    + accepted("dim_geography", "region", *REGIONS)
    + _key("dim_date", "date_key")
    + not_null("dim_date", "iso_day_of_week", "is_weekend")
    + accepted("dim_date", "iso_day_of_week", 1, 2, 3, 4, 5, 6, 7)
    + _key("dim_sellers_history", "seller_version_key")
    + not_null(
        "dim_sellers_history", "seller_key", "valid_from", "is_current", "version_number"
    )
    + relationship("dim_sellers_history", "seller_key", "dim_sellers", "seller_key")
    + unique_combination(
        "agg_daily_performance", "purchased_date", "customer_state", "category_name"
    )
    + not_null("agg_daily_performance", "purchased_date", "total_revenue")
    + between("agg_daily_performance", "late_delivery_rate", 0, 1)
)

ALL_CHECKS = SOURCE_CHECKS + STAGING_CHECKS + INTERMEDIATE_CHECKS + MART_CHECKS
