"""The three distribution suites over the marts; bounds are defaults to pass over."""

from __future__ import annotations

from martworks.quality.declared import DELIVERY_STATUSES
from martworks.quality.expectations import (
    Suite,
    at_least_other,
    lengths_equal,
    mean_between,
    quantiles_between,
    row_count_between,
    values_between,
    values_in_set,
    values_not_null,
    values_unique,
)

# Default bounds per measure as (low, high).
ORDER_BOUNDS = {
    "order_total": (0, 50_000),
    "order_total_mean": (40, 1_000),
    "order_total_quantiles": {0.5: (30, 500), 0.95: (200, 3_000), 0.99: (400, 8_000)},
    "item_count": (0, 100),
    "avg_review_score": (1, 5),
    "payment_variance": (-0.01, 0.01),
    "days_to_delivery": (0, 400),
}
LINE_BOUNDS = {
    "item_price": (0, 20_000),
    "item_price_mean": (20, 500),
    "freight_ratio_quantiles": {0.5: (0.0, 1.5), 0.99: (0.0, 20.0)},
}
DAILY_BOUNDS = {
    "late_delivery_rate": (0, 1),
    "late_delivery_rate_mean": (0.001, 0.60),
    "total_revenue": (0, 5_000_000),
    "avg_review_score": (1, 5),
}


def order_suite(rows: tuple[int, int], bounds: dict | None = None) -> Suite:
    b = {**ORDER_BOUNDS, **(bounds or {})}
    return Suite(
        "fct_orders",
        "fct_orders",
        [
            row_count_between(*rows),
            values_not_null("order_key"),
            values_unique("order_key"),
            values_in_set("delivery_status", DELIVERY_STATUSES),
            values_between("order_total", *b["order_total"]),
            mean_between("order_total", *b["order_total_mean"]),
            *quantiles_between("order_total", b["order_total_quantiles"]),
            values_between("item_count", *b["item_count"]),
            values_between("avg_review_score", *b["avg_review_score"]),
            values_between("payment_variance", *b["payment_variance"], mostly=0.99),
            values_between("days_to_delivery", *b["days_to_delivery"]),
        ],
    )


def line_suite(rows: tuple[int, int], bounds: dict | None = None) -> Suite:
    b = {**LINE_BOUNDS, **(bounds or {})}
    return Suite(
        "fct_order_items",
        "fct_order_items",
        [
            row_count_between(*rows),
            values_unique("order_item_key"),
            values_not_null("item_price"),
            values_between("item_price", *b["item_price"]),
            mean_between("item_price", *b["item_price_mean"]),
            *quantiles_between("freight_ratio", b["freight_ratio_quantiles"]),
            at_least_other("item_total", "item_price"),
            values_not_null("category_name"),
        ],
    )


def daily_suite(bounds: dict | None = None) -> Suite:
    b = {**DAILY_BOUNDS, **(bounds or {})}
    return Suite(
        "agg_daily_performance",
        "agg_daily_performance",
        [
            values_not_null("purchased_date"),
            values_between("late_delivery_rate", *b["late_delivery_rate"]),
            mean_between("late_delivery_rate", *b["late_delivery_rate_mean"]),
            values_between("total_revenue", *b["total_revenue"]),
            lengths_equal("customer_state", 2),
            values_between("avg_review_score", *b["avg_review_score"]),
        ],
    )


def build_suites(scale: int = 100_000, bounds: dict[str, dict] | None = None) -> list[Suite]:
    """All suites. Volume bounds follow the expected number of orders, plus and minus
    40 %, with 1.2 to 2 lines per order at the ends."""
    low, high = int(scale * 0.6), int(scale * 1.4)
    over = bounds or {}
    return [
        order_suite((low, high), over.get("fct_orders")),
        line_suite((int(low * 1.2), int(high * 2.0)), over.get("fct_order_items")),
        daily_suite(over.get("agg_daily_performance")),
    ]
