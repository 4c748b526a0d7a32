"""What the stored marts and their columns mean; kept with the tables."""

from __future__ import annotations

#: Table: (description, comments by column).
TABLES: dict[str, tuple[str, dict[str, str]]] = {
    "fct_orders": (
        "One row per order with its lines, payments and reviews summed",
        {
            "order_key": "Order id of the source",
            "order_total": "Price and freight of all lines",
            "payment_variance": "Paid less owed",
            "is_late": "Arrived after the promised day; NULL before arrival",
        },
    ),
    "fct_order_items": (
        "One row per order line",
        {
            "order_item_key": "Hash of order id and line number",
            "item_total": "Price and freight of the line",
            "freight_ratio": "Freight per price; NULL without a price",
        },
    ),
    "dim_customers": (
        "One row per customer id with the lifetime of the person",
        {
            "customer_key": "Customer id, one per order",
            "customer_unique_id": "The person",
            "lifetime_order_count": "Orders of the person; NULL without any",
        },
    ),
    "dim_products": (
        "One row per product with what it sold",
        {
            "product_key": "Product id of the source",
            "units_sold": "Lines of the product",
            "is_never_sold": "No line has the product",
        },
    ),
    "dim_sellers": (
        "One row per seller with sales and fulfilment",
        {
            "seller_key": "Seller id of the source",
            "order_count": "Orders with a line of the seller",
            "late_delivery_rate": "Late orders per delivered order; NULL without any",
        },
    ),
    "dim_geography": (
        "One row per postcode prefix",
        {
            "zip_code_prefix": "First five digits",
            "latitude": "Mean of the samples",
            "observation_count": "Samples inside the bounding box",
        },
    ),
    "dim_date": ("One row per calendar day", {"date_key": "The day"}),
    "agg_daily_performance": (
        "Day by customer state, region and category",
        {
            "orders_placed": "Orders of the day and state, repeated on each category",
            "total_revenue": "Price and freight of the lines",
        },
    ),
    "dim_sellers_history": (
        "Versions of sellers",
        {
            "seller_version_key": "Hash of seller and start",
            "valid_to": "End, exclusive; NULL while open",
            "version_number": "Place in the seller's versions, from 1",
        },
    ),
}


def comments_of(table: str) -> dict[str, str]:
    return TABLES[table][1] if table in TABLES else {}
