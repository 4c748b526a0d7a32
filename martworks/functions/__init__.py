from martworks.functions.columns import (
    bucket,
    days_between,
    delivery_status,
    hours_between,
    in_bounds,
    macro_region,
    money,
    numeric,
    rate,
    review_sentiment,
    surrogate_key,
    text_or_null,
    title_case,
    weight_class,
    zip5,
)

__all__ = [
    "bucket",
    "days_between",
    "delivery_status",
    "hours_between",
    "in_bounds",
    "macro_region",
    "money",
    "numeric",
    "rate",
    "review_sentiment",
    "surrogate_key",
    "text_or_null",
    "title_case",
    "weight_class",
    "zip5",
]
