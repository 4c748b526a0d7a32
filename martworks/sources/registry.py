"""The nine source tables: schema, key, load strategy and watermark."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import types as T

# Logical type names and what they are in Spark. Timestamps carry no zone.
LOGICAL_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "integer": T.LongType(),
    "float": T.DoubleType(),
    "timestamp": T.TimestampNTZType(),
    "date": T.DateType(),
    "boolean": T.BooleanType(),
}

LINEAGE_COLUMNS = ("ingest_date", "_ingested_at", "_source_file", "_run_id")


@dataclass(frozen=True)
class SourceTable:
    name: str
    fields: tuple[tuple[str, str], ...]
    primary_key: tuple[str, ...] = ()
    watermark: str | None = None
    # Free text may hold line breaks; such a file cannot be split by lines.
    free_text: bool = False
    tags: tuple[str, ...] = ()
    # Name of the published file, where it is not the table's own.
    file: str | None = None

    @property
    def strategy(self) -> str:
        """A table with a watermark is loaded by slices, any other as a snapshot."""
        return "incremental" if self.watermark else "full"

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, LOGICAL_TYPES[t]) for n, t in self.fields])

    @property
    def columns(self) -> list[str]:
        return [n for n, _ in self.fields]

    @property
    def filename(self) -> str:
        return self.file or f"{self.name}.csv"


# The source schemas (the two "lenght" spellings are the source's own).
SOURCE_TABLES: tuple[SourceTable, ...] = (
    SourceTable(
        "customers",
        (
            ("customer_id", "string"),
            ("customer_unique_id", "string"),
            ("customer_zip_code_prefix", "string"),
            ("customer_city", "string"),
            ("customer_state", "string"),
        ),
        primary_key=("customer_id",),
        tags=("dimension",),
    ),
    SourceTable(
        "geolocation",
        (
            ("geolocation_zip_code_prefix", "string"),
            ("geolocation_lat", "float"),
            ("geolocation_lng", "float"),
            ("geolocation_city", "string"),
            ("geolocation_state", "string"),
        ),
        tags=("dimension",),
    ),
    SourceTable(
        "order_items",
        (
            ("order_id", "string"),
            ("order_item_id", "integer"),
            ("product_id", "string"),
            ("seller_id", "string"),
            ("shipping_limit_date", "timestamp"),
            ("price", "float"),
            ("freight_value", "float"),
        ),
        primary_key=("order_id", "order_item_id"),
        watermark="shipping_limit_date",
        tags=("fact",),
    ),
    SourceTable(
        "order_payments",
        (
            ("order_id", "string"),
            ("payment_sequential", "integer"),
            ("payment_type", "string"),
            ("payment_installments", "integer"),
            ("payment_value", "float"),
        ),
        primary_key=("order_id", "payment_sequential"),
        tags=("fact",),
    ),
    SourceTable(
        "order_reviews",
        (
            ("review_id", "string"),
            ("order_id", "string"),
            ("review_score", "integer"),
            ("review_comment_title", "string"),
            ("review_comment_message", "string"),
            ("review_creation_date", "timestamp"),
            ("review_answer_timestamp", "timestamp"),
        ),
        primary_key=("review_id", "order_id"),
        free_text=True,
        tags=("fact",),
    ),
    SourceTable(
        "orders",
        (
            ("order_id", "string"),
            ("customer_id", "string"),
            ("order_status", "string"),
            ("order_purchase_timestamp", "timestamp"),
            ("order_approved_at", "timestamp"),
            ("order_delivered_carrier_date", "timestamp"),
            ("order_delivered_customer_date", "timestamp"),
            ("order_estimated_delivery_date", "timestamp"),
        ),
        primary_key=("order_id",),
        watermark="order_purchase_timestamp",
        tags=("fact",),
    ),
    SourceTable(
        "products",
        (
            ("product_id", "string"),
            ("product_category_name", "string"),
            ("product_name_lenght", "integer"),
            ("product_description_lenght", "integer"),
            ("product_photos_qty", "integer"),
            ("product_weight_g", "float"),
            ("product_length_cm", "float"),
            ("product_height_cm", "float"),
            ("product_width_cm", "float"),
        ),
        primary_key=("product_id",),
        tags=("dimension",),
    ),
    SourceTable(
        "sellers",
        (
            ("seller_id", "string"),
            ("seller_zip_code_prefix", "string"),
            ("seller_city", "string"),
            ("seller_state", "string"),
        ),
        primary_key=("seller_id",),
        tags=("dimension",),
    ),
    SourceTable(
        "product_category_translation",
        (
            ("product_category_name", "string"),
            ("product_category_name_english", "string"),
        ),
        primary_key=("product_category_name",),
        tags=("dimension",),
    ),
)

_BY_NAME = {t.name: t for t in SOURCE_TABLES}


def get_table(name: str) -> SourceTable:
    if name not in _BY_NAME:
        raise KeyError(f"no source table {name!r}; there are {sorted(_BY_NAME)}")
    return _BY_NAME[name]


def select_tables(names: Iterable[str] | None = None) -> tuple[SourceTable, ...]:
    """All tables, or the named ones in registry order."""
    if not names:
        return SOURCE_TABLES
    wanted = {get_table(n).name for n in names}
    return tuple(t for t in SOURCE_TABLES if t.name in wanted)
