"""Raw tables: landed Parquet loaded by strategy. Loading a day twice leaves the same
table as loading it once."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from martworks.sources import files
from martworks.sources.landing import PARTITION, as_date, read_landed
from martworks.sources.registry import SourceTable, select_tables


@dataclass(frozen=True)
class Loaded:
    """A finished load: the rows it brought, and the day it replaced, None for all days."""

    table: str
    path: str
    rows: int
    day: str | None

    @property
    def replaced_all(self) -> bool:
        return self.day is None


def read_raw(spark: SparkSession, raw_root: str, table: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(f"{raw_root.rstrip('/')}/{table}")


def load_raw(
    spark: SparkSession,
    table: SourceTable,
    root: str,
    raw_root: str,
    ingest_date: str | date | None = None,
    full: bool = False,
) -> Loaded:
    """Load one landed day, or everything landed when ``ingest_date`` is None.

    A snapshot table, a full load and a missing target are replaced. Otherwise only
    the day's partition is replaced, column by name. Files keep their day while being
    copied, so neither path shuffles."""
    dest = f"{raw_root.rstrip('/')}/{table.name}"
    landed = read_landed(spark, root, table.name, ingest_date)
    replace = full or ingest_date is None or table.strategy == "full"
    rows, seen = files.counted(landed)
    if replace or not files.exists(spark, dest):
        _write(rows, dest, "static")
        return Loaded(table.name, dest, files.rows_of(seen), None)
    day_dir = f"{dest}/{PARTITION}={as_date(ingest_date)}"
    rows.drop(PARTITION).write.mode("overwrite").option("compression", "zstd").parquet(
        day_dir
    )
    spark.catalog.refreshByPath(dest)
    return Loaded(table.name, dest, files.rows_of(seen), str(as_date(ingest_date)))


def _write(landed: DataFrame, dest: str, mode: str) -> None:
    (
        landed.write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .option("compression", "zstd")
        .partitionBy(PARTITION)
        .parquet(dest)
    )


def load_all(
    spark: SparkSession,
    root: str,
    raw_root: str,
    ingest_date: str | date | None = None,
    tables: Iterable[str] | None = None,
    full: bool = False,
) -> list[Loaded]:
    return [
        load_raw(spark, t, root, raw_root, ingest_date, full) for t in select_tables(tables)
    ]


def row_counts(spark: SparkSession, raw_root: str, tables: Iterable[str] | None = None) -> dict:
    """Rows per raw table; answered from Parquet footers."""
    return {t.name: read_raw(spark, raw_root, t.name).count() for t in select_tables(tables)}
