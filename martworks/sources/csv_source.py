"""Typed CSV scan: schema enforced at the boundary, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martworks.sources import files
from martworks.sources.registry import SourceTable


def read_source(
    spark: SparkSession, table: SourceTable, source_dir: str, filename: str | None = None
) -> DataFrame:
    """All declared columns in declared order. The header must name them, an empty
    field is NULL, and a value that does not parse fails the job.

    The path may be a folder or glob of parts. A free-text table can hold line breaks in
    a field, so each of its files is read by one task: export it as many files. Its rows
    are spread over tasks again right after the scan."""
    path = f"{source_dir.rstrip('/')}/{filename or table.filename}"
    if not files.any_exists(spark, path):
        raise FileNotFoundError(f"no source file for table {table.name!r} at {path}")
    rows = (
        spark.read.schema(table.schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", table.free_text)
        .option("mode", "FAILFAST")
        .csv(path)
        .select(*table.columns)
    )
    return rows.hint("rebalance") if table.free_text else rows
