"""Named queries over the test tables, one or more per operator."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martworks.catalog.lake import AS_OF, EARLIEST, Lake
from martworks.operators import scd2, upsert
from martworks.operators.key_index import KeyIndex
from martworks.operators.keyed import top_n_per_group
from martworks.plans import marts, reports, rollups
from martworks.plans.descriptions import TABLES
from martworks.plans.pipeline import Build
from martworks.plans.warehouse import Warehouse, namespace, with_comments
from martworks.quality import checks, declared, expectations, invariants, suites
from martworks.quality.quantiles import exact_quantiles
from martworks.sources import csv_source, files, landing, raw
from martworks.sources.registry import SourceTable, get_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

INCREMENTAL_FROM = "2001-06-01"
SUITE_BOUNDS = {
    "fct_orders": {
        "order_total": (0, 1_000_000),
        "order_total_mean": (40, 400_000),
        "order_total_quantiles": {
            0.5: (30, 500_000),
            0.95: (200, 1_000_000),
            0.99: (400, 1_000_000),
        },
    },
    "fct_order_items": {"item_price": (0, 60_000), "item_price_mean": (20, 60_000)},
}


def plain(df: DataFrame) -> DataFrame:
    """Result types both engines share: decimals as double, integers as bigint."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(fn: Callable[[Lake], DataFrame]):
    QUERIES[fn.__name__] = lambda spark, sf_dir: plain(fn(Lake(spark, sf_dir)))
    return fn


def _model(name: str, *drop: str) -> None:
    QUERIES[name] = lambda spark, sf_dir: plain(
        getattr(Lake(spark, sf_dir), name).drop("_ingested_at", *drop)
    )


for _name in (
    "stg_customers stg_orders stg_order_items stg_payments stg_reviews stg_geolocation "
    "stg_translation stg_products stg_sellers payment_summary item_summary review_summary "
    "delivery_timeline items_enriched fct_orders fct_order_items dim_customers dim_products "
    "dim_sellers dim_geography dim_date agg_daily_performance dim_sellers_history"
).split():
    _model(_name)


# keyed selection


@query
def dominant_category(lake: Lake) -> DataFrame:
    """Category with the most revenue per order, as a ranked selection."""
    revenue = (
        lake.stg_order_items.join(
            lake.stg_products.select("product_id", "category_name"), "product_id", "left"
        )
        .groupBy("order_id", "category_name")
        .agg(F.sum("item_price").alias("revenue"))
    )
    order = [F.desc("revenue"), F.asc_nulls_last("category_name")]
    return top_n_per_group(revenue, ["order_id"], order, 1)


@query
def modal_place(lake: Lake) -> DataFrame:
    return marts.modal_place(lake.stg_geolocation)


# sources and landing


@query
def typed_csv_scan(lake: Lake) -> DataFrame:
    """Orders written as CSV, read back through the typed scan."""
    table = get_table("orders")
    folder = lake.work()
    (
        lake.raw("orders")
        .select(*table.columns)
        .write.option("header", True)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(f"{folder}/{table.filename}")
    )
    return csv_source.read_source(lake.spark, table, folder)


@query
def land_window_rows(lake: Lake) -> DataFrame:
    """Lines in a half-open window of the watermark."""
    table = get_table("order_items")
    window = landing.window_filter(table, "1997-03-01 00:00:00", "1997-04-01 00:00:00")
    return lake.raw("order_items").where(window).select(*table.columns)


@query
def landed_by_day(lake: Lake) -> DataFrame:
    """Rows per partition of a history load."""
    day = landing.event_date(get_table("orders"), "2002-01-01").alias("ingest_date")
    return (
        lake.raw("orders").groupBy(day).agg(F.count(F.lit(1)).alias("row_count"))
    )


# The run table is landed like a source: sliced by start time, one folder per day.
RUN_TABLE = SourceTable(
    "runs",
    (
        ("dag_id", "string"),
        ("task_id", "string"),
        ("run_id", "string"),
        ("started_at", "timestamp"),
        ("duration_seconds", "float"),
        ("status", "string"),
    ),
    watermark="started_at",
)


@query
def landing_roundtrip(lake: Lake) -> DataFrame:
    """History landed, loaded to raw, one day landed and loaded again: rows per load
    date, the same as after the first load."""
    root, raw_root = f"{lake.work()}/landing", f"{lake.work()}/raw"
    day = "2024-01-09"
    counted = []
    for table, source in ((RUN_TABLE, lake.runs), (get_table("sellers"), lake.raw("sellers"))):
        landing.land_history(source, table, root, "2024-01-01")
        raw.load_raw(lake.spark, table, root, raw_root, full=True)
        landing.land_day(source, table, root, day)
        raw.load_raw(lake.spark, table, root, raw_root, day)
        loaded = raw.read_raw(lake.spark, raw_root, table.name)
        counted.append(
            loaded.groupBy("ingest_date")
            .agg(F.count(F.lit(1)).alias("row_count"))
            .select(F.lit(table.name).alias("table"), "ingest_date", "row_count")
        )
    return reduce(DataFrame.unionByName, counted)


@query
def backfill_days(lake: Lake) -> DataFrame:
    """A closed range of days landed in one job, rows per partition."""
    table, root = get_table("order_items"), f"{lake.work()}/landing"
    landing.backfill(lake.raw("order_items"), table, root, "1996-01-10", "1996-02-08")
    landed = landing.read_landed(lake.spark, root, table.name)
    return landed.groupBy("ingest_date").agg(F.count(F.lit(1)).alias("row_count"))


@query
def landed_lineage(lake: Lake) -> DataFrame:
    """Lineage of two tables landed in one run: one run id and one file name each."""
    root = f"{lake.work()}/landing"
    sources = {"orders": lake.raw("orders"), "sellers": lake.raw("sellers")}
    landing.land_all(lambda t: sources[t.name], root, "1999-03-03", list(sources))
    both = [
        landing.read_landed(lake.spark, root, n).select(
            F.lit(n).alias("table"), "ingest_date", "_ingested_at", "_source_file", "_run_id"
        )
        for n in sources
    ]
    rows = both[0].unionByName(both[1])
    runs = rows.agg(F.count_distinct("_run_id").alias("runs"))
    found = rows.groupBy("table").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("_source_file").alias("source_file"),
        F.count_distinct("_source_file").alias("files"),
        F.count_distinct("ingest_date").alias("days"),
        F.count_if(F.col("_ingested_at").isNull()).alias("without_time"),
    )
    # One row beside each of two: the number of run ids over both tables.
    return found.withColumn("runs", F.lit(runs.first()["runs"]))


@query
def widened_files(lake: Lake) -> DataFrame:
    """A day landed again with one more column: rows by its value over all files."""
    table, root, raw_root = get_table("orders"), f"{lake.work()}/landing", f"{lake.work()}/raw"
    landing.backfill(lake.raw("orders"), table, root, "1999-03-01", "1999-03-10")
    raw.load_raw(lake.spark, table, root, raw_root, full=True)
    day = landing.read_landed(lake.spark, root, "orders", "1999-03-03")
    wider = day.withColumn("channel", F.when(F.col("order_status") == "delivered", "shop").otherwise("app"))
    wider.drop("ingest_date").write.mode("overwrite").parquet(
        landing.partition_path(root, "orders", "1999-03-04")
    )
    raw.load_raw(lake.spark, table, root, raw_root, "1999-03-04")
    loaded = raw.read_raw(lake.spark, raw_root, "orders")
    return loaded.groupBy("channel").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("ingest_date").alias("days")
    )


@query
def load_results(lake: Lake) -> DataFrame:
    """What the loads of several tables report: all days first, one day afterwards."""
    root, raw_root = f"{lake.work()}/landing", f"{lake.work()}/raw"
    names = ["order_items", "sellers"]
    landing.backfill_all(lambda t: lake.raw(t.name), root, "1999-03-01", "1999-03-05", names)
    first = raw.load_all(lake.spark, root, raw_root, tables=names, full=True)
    landing.land_all(lambda t: lake.raw(t.name), root, "1999-03-03", names)
    again = raw.load_all(lake.spark, root, raw_root, "1999-03-03", names)
    rows = [
        F.struct(
            F.lit(step).alias("step"), F.lit(r.table).alias("table"),
            F.lit(r.rows).cast("bigint").alias("row_count"), F.lit(r.day).cast("string").alias("day"),
        )
        for step, results in (("all", first), ("day", again))
        for r in results
    ]
    return lake.spark.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


@query
def stored_descriptions(lake: Lake) -> DataFrame:
    """Column comments as a stored dimension gives them back, with the columns' values."""
    warehouse = Warehouse(lake.spark, f"{lake.work()}/warehouse", "prod")
    stored = warehouse.write(with_comments(lake.dim_sellers, TABLES["dim_sellers"][1]), "dim_sellers")
    found = [
        F.struct(
            F.lit(f.name).alias("column"), F.lit(f.metadata["comment"]).alias("comment"),
            F.count(F.col(f.name)).alias("values"),
        )
        for f in stored.schema
        if "comment" in f.metadata
    ]
    return stored.agg(F.array(*found).alias("found")).select(F.explode("found").alias("r")).select("r.*")


@query
def landing_metrics(lake: Lake) -> DataFrame:
    """Partitions and rows of landed tables. Objects and bytes, which the same listing
    gives, depend on the writer and are left to the tests."""
    names, found = (RUN_TABLE, get_table("sellers")), []
    for table, source in zip(names, (lake.runs, lake.raw("sellers"))):
        landed = landing.land_history(source, table, f"{lake.work()}/landing", "2024-01-01")
        stored = files.storage_metrics(lake.spark, landed.path).select("partitions")
        rows = lake.spark.read.parquet(landed.path).agg(F.count(F.lit(1)).alias("row_count"))
        found.append(reports.one_row(stored, rows).withColumn("table", F.lit(table.name)))
    return reduce(DataFrame.unionByName, found)


@query
def window_intersection(lake: Lake) -> DataFrame:
    """Orders in two adjacent half-open windows: those without a purchase time."""
    table, orders = get_table("orders"), lake.raw("orders")
    cut = "1997-03-15 00:00:00"
    before = orders.where(landing.window_filter(table, "1995-01-01 00:00:00", cut))
    after = orders.where(landing.window_filter(table, cut))
    return invariants.window_overlap(before, after, "order_id")


@query
def seller_key_drift(lake: Lake) -> DataFrame:
    """Seller keys that only one of two loads has."""
    return invariants.key_sets_differ(
        lake.raw("sellers"), lake.src("src_sellers_later"), "seller_id"
    )


# history


@query
def scd2_snapshot_two_loads(lake: Lake) -> DataFrame:
    return lake.seller_snapshot


@query
def scd2_point_in_time_revenue(lake: Lake) -> DataFrame:
    lines = lake.line_context.withColumnRenamed("seller_id", "seller_key")
    return reports.revenue_by_seller_place(lines, lake.dim_sellers_history)


@query
def scd2_overlap_violations(lake: Lake) -> DataFrame:
    """Line intervals per part taken as versions: many overlap, some are reversed."""
    intervals = lake.table("lineitem").select(
        F.col("l_partkey").alias("part_key"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("version_key"),
        F.col("l_shipdate").alias("valid_from"),
        F.when(
            F.col("l_quantity") < 49,
            F.timestamp_add("DAY", F.col("l_suppkey") % 40 - 3, F.col("l_shipdate")),
        ).alias("valid_to"),
    )
    flagged = intervals.withColumn("is_current", F.col("valid_to").isNull())
    return scd2.history_violations(flagged, "part_key")


@query
def scd2_seller_violations(lake: Lake) -> DataFrame:
    return scd2.history_violations(lake.dim_sellers_history, "seller_key", "seller_version_key")


@query
def scd2_summary(lake: Lake) -> DataFrame:
    return scd2.history_summary(lake.dim_sellers_history, "seller_key")


@query
def scd2_changed_sellers(lake: Lake) -> DataFrame:
    return scd2.changed_versions(lake.dim_sellers_history, "seller_key").select(
        "seller_key",
        "version_number",
        "seller_city",
        "seller_state",
        "valid_from",
        "valid_to",
        "is_current",
    )


def _fact_runs(lake: Lake, early: dict, later: dict, **options) -> DataFrame:
    """The order fact after a full run on early raw tables and an incremental run on later
    ones; tables not named are as given."""
    lake.keep_raw("order_payments")
    warehouse = Warehouse(lake.spark, f"{lake.work()}/warehouse")
    for changed, more in ((early, {}), (later, options)):
        build = Build(
            warehouse,
            lambda name, c=changed: c[name] if name in c else lake.raw(name),
            datetime(2001, 9, 1),
            earliest=EARLIEST,
            partition_by_month=True,
            **more,
        )
        build.facts()
    return warehouse.read("fct_orders")


@query
def incremental_equals_full(lake: Lake) -> DataFrame:
    """The order fact built from the orders up to a date, then by an incremental run on
    raw tables in which second payments and second reviews are gone: orders since the
    lookback follow the new rows, older ones stay as they were built."""
    orders = lake.raw("orders")
    purchased = F.col("order_purchase_timestamp")
    early = orders.where(purchased.isNull() | (purchased < INCREMENTAL_FROM))
    lake.keep_raw("order_payments")
    later = {
        "order_payments": lake.raw("order_payments").where("payment_sequential = 1"),
        "order_reviews": lake.raw("order_reviews").where("review_id not like 's%'"),
    }
    return _fact_runs(lake, {"orders": early}, later)


@query
def incremental_late_lines(lake: Lake) -> DataFrame:
    """The same when the lines of some old orders land after the lookback has passed: a
    run that also takes up orders touched by new partitions equals a full one."""
    lines = lake.raw("order_items")
    late = F.col("order_id").cast("bigint") % 50 == 0
    landed = F.when(late, F.lit("2002-02-01").cast("date")).otherwise(F.col("ingest_date"))
    return _fact_runs(
        lake,
        {"order_items": lines.where(~late)},
        {"order_items": lines.withColumn("ingest_date", landed)},
        landed_since=date(2002, 1, 15),
    )


@query
def incremental_dimensions(lake: Lake) -> DataFrame:
    """Measures of customers, sellers and products after a full run on the orders up to a
    date and without some lines, and an incremental run on everything: the late lines and
    the orders whose lines came before them change the kept measures to those of all
    orders and lines."""
    orders, lines = lake.raw("orders"), lake.raw("order_items")
    late = F.col("order_id").cast("bigint") % 50 == 0
    landed = F.when(late, F.lit("2002-02-01").cast("date")).otherwise(F.col("ingest_date"))
    early = {
        "orders": orders.where(F.col("order_purchase_timestamp") < INCREMENTAL_FROM),
        "order_items": lines.where(~late),
    }
    lake.keep_raw("order_payments")
    warehouse = Warehouse(lake.spark, f"{lake.work()}/warehouse")
    for changed in (early, {"order_items": lines.withColumn("ingest_date", landed)}):
        build = Build(
            warehouse,
            lambda name, c=changed: c[name] if name in c else lake.raw(name),
            datetime(2001, 9, 1),
            earliest=EARLIEST,
            partition_by_month=True,
        )
        build.facts()
        build.dimensions()
    money = lambda c: F.col(c).cast("double").alias("value")
    none = lambda c: F.lit(None).cast(c)
    people = warehouse.read("dim_customers").select(
        F.lit("customer").alias("dimension"), F.col("customer_unique_id").alias("key"),
        F.col("lifetime_order_count").alias("orders"), none("bigint").alias("units"), money("lifetime_gross_value"),
        F.col("first_order_date").alias("first_day"), F.col("most_recent_order_date").alias("last_day"),
    ).distinct()
    sellers = warehouse.read("dim_sellers").select(
        F.lit("seller"), "seller_key", "order_count", "items_sold", money("gross_revenue"), "first_sale_date",
        "most_recent_sale_date",
    )
    products = warehouse.read("dim_products").select(
        F.lit("product"), "product_key", "orders_containing_product", "units_sold", money("gross_revenue"),
        none("date"), none("date"),
    )
    return people.union(sellers).union(products)


@query
def index_partitions(lake: Lake) -> DataFrame:
    """Which partitions of the landed lines hold lines of the orders of a week, as the
    stored index names them, and the week's lines that lie in them."""
    lines, orders = lake.raw("order_items"), lake.raw("orders")
    early = F.col("ingest_date") < "1998-01-01"
    index = KeyIndex(lake.spark, f"{lake.work()}/index", "order_id", "ingest_date")
    index.rebuild(lines.where(early))
    index.add(lines.where(~early))
    purchased = F.col("order_purchase_timestamp")
    week = orders.where((purchased >= "1997-12-01") & (purchased < "1997-12-08")).select("order_id").distinct()
    days = sorted(index.partitions(week))
    named = lines.where(F.col("ingest_date").isin(days)).join(week, "order_id", "left_semi")
    return named.groupBy("ingest_date").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("order_id").alias("orders"),
        F.lit(len(days)).cast("bigint").alias("partitions"),
    )


@query
def incremental_partitions(lake: Lake) -> DataFrame:
    """The same on stored partitions: full refresh, then an upsert of a window whose
    orders also change their date; rows and orders per month afterwards."""
    path = f"{lake.work()}/orders_by_month"
    month = F.trunc("purchased_date", "month").alias("purchased_month")
    orders = lake.stg_orders.select("order_id", "order_status", "purchased_date", month)
    early = orders.where(F.col("purchased_date") < INCREMENTAL_FROM)
    upsert.full_refresh(early, path, "purchased_month")
    target = lake.spark.read.parquet(path)
    start = upsert.lookback_start(target, "purchased_date")
    batch = upsert.since(orders, "purchased_date", start)
    moved = orders.where((F.col("purchased_date") < start) & (F.col("order_id") % 50 == 0))
    moved = moved.withColumn("purchased_month", F.add_months("purchased_month", 1))
    upsert.upsert_partitions(
        lake.spark, batch.unionByName(moved), path, ["order_id"], "purchased_month"
    )
    return (
        lake.spark.read.parquet(path)
        .groupBy("purchased_month")
        .agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("order_id").alias("orders"))
    )


@query
def incremental_added_column(lake: Lake) -> DataFrame:
    """A column that only later batches have: it is added to the stored table, and rows of
    partitions that were not touched have none in it."""
    path = f"{lake.work()}/orders_by_month"
    month = F.trunc("purchased_date", "month").alias("purchased_month")
    orders = lake.stg_orders.select("order_id", "order_status", "purchased_date", month)
    early = orders.where(F.col("purchased_date") < INCREMENTAL_FROM)
    index = KeyIndex(lake.spark, f"{lake.work()}/index", "order_id", "purchased_month")
    upsert.full_refresh(early, path, "purchased_month", index=index)
    channel = F.when(F.col("order_status") == "delivered", "shop").otherwise("app").alias("channel")
    batch = orders.where(F.col("purchased_date") >= INCREMENTAL_FROM).select("*", channel)
    upsert.upsert_partitions(lake.spark, batch, path, ["order_id"], "purchased_month", index=index)
    stored = lake.spark.read.option("mergeSchema", True).parquet(path)
    return stored.groupBy("channel").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("purchased_month").alias("months")
    )


@query
def published_marts(lake: Lake) -> DataFrame:
    """Two marts read as catalog tables of two namespaces side by side, with the descriptions
    that the catalog gives back. Both are of this call alone: a catalog may hold others."""
    parts = []
    for target in ("dev", "ci"):
        prefix = f"m{uuid.uuid4().hex[:12]}"
        warehouse = Warehouse(lake.spark, f"{lake.work()}/{target}", target, prefix)
        warehouse.write(lake.dim_geography, "dim_geography")
        warehouse.write(lake.dim_products, "dim_products")
        names = ["dim_geography", "dim_products"]
        warehouse.publish(names)
        database = namespace("marts", target, prefix)
        for name in names:
            comment = lake.spark.catalog.getTable(f"{database}.{name}").description
            parts.append(
                lake.spark.table(f"{database}.{name}").agg(F.count(F.lit(1)).alias("row_count")).select(
                    F.lit(target).alias("target"), F.lit(name).alias("mart"), "row_count", F.lit(comment).alias("comment")
                )
            )
    return reduce(DataFrame.unionByName, parts)


# data tests


def _raw_tables(lake: Lake) -> dict[str, DataFrame]:
    return {
        f"raw_{t}": lake.raw(t)
        for t in (
            "orders order_items order_payments customers products sellers "
            "product_category_translation"
        ).split()
    }


def _models(lake: Lake, wanted, *kept: str) -> dict[str, DataFrame]:
    """The models that checks read. Each is read once and only in the columns of its checks,
    so it is not stored itself; ``kept`` are models that several of them read."""
    lake.keep(*kept)
    names = {c.model for c in wanted} | {c.parent for c in wanted if c.parent}
    return {n: getattr(lake, n) for n in sorted(names)}


def _of_kind(pool, *kinds):
    return [c for c in pool if c.kind in kinds]


@query
def checks_sources(lake: Lake) -> DataFrame:
    return checks.run_checks(_raw_tables(lake), declared.SOURCE_CHECKS)


@query
def checks_staging(lake: Lake) -> DataFrame:
    wanted = declared.STAGING_CHECKS
    return checks.run_checks(_models(lake, wanted, "stg_order_items"), wanted)


@query
def checks_intermediate(lake: Lake) -> DataFrame:
    wanted = declared.INTERMEDIATE_CHECKS
    return checks.run_checks(_models(lake, wanted, "stg_order_items", "order_context"), wanted)


@query
def checks_marts(lake: Lake) -> DataFrame:
    wanted = declared.MART_CHECKS
    return checks.run_checks(_models(lake, wanted, "stg_order_items", "order_context"), wanted)


@query
def null_counts(lake: Lake) -> DataFrame:
    wanted = _of_kind(
        [c for c in declared.MART_CHECKS if c.model == "fct_order_items"], "not_null"
    )
    return checks.run_checks(_models(lake, wanted), wanted)


@query
def duplicate_keys(lake: Lake) -> DataFrame:
    return checks.duplicates(
        lake.raw("order_items"), "order_id", "order_item_id", keep_null=True
    )


@query
def duplicate_order_ids(lake: Lake) -> DataFrame:
    return checks.duplicates(lake.raw("orders"), "order_id")


@query
def length_and_range_violations(lake: Lake) -> DataFrame:
    """Rows that break a value length or a range, with the number of rules broken."""
    rules = [
        *checks.between("raw_products", "product_photos_qty", 2, 5),
        *checks.between("raw_products", "product_weight_g", 500, None),
        *checks.value_length("raw_products", "product_category_name", 8),
    ]
    broken = [F.coalesce(checks.breaks(c), F.lit(False)).cast("int") for c in rules]
    total = reduce(lambda a, b: a + b, broken)
    return (
        lake.raw("products")
        .select("product_id", "product_category_name", total.alias("rules_broken"))
        .where("rules_broken > 0")
    )


@query
def accepted_values_violations(lake: Lake) -> DataFrame:
    """Raw payments whose type is outside the set before it is cleaned."""
    (check,) = checks.accepted("raw", "payment_type", *declared.PAYMENT_TYPES)
    table = get_table("order_payments")
    return checks.violations(check, {"raw": lake.raw("order_payments")}).select(*table.columns)


@query
def stored_violations(lake: Lake) -> DataFrame:
    """Failing payments of the same check, stored for inspection and read back."""
    (check,) = checks.accepted("raw", "payment_type", *declared.PAYMENT_TYPES)
    path = checks.store_violations(check, {"raw": lake.raw("order_payments")}, f"{lake.work()}/failures")
    return lake.spark.read.parquet(path).groupBy("payment_type").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("order_id").alias("orders")
    )


@query
def orphan_lines(lake: Lake) -> DataFrame:
    """Order ids of lines whose order is not valid, with their lines."""
    return checks.orphans(lake.stg_order_items, "order_id", lake.stg_orders, "order_id")


@query
def checks_with_severity(lake: Lake) -> DataFrame:
    """Incomplete orders per flag: pass, warn or error by count."""
    flags = ("is_missing_payment", "is_missing_items", "is_missing_delivery_timestamp")
    counted = lake.fct_orders.agg(
        *[F.count_if(F.col(c)).alias(c) for c in flags],
    ).select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("check"), F.col(c).alias("failures")) for c in flags])
        ).alias("r")
    )
    return checks.with_severity(counted.select("r.*"), warn_above=0, error_above=250)


@query
def freshness(lake: Lake) -> DataFrame:
    names = ("orders", "order_items", "sellers")
    return reduce(
        DataFrame.unionByName,
        [checks.freshness(lake.raw(n), n, "2002-01-02 12:00:00") for n in names],
    )


# invariants


@query
def agg_vs_fact(lake: Lake) -> DataFrame:
    return invariants.agg_reconciles_to_fact(
        lake.fct_order_items, lake.agg_daily_performance
    )


@query
def agg_vs_fact_broken(lake: Lake) -> DataFrame:
    """The same against an aggregate that lost the shipped orders."""
    partial = lake.fct_order_items.where(F.col("order_status") != "shipped")
    broken = partial.groupBy("purchased_date").agg(
        F.count(F.lit(1)).alias("item_count"),
        F.sum("item_price").alias("gross_item_revenue"),
        F.sum("item_total").alias("total_revenue"),
    )
    return invariants.agg_reconciles_to_fact(lake.fct_order_items, broken)


@query
def lines_vs_orders(lake: Lake) -> DataFrame:
    return invariants.lines_roll_up_to_orders(lake.fct_order_items, lake.fct_orders)


@query
def lines_vs_orders_broken(lake: Lake) -> DataFrame:
    """The same with every line of product 7 counted twice."""
    lines = lake.fct_order_items
    doubled = lines.unionByName(lines.where(F.col("product_key") == "7"))
    return invariants.lines_roll_up_to_orders(doubled, lake.fct_orders)


@query
def payments_vs_orders(lake: Lake) -> DataFrame:
    return invariants.unsettled_orders(lake.fct_orders)


@query
def payments_vs_orders_broken(lake: Lake) -> DataFrame:
    """The same with the second part of split payments lost."""
    paid = rollups.payment_summary(lake.stg_payments.where("payment_sequential = 1"))
    facts = marts.fct_orders(lake.order_context, lake.item_summary, paid, lake.review_summary)
    return invariants.unsettled_orders(facts)


@query
def impossible_dates(lake: Lake) -> DataFrame:
    """Judged from the middle of the data, so later orders count as future ones."""
    facts = lake.delivery_timeline.withColumnRenamed("order_id", "order_key")
    return invariants.impossible_dates(facts, "2001-01-01 00:00:00", "1995-06-01")


@query
def completeness_rows(lake: Lake) -> DataFrame:
    return invariants.incomplete_orders(lake.fct_orders)


@query
def sla_rate(lake: Lake) -> DataFrame:
    return invariants.delivery_rate(lake.delivery_timeline)


@query
def sla_implausible(lake: Lake) -> DataFrame:
    return invariants.implausible_sla(lake.delivery_timeline, high=0.05)


# distributions


def _judged(lake: Lake, wanted) -> dict[str, DataFrame]:
    """The tables of suites. Their columns are read several times and stored; no others are."""
    lake.keep("stg_order_items", "order_context")
    return {s.table: lake.stored(s.table, s.columns()) for s in wanted}


@query
def expectation_summary(lake: Lake) -> DataFrame:
    wanted = suites.build_suites(lake.table("orders").count(), SUITE_BOUNDS)
    found = expectations.run_suites(_judged(lake, wanted), wanted)
    return found.withColumn("observed_value", F.round("observed_value", 4)).withColumn(
        "unexpected_percent", F.round("unexpected_percent", 6)
    )


TIGHT_BOUNDS = {**SUITE_BOUNDS, "fct_order_items": {"item_price": (0, 30_000), "item_price_mean": (1, 2)}}


@query
def suite_outcomes(lake: Lake) -> DataFrame:
    """Two suites, one of them with bounds that the data break: outcome per suite, read
    back from the JSON report, with the rows each has looked at."""
    judged = ("fct_order_items", "agg_daily_performance")
    wanted = [s for s in suites.build_suites(lake.table("orders").count(), TIGHT_BOUNDS) if s.table in judged]
    tables = _judged(lake, wanted)
    found = expectations.run_suites(tables, wanted)
    path = expectations.write_report(lake.spark, found, f"{lake.work()}/reports", "20020101")
    report = lake.spark.read.schema(found.schema).json(path)
    whole = expectations.outcome(report)
    return (
        expectations.summarise(report)
        .join(expectations.rows_validated(tables, wanted), "suite")
        .withColumn("all_suites_passed", F.lit(whole.passed))
    )


@query
def quantiles_with_nan(lake: Lake) -> DataFrame:
    """Quantiles of line prices of which some are NaN and some infinite."""
    key = F.col("l_orderkey") % 20
    price = F.when(key == 3, F.lit(float("nan"))).when(key == 4, F.lit(float("inf"))).otherwise(
        F.col("l_extendedprice")
    )
    wanted = (0.0, 0.1, 0.5, 0.85, 0.93, 0.99, 1.0)
    found = exact_quantiles(lake.table("lineitem").select(price.alias("v")), "v", wanted)
    rows = [F.struct(F.lit(p).alias("p"), F.lit(str(v)).alias("v")) for p, v in found.items()]
    shown = F.when(F.col("r.v") == "nan", "nan").when(F.col("r.v") == "inf", "inf").otherwise(
        F.round(F.try_to_number("r.v", F.lit("999999999.99")).cast("double"), 2).cast("string")
    )
    listed = lake.spark.range(1).select(F.explode(F.array(*rows)).alias("r"))
    return listed.select("r.p", shown.alias("v"))


@query
def order_quantiles(lake: Lake) -> DataFrame:
    totals = lake.order_values.select("order_total")
    stored = f"{lake.work()}/totals"
    totals.write.parquet(stored)
    wanted = (0.01, 0.25, 0.5, 0.75, 0.95, 0.99)
    found = exact_quantiles(lake.spark.read.parquet(stored), "order_total", wanted)
    rows = [F.struct(F.lit(p).alias("p"), F.lit(v).alias("order_total")) for p, v in found.items()]
    return lake.spark.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


# reports


@query
def monthly_revenue_region(lake: Lake) -> DataFrame:
    return reports.monthly_revenue_by_region(lake.agg_daily_performance, lake.dim_date)


@query
def monthly_revenue_region_orders_once(lake: Lake) -> DataFrame:
    daily = lake.stored("agg_daily_performance")
    return reports.monthly_revenue_by_region(daily, lake.dim_date, orders_once=True)


@query
def weekly_late_rate(lake: Lake) -> DataFrame:
    return reports.weekly_late_rate(lake.agg_daily_performance, lake.dim_date)


@query
def weekly_late_rate_orders_once(lake: Lake) -> DataFrame:
    return reports.weekly_late_rate(
        lake.agg_daily_performance, lake.dim_date, floor=4, orders_once=True
    )


@query
def worst_sellers(lake: Lake) -> DataFrame:
    return reports.worst_sellers(lake.dim_sellers)


@query
def top_categories_region(lake: Lake) -> DataFrame:
    return reports.top_categories_by_region(lake.agg_daily_performance, AS_OF)


def _both_grains(name: str, build: Callable[[DataFrame], DataFrame]) -> None:
    QUERIES[f"{name}_fact"] = lambda spark, sf_dir: plain(
        build(Lake(spark, sf_dir).fct_order_items)
    )
    QUERIES[f"{name}_agg"] = lambda spark, sf_dir: plain(
        build(Lake(spark, sf_dir).agg_daily_performance)
    )


_both_grains("monthly_trend", reports.monthly_trend)
_both_grains("region_category", reports.region_category_revenue)
_both_grains("top_states", lambda facts: reports.top_states(facts, 2000))


@query
def headline_metrics(lake: Lake) -> DataFrame:
    return reports.headline_metrics(
        lake.delivery_timeline, lake.fct_order_items, lake.dim_sellers_history
    )


@query
def load_volume(lake: Lake) -> DataFrame:
    return reports.load_volume(lake.raw("order_items"))


@query
def run_durations(lake: Lake) -> DataFrame:
    found = reports.average_durations(lake.runs, "2024-02-10")
    return found.withColumn("avg_seconds", F.round("avg_seconds", 6))


@query
def run_summary(lake: Lake) -> DataFrame:
    return reports.run_summary(lake.runs)


@query
def slowest_tasks(lake: Lake) -> DataFrame:
    return reports.slowest_tasks(lake.runs).select(
        "run_date", "run_id", "task_id", "started_at", "seconds"
    )


@query
def table_row_counts(lake: Lake) -> DataFrame:
    """Rows per raw table."""
    from martworks.catalog.testdata import RAW_TABLES

    counted = [
        lake.raw(t).agg(F.lit(t).alias("table"), F.count(F.lit(1)).alias("row_count"))
        for t in RAW_TABLES
    ]
    return reduce(DataFrame.unionByName, counted)
