from __future__ import annotations

from datetime import date, datetime
from pathlib import Path

import pytest
from conftest import rows, same
from pyspark.sql import functions as F

from martworks.catalog import queries
from martworks.catalog.lake import Lake
from martworks.plans import marts, pipeline, reports, rollups
from martworks.plans.warehouse import Warehouse, namespace, with_comments
from martworks.quality import declared, invariants
from martworks.sources import files


@pytest.fixture(scope="module")
def lake(spark, sf_dir):
    return Lake(spark, sf_dir)


@pytest.fixture(scope="module")
def stored(spark, lake):
    return {n: lake.stored(n) for n in ("fct_orders", "fct_order_items", "agg_daily_performance")}


def test_invariants_hold_and_catch_mutations(lake, stored):
    orders, lines, daily = stored["fct_orders"], stored["fct_order_items"], stored["agg_daily_performance"]
    assert invariants.lines_roll_up_to_orders(lines, orders).isEmpty()
    assert invariants.unsettled_orders(orders).isEmpty()
    assert invariants.agg_reconciles_to_fact(lines, daily).isEmpty()
    one = lines.limit(1)
    fanned = lines.unionByName(one)
    assert invariants.lines_roll_up_to_orders(fanned, orders).count() == 1
    assert invariants.agg_reconciles_to_fact(fanned, daily).count() == 1
    dropped = orders.withColumn("payment_variance", F.col("payment_variance") - F.lit("0.02").cast("decimal(18,2)"))
    settled = orders.where(~F.col("is_missing_payment") & ~F.col("is_missing_items")).count()
    assert invariants.unsettled_orders(dropped).count() == settled


def test_calendar(spark):
    days = marts.dim_date(marts.calendar_bounds(spark))
    assert days.count() == 1826
    row = days.where("date_key = date '2024-12-29'").first()
    assert (row.iso_day_of_week, row.is_weekend, row.year_quarter, row.year_month_key) == (7, True, "2024-Q4", 202412)
    assert (row.week_start_date, row.quarter_start_date) == (date(2024, 12, 23), date(2024, 10, 1))
    assert marts.dim_date(marts.calendar_bounds(spark, "2024-01-01", "2024-01-01")).isEmpty()


def test_geography_breaks_ties_by_name(spark):
    df = spark.createDataFrame(
        [("1", "B", "SP", 1.0, 2.0), ("1", "A", "SP", 3.0, 4.0), ("2", "Z", "RJ", 1.0, 1.0), ("2", "Z", "RJ", 2.0, 2.0), ("2", "A", "SP", 3.0, 3.0)],
        "zip_code_prefix string, city string, state string, latitude double, longitude double",
    )
    got = marts.dim_geography(df)
    assert rows(got.select("zip_code_prefix", "city", "region", "observation_count")) == [
        ("1", "A", "Sudeste", 2), ("2", "Z", "Sudeste", 3),
    ]
    assert [float(r[0]) for r in got.orderBy("zip_code_prefix").select("latitude").collect()] == [2.0, 2.0]
    assert rows(marts.modal_place(df).select("zip_code_prefix", "city")) == [("1", "A"), ("2", "Z")]


def test_customers_without_orders_keep_nulls(spark):
    people = spark.createDataFrame(
        [("c1", "p1", "1", "X", "SP", "Sudeste"), ("c2", "p2", "9", "Y", "SP", "Sudeste")],
        "customer_id string, customer_unique_id string, zip_code_prefix string, customer_city string, customer_state string, customer_region string",
    )
    orders = spark.createDataFrame([("p1", 5.0, date(2024, 1, 1))] * 2, "customer_unique_id string, order_total double, purchased_date date")
    geography = spark.createDataFrame([("1", "Geo", 1.0, 2.0)], "zip_code_prefix string, city string, latitude double, longitude double")
    got = {r.customer_key: r for r in marts.dim_customers(people, orders, geography).collect()}
    assert (got["c1"].customer_city, got["c1"].lifetime_order_count, got["c1"].is_repeat_customer) == ("Geo", 2, True)
    assert (got["c2"].customer_city, got["c2"].lifetime_order_count, got["c2"].is_repeat_customer) == ("Y", None, None)
    assert got["c2"].is_missing_geography and not got["c1"].is_missing_geography


def test_benchmark_trio_agrees_on_both_grains(stored):
    lines, daily = stored["fct_order_items"], stored["agg_daily_performance"]
    for report in (reports.monthly_trend, reports.region_category_revenue, lambda f: reports.top_states(f, 1999)):
        assert same(report(lines), report(daily).select(*report(lines).columns))


def test_run_metrics_keep_missing_timings(spark, folder):
    t = datetime(2024, 1, 1)
    data = [
        (date(2024, 1, 1), "d", "a", "r", t, datetime(2024, 1, 1, 0, 0, 2), None, "success", 5, None),
        (date(2024, 1, 1), "d", "b", "r", t, None, 1.239, "success", None, None),
        (date(2024, 1, 1), "d", "c", "r", t, None, None, "failed", None, None),
    ]
    runs = spark.createDataFrame(data, reports.RUN_METRICS_SCHEMA)
    row = reports.run_summary(runs).first()
    assert (row.total_seconds, row.tasks, row.tasks_without_timing) == (3.24, 3, 1)
    none = reports.run_summary(runs.where("task_id = 'c'")).first()
    assert none.total_seconds is None
    assert [r.task_id for r in reports.slowest_tasks(runs).collect()] == ["a", "b"]
    for _ in range(2):
        reports.append_run_metrics(runs, folder)
    assert spark.read.parquet(folder).count() == 6


def test_namespaces_and_comments(spark, folder):
    assert namespace("marts", "prod") == "marts" and namespace("marts", "ci", "ci_pr_7") == "ci_pr_7_marts"
    wh = Warehouse(spark, folder, "ci", "pr7")
    df = with_comments(spark.range(3).toDF("k"), {"k": "the key"})
    wh.write(df, "t")
    wh.publish(["t"], comments={"t": "a table"})
    wh.publish(["t"])
    assert spark.table("pr7_marts.t").count() == 3
    assert spark.table("pr7_marts.t").schema["k"].metadata["comment"] == "the key"


@pytest.fixture(scope="module")
def raw(spark, lake):
    root = lake.work()
    out = {}
    for name in ("customers geolocation order_items order_payments order_reviews orders products sellers product_category_translation").split():
        lake.raw(name).write.parquet(f"{root}/{name}")
        out[name] = spark.read.parquet(f"{root}/{name}")
    return out


def build(spark, root, raw, at, **options):
    return pipeline.Build(
        Warehouse(spark, root), raw.__getitem__, at, earliest="1995-02-01", partition_by_month=True,
        calendar=("1995-01-01", "2002-01-01"), **options,
    )


def test_incremental_build_equals_full_refresh(spark, raw, lake, folder):
    """Orders arrive in two batches; their lines, payments and reviews with them."""
    cut = F.lit("2001-06-01 00:00:00").cast("timestamp_ntz")
    early = {**raw, "orders": raw["orders"].where(F.col("order_purchase_timestamp") < cut)}
    build(spark, folder, early, datetime(2001, 6, 1)).run()
    result = build(spark, folder, raw, datetime(2001, 9, 1)).run()
    assert {r.mode for r in result.values()} == {"incremental"}
    assert all(r.partitions <= 4 for r in result.values())
    once = f"{folder}/once"
    full = build(spark, once, raw, datetime(2001, 9, 1), full_refresh=True)
    full.run()
    wh, other = Warehouse(spark, folder), Warehouse(spark, once)
    for name in ("fct_orders", "fct_order_items", "agg_daily_performance", "dim_customers", "dim_sellers", "dim_products"):
        assert same(wh.read(name), other.read(name)), name
    assert same(other.read("fct_orders"), lake.fct_orders.select(*other.read("fct_orders").columns))
    status = {(r["model"], r["check"], r["column"]): r["status"] for r in full.check().collect()}
    assert len(status) == 65 + 7
    assert {k for k, v in status.items() if v != "pass"} == {("orders_are_complete", "invariant", "")}
    assert status["orders_are_complete", "invariant", ""] == "warn"
    assert other.read("orders_are_complete", "test_failures").count() > 0
    metrics = full.run_metrics("daily", "r1")
    assert metrics.where("duration_seconds > 0").count() == 13
    runs = spark.read.parquet(other.path("runs", "state"))
    assert rows(runs.where("rows_processed is not null").select("task_id", "rows_processed")) == [
        (n, other.read(n).count()) for n in ("fct_order_items", "fct_orders")
    ]
    assert full.check(raise_on_error=True).count() == len(status)
    spark.range(1).selectExpr("'x' as seller_key").write.mode("append").parquet(other.path("dim_sellers"))
    with pytest.raises(pipeline.ChecksFailed, match="dim_sellers"):
        full.check(raise_on_error=True)


def test_late_lines_are_taken_up_by_the_next_run(spark, raw, folder):
    """Lines of old orders land long after the lookback: the next run counts them in facts
    and dimensions, unless it is told to leave them."""
    late = F.col("order_id").cast("bigint") % 50 == 0
    landed = F.when(late, F.lit("2002-02-01").cast("date")).otherwise(F.col("ingest_date"))
    complete = {**raw, "order_items": raw["order_items"].withColumn("ingest_date", landed)}
    early = {**raw, "order_items": raw["order_items"].where(~late)}
    once = f"{folder}/once"
    build(spark, once, complete, datetime(2001, 9, 2), full_refresh=True).run()
    other = Warehouse(spark, once)
    names = ("fct_orders", "fct_order_items", "agg_daily_performance", "dim_customers", "dim_sellers", "dim_products")
    for options in ({}, {"take_late": False, "landed_since": date(2002, 1, 15)}):
        root = f"{folder}/{len(options)}"
        build(spark, root, early, datetime(2001, 9, 1)).run()
        wh = Warehouse(spark, root)
        if options:
            build(spark, root, early, datetime(2001, 9, 2), take_late=False).run()
            assert not same(wh.read("fct_order_items"), other.read("fct_order_items"))
        build(spark, root, complete, datetime(2001, 9, 2), **options).run()
        for name in names:
            assert same(wh.read(name), other.read(name)), (name, options)


def test_a_build_in_parts_equals_one_in_one_go(spark, raw, folder):
    """Full and late lines in parts: the same facts and measures, one row of metrics for each
    step, and a full run that stopped between parts is done again in full."""
    late = F.col("order_id").cast("bigint") % 50 == 0
    none = raw["order_items"].limit(1).withColumn("order_id", F.lit(None).cast("string"))
    lines = raw["order_items"].unionByName(none)
    landed = F.when(late, F.lit("2002-02-01").cast("date")).otherwise(F.col("ingest_date"))
    complete = {**raw, "order_items": lines.withColumn("ingest_date", landed)}
    early = {**raw, "order_items": lines.where(~F.coalesce(late, F.lit(False)))}
    stored = [(n, "marts") for n in ("fct_orders", "fct_order_items")] + [
        (n, "state") for n in ("customer_measures", "seller_measures", "product_measures", "product_sellers", "orphan_lines")
    ]
    for source, at, mode in ((early, datetime(2001, 9, 1), "full"), (complete, datetime(2001, 9, 2), "incremental")):
        few, all_ = (build(spark, f"{folder}/{n}", source, at, lines_at_once=n) for n in (3500, 10**9))
        assert {r.mode for own in (few, all_) for r in own.facts().values()} == {mode}
        assert few._parts() == 2 and all_._parts() == 1
        for name, layer in stored:
            assert same(few.warehouse.read(name, layer), all_.warehouse.read(name, layer)), (name, mode)
        assert len(few.timings) == len({t[0] for t in few.timings})
        assert few.rows == all_.rows
    assert not few.warehouse.exists("unfinished", "state") and few._start() is not None
    few._mark(True, "unfinished")
    assert few._start() is None


def _step(spark, folder, raw, at, **options):
    """One incremental run beside a full one on the same raw tables: all that differs."""
    build(spark, f"{folder}/steps", raw, at, **options).run()
    build(spark, f"{folder}/full", raw, at, full_refresh=True).run()
    wh, other = Warehouse(spark, f"{folder}/steps"), Warehouse(spark, f"{folder}/full")
    names = ("fct_orders", "fct_order_items", "dim_customers", "dim_sellers", "dim_products")
    return [n for n in names if not same(wh.read(n), other.read(n))]


def test_measures_follow_changes_that_are_taken_back(spark, raw, folder):
    """Orders that move to another day, lines that change seller and price, orders that
    appear after their lines: kept measures stay those of a full run."""
    some = F.col("order_id").cast("bigint") % 40 == 0
    first = {**raw, "orders": raw["orders"].where(~some)}  # their lines have no order yet
    assert _step(spark, folder, first, datetime(2001, 9, 1)) == []
    later = F.lit("2002-03-01").cast("date")
    arrived = {**raw, "orders": raw["orders"].withColumn("ingest_date", F.when(some, later).otherwise(F.col("ingest_date")))}
    assert _step(spark, folder, arrived, datetime(2001, 9, 2)) == []
    moved = F.col("order_id").cast("bigint") % 60 == 0
    purchased = "order_purchase_timestamp"
    orders = arrived["orders"].where(moved & F.col(purchased).isNotNull()).withColumns(
        {
            purchased: F.col(purchased) - F.expr("interval 70 days"), "ingest_date": F.lit("2002-03-02").cast("date"),
            "_ingested_at": F.lit("2002-03-02 00:00:00").cast("timestamp_ntz"),
        }
    )
    lines = raw["order_items"].where(F.col("order_id").cast("bigint") % 70 == 0).withColumns(
        {
            "seller_id": F.lit("3"), "price": F.col("price") + 1, "ingest_date": F.lit("2002-03-02").cast("date"),
            "_ingested_at": F.lit("2002-03-02 00:00:00").cast("timestamp_ntz"),
        }
    )
    changed = {
        **arrived, "orders": arrived["orders"].unionByName(orders), "order_items": raw["order_items"].unionByName(lines),
    }
    assert _step(spark, folder, changed, datetime(2001, 9, 3)) == []
    # A run that stopped half-way leaves a mark; the next one sums all measures again.
    stopped = build(spark, f"{folder}/steps", changed, datetime(2001, 9, 4))
    stopped._mark(True)
    spark.range(0).selectExpr("'x' as customer_unique_id", "id as orders", "cast(id as decimal(28,2)) as value",
                              "current_date() as first", "current_date() as last").write.mode("overwrite").parquet(
        stopped._state("customer_measures"))
    assert _step(spark, folder, changed, datetime(2001, 9, 4)) == []


def test_window_reads_the_partitions_of_its_orders(spark, raw, folder):
    path = f"{folder}/lines"
    lines = raw["order_items"].withColumn("ingest_date", F.to_date(F.trunc("ingest_date", "month")))
    lines.write.partitionBy("ingest_date").parquet(path)
    complete = {**raw, "order_items": spark.read.parquet(path)}
    build(spark, folder, complete, datetime(2001, 9, 1)).run()
    own = build(spark, folder, complete, datetime(2001, 9, 2))
    keys = complete["orders"].where("order_id = '7'").select("order_id")
    matched = own._matching("order_items", keys, "order_id")
    plan = matched._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.splitlines() if path in x)
    assert "PartitionFilters: [" in scan and "PartitionFilters: []" not in scan
    days = {r[0] for r in lines.where("order_id = '7'").select("ingest_date").distinct().collect()}
    assert own._index("order_items").partitions(keys, "order_id") == days
    assert rows(matched.select("order_item_id")) == rows(lines.where("order_id = '7'").select("order_item_id"))


def test_stored_marts_carry_their_descriptions(spark, lake, folder):
    wh = Warehouse(spark, folder)
    stored = wh.write(lake.dim_geography, "dim_geography")
    assert stored.schema["latitude"].metadata["comment"] == "Mean of the samples"


def test_a_lake_removes_what_it_stored(spark, sf_dir, folder):
    with Lake(spark, sf_dir, folder) as own:
        path = own.work()
        assert own.stored("stg_sellers").count() > 0 and files.exists(spark, path)
    assert not files.exists(spark, path)


def test_a_raw_table_that_is_kept_is_read_and_not_made_again(spark, sf_dir, folder, lake):
    with Lake(spark, sf_dir, folder) as own:
        own.keep_raw("order_payments")
        kept = own.raw("order_payments")
        assert same(kept, lake.raw("order_payments")) and kept.dtypes == lake.raw("order_payments").dtypes
        assert all("src_order_payments" in f for f in kept.inputFiles())


def test_stored_snapshot_follows_changes(spark, raw, folder):
    wh = Warehouse(spark, folder)
    sellers = raw["sellers"]
    moved = sellers.where("seller_id <> '3'").withColumn(
        "seller_state", F.when(F.col("seller_id") == "5", "XX").otherwise(F.col("seller_state"))
    )
    for at, source in ((datetime(2024, 1, 1), sellers), (datetime(2024, 1, 2), moved), (datetime(2024, 1, 2, 12), moved), (datetime(2024, 1, 2, 13), sellers)):
        build(spark, folder, {**raw, "sellers": source}, at).snapshot()
    snap = pipeline.read_snapshot(wh, "snap_sellers")
    n = sellers.select("seller_id").distinct().count()
    assert snap.where("valid_to is null").count() == n
    assert rows(snap.where("seller_id = '5'").select("valid_from", "valid_to")) == rows(
        spark.createDataFrame([(datetime(2024, 1, 1), datetime(2024, 1, 2)), (datetime(2024, 1, 2), datetime(2024, 1, 2, 13)), (datetime(2024, 1, 2, 13), None)], "a timestamp_ntz, b timestamp_ntz")
    )
    assert snap.where("seller_id = '3'").count() == 2


def test_kept_models_lie_by_order_and_say_the_same(spark, sf_dir, folder, lake):
    with Lake(spark, sf_dir, folder) as own:
        before = {t.name for t in spark.catalog.listTables()}
        own.keep("stg_order_items", "order_context")
        assert {t.name for t in spark.catalog.listTables()} == before
        # Checks of the line fact read nothing of products or sellers, and lines and orders meet where they lie.
        keys = own.fct_order_items.select("order_item_key", "order_key", "product_key", "customer_key")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        try:
            plan = keys._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert "SortMergeJoin" in plan and "Exchange" not in plan and "part.parquet" not in plan
        for name in ("fct_order_items", "fct_orders", "dim_customers", "dim_sellers", "agg_daily_performance"):
            assert same(getattr(own, name), getattr(lake, name)), name
        assert sorted(p.name for p in Path(folder).glob("*/*")) == ["order_context", "stg_order_items"]


def test_models_that_checks_read_are_not_stored(spark, sf_dir, folder):
    with Lake(spark, sf_dir, folder) as own:
        assert queries.checks_marts(own).count() == len(declared.MART_CHECKS)
        assert sorted(p.name for p in Path(folder).glob("*/*")) == ["order_context", "stg_order_items"]


def test_order_rollup_keeps_lines_without_order_and_leaves_out_unread_sides(spark, sf_dir, folder):
    cents = "decimal(18,2)"
    lines = spark.createDataFrame(
        [("o", "p", "s", 1.0), ("o", "q", "s", 3.0), (None, "p", "s", 2.0), (None, "q", "t", 2.0), (None, None, None, 1.0)],
        "order_id string, product_id string, seller_id string, item_price double",
    ).select("*", F.lit(0).cast(cents).alias("freight_value"), F.col("item_price").cast(cents).alias("item_total"))
    lines = lines.withColumn("item_price", F.col("item_price").cast(cents))
    products = spark.createDataFrame([("p", "a"), ("q", "b")], "product_id string, category_name string")
    got = rollups.item_summary(lines, products).select(
        "order_id", "item_count", "distinct_product_count", "distinct_seller_count", "primary_category"
    )
    assert rows(got) == sorted([("o", 2, 2, 1, "b"), (None, 3, 2, 2, "a")], key=repr)
    with Lake(spark, sf_dir, folder) as own:
        own.keep("stg_order_items", "order_context")
        plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
        unread = plan(own.fct_orders.select("order_key", "order_total")).count("part.parquet")
        assert unread < plan(own.fct_orders.select("order_key", "primary_category")).count("part.parquet")
