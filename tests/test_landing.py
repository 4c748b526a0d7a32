from __future__ import annotations

import os
from datetime import date, datetime

import pytest
from conftest import rows, same
from pyspark.sql import functions as F

from martworks.quality.invariants import key_sets_differ, window_overlap
from martworks.sources import csv_source, files, landing, raw
from martworks.sources.registry import LINEAGE_COLUMNS, SOURCE_TABLES, get_table, select_tables

ORDERS, SELLERS = get_table("orders"), get_table("sellers")


def orders(spark, *stamps):
    data = [(f"o{i}", "c", "created", t, None, None, None, None) for i, t in enumerate(stamps)]
    return spark.createDataFrame(data, ORDERS.schema)


def sellers(spark, *ids):
    return spark.createDataFrame([(i, "1", "x", "SP") for i in ids], SELLERS.schema)


STAMPS = [datetime(2024, 3, 15), datetime(2024, 3, 15, 23, 59), datetime(2024, 3, 16), None]


def test_registry():
    assert len(SOURCE_TABLES) == 9
    assert [t.name for t in SOURCE_TABLES if t.strategy == "incremental"] == ["order_items", "orders"]
    assert get_table("geolocation").primary_key == ()
    assert [t.name for t in select_tables(["sellers", "orders"])] == ["orders", "sellers"]
    with pytest.raises(KeyError, match="nope"):
        get_table("nope")


def write_csv(folder, table, text):
    with open(os.path.join(folder, table.filename), "w") as f:
        f.write(text)


def test_csv_is_typed_and_blank_is_null(spark, folder):
    reviews = get_table("order_reviews")
    write_csv(folder, reviews, ",".join(reviews.columns) + "\n"
              'r1,o1,5,"","two\nlines, ""quoted""",2024-01-02 03:04:05,\n')
    row = csv_source.read_source(spark, reviews, folder).first()
    assert row.review_score == 5 and row.review_comment_title is None
    assert row.review_comment_message == 'two\nlines, "quoted"'
    assert row.review_creation_date == datetime(2024, 1, 2, 3, 4, 5)
    assert row.review_answer_timestamp is None


def test_csv_keeps_leading_zeros_and_rejects_bad_input(spark, folder):
    header = ",".join(SELLERS.columns)
    write_csv(folder, SELLERS, f"{header}\ns1,00123,são paulo,SP\n")
    assert csv_source.read_source(spark, SELLERS, folder).first().seller_zip_code_prefix == "00123"
    items = get_table("order_items")
    write_csv(folder, items, ",".join(items.columns) + "\no,one,p,s,2024-01-01 00:00:00,1.0,1.0\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        csv_source.read_source(spark, items, folder).collect()
    write_csv(folder, SELLERS, "id,zip,city,state\ns1,1,x,SP\n")
    with pytest.raises(Exception, match="header|CSV"):
        csv_source.read_source(spark, SELLERS, folder).collect()
    with pytest.raises(FileNotFoundError, match="customers"):
        csv_source.read_source(spark, get_table("customers"), folder)


def test_window_is_half_open_and_keeps_rows_without_watermark(spark):
    df = orders(spark, *STAMPS)
    first = df.where(landing.window_filter(ORDERS, *landing.day_window("2024-03-15")))
    second = df.where(landing.window_filter(ORDERS, *landing.day_window("2024-03-16")))
    assert rows(first.select("order_id")) == [("o0",), ("o1",), ("o3",)]
    assert rows(second.select("order_id")) == [("o2",), ("o3",)]
    dated = F.col("order_purchase_timestamp").isNotNull()
    assert window_overlap(first.where(dated), second.where(dated), "order_id").isEmpty()
    open_end = df.where(landing.window_filter(ORDERS, "2024-03-16 00:00:00", None))
    assert open_end.count() == 2
    assert sellers(spark, "a").where(landing.window_filter(SELLERS, *landing.day_window("2024-03-15"))).count() == 1


def test_landing_a_day_is_idempotent(spark, folder):
    df = orders(spark, *STAMPS)
    results = [landing.land_day(df, ORDERS, folder, "2024-03-15") for _ in range(3)]
    assert [r.rows for r in results] == [3, 3, 3]
    assert [r.replaced for r in results] == [False, True, True]
    landed = landing.read_landed(spark, folder, "orders", "2024-03-15")
    assert landed.count() == 3 and set(LINEAGE_COLUMNS) <= set(landed.columns)
    assert rows(landed.select("ingest_date").distinct()) == [(date(2024, 3, 15),)]
    assert results[0].path.endswith("raw/orders/ingest_date=2024-03-15")


def test_landing_an_empty_day_clears_it(spark, folder):
    landing.land_day(orders(spark, *STAMPS), ORDERS, folder, "2024-03-15")
    assert landing.land_day(orders(spark), ORDERS, folder, "2024-03-15").rows == 0
    assert landing.read_landed(spark, folder, "orders", "2024-03-15").isEmpty()


def test_history_fans_out_by_event_date(spark, folder):
    result = landing.land_history(orders(spark, *STAMPS), ORDERS, folder, "2025-01-01")
    assert (result.rows, len(result.days)) == (4, 3)
    landed = landing.read_landed(spark, folder, "orders")
    own = F.coalesce(F.to_date("order_purchase_timestamp"), F.lit("2025-01-01").cast("date"))
    assert landed.where(F.col("ingest_date") != own).isEmpty()
    again = landing.land_history(orders(spark, *STAMPS[:2]), ORDERS, folder, "2025-01-01")
    assert again.days == ("2024-03-15",) and again.replaced
    full = landing.land_history(sellers(spark, "a", "b"), SELLERS, folder, "2025-01-01")
    assert (full.rows, full.days) == (2, ("2025-01-01",))
    landing.land_history(sellers(spark, "a"), SELLERS, folder, "2025-01-02")
    assert files.partition_values(spark, landing.table_path(folder, "sellers"), "ingest_date") == ["2025-01-02"]


def test_a_hot_day_is_split_over_tasks(spark, folder):
    """A third of all rows share a day: more than one file, nothing lost."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "16k")
    try:
        big = spark.range(0, 120000, 1, 8).select(
            F.concat(F.lit("o"), "id").alias("order_id"), F.md5(F.col("id").cast("string")).alias("customer_id"),
            F.lit("created").alias("order_status"),
            F.timestamp_add("DAY", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 20),
                            F.lit("2024-01-01").cast("timestamp_ntz")).alias("order_purchase_timestamp"),
            *[F.lit(None).cast("timestamp_ntz").alias(c) for c in ORDERS.columns[4:]],
        )
        result = landing.land_history(big, ORDERS, folder, "2025-01-01")
        assert result.rows == 120000
        hot = files.storage_metrics(spark, landing.partition_path(folder, "orders", "2024-01-01")).first()
        assert hot["objects"] > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")


def test_backfill_equals_landing_day_by_day(spark, folder):
    df = orders(spark, *STAMPS)
    for d in ("2024-03-14", "2024-03-15", "2024-03-16"):
        landing.land_day(df, ORDERS, f"{folder}/daily", d)
        landing.land_day(sellers(spark, "a"), SELLERS, f"{folder}/daily", d)
    # A day that no longer has rows must end up empty.
    landing.land_day(orders(spark, datetime(2024, 3, 14)), ORDERS, f"{folder}/range", "2024-03-14")
    landing.backfill(df, ORDERS, f"{folder}/range", "2024-03-14", "2024-03-16")
    landing.backfill(sellers(spark, "a"), SELLERS, f"{folder}/range", "2024-03-14", "2024-03-16")
    for name in ("orders", "sellers"):
        drop = ("_ingested_at", "_run_id")
        daily = landing.read_landed(spark, f"{folder}/daily", name).drop(*drop)
        ranged = landing.read_landed(spark, f"{folder}/range", name).drop(*drop)
        assert same(daily, ranged)
    with pytest.raises(ValueError, match="ends"):
        landing.backfill(df, ORDERS, folder, "2024-03-16", "2024-03-14")


def test_daily_load_is_idempotent(spark, folder):
    land, store = f"{folder}/land", f"{folder}/raw"
    df = orders(spark, *STAMPS[:3])
    landing.land_history(df, ORDERS, land, "2025-01-01")
    first = raw.load_raw(spark, ORDERS, land, store, full=True)
    assert (first.replaced_all, first.rows) == (True, 3)
    for _ in range(3):
        landing.land_day(df, ORDERS, land, "2024-03-15")
        again = raw.load_raw(spark, ORDERS, land, store, "2024-03-15")
        assert (again.day, again.rows) == ("2024-03-15", 2)
        assert raw.read_raw(spark, store, "orders").count() == 3
    assert raw.read_raw(spark, store, "orders").groupBy("order_id").count().where("count > 1").isEmpty()


def test_full_tables_replace_and_new_columns_are_tolerated(spark, folder):
    land, store = f"{folder}/land", f"{folder}/raw"
    for day in ("2025-01-01", "2025-01-02"):
        landing.land_day(sellers(spark, "a", "b"), SELLERS, land, day)
        assert raw.load_raw(spark, SELLERS, land, store, day).rows == 2
    landing.land_history(orders(spark, *STAMPS), ORDERS, land, "2025-01-01")
    raw.load_raw(spark, ORDERS, land, store, full=True)
    wider = landing.with_lineage(orders(spark, datetime(2024, 3, 15)), ORDERS, "r", F.lit(date(2024, 3, 15)))
    landing._write_one(wider.withColumn("channel", F.lit("app")), landing.partition_path(land, "orders", "2024-03-15"))
    raw.load_raw(spark, ORDERS, land, store, "2024-03-15")
    loaded = raw.read_raw(spark, store, "orders")
    assert rows(loaded.groupBy("channel").count()) == [("app", 1), (None, 2)]
    assert raw.row_counts(spark, store, ["orders"]) == {"orders": 3}


def test_run_id_is_shared_and_tables_can_be_selected(spark, folder):
    sources = {"orders": orders(spark, *STAMPS), "sellers": sellers(spark, "a")}
    results = landing.land_all(lambda t: sources[t.name], folder, "2024-03-15", ["orders", "sellers"])
    assert [r.table for r in results] == ["orders", "sellers"]
    ids = {landing.read_landed(spark, folder, n).select("_run_id").first()[0] for n in sources}
    assert len(ids) == 1
    loaded = raw.load_all(spark, folder, f"{folder}/raw_tables", "2024-03-15", ["orders", "sellers"])
    assert all(r.replaced_all for r in loaded)


def test_key_drift(spark):
    got = key_sets_differ(sellers(spark, "a", "b"), sellers(spark, "b", "c"), "seller_id")
    assert rows(got) == [("a", "left"), ("c", "right")]
