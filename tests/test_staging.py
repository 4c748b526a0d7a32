from __future__ import annotations

from datetime import date, datetime

from conftest import rows
from pyspark.sql import functions as F

from martworks.catalog.lake import Lake
from martworks.operators.keyed import latest_by_key, top_n_per_group
from martworks.plans import rollups, staging

LOAD = "ingest_date date, _ingested_at timestamp_ntz"
D = date(2024, 1, 1)
T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def test_latest_copy_wins_and_ties_are_settled(spark):
    data = [("a", T1, 1), ("a", T2, 2), ("a", T2, 3), ("b", T1, 9), (None, T1, 4), (None, T2, 5)]
    df = spark.createDataFrame(data, "k string, _ingested_at timestamp_ntz, v int")
    for attempt in (df, df.orderBy("v"), df.orderBy(F.desc("v"))):
        got = rows(latest_by_key(attempt, ["k"]).select("k", "v"))
        assert got == [("a", 3), ("b", 9), (None, 5)]


def test_group_limit_runs_before_the_exchange(spark):
    """A group that holds most of the rows is cut down on the map side."""
    hot = spark.range(0, 30000, 1, 6).select(
        F.when(F.col("id") % 3 < 2, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("v"),
    )
    top = top_n_per_group(hot, ["k"], [F.desc("v")], 2)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert rows(top.where("k = 'hot'").select("v")) == [(29998,), (29997,)][::-1]


def test_items_drop_negative_amounts_before_choosing_the_latest(spark):
    cols = (
        "order_id string, order_item_id bigint, product_id string, seller_id string, "
        f"shipping_limit_date timestamp_ntz, price double, freight_value double, {LOAD}"
    )
    raw = spark.createDataFrame(
        [
            ("o", 1, "p", "s", T1, 10.005, 1.0, D, T1),
            ("o", 1, "p", "s", T1, -1.0, 1.0, D, T2),
            ("o", 2, "p", "s", T1, 0.0, 0.0, D, T1),
            ("o", 3, "p", "s", T1, None, 1.0, D, T1),
        ],
        cols,
    )
    got = staging.order_items(raw).select("line_number", "item_price", "item_total")
    assert [(r[0], float(r[1]), float(r[2])) for r in got.orderBy("line_number").collect()] == [
        (1, 10.01, 11.01),
        (2, 0.0, 0.0),
    ]


def test_payment_instalments_count_at_least_once(spark):
    raw = spark.createDataFrame(
        [("o", i, " Boleto ", n, 5.0, D, T1) for i, n in enumerate((None, 0, 1, 3))],
        "order_id string, payment_sequential bigint, payment_type string, "
        f"payment_installments bigint, payment_value double, {LOAD}",
    )
    got = rows(staging.order_payments(raw).select("payment_installments", "payment_type"))
    assert got == [(1, "boleto")] * 3 + [(3, "boleto")]


def test_orders_without_purchase_time_or_too_old_are_dropped(spark):
    raw = spark.createDataFrame(
        [
            ("a", "c", " Shipped ", datetime(2015, 1, 1)),
            ("b", "c", "created", datetime(2014, 12, 31, 23, 59, 59)),
            ("c", "c", "created", None),
        ],
        "order_id string, customer_id string, order_status string, "
        "order_purchase_timestamp timestamp_ntz",
    )
    for c in ("approved_at", "delivered_carrier_date", "delivered_customer_date",
              "estimated_delivery_date"):
        raw = raw.withColumn(f"order_{c}", F.lit(None).cast("timestamp_ntz"))
    raw = raw.withColumn("ingest_date", F.lit(D)).withColumn("_ingested_at", F.lit(T1))
    assert rows(staging.orders(raw).select("order_id", "order_status")) == [("a", "shipped")]


def test_products_without_category_or_translation_are_unknown(spark):
    cols = (
        "product_id string, product_category_name string, product_name_lenght bigint, "
        "product_description_lenght bigint, product_photos_qty bigint, product_weight_g double, "
        f"product_length_cm double, product_height_cm double, product_width_cm double, {LOAD}"
    )
    raw = spark.createDataFrame(
        [(p, c, 1, 1, 1, 1.0, 2.0, 3.0, 0.335, D, T1) for p, c in
         (("1", " livros "), ("2", "  "), ("3", None), ("4", "novo"))],
        cols,
    )
    names = spark.createDataFrame(
        [("livros ", "books", D, T1), (" ", "blank", D, T1), ("livros", "old", D, datetime(2023, 1, 1))],
        f"product_category_name string, product_category_name_english string, {LOAD}",
    )
    got = staging.products(raw, staging.category_translation(names))
    assert rows(got.select("product_id", "category_name_pt", "category_name")) == [
        ("1", "livros", "books"),
        ("2", "unknown", "unknown"),
        ("3", "unknown", "unknown"),
        ("4", "novo", "unknown"),
    ]
    assert {str(r[0]) for r in got.select("product_volume_cm3").collect()} == {"2.01"}


def timeline(spark, status, approved=None, shipped=None, delivered=None, promised=None):
    row = ("o", "c", status, T1, approved, shipped, delivered, promised)
    df = spark.createDataFrame(
        [row],
        "order_id string, customer_id string, order_status string, purchased_at timestamp_ntz, "
        "approved_at timestamp_ntz, shipped_at timestamp_ntz, delivered_at timestamp_ntz, "
        "estimated_delivery_at timestamp_ntz",
    )
    df = df.withColumn("purchased_date", F.to_date("purchased_at"))
    df = df.withColumn("estimated_delivery_date", F.to_date("estimated_delivery_at"))
    return rollups.delivery_timeline(df.withColumn("delivered_date", F.to_date("delivered_at"))).first()


def test_delivery_states(spark):
    on, late = datetime(2024, 1, 10, 23, 59), datetime(2024, 1, 11, 0, 1)
    promised = datetime(2024, 1, 10)
    cases = [
        (("created",), "pending", None),
        (("approved", T1), "approved", None),
        (("shipped", T1, T2), "in_transit", None),
        (("delivered", T1, T2, on, promised), "delivered_on_time", False),
        (("delivered", T1, T2, late, promised), "delivered_late", True),
        (("delivered", T1, T2, late, None), "delivered_on_time", None),
        (("canceled", T1, T2, late, promised), "canceled", True),
        (("not_defined",), "pending", None),
    ]
    for args, status, is_late in cases:
        row = timeline(spark, *args)
        assert (row.delivery_status, row.is_late) == (status, is_late), args
    assert timeline(spark, "delivered", T1, T2).is_missing_delivery_timestamp


def test_payment_summary_flags_and_primary(spark):
    df = spark.createDataFrame(
        [("a", 1, "voucher", 1, 10.0), ("a", 2, "boleto", 2, 10.0), ("b", 1, None, 1, 1.0)],
        "order_id string, payment_sequential bigint, payment_type string, "
        "payment_installments bigint, payment_value double",
    ).withColumn("payment_value", F.col("payment_value").cast("decimal(18,2)"))
    got = {r.order_id: r for r in rollups.payment_summary(df).collect()}
    assert got["a"].primary_payment_type == "voucher" and got["a"].used_voucher
    assert got["a"].payment_type_count == 2 and not got["a"].used_credit_card
    assert got["b"].used_voucher is False and got["b"].payment_type_count == 0


def test_item_summary_matches_brute_force_with_a_hot_order(spark):
    import random

    rng = random.Random(7)
    lines = []
    for i in range(3000):
        order = "hot" if i % 3 == 0 else f"o{rng.randrange(200)}"
        lines.append((order, f"p{rng.randrange(30)}", f"s{rng.randrange(9)}", rng.randrange(1, 900)))
    category = {f"p{i}": (None if i == 4 else f"c{i % 5}") for i in range(28)}
    items = spark.createDataFrame(lines, "order_id string, product_id string, seller_id string, c int")
    amount = (F.col("c") / 100).cast("decimal(18,2)")
    items = items.select("order_id", "product_id", "seller_id", amount.alias("item_price"),
                         amount.alias("freight_value"), amount.alias("item_total"))
    products = spark.createDataFrame(list(category.items()), "product_id string, category_name string")
    got = {r.order_id: r for r in rollups.item_summary(items, products).collect()}
    assert set(got) == {x[0] for x in lines}
    for order, row in got.items():
        own = [x for x in lines if x[0] == order]
        assert row.item_count == len(own)
        assert row.distinct_product_count == len({x[1] for x in own})
        assert row.distinct_seller_count == len({x[2] for x in own})
        assert int(row.gross_item_revenue * 100) == sum(x[3] for x in own)
        by = {}
        for x in own:
            c = category.get(x[1])
            by[c] = by.get(c, 0) + x[3]
        best = min(by, key=lambda c: (-by[c], c is None, c or ""))
        assert row.primary_category == best


def test_first_review_and_response_hours(spark):
    df = spark.createDataFrame(
        [
            ("r2", "o", 5, True, "promoter", T2, datetime(2024, 1, 2, 5, 1)),
            ("r1", "o", 2, False, "detractor", T2, datetime(2024, 1, 2, 3, 1)),
            ("r0", "o", 3, False, "passive", None, None),
        ],
        "review_id string, order_id string, review_score bigint, has_comment boolean, "
        "review_sentiment string, review_created_at timestamp_ntz, review_answered_at timestamp_ntz",
    )
    row = rollups.review_summary(df).first()
    assert (row.review_count, row.first_review_score, row.review_response_hours) == (3, 2, 3)
    assert row.has_any_comment and row.min_review_score == 2


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


def test_lines_are_dealt_by_order_once(spark, sf_dir):
    """Staging deals orders, lines and payments by order; their rollups need no exchange by
    order of their own, and map tasks do not sort lines."""
    lake = Lake(spark, sf_dir)
    for model in (lake.item_summary, lake.payment_summary, lake.stg_orders):
        lines = _plan(model)
        assert not [x for x in lines if "Exchange hashpartitioning(order_id" in x and "ENSURE_REQUIREMENTS" in x]
    assert "\n".join(_plan(lake.stg_order_items)).count("WindowGroupLimit") == 1


def test_key_of_lines_is_not_carried_through_joins(spark, sf_dir):
    plan = _plan(Lake(spark, sf_dir).items_enriched)
    hashed = [i for i, x in enumerate(plan) if "md5(" in x]
    joined = [i for i, x in enumerate(plan) if "Join" in x]
    assert hashed and joined and max(hashed) < min(joined)
