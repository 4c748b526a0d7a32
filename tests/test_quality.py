from __future__ import annotations

import random
from collections import Counter
from datetime import date, datetime
from math import floor

import pytest
from conftest import rows
from pyspark.sql import functions as F

from martworks.quality import checks, declared, expectations, invariants, suites
from martworks.quality.quantiles import exact_quantiles


def test_there_are_148_declared_checks():
    kinds = Counter(c.kind for c in declared.ALL_CHECKS)
    assert len(set(declared.ALL_CHECKS)) == len(declared.ALL_CHECKS) == 148
    assert kinds == {
        "not_null": 81, "unique": 24, "accepted_values": 12, "relationship": 12,
        "unique_combination": 5, "between": 13, "value_length": 1,
    }


@pytest.fixture
def tables(spark):
    child = spark.createDataFrame(
        [("1", "a", 5, "SP"), ("1", "b", -1, "RJ"), ("2", None, None, "X"), (None, "zz", 9, None), (None, "zz", 2, None)],
        "id string, fk string, n int, st string",
    )
    return {"child": child, "parent": spark.createDataFrame([("a",), ("b",)], "pk string")}


def test_every_kind_of_check_counts_its_failures(spark, tables):
    wanted = (
        checks.not_null("child", "id", "n")
        + checks.unique("child", "id")
        + checks.unique_combination("child", "id", "fk")
        + checks.accepted("child", "st", "SP", "RJ")
        + checks.relationship("child", "fk", "parent", "pk")
        + checks.between("child", "n", 0, 5)
        + checks.value_length("child", "st", 2)
    )
    got = {(r["check"], r["column"]): r.failures for r in checks.run_checks(tables, wanted).collect()}
    assert got == {
        ("not_null", "id"): 2, ("not_null", "n"): 1, ("unique", "id"): 1,
        ("unique_combination", "id,fk"): 1, ("accepted_values", "st"): 1,
        ("relationship", "fk"): 2, ("between", "n"): 2, ("value_length", "st"): 1,
    }


def test_failing_rows_are_stored(spark, tables, folder):
    (check,) = checks.accepted("child", "st", "SP", "RJ")
    path = checks.store_violations(check, tables, folder)
    assert spark.read.parquet(path).count() == 1


def test_severity_levels(spark):
    assert [checks.severity(n, 0, 1500) for n in (0, 1, 1500, 1501)] == ["pass", "warn", "warn", "error"]
    assert [checks.severity(n) for n in (0, 1)] == ["pass", "error"]
    df = spark.createDataFrame([(n,) for n in (0, 5, 2000)], "failures long")
    assert [r.status for r in checks.with_severity(df, 0, 1500).orderBy("failures").collect()] == ["pass", "warn", "error"]


def test_freshness_limits(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1),), (datetime(2024, 1, 2),)], "_ingested_at timestamp_ntz")
    for as_of, status in (("2024-01-03 00:00:00", "pass"), ("2024-01-03 00:00:01", "warn"),
                          ("2024-01-04 00:00:00", "warn"), ("2024-01-04 00:00:01", "error")):
        assert checks.freshness(df, "t", as_of).first().status == status
    assert checks.freshness(df.where("false"), "t", "2024-01-03 00:00:00").first().status == "error"


def test_quantiles_are_exact_under_skew(spark):
    rng = random.Random(5)
    values = [round(rng.lognormvariate(3, 2), 2) for _ in range(4000)] + [17.25] * 2000 + [0.0] * 3
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").repartition(8)
    wanted = (0.0, 0.01, 0.3, 0.5, 0.95, 0.99, 1.0)
    ordered, n = sorted(values), len(values)
    want = {p: ordered[max(1, n - floor(n - p * n)) - 1] for p in wanted}
    assert exact_quantiles(df, "v", wanted) == want
    assert exact_quantiles(df, "v", wanted, buckets=3) == want
    assert exact_quantiles(df.where("v is null"), "v", (0.5,)) == {0.5: None}


def test_expectations(spark):
    df = spark.createDataFrame(
        [(1, 1.0, "SP", 2.0), (2, 3.0, "RJ", 2.0), (2, None, "X", None), (None, 100.0, None, None)],
        "k int, v double, st string, w double",
    )
    found = expectations.run_suite(df, [
        expectations.row_count_between(1, 4),
        expectations.values_unique("k"),
        expectations.values_not_null("v", mostly=0.75),
        expectations.values_between("v", 0, 10),
        expectations.values_between("v", 0, 10, mostly=0.6),
        expectations.values_in_set("st", ["SP", "RJ"]),
        expectations.lengths_equal("st", 2),
        expectations.mean_between("v", 30, 35),
        *expectations.quantiles_between("v", {0.5: (3, 3)}),
        expectations.at_least_other("v", "w"),
    ]).collect()
    by = [(r.expectation, r.element_count, r.unexpected_count, r.success) for r in found]
    assert sorted(by, key=repr) == sorted([
        ("row_count_between", 4, None, True),
        ("values_unique", 3, 2, False),
        ("values_not_null", 4, 1, True),
        ("values_between", 3, 1, False),
        ("values_between", 3, 1, True),
        ("values_in_set", 3, 1, False),
        ("lengths_equal", 3, 1, False),
        ("mean_between", 3, None, True),
        ("quantile_between[0.5]", None, None, True),
        ("at_least_other", 3, 2, False),
    ], key=repr)


def test_empty_columns_pass_and_filters_apply(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "k int, v double")
    found = expectations.run_suite(df, [expectations.values_between("v", 0, 1), expectations.row_count_between(1, 1)],
                                   where=F.col("k") == 1)
    assert [r.success for r in found.collect()] == [True, True]


def test_suites_follow_the_scale(spark, folder):
    built = suites.build_suites(1000)
    assert [len(s.expectations) for s in built] == [13, 9, 6]  # quantile lists count one by one
    assert (built[0].expectations[0].low, built[1].expectations[0].high) == (600, 2800)
    df = spark.createDataFrame([(1,)], "k int")
    suite = expectations.Suite("s", "t", [expectations.values_not_null("k")])
    found = expectations.run_suites({"t": df}, [suite], ["s"])
    assert tuple(expectations.summarise(found).first()) == ("s", 1, 1, 0, True)
    with pytest.raises(ValueError, match="no suite"):
        expectations.run_suites({"t": df}, [suite], ["other"])
    expectations.write_report(spark, found, folder, "20240101T000000Z")
    assert spark.read.json(f"{folder}/latest").first().suite == "s"


def facts(spark, *orders):
    return spark.createDataFrame(
        list(orders),
        "order_key string, purchased_at timestamp_ntz, delivered_at timestamp_ntz, is_delivered boolean, is_late boolean",
    )


def test_impossible_dates_label_every_rule(spark):
    t = lambda y: datetime(y, 1, 1)
    df = facts(spark, ("ok", t(2020), t(2021), True, False), ("future", t(2031), None, False, None),
               ("back", t(2020), t(2019), True, True), ("both", t(2031), t(2030), True, True), ("old", t(2010), None, False, None))
    got = rows(invariants.impossible_dates(df, "2030-06-01 00:00:00").select("order_key", "violation"))
    assert [k for k, _ in got] == ["back", "both", "both", "future", "old"]


def test_sla_edges(spark):
    t = datetime(2020, 1, 1)
    row = lambda late: ("o", t, t, True, late)
    assert invariants.implausible_sla(facts(spark, row(True), row(False), row(False))).isEmpty()
    for data in ([row(False)], [row(True)], [("o", t, None, False, None)]):
        assert invariants.implausible_sla(facts(spark, *data)).count() == 1


def test_totals_are_compared_with_tolerance(spark):
    fact = spark.createDataFrame([(1, 10.00, 12.00)] * 3, "line_number int, item_price double, item_total double")
    fact = fact.select(*[F.col(c).cast("decimal(18,2)") for c in fact.columns])
    for gap, broken in ((0.01, 0), (0.02, 1)):
        agg = spark.createDataFrame([(date(2024, 1, 1), 3, 30.00 + gap, 36.00)],
                                    "d date, item_count long, gross_item_revenue double, total_revenue double")
        agg = agg.select("item_count", *[F.col(c).cast("decimal(18,2)") for c in agg.columns[2:]])
        assert invariants.agg_reconciles_to_fact(fact, agg).count() == broken


def test_quantiles_with_nan_and_infinities(spark):
    nan, inf = float("nan"), float("inf")
    values = [*map(float, range(100)), nan]
    one = lambda vs, *ps: exact_quantiles(spark.createDataFrame([(v,) for v in vs], "v double"), "v", ps)
    assert one(values, 0.5, 0.0, 0.99) == {0.5: 50.0, 0.0: 0.0, 0.99: 99.0}
    assert str(one(values, 1.0)[1.0]) == "nan"
    assert one([-inf, 1.0, 2.0, inf], 0.25, 0.5, 0.75, 1.0) == {0.25: -inf, 0.5: 1.0, 0.75: 2.0, 1.0: inf}
    assert one([-1.7e308, 0.0, 1.7e308], 0.3, 0.5, 1.0) == {0.3: -1.7e308, 0.5: 0.0, 1.0: 1.7e308}
    assert str(one([nan, None], 0.5)[0.5]) == "nan"


def test_quantiles_keep_every_digit(spark):
    big = 2**53
    whole = spark.range(5).select((F.col("id") + big).alias("v"))
    assert exact_quantiles(whole, "v", (0.2, 0.4, 0.6)) == {0.2: big, 0.4: big + 1, 0.6: big + 2}
    wide = spark.createDataFrame([(-(2**63),), (0,), (2**63 - 1,)], "v long")
    assert exact_quantiles(wide, "v", (0.3, 0.6, 1.0)) == {0.3: -(2**63), 0.6: 0, 1.0: 2**63 - 1}
    cents = whole.select((F.col("v").cast("decimal(20,0)") + F.col("v") % 100 / 100).cast("decimal(28,2)").alias("v"))
    assert exact_quantiles(cents, "v", (1.0,))[1.0] == cents.agg(F.max("v")).first()[0]


def test_outcome_of_suites(spark):
    results = spark.createDataFrame(
        [("a", "mean", "x", True), ("b", "range", None, False)], "suite string, expectation string, column string, success boolean"
    )
    found = expectations.outcome(results)
    assert (found.evaluated, found.failed, found.passed) == (2, ("b: range()",), False)
    with pytest.raises(expectations.SuiteFailure, match="b: range"):
        expectations.outcome(results, raise_on_failure=True)
    assert expectations.outcome(results.where("success"), raise_on_failure=True).passed


def test_a_key_that_several_checks_ask_for_is_told_once(spark):
    wanted = [
        *checks.unique("parent", "pk"),
        *checks.relationship("child", "fk", "parent", "pk"),
        *checks.relationship("other", "fk", "parent", "pk"),
        *checks.relationship("parent", "boss", "parent", "pk"),
    ]
    assert {m: len(e) for m, e in checks._entries(wanted).items()} == {"parent": 2, "child": 1, "other": 1}
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    tables = {
        "parent": frame([("ab", "zz"), ("ab", None), ("1", "ab"), (None, "AB")], "pk string, boss string"),
        "child": frame([("ab",), ("x",), ("x",), (None,)], "fk string"),
        "other": frame([(1,), (2,)], "fk int"),
    }
    got = {(r.model, r["check"]): r.failures for r in checks.run_checks(tables, wanted).collect()}
    assert got == {
        ("parent", "unique"): 1, ("child", "relationship"): 2, ("other", "relationship"): 1, ("parent", "relationship"): 2,
    }


def test_packed_keys_are_as_different_as_their_texts(spark):
    texts = ["", "a", "ab", "AB", "abc", "ab\n", "00", "0", "000", "0000", "\x01\xab", "\x00ab", "é", "f" * 32, "f" * 20_000]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", checks.packed(F.col("t")).alias("k"))
    found = {r.t: bytes(r.k) for r in df.collect()}
    assert len(set(found.values())) == len(texts) and len(found["f" * 32]) == 17


def test_a_suite_names_the_columns_it_reads():
    orders, lines, daily = suites.build_suites(1000)
    assert lines.columns() == ("order_item_key", "item_price", "freight_ratio", "item_total", "category_name")
    assert daily.columns() == ("purchased_date", "late_delivery_rate", "total_revenue", "customer_state", "avg_review_score")
    assert "primary_category" not in orders.columns() and "payment_variance" in orders.columns()
