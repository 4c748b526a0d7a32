from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from martworks.functions import columns as fn


def one(spark, expr, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(expr.alias("x")).first()["x"]


def ntz(text):
    return F.lit(text).cast("timestamp_ntz")


@pytest.mark.parametrize(
    "start,end,hours,days",
    [
        ("2024-01-01 10:59:00", "2024-01-01 11:01:00", 1, 0),
        ("2024-01-01 23:00:00", "2024-01-02 01:00:00", 2, 1),
        ("2024-01-01 11:01:00", "2024-01-01 11:59:59", 0, 0),
        ("2024-01-02 00:00:00", "2024-01-01 23:59:59", -1, -1),
        ("2024-02-28 12:00:00", "2024-03-01 12:00:00", 48, 2),
    ],
)
def test_differences_count_boundaries(spark, start, end, hours, days):
    assert one(spark, fn.hours_between(ntz(start), ntz(end))) == hours
    assert one(spark, fn.days_between(ntz(start), ntz(end))) == days


def test_hours_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        gap = fn.hours_between(ntz("2017-10-14 22:30:00"), ntz("2017-10-15 03:10:00"))
        assert one(spark, gap) == 5
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_text_helpers(spark):
    assert one(spark, fn.zip5("z"), z=" 123 ") == "00123"
    assert one(spark, fn.title_case("c"), c="  são  JOÃO d'el-rei ") == "São  João D'el-rei"
    assert one(spark, fn.text_or_null("t"), t="   ") is None
    assert one(spark, fn.text_or_null("t"), t=" a ") == "a"


def test_region_map_has_27_states(spark):
    states = [s for group in fn.REGION_STATES.values() for s in group]
    assert len(states) == len(set(states)) == 27
    assert one(spark, fn.macro_region("s"), s=" sp ") == "Sudeste"
    assert one(spark, fn.macro_region("s"), s="XX") == "Unknown"
    assert one(spark, fn.macro_region(F.lit(None).cast("string"))) == "Unknown"


def test_bounding_box_is_inclusive(spark):
    assert one(spark, fn.in_bounds("a", "b"), a=-33.75, b=-34.79)
    assert not one(spark, fn.in_bounds("a", "b"), a=5.28, b=-40.0)


def test_money_rounds_half_up_on_decimals(spark):
    assert [str(one(spark, fn.money("p"), p=p)) for p in (1.005, 2.675, 1.115)] == [
        "1.01",
        "2.68",
        "1.12",
    ]


def test_rate_needs_a_denominator(spark):
    assert one(spark, fn.rate("a", "b"), a=1, b=0) is None
    assert one(spark, fn.rate("a", "b"), a=1, b=3) == 0.3333


def test_weight_bands(spark):
    grams = [None, 0.0, 499.9, 500.0, 1999.0, 2000.0, 9999.9, 10000.0]
    df = spark.createDataFrame([(g,) for g in grams], "g double")
    got = [r[0] for r in df.select(fn.weight_class("g")).collect()]
    assert got == [
        "unknown", "light", "light", "medium", "medium", "heavy", "heavy", "oversized",
    ]


def test_sentiment(spark):
    df = spark.createDataFrame([(i,) for i in (1, 2, 3, 4, 5, None)], "s int")
    got = [r[0] for r in df.select(fn.review_sentiment("s")).collect()]
    assert got == ["detractor", "detractor", "passive", "promoter", "promoter", None]


def test_surrogate_key_tells_null_from_blank(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), (None, "a")], "x string, y string")
    keys = [r[0] for r in df.select(fn.surrogate_key("x", "y")).collect()]
    assert len(set(keys)) == 3 and all(len(k) == 32 for k in keys)
    assert rows(df.select(fn.surrogate_key("x", "y"))) == sorted((k,) for k in keys)
