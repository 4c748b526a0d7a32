from __future__ import annotations

import random
from datetime import datetime, timedelta

from conftest import rows, same
from pyspark.sql import functions as F

from martworks.operators import scd2

SCHEMA = "id string, city string, note string"
CHECK = ["city"]


def load(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def step(current, incoming, day, **options):
    return scd2.snapshot_check(current, incoming, "id", CHECK, f"2024-01-{day:02d} 00:00:00", **options)


def test_snapshot_life_of_a_key(spark):
    first = step(None, load(spark, ("a", "X", "n1"), ("b", "X", "n1"), ("c", None, "n1")), 1)
    second = step(first, load(spark, ("a", "Y", "n2"), ("c", None, "n2"), ("d", "Z", "n2")), 2)
    got = rows(second.select("id", "city", "note", F.to_date("valid_from").cast("string"),
                             F.to_date("valid_to").cast("string")))
    assert got == [
        ("a", "X", "n1", "2024-01-01", "2024-01-02"),
        ("a", "Y", "n2", "2024-01-02", None),
        ("b", "X", "n1", "2024-01-01", "2024-01-02"),
        ("c", None, "n1", "2024-01-01", None),
        ("d", "Z", "n2", "2024-01-02", None),
    ]
    third = step(second, load(spark, ("a", "Y", "n3"), ("b", "X", "n3"), ("c", None, ""), ("d", "Z", "")), 3)
    reopened = third.where("id = 'b'")
    assert reopened.count() == 2 and reopened.where("valid_to is null").count() == 1
    assert scd2.history_violations(scd2.history(third, "id"), "id").isEmpty()
    numbered = scd2.history(third, "id").where("id = 'a'").select("version_number", "is_current")
    assert rows(numbered) == [(1, False), (2, True)]


def test_snapshot_is_idempotent_and_can_keep_missing(spark):
    data = load(spark, ("a", "X", ""), ("b", "Y", ""))
    first = step(None, data, 1)
    assert same(step(first, data, 2), first)
    kept = step(first, load(spark, ("a", "X", "")), 2, close_missing=False)
    assert kept.where("valid_to is null").count() == 2


def test_backdated_first_version_catches_old_facts(spark):
    data = load(spark, ("a", "X", ""))
    facts = spark.createDataFrame([("a", datetime(2020, 1, 1))], "id string, at timestamp_ntz")
    plain, back = step(None, data, 5), step(None, data, 5, backdate_first="1900-01-01 00:00:00")
    assert scd2.point_in_time_join(facts, plain, "id", "at").isEmpty()
    assert scd2.point_in_time_join(facts, back, "id", "at").count() == 1


def test_point_in_time_interval_is_half_open(spark):
    hist = step(step(None, load(spark, ("a", "X", "")), 1), load(spark, ("a", "Y", "")), 10)
    at = [datetime(2023, 12, 31), datetime(2024, 1, 1), datetime(2024, 1, 9, 23), datetime(2024, 1, 10)]
    facts = spark.createDataFrame([("a", t) for t in at], "id string, at timestamp_ntz")
    joined = scd2.point_in_time_join(facts, hist, "id", "at", "left").orderBy("at")
    assert [r.city for r in joined.collect()] == [None, "X", "X", "Y"]


def brute(versions):
    found = set()
    end = lambda v: v[3] or datetime(9999, 12, 31)
    for k in {v[0] for v in versions}:
        own = [v for v in versions if v[0] == k]
        if sum(v[3] is None for v in own) > 1:
            found.add((k, "expected exactly one open version"))
        if any(v[3] is not None and v[3] <= v[2] for v in own):
            found.add((k, "valid_to precedes valid_from"))
        for a in own:
            for b in own:
                if a[1] != b[1] and a[2] < end(b) and end(a) > b[2]:
                    found.add((k, "versions overlap in time"))
    return sorted(found)


def test_violations_match_pairwise_comparison(spark):
    rng = random.Random(3)
    day = lambda n: datetime(2024, 1, 1) + timedelta(days=n)
    versions = []
    for k in range(300):
        at = 0
        for v in range(rng.randrange(1, 5)):
            start = at + rng.choice([0, 0, 1, 3])
            length = rng.choice([-2, 0, 2, 3, 4, 6])
            at = start + max(length, 0) - rng.choice([0, 0, 0, 1])
            to = None if rng.random() < 0.15 else day(start + length)
            versions += [(f"k{k}", f"v{v}", day(start), to)] * rng.choice([1, 1, 1, 3])
    df = spark.createDataFrame(
        versions, "id string, version_key string, valid_from timestamp_ntz, valid_to timestamp_ntz"
    ).withColumn("is_current", F.col("valid_to").isNull())
    got = scd2.history_violations(df, "id")
    assert rows(got) == brute(versions)
    assert {v for _, v in brute(versions)} == {
        "expected exactly one open version",
        "valid_to precedes valid_from",
        "versions overlap in time",
    }


def test_summary_and_changed_keys(spark):
    hist = scd2.history(
        step(step(None, load(spark, *[(k, "X", "") for k in "abcde"]), 1),
             load(spark, *[(k, "Y", "") for k in "bcde"]), 2), "id")
    row = scd2.history_summary(hist, "id").first()
    assert tuple(row) == (9, 5, 4, 4)
    assert {r.id for r in scd2.changed_versions(hist, "id").collect()} == {"b", "c", "d"}
