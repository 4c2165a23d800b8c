"""United sketches against exact counts and ranks."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators.sketches import (
    distinct_estimate,
    distinct_sketches,
    quantile_columns,
    quantile_sketches,
    returning,
    rolling_sketches,
    set_sketches,
    unite_quantiles,
    unite_sketches,
)

DAY = date(2024, 1, 1)


@pytest.fixture(scope="module")
def visits(spark):
    """Some 20,000 users, most of them on several days; one source has most rows."""
    users = spark.range(60_000).select(
        F.when(F.col("id") % 10 < 8, F.lit("hot")).otherwise(F.lit("cold")).alias("source"),
        F.expr("date_add(date'2024-01-01', cast(pmod(xxhash64(id), 14) as int))").alias("day"),
        F.expr("pmod(xxhash64(id, 1), 20000)").alias("user"),
        (F.rand(5) * 100).alias("value"),
    )
    return users.repartition(8)


def test_days_are_united_without_the_rows(spark, visits):
    daily = distinct_sketches(visits, ["source", "day"], "user")
    got = {r[0]: r[1] for r in unite_sketches(daily, ["source"]).select("source", distinct_estimate()).collect()}
    exact = {r[0]: r[1] for r in visits.groupBy("source").agg(F.count_distinct("user")).collect()}
    assert got == {k: pytest.approx(n, rel=0.03) for k, n in exact.items()}
    whole = distinct_sketches(visits, [], "user").select(distinct_estimate()).first()[0]
    united = unite_sketches(daily, []).select(distinct_estimate()).first()[0]
    assert united == pytest.approx(whole, rel=0.01)


def test_rolling_week(spark, visits):
    daily = distinct_sketches(visits, ["source", "day"], "user")
    # A day is missing: it has no result, and its followers do not count it.
    daily = daily.filter((F.col("day") != F.lit(DAY + timedelta(3))))
    got = {(r[0], r[1]): r[2] for r in rolling_sketches(daily, ["source"], "day", 7).select("source", "day", distinct_estimate()).collect()}
    seen = {}
    for r in visits.select("source", "day", "user").distinct().collect():
        seen.setdefault((r.source, r.day), set()).add(r.user)
    seen = {k: v for k, v in seen.items() if k[1] != DAY + timedelta(3)}
    for (source, day), n in got.items():
        week = set().union(*[seen.get((source, day - timedelta(i)), set()) for i in range(7)])
        assert n == pytest.approx(len(week), rel=0.03)
    assert set(got) == set(seen)


def test_one_row_for_each_group_is_exchanged_by_a_task(spark, visits, capsys):
    distinct_sketches(visits, ["source"], "user").explain()
    plan = capsys.readouterr().out
    assert plan.index("partial_hll_sketch_agg") > plan.index("Exchange hashpartitioning(source")


def test_nulls_and_empty_groups(spark):
    rows = spark.createDataFrame([("a", None), ("a", None), ("b", "x"), ("b", "x")], "k string, v string")
    got = {r[0]: r[1] for r in distinct_sketches(rows, ["k"], "v").select("k", distinct_estimate()).collect()}
    assert got == {"a": 0, "b": 1}
    assert distinct_sketches(rows.limit(0), ["k"], "v").collect() == []


def test_quantiles_of_united_days(spark, visits):
    shares = {"low": 0.01, "median": 0.5, "high": 0.99}
    daily = quantile_sketches(visits, ["source", "day"], "value")
    found = unite_quantiles(daily, ["source"]).select("source", *quantile_columns(shares)).collect()
    for r in found:
        values = sorted(x.value for x in visits.filter(F.col("source") == r.source).select("value").collect())
        for name, share in shares.items():
            rank = sum(v <= r[name] for v in values) / len(values)
            assert rank == pytest.approx(share, abs=0.02)


def test_sketches_do_not_depend_on_the_order_of_rows(spark):
    rng = random.Random(1)
    rows = [(i % 3, rng.randrange(500)) for i in range(5_000)]
    frames = [spark.createDataFrame(r, "k int, v int").repartition(n) for r, n in ((rows, 1), (rows[::-1], 7))]
    a, b = ({r[0]: r[1] for r in distinct_sketches(f, ["k"], "v").select("k", distinct_estimate()).collect()} for f in frames)
    assert a == pytest.approx(b, rel=0.001)


def test_returning_and_lost_values(spark, visits):
    weekly = visits.withColumn("week", F.floor(F.datediff("day", F.lit(DAY)) / 7))
    got = {(r.source, r.week): r for r in returning(set_sketches(weekly, ["source", "week"], "user"), ["source"], "week", 1).collect()}
    users = {}
    for r in weekly.select("source", "week", "user").distinct().collect():
        users.setdefault((r.source, r.week), set()).add(r.user)
    assert got.keys() == users.keys()
    for (source, week), r in got.items():
        now, before = users[source, week], users.get((source, week - 1), set())
        slack = 0.05 * max(len(now), len(before))
        assert abs(r.seen - len(now)) <= slack
        assert abs(r.returned - len(now & before)) <= slack and abs(r.left - len(before - now)) <= slack
