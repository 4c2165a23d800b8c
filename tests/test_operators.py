"""Merge, flatten, windows, aggregates, snapshots and dedup on literal frames."""

import random
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import Row, Window
from pyspark.sql import functions as F

from tidemark.functions.text import folded
from tidemark.operators.aggregates import (
    box_stats,
    box_stats_approx,
    first_rows,
    histogram,
    keep_first_copy,
    linear_fit,
    mode_per_group,
    null_counts,
)
from tidemark.operators.flatten import flatten
from tidemark.operators.joins import carry_previous, common_members
from tidemark.operators.merge import merge_upsert
from tidemark.operators.snapshots import (
    all_versions,
    history,
    read_as_of,
    read_version,
    write_version,
)
from tidemark.operators.windows import forward_fill, running_max

RELAXED = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
KV = "k string, j int, a string, b int"


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_merge_matched_unmatched_and_null_overwrite(spark):
    target = spark.createDataFrame([("x", 1, "old", 1), ("y", 1, "kept", 2), (None, 1, "n", 3)], KV)
    source = spark.createDataFrame([("x", 1, None, 9), ("z", 1, "new", 8), (None, 1, "m", 7)], KV)
    assert rows_of(merge_upsert(target, source, ["k", "j"])) == sorted(
        [("x", 1, None, 9), ("y", 1, "kept", 2), (None, 1, "n", 3), ("z", 1, "new", 8), (None, 1, "m", 7)],
        key=repr,
    )


def test_merge_partial_columns(spark):
    target = spark.createDataFrame([("x", 1, "old", 1)], KV)
    source = spark.createDataFrame([("x", 1, "new", 9), ("z", 1, "all", 8)], KV)
    assert rows_of(merge_upsert(target, source, ["k", "j"], ["a"])) == [("x", 1, "new", 1), ("z", 1, "all", 8)]


def test_merge_updates_every_target_row_of_a_key(spark):
    target = spark.createDataFrame([("hot", 1, "a", i) for i in range(50)], KV)
    source = spark.createDataFrame([("hot", 1, "b", -1)], KV)
    merged = merge_upsert(target, source, ["k", "j"])
    assert merged.count() == 50 and merged.filter("a = 'b' AND b = -1").count() == 50


def test_merge_rejects_bad_input(spark):
    target = spark.createDataFrame([("x", 1, "old", 1)], KV)
    twice = spark.createDataFrame([("q", 1, "a", 1), ("q", 1, "b", 2)], KV)
    with pytest.raises(PySparkException, match="repeats a key"):
        merge_upsert(target, twice, ["k", "j"]).collect()
    with pytest.raises(ValueError):
        merge_upsert(target, twice.drop("a"), ["k", "j"])
    with pytest.raises(ValueError):
        merge_upsert(target, twice, ["k", "j"], ["k"])


@RELAXED
@given(
    old=st.dictionaries(st.integers(0, 8), st.one_of(st.none(), st.integers(0, 3)), max_size=8),
    new=st.dictionaries(st.integers(0, 8), st.one_of(st.none(), st.integers(0, 3)), max_size=8),
)
def test_merge_equals_dict_update(spark, old, new):
    schema = "k int, v int"
    merged = merge_upsert(
        spark.createDataFrame(list(old.items()), schema), spark.createDataFrame(list(new.items()), schema), ["k"]
    )
    assert {r.k: r.v for r in merged.collect()} == {**old, **new}
    assert merged.count() == len({**old, **new})


def test_flatten_edges(spark):
    schema = """id int, a struct<b: int, c: struct<d: string>>, tags array<string>,
                items array<struct<n: int, `odd.name`: string>>, a_b string"""
    rows = [
        (1, Row(b=5, c=Row(d="x")), ["p", "q"], [(1, "one"), (2, "two")], "clash"),
        (2, None, [], None, None),
    ]
    flat = flatten(spark.createDataFrame(rows, schema))
    assert flat.columns == ["id", "a_b_2", "a_c_d", "tags", "items_n", "items_odd.name", "a_b"]
    got = rows_of(flat)
    assert len(got) == 5  # two sibling arrays multiply; the empty ones keep their row
    assert (2, None, None, None, None, None, None) in got
    assert (1, 5, "x", "q", 2, "two", "clash") in got


def test_flatten_array_of_arrays_and_flat_input(spark):
    nested = spark.createDataFrame([(1, [[1, 2], [3]])], "id int, xs array<array<int>>")
    assert rows_of(flatten(nested)) == [(1, 1), (1, 2), (1, 3)]
    plain = spark.createDataFrame([(1, "a")], "id int, t string")
    assert flatten(plain).collect() == plain.collect()


@RELAXED
@given(st.lists(st.lists(st.lists(st.integers(0, 9), max_size=3), max_size=3), min_size=1, max_size=4))
def test_flatten_row_counts(spark, documents):
    frame = spark.createDataFrame(
        [(i, [Row(ys=ys) for ys in xs]) for i, xs in enumerate(documents)], "i int, xs array<struct<ys: array<int>>>"
    )
    expected = sum(max(1, sum(max(1, len(ys)) for ys in xs)) for xs in documents)
    assert flatten(frame).count() == expected


@pytest.mark.parametrize("max_gap", [None, 0, 3])
def test_forward_fill_equals_plain_loop(spark, max_gap):
    rng = random.Random(4)
    rows = []
    for key in ("hot", "b", None):
        for slot in sorted(rng.sample(range(-20, 60), 50 if key == "hot" else 12)):
            rows.append((key, slot, rng.choice([None, None, 1.0, 2.0])))
    frame = spark.createDataFrame(rows, "k string, slot int, v double")
    expected, held = {}, {}
    for key, slot, value in rows:
        if value is not None:
            held[key] = (slot, value)
        at, last = held.get(key, (None, None))
        fresh = at is not None and (max_gap is None or slot - at <= max_gap)
        expected[(key, slot)] = last if fresh else None
    for chunk in (7, 1000):
        filled = forward_fill(frame, ["k"], "slot", "v", "f", max_gap, chunk)
        assert filled.columns == ["k", "slot", "v", "f"]
        assert {(r.k, r.slot): r.f for r in filled.collect()} == expected
        assert filled.count() == len(rows)


@pytest.mark.parametrize("width", [1, 2, 100])
def test_running_max_with_peers_and_nulls(spark, width):
    rng = random.Random(5)
    rows = [("a", 1, 3.0), ("a", 1, 9.0), (None, 1, 5.0), (None, None, 2.0), ("a", None, None), ("b", 0, None)]
    rows += [("hot", rng.randint(0, 30), rng.choice([None, rng.random()])) for _ in range(100)]
    frame = spark.createDataFrame(rows, "k string, o int, v double")
    chunk = F.floor(F.col("o") / width)
    got = running_max(frame, [F.col("k")], "o", "v", "m", chunk)
    expected = frame.withColumn("m", F.max("v").over(Window.partitionBy("k").orderBy("o")))
    assert rows_of(got) == rows_of(expected)


def test_mode_ties_and_nulls(spark):
    rows = [("a", 1), ("a", 2), ("b", None), ("b", 3), ("c", None), ("c", None), ("c", 1)]
    frame = spark.createDataFrame(rows, "k string, v int")
    assert rows_of(mode_per_group(frame, ["k"], "v", "m")) == [("a", 2), ("b", 3), ("c", None)]


def test_histogram_keeps_every_row(spark):
    frame = spark.range(1001).select(F.col("id").alias("x"))
    got = dict(rows_of(histogram(frame, "x", 10)))
    assert sum(got.values()) == 1001 and sorted(got) == list(range(10)) and got[9] == 101
    constant = spark.createDataFrame([(5,), (5,), (None,)], "x int")
    assert rows_of(histogram(constant, "x", 4)) == [(0, 2)]


def test_box_and_fit(spark):
    frame = spark.range(1, 102).select(F.lit("g").alias("g"), F.col("id").cast("double").alias("x"))
    (row,) = box_stats(frame, ["g"], "x").collect()
    assert (row.q1, row.median, row.q3, row.low_fence, row.high_fence) == (26.0, 51.0, 76.0, -49.0, 151.0)
    (near,) = box_stats_approx(frame, ["g"], "x").collect()
    assert abs(near.median - 51) <= 1
    line = linear_fit(frame.withColumn("y", 3 * F.col("x") - 1), ["g"], "x", "y").first()
    assert line.slope == pytest.approx(3) and line.intercept == pytest.approx(-1)


def test_box_stats_of_hot_values_nulls_and_many_distinct_values(spark):
    draw = random.Random(5)
    rows = [("hot", 7.5 if draw.random() < 0.4 else draw.gauss(0, 50)) for _ in range(5000)]
    rows += [("few", float(draw.randrange(4))) for _ in range(150)]
    rows += [("one", 3.0), ("none", None), ("none", None), ("some", None), ("some", 1.0), ("some", 2.0)]
    rows += [(None, 4.0), (None, 8.0)]
    frame = spark.createDataFrame(rows, "g string, x double")
    got = {r.g: (r.q1, r.median, r.q3) for r in box_stats(frame, ["g"], "x", halvings=4).collect()}
    exact = frame.groupBy("g").agg(F.percentile("x", F.array(*map(F.lit, (0.25, 0.5, 0.75)))).alias("q"))
    expected = {r.g: tuple(r.q or [None] * 3) for r in exact.collect()}
    assert got.keys() == expected.keys()
    for group, quartiles in expected.items():
        assert got[group] == pytest.approx(quartiles), group


def test_first_copy_among_mostly_copies(spark):
    """A third of the rows share one text; nulls are texts like others."""
    draw = random.Random(6)
    texts = [draw.choice(["the same", "the same", f"t{draw.randrange(300)}", None]) for _ in range(900)]
    frame = spark.createDataFrame(list(enumerate(texts)), "id bigint, t string")
    kept = {r.id for r in keep_first_copy(frame, "id", F.col("t")).collect()}
    assert kept == {texts.index(t) for t in set(texts)}


def test_null_counts(spark):
    frame = spark.createDataFrame([(1, None), (None, None)], "a int, b string")
    assert null_counts(frame).first().asDict() == {"a": 1, "b": 2}


def test_first_rows_and_keep_first_copy(spark):
    people = [
        (1, "Ann", "Lee", "123-45-6789"),
        (2, "ANN", "lee", "123456789"),
        (3, "Bob", "Lee", "123-45-6789"),
        (4, "ann", " Lee ", "123-456789"),
        (5, None, "Lee", "123-45-6789"),
        (6, None, "LEE", "123456789"),
    ]
    frame = spark.createDataFrame(people, "id int, first string, last string, ssn string")
    kept = keep_first_copy(frame, "id", *[folded(F.col(c)) for c in ("first", "last", "ssn")])
    assert rows_of(kept) == [people[0], people[2], people[4]]
    assert rows_of(first_rows(frame, ["ssn"], "id").select("id")) == [(1,), (2,), (4,)]


def test_common_members(spark):
    frames = [spark.createDataFrame([(x,) for x in xs], "v int") for xs in ([1, 2, 2, 3], [2, 3, 3], [3, 2, 9])]
    assert rows_of(common_members(frames, "v")) == [(2,), (3,)]


def test_carry_previous(spark):
    current = spark.createDataFrame(
        [("a", 0, None, True), ("a", 1, None, False), ("b", 0, None, True), ("c", 0, 4.0, True)],
        "k string, slot int, v double, first boolean",
    )
    state = spark.createDataFrame([("a", 7.0), ("c", 8.0)], "k string, v double")
    got = {(r.k, r.slot): r.v for r in carry_previous(current, state, ["k"], "v", "first").collect()}
    assert got == {("a", 0): 7.0, ("a", 1): None, ("b", 0): 0.0, ("c", 0): 4.0}


def test_versions(spark, tmp_path):
    root = str(tmp_path / "t")
    days = [datetime(2024, 1, d, 12) for d in (1, 2, 3)]
    for version, (n, day) in enumerate(zip((3, 5, 1), days)):
        write_version(spark.range(n), root, version, day)
    write_version(spark.range(5), root, 1, days[1])  # repeated after a failure
    versions = all_versions(spark, root)
    assert rows_of(history(versions).select("version", "n_rows")) == [(0, 3), (1, 5), (2, 1)]
    assert read_version(versions, 1).columns == ["id"]
    assert [read_version(versions, v).count() for v in (0, 1, 2, 9)] == [3, 5, 1, 0]
    assert read_as_of(versions).count() == 1
    assert read_as_of(versions, datetime(2024, 1, 2, 18)).count() == 5
    assert read_as_of(versions, datetime(2023, 1, 1)).count() == 0
    kept = all_versions(spark, root, keep_from=1)
    assert rows_of(history(kept).select("version")) == [(1,), (2,)]
    assert read_version(kept, 0).count() == 0
    plan = read_version(kept, 1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(version" in plan


def test_merge_with_dots_in_names(spark):
    schema = "`k.a` int, `v.x` string"
    target = spark.createDataFrame([(1, "a"), (2, "b")], schema)
    merged = merge_upsert(target, spark.createDataFrame([(2, "B"), (3, "c")], schema), ["k.a"])
    assert rows_of(merged) == [(1, "a"), (2, "B"), (3, "c")]
