"""Frequent keys, salted joins, space-filling curves, variants, observed metrics."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidemark.operators import frequent
from tidemark.operators.curve import with_curve_position
from tidemark.operators.frequent import frequency_summaries, top_values
from tidemark.operators.joins import frequent_keys, salted_join
from tidemark.operators.variants import flatten_json, merged_schema, parsed
from tidemark.session import stored
from tidemark.sources import writers
from tidemark.sources.readers import bytes_in_memory, bytes_of_files, parts_of_size, range_partitioned
from tidemark.sources.writers import compact, compact_by_curve
from tidemark.streaming.monitor import checked

# --- salted joins --------------------------------------------------------------


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows on one key, a tenth on another, a tenth without a key."""
    i = F.col("id")
    key = F.when(i % 3 == 0, 7).when(i % 10 == 1, 8).when(i % 10 == 2, F.lit(None)).otherwise(100 + i % 5000)
    return spark.range(60_000).select("id", key.cast("bigint").alias("k"), (i % 4).alias("k2")).repartition(6)


@pytest.fixture(scope="module")
def dimension(spark):
    return spark.range(6_000).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v"))


def test_frequent_keys_are_found_and_bounded(facts):
    by_hash = frequent_keys(facts, ["k"], 8)
    hashes = {r["k"]: r["h"] for r in facts.select("k", F.xxhash64("k").alias("h")).distinct().collect()}
    found = {k: by_hash[h] for k, h in hashes.items() if k is not None and h in by_hash}
    counts = Counter(r["k"] for r in facts.select("k").collect())
    assert set(found) == {7, 8} and len(by_hash) == 2
    assert all(abs(found[k] - counts[k] / (60_000 / (8 * 16))) <= 1 for k in found)
    assert frequent_keys(facts.filter("k > 100"), ["k"], 8) == frequent_keys(facts.limit(0), ["k"], 8) == {}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_is_the_join(facts, dimension, how):
    plain = facts.join(dimension, "k", how).select("id", "k", "k2", "v")
    salted = salted_join(facts, dimension, ["k"], how, spread=["id"])
    assert salted.columns == ["id", "k", "k2", "v"]
    assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))


def test_salted_join_on_two_keys_with_several_rows_each(facts, dimension):
    other = dimension.withColumn("k2", F.explode(F.array(F.lit(0).cast("bigint"), F.lit(0).cast("bigint"), F.lit(3).cast("bigint"))))
    plain = facts.join(other, ["k", "k2"]).select("id", "k", "k2", "v")
    salted = salted_join(facts, other, ["k", "k2"], spread=["id"])
    assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))


def rows_by_partition(frame):
    counted = frame.groupBy(F.spark_partition_id().alias("p")).count()
    return sorted(r["count"] for r in counted.collect())


def test_salted_rows_are_spread_evenly(spark, facts, dimension):
    """The slowest task has at most 1.5 times the rows of the median one, with a third of all on one key."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for k, v in zip(before, ("8", "-1", "false")):
            spark.conf.set(k, v)
        plain = rows_by_partition(facts.join(dimension, "k", "left"))
        salted = rows_by_partition(salted_join(facts, dimension, ["k"], "left", spread=["id"]))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(salted) == 8 and salted[-1] <= 1.5 * salted[4]
    assert plain[-1] > 3 * plain[4]


def test_salted_join_of_empty_sides(facts, dimension):
    assert salted_join(facts.limit(0), dimension, ["k"]).collect() == []
    assert salted_join(facts, dimension.limit(0), ["k"], "left").count() == 60_000
    with pytest.raises(ValueError, match="inner"):
        salted_join(facts, dimension, ["k"], "full")


# --- top values ----------------------------------------------------------------


def zipf(n, values, seed=3):
    rng = random.Random(seed)
    return [min(int(rng.paretovariate(1.1)), values) for _ in range(n)]


def expected_top(rows, k):
    return sorted(Counter(rows).items(), key=lambda x: (-x[1], x[0] is None, x[0]))[:k]


@pytest.mark.parametrize("size", [20, 200, 100_000])
def test_top_values_are_exact(spark, size):
    rows = zipf(30_000, 20_000) + [None] * 500
    frame = spark.createDataFrame([(v,) for v in rows], "v bigint").repartition(6)
    got = [tuple(r) for r in top_values(frame, "v", 8, size).collect()]
    assert got == expected_top(rows, 8)


def test_nearly_equal_counts_are_counted_in_full(spark):
    """No summary of ten values can certify a uniform distribution."""
    rows = [i % 997 for i in range(20_000)] + [5, 5, 17]
    frame = spark.createDataFrame([(v,) for v in rows], "v bigint").repartition(4)
    assert [tuple(r) for r in top_values(frame, "v", 3, size=10).collect()] == expected_top(rows, 3)


def test_only_summaries_are_exchanged(spark):
    rows = zipf(50_000, 40_000)
    frame = stored(spark.createDataFrame([(f"w{v}",) for v in rows], "w string").repartition(5), "words")
    summaries = frequency_summaries(frame, "w", 50)
    assert summaries.count() <= 51 * frame.rdd.getNumPartitions()
    counts = Counter(f"w{v}" for v in rows)
    error = sum(r["error"] for r in summaries.filter("n IS NULL").collect())
    low = Counter()
    for r in summaries.filter("n IS NOT NULL").collect():
        low[r["w"]] += r["n"]
    assert all(low[w] <= n <= low[w] + error for w, n in counts.items())
    # Certified: what is given out are the counted candidates, not all values.
    first = top_values(frame, "w", 5, 50)
    assert "Aggregate" not in first._jdf.queryExecution().optimizedPlan().toString()
    joined = top_values(frame, "w", 5, 50, broadcast_candidates=0)
    assert first.collect() == joined.collect() == [tuple(x) for x in expected_top([f"w{v}" for v in rows], 5)]


def test_top_values_of_few_and_no_rows(spark):
    frame = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "v string")
    assert [tuple(r) for r in top_values(frame, "v", 10).collect()] == [("b", 2), ("a", 1), (None, 1)]
    assert [tuple(r) for r in top_values(frame, "v", 10, size=1).collect()] == [("b", 2), ("a", 1), (None, 1)]
    assert top_values(frame.limit(0), "v", 3).collect() == []


# --- space-filling curve ----------------------------------------------------------


def readings(spark, n=8_000):
    rng = random.Random(4)
    start = datetime(2024, 1, 1)
    rows = [
        (rng.randrange(300), rng.choice("abcde"), start + timedelta(minutes=rng.randrange(40_000)), i)
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "device bigint, tag string, ts timestamp, id bigint")


COLUMNS = ["device", "tag", "ts"]


@pytest.fixture(scope="module")
def by_curve(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("curve"))
    frame = stored(readings(spark), "readings")
    compact_by_curve(frame, f"{folder}/curve", COLUMNS, files=64)
    compact(frame, f"{folder}/sorted", COLUMNS, file_bytes=1 + bytes_of_files(spark, *frame.inputFiles()) // 64)
    return frame, f"{folder}/curve", f"{folder}/sorted"


def opened_share(spark, path, column, probe):
    """Share of the files whose bounds hold a value."""
    rows = spark.read.parquet(path)
    bounds = rows.groupBy(F.col("_metadata.file_name")).agg(F.min(column).alias("low"), F.max(column).alias("high")).collect()
    return sum(b.low <= probe <= b.high for b in bounds) / len(bounds)


@pytest.mark.parametrize("column, probe", [("device", 150), ("tag", "c"), ("ts", datetime(2024, 1, 15))])
def test_a_filter_on_any_column_skips_half_of_the_files(spark, by_curve, column, probe):
    _, curve, _ = by_curve
    assert opened_share(spark, curve, column, probe) <= 0.5


def test_sorting_skips_by_the_first_column_only(spark, by_curve):
    _, _, in_order = by_curve
    assert opened_share(spark, in_order, "device", 150) < 0.1
    assert opened_share(spark, in_order, "ts", datetime(2024, 1, 15)) > 0.9


def test_rows_are_kept_and_a_hot_place_is_spread(spark, by_curve, tmp_path):
    frame, curve, _ = by_curve
    assert sorted(map(tuple, spark.read.parquet(curve).collect())) == sorted(map(tuple, frame.collect()))
    hot = frame.withColumns({"device": F.lit(1).cast("bigint"), "tag": F.lit(None).cast("string")})
    compact_by_curve(hot, str(tmp_path / "hot"), ["device", "tag"], files=8)
    sizes = [r["count"] for r in spark.read.parquet(str(tmp_path / "hot")).groupBy("_metadata.file_name").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * min(sizes)


@pytest.mark.parametrize("by_place", [False, True])
def test_a_file_is_sorted_in_several_tasks_and_stays_in_order(spark, tmp_path, monkeypatch, by_place):
    frame = stored(readings(spark, 6_000).withColumn("tag", F.when(F.col("tag") != "c", F.col("tag"))), "readings")
    path, sorted_by = str(tmp_path / "out"), []
    monkeypatch.setattr(
        writers, "range_partitioned", lambda f, n, *by: sorted_by.append(n) or range_partitioned(f, n, *by)
    )
    monkeypatch.setattr(writers, "RUN_BYTES", bytes_in_memory(frame) // 17, raising=False)
    monkeypatch.setattr(writers, "FILES_PER_JOB", 2, raising=False)
    before = spark.conf.get("spark.sql.unionOutputPartitioning", None)
    if by_place:
        compact_by_curve(frame, path, COLUMNS, files=3)
    else:
        compact(frame, path, ["device", "tag"], file_bytes=1 + bytes_of_files(spark, *frame.inputFiles()) // 3)
    # The rows of a file are too many for a task: six tasks or more for each of three files.
    assert sorted_by[0] >= 18
    written = spark.read.parquet(path)
    assert written.columns == frame.columns and written.exceptAll(frame).isEmpty() and written.count() == 6_000
    assert spark.conf.get("spark.sql.unionOutputPartitioning", None) == before
    files = written.inputFiles()
    assert len(files) == 3
    if not by_place:
        ordered = [pq.read_table(f.removeprefix("file:")).to_pylist() for f in files]
        keys = [[(r["device"], r["tag"] or "") for r in rows] for rows in ordered]
        assert all(k == sorted(k) for k in keys)
        keys.sort()
        assert all(a[-1] <= b[0] for a, b in zip(keys, keys[1:])) and min(map(len, keys)) > 1_000


def test_bytes_in_memory_follow_the_rows(spark):
    numbers = spark.range(1_000)
    texts = numbers.select("id", F.repeat(F.lit("é"), 50).alias("a`b"), F.lit(None).cast("string").alias("none"))
    nested = numbers.select(F.sequence(F.lit(0), F.lit(99)).alias("list"), F.struct("id").alias("pair"))
    assert bytes_in_memory(numbers) == 64_000 and bytes_in_memory(numbers.limit(0)) == 0
    assert bytes_in_memory(texts) == 1_000 * (56 + 3 * 8 + 100)
    assert bytes_in_memory(nested) >= 1_000 * 100 * 8


def test_places_interleave_the_bits_of_the_ranks(spark):
    rows = [(a, b) for a in range(4) for b in range(4)]
    frame = spark.createDataFrame(rows, "a int, b int")
    got = {(r.a, r.b): r.p for r in with_curve_position(frame, ["a", "b"], "p", bits=2).collect()}
    # Four values, four ranks: quarters of the square one after another.
    ranks = {v: sorted({got[v, 0] for v in range(4)}).index(got[v, 0]) for v in range(4)}
    assert ranks == {v: v for v in range(4)}
    quarter = {k: p >> 2 for k, p in got.items()}
    assert len({quarter[k] for k in got if k[0] < 2 and k[1] < 2}) <= 2
    with pytest.raises(ValueError, match="62 bits"):
        with_curve_position(frame, ["a", "b"], "p", bits=40)
    with pytest.raises(TypeError, match="array"):
        with_curve_position(frame.select(F.array("a").alias("x")), ["x"], "p")


def test_parts_are_counted_from_the_files(spark, tmp_path):
    frame = stored(spark.range(200_000), "numbers")
    size = bytes_of_files(spark, *frame.inputFiles())
    assert parts_of_size(frame, size) == 1 and parts_of_size(frame, size // 4 - 1) == 5
    joined = frame.join(frame.withColumnRenamed("id", "other"), F.col("id") == F.col("other"))
    assert parts_of_size(joined, 128 << 20) == 1
    assert parts_of_size(spark.range(5), 1) == 1


# --- variants -------------------------------------------------------------------


def test_fields_that_differ_by_row_are_all_found(spark):
    rows = [f'{{"a": {i}}}' for i in range(500)] + ['{"a": 1.5, "late": {"x y": [1, 2]}}', '{"a": "text"}', "no json", None, "[1]", "3"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "id int, t string").repartition(7)
    got = {r["id"]: r.asDict() for r in flatten_json(frame, "t", ["id"]).collect()}
    assert len(got) == len(rows)
    # Whole numbers, decimals and text: kept as text in a column of their own; no row is lost.
    assert got[7]["a"] == "7" and got[500]["a"] == "1.5" and got[501]["a"] == "text"
    assert {i for i, r in got.items() if r["a"] is None} == {502, 503, 504, 505}


def test_nested_objects_and_arrays(spark):
    rows = ['{"a": {"b": {"c": 1}}, "l": [1, 2]}', '{"a": {"b": {"d": true}}}', "{}"]
    frame = spark.createDataFrame([(t,) for t in rows], "t string")
    flat = flatten_json(frame, "t")
    assert sorted(flat.columns) == ["a_b_c", "a_b_d", "l"]
    assert {tuple(r[c] for c in ("a_b_c", "a_b_d")) for r in flat.collect()} == {(1, None), (None, True), (None, None)}
    assert "BIGINT" in merged_schema(parsed(frame, "t", "v"), "v").upper()
    assert flatten_json(frame.limit(0), "t", ["t"]).columns == ["t"]


# --- observed metrics --------------------------------------------------------------


def test_counts_of_the_pass_that_writes(spark, tmp_path):
    rows = [(1, None), (None, "x"), (3, "y"), (4, None)]
    seen = Observation("rows")
    frame = checked(spark.createDataFrame(rows, "a int, `b.c` string"), seen, large=F.col("a") > 2)
    frame.write.parquet(str(tmp_path / "out"))
    assert seen.get == {"rows": 4, "null_a": 1, "null_b.c": 2, "large": 2}


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(0, 30), max_size=200), st.integers(1, 8), st.integers(1, 5))
def test_summaries_bound_every_count(rows, size, batch):
    """The kept counts and their error, without Spark: batches of a task, one after another."""
    import pyarrow as pa

    collected = []

    class Frame:
        schema = {"v": None}

        def select(self, _):
            return self

        def mapInArrow(self, run, _):
            batches = [pa.RecordBatch.from_arrays([pa.array(rows[i : i + batch], pa.int64())], names=["v"]) for i in range(0, len(rows), batch)]
            collected.extend(r for b in run(iter(batches)) for r in b.to_pylist())
            return self

    from pyspark.sql.types import LongType, StructField

    Frame.schema = {"v": StructField("v", LongType())}
    frequent.frequency_summaries(Frame(), "v", size)
    kept = {r["v"]: r["n"] for r in collected if r["n"] is not None}
    error = max([r["error"] for r in collected], default=0)
    assert len(kept) <= size
    for v, n in Counter(rows).items():
        assert kept.get(v, 0) <= n <= kept.get(v, 0) + error
