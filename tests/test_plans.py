"""Shapes of physical plans: push-down, pruning, exchanges and joins."""

import re

import pytest
from pyspark.sql import functions as F

from tidemark.queries import QUERIES
from tidemark.queries.registry import Tables

FOLDER = "/root/testdata/sf0.001"


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def large_sides(spark):
    """Plan as for tables above the broadcast threshold."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


NO_SIDE_EFFECT = [
    n
    for n in sorted(QUERIES)
    if not re.match(r"(stream|sink|scan|foreach|snapshot|read_|history|expire|schema)", n)
]


@pytest.mark.parametrize("name", NO_SIDE_EFFECT)
def test_no_cross_join_or_single_partition_window(spark, large_sides, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert not re.search(r"Window.*\n.*Exchange SinglePartition", plan)


def test_chained_filters_are_one_pushed_filter(spark):
    plan = plan_of(QUERIES["filter_conjunction_chain"](spark, FOLDER))
    assert len(re.findall(r"\bFilter \(", plan)) == 1
    assert "Not(EqualTo(p_brand,Brand#1))" in plan or "Not(In(p_brand" in plan


def test_repeated_filters_collapse(spark):
    t = Tables(spark, FOLDER)
    plan = plan_of(t.part.filter("p_brand != 'Brand#1'").filter("p_brand != 'Brand#1'"))
    assert plan.split("PushedFilters")[0].count("Brand#1") <= 2


def test_caching_hides_the_filter_from_the_scan(spark):
    t = Tables(spark, FOLDER)
    cached = t.part.cache()
    try:
        plan = plan_of(cached.filter("p_brand = 'Brand#1'"))
        assert "InMemoryTableScan" in plan and "PushedFilters: []" in plan
    finally:
        cached.unpersist()


def test_only_needed_columns_are_read(spark):
    plan = plan_of(QUERIES["group_count"](spark, FOLDER))
    assert "ReadSchema: struct<o_orderpriority:string>" in plan


def test_partition_folders_are_pruned(spark, tmp_path):
    t = Tables(spark, FOLDER)
    path = str(tmp_path / "bronze")
    parts = t.events.select("event_id", "ts", F.month("ts").alias("month"), F.dayofmonth("ts").alias("day"))
    parts.write.partitionBy("month", "day").parquet(path)
    plan = plan_of(spark.read.parquet(path).filter("month = 1 AND day = 3"))
    assert re.search(r"PartitionFilters: \[.*day#\d+ = 3", plan)


def test_time_range_opens_only_its_days(spark):
    plan = plan_of(QUERIES["bronze_time_range"](spark, FOLDER))
    assert re.search(r"PartitionFilters: \[.*make_date\(year#", plan)


def test_time_range_reaches_the_scan(spark):
    plan = plan_of(QUERIES["catch_up_windows"](spark, FOLDER))
    assert "GreaterThanOrEqual(ts,2024-01-01T00:00)" in plan


def test_top_k_takes_ordered(spark):
    assert "TakeOrderedAndProject" in plan_of(QUERIES["top_k"](spark, FOLDER))


def test_sales_are_summed_before_the_join(spark, large_sides):
    """The exchange below the join carries partial sums, not sales."""
    plan = plan_of(QUERIES["revenue_by_source"](spark, FOLDER))
    sales = plan[plan.index("SortMergeJoin") :]
    assert sales.index("HashAggregate") < sales.index("o_totalprice")
    assert plan.count("Exchange") == 3


def test_gap_fill_reads_its_input_once(spark, large_sides):
    frame = QUERIES["catch_up_windows"](spark, FOLDER)
    frame.collect()
    plan = plan_of(frame).split("Initial Plan")[0]
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan


def test_merge_source_is_exchanged_once(spark, large_sides):
    frame = QUERIES["merge_upsert"](spark, FOLDER)
    frame.collect()
    assert "ReusedExchange" in plan_of(frame).split("Initial Plan")[0]


def test_small_merge_source_leaves_the_target_in_place(spark, tmp_path):
    from tidemark.operators.merge import merge_upsert

    t = Tables(spark, FOLDER)
    path = str(tmp_path / "source")
    t.orders.filter("o_orderkey < 50").write.parquet(path)
    merged = merge_upsert(t.orders, spark.read.parquet(path), ["o_orderkey"])
    merged.collect()
    plan = plan_of(merged).split("Initial Plan")[0]
    target_scans = plan.count(f"{FOLDER}/orders.parquet")
    assert target_scans == 2 and "SortMergeJoin" not in plan


def test_few_copies_are_dropped_without_moving_texts(spark):
    from tidemark.operators.aggregates import keep_first_copy

    documents = Tables(spark, FOLDER).documents
    plan = plan_of(keep_first_copy(documents, "doc_id", F.col("text")))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


@pytest.fixture
def small_skew_sizes(spark, large_sides):
    """Sizes at which a test frame counts as skewed."""
    sizes = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in sizes}
    for key, value in sizes.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot_rows(spark):
    """Half of the rows have one key; the values do not compress."""
    key = F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id"))
    ts = F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 300)
    return spark.range(0, 120_000, 1, 8).select(
        key.alias("k"), F.lit("x").alias("tag"), ts.alias("ts"), F.rand(3).alias("value")
    )


def test_hot_target_key_is_split_in_a_merge(spark, small_skew_sizes):
    from tidemark.operators.merge import merge_upsert

    target = hot_rows(spark).select("k", "value")
    source = spark.range(0, 30_000).select(F.col("id").alias("k"), F.rand(4).alias("value"))
    merged = merge_upsert(target, source, ["k"])
    assert len(merged.collect()) == 120_000 + 14_999
    assert "SortMergeJoin(skew=true)" in plan_of(merged)


def test_hot_device_is_split_in_the_sparse_summary(spark, small_skew_sizes):
    from tidemark.plans.sensors import summarise_latest

    summary = summarise_latest(hot_rows(spark), ["k", "tag"], "ts", "value", 300, run_seconds=300 * 10**6)
    assert len(summary.collect()) == 120_000
    assert "SortMergeJoin(skew=true)" in plan_of(summary)


def test_hot_period_is_split_in_a_running_maximum(spark, small_skew_sizes):
    from tidemark.operators.windows import running_max

    rows = hot_rows(spark).withColumn("day", F.to_date(F.timestamp_seconds(F.col("k") * 300)))
    result = running_max(rows, [F.month("day")], "day", "value", "m", F.date_trunc("week", "day"))
    assert len(result.collect()) == 120_000
    assert "SortMergeJoin(skew=true)" in plan_of(result)


def test_pandas_udf_runs_on_arrow_batches(spark):
    assert "ArrowEvalPython" in plan_of(QUERIES["udf_pandas"](spark, FOLDER))
    assert "Python" not in plan_of(QUERIES["udf_native_twin"](spark, FOLDER))


def test_single_file_sink_keeps_upstream_parallelism(spark, tmp_path):
    from tidemark.sources.writers import write_single_file

    path = str(tmp_path / "one")
    write_single_file(spark.range(1000, numPartitions=8), path)
    assert spark.read.parquet(path).select("_metadata.file_path").distinct().count() == 1
