"""Column functions, UDF twins, readers and writers on literal rows."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions.numbers import (
    divide_or_null,
    is_leap_year,
    ladder,
    parse_currency,
    truncate_decimals,
)
from tidemark.functions.text import file_name, file_number, first_letter, folded
from tidemark.functions.times import sane_time, weekday_label
from tidemark.functions.udfs import first_letter_udf, first_letter_vectorised, weekday_label_udf
from tidemark.plans.clickstream import (
    abandoned_items,
    converted_flags,
    daily_active_users,
    options_per_customer,
    product_options,
    revenue_by_source,
    weekday_active_users,
    with_revenue,
)
from tidemark.session import pin_session, scratch_path, shared_folder, stored
from tidemark.sources.readers import (
    parts_of_size,
    range_partitioned,
    stride_partitioned,
    stride_scans,
    read_delimited,
    read_json,
    schema_as_ddl,
    with_source_file,
)
from tidemark.operators.snapshots import all_versions, read_as_of, remove_versions, write_version
from tidemark.sources.writers import (
    compact,
    create_external_table,
    keyed_json,
    write_csv,
    write_documents,
    write_parquet,
    write_table,
)


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "text, expected", [("$1,234.50", 1234.5), ("$0.00", 0.0), ("free", None), (None, None), ("", None)]
)
def test_currency(spark, text, expected):
    assert one(spark, parse_currency, text) == expected


@pytest.mark.parametrize("value, expected", [(1.999, 1.99), (-1.999, -1.99), (2.0, 2.0), (None, None)])
def test_truncate(spark, value, expected):
    assert one(spark, truncate_decimals, value, "double") == expected


@pytest.mark.parametrize("year, leap", [(2000, True), (1900, False), (2024, True), (2023, False)])
def test_leap_year(spark, year, leap):
    assert one(spark, is_leap_year, year, "int") is leap


def test_divide_by_zero_is_null(spark):
    assert one(spark, lambda x: divide_or_null(F.lit(5.0), x), 0.0, "double") is None


def test_ladder_takes_the_first_match(spark):
    assert one(spark, lambda x: ladder([(x > 5, "big"), (x > 1, "mid")], "small"), 9, "int") == "big"


def test_file_names(spark):
    path = "/data/stocks/ABC_17.csv"
    assert one(spark, file_name, path) == "ABC_17.csv"
    assert one(spark, file_number, path) == 17
    assert one(spark, file_number, "readme.md") is None


def test_folded(spark):
    assert one(spark, folded, "  ANN-Marie   LEE ") == "annmarie lee"


def test_weekdays_and_bounds(spark):
    assert one(spark, weekday_label, "Sun") == "7-Sun"
    assert one(spark, weekday_label, "Xyz") is None
    assert one(spark, lambda x: sane_time(x.cast("timestamp")), "2400-01-01") is False
    assert one(spark, lambda x: sane_time(x.cast("timestamp")), "2024-01-01") is True


@pytest.mark.parametrize("text", ["anna", "Ärger", "", None])
def test_udf_forms_agree(spark, text):
    expected = one(spark, first_letter, text)
    assert one(spark, first_letter_udf, text) == expected
    assert one(spark, first_letter_vectorised, text) == expected
    assert one(spark, weekday_label_udf, "Mon") == one(spark, weekday_label, "Mon")


AWKWARD = [(1, 'say "hi"', "a,b"), (2, "line\nbreak", "  padded  "), (3, "", None), (4, "tab\there", "back\\slash")]


def test_csv_round_trip_of_awkward_text(spark, tmp_path):
    frame = spark.createDataFrame(AWKWARD, "id int, a string, b string")
    write_csv(frame, str(tmp_path / "c"))
    read = read_delimited(spark, str(tmp_path / "c"), schema=frame.schema, quoted_newlines=True)
    # CSV has one spelling for null and empty text; Spark reads it as null.
    expected = [tuple(None if v == "" else v for v in row) for row in AWKWARD]
    assert sorted(tuple(r) for r in read.collect()) == expected


def test_inference_and_ddl(spark, tmp_path):
    path = str(tmp_path / "j")
    spark.createDataFrame([(1, 2.5, "x")], "i int, d double, s string").write.json(path)
    ddl = schema_as_ddl(read_json(spark, path))
    assert read_json(spark, path, schema=ddl).schema == read_json(spark, path).schema
    with open(tmp_path / "p.txt", "w") as f:
        f.write("name:age\nann:5\n")
    assert read_delimited(spark, str(tmp_path / "p.txt"), sep=":").dtypes == [("name", "string"), ("age", "int")]


def test_documents_are_bounded_and_whole(spark, tmp_path):
    path = str(tmp_path / "d")
    frame = spark.range(95, numPartitions=3).withColumn("t", F.lit("two\nlines"))
    write_documents(frame, path, rows_per_document=10)
    read = read_json(spark, path, schema=frame.schema, whole_document=True)
    assert read.select("id").distinct().count() == 95
    per_file = with_source_file(read).groupBy("source_file").count()
    assert per_file.agg(F.max("count")).first()[0] <= 10


def test_partitions_tables_and_compaction(spark, tmp_path):
    rows = spark.range(100).withColumn("k", F.col("id") % 4)
    write_parquet(rows, str(tmp_path / "p"), partition_by=["k"])
    assert spark.read.parquet(str(tmp_path / "p")).filter("k = 2").count() == 25
    rows.repartition(20).write.parquet(str(tmp_path / "many"))
    many = spark.read.parquet(str(tmp_path / "many"))
    compact(many, str(tmp_path / "small"), ["k", "id"], file_bytes=parts_of_size(many, 1) // 2 + 1)
    read = spark.read.parquet(str(tmp_path / "small"))
    assert read.count() == 100 and with_source_file(read).select("source_file").distinct().count() == 2
    hot = spark.range(9000).withColumn("k", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")))
    parts = range_partitioned(hot, 6, "k").groupBy(F.spark_partition_id().alias("p"))
    sizes = parts.agg(F.count("k").alias("n"), F.min("k"), F.max("k")).orderBy("p").collect()
    assert len(sizes) == 6 and max(r.n for r in sizes) < 2500
    assert all(a["max(k)"] <= b["min(k)"] for a, b in zip(sizes, sizes[1:]))
    write_table(rows, "numbers_table", str(tmp_path / "t"))
    write_table(rows, "numbers_table", str(tmp_path / "t"), mode="append")
    assert spark.table("numbers_table").count() == 200
    named = create_external_table(spark, "numbers_files", str(tmp_path / "small"))
    assert named.count() == 100
    spark.sql("DROP TABLE numbers_files")
    assert spark.read.parquet(str(tmp_path / "small")).count() == 100


def test_keyed_json(spark):
    frame = spark.createDataFrame([("a", "x", 1.5), ("b", None, 2.0)], "device string, tag string, v double")
    got = [tuple(r) for r in keyed_json(frame, ["device", "tag"]).orderBy("key").collect()]
    assert got == [("a~x", '{"device":"a","tag":"x","v":1.5}'), ("b", '{"device":"b","v":2.0}')]


def test_folder_files_are_few_and_a_hot_folder_is_whole(spark, tmp_path):
    path = str(tmp_path / "folders")
    rows = spark.range(4000, numPartitions=16).withColumn("k", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5))
    write_parquet(rows, path, partition_by=["k"])
    read = spark.read.parquet(path)
    assert read.count() == 4000 and read.select("_metadata.file_path").distinct().count() <= 8


class _Cluster:
    """Stands for a session on a cluster without the setting."""

    class conf:
        get = staticmethod(lambda key, default=None: default)

    class sparkContext:
        master = "yarn"


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(_Cluster)


def test_a_sessions_own_settings_win(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "7m")
        spark.conf.set("spark.sql.session.timeZone", "Europe/Oslo")
        pin_session(spark)
        assert spark.conf.get(key) == "7m" and spark.conf.get("spark.sql.session.timeZone") == "UTC"
        spark.conf.unset(key)
        assert pin_session(spark).conf.get(key) == "64m"
    finally:
        spark.conf.set(key, before)


def test_shared_folder_comes_from_the_session(spark):
    assert scratch_path(spark, "x").startswith(shared_folder(spark))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert stored(spark.range(3), "three").count() == 3


def test_revenue_by_source(spark):
    sales = spark.createDataFrame([(1, 10.0), (1, 20.0), (2, 5.0), (3, None), (9, 99.0)], "u int, r double")
    users = spark.createDataFrame([(1, "mail"), (2, "ads"), (3, "ads")], "u int, src string")
    got = [tuple(r) for r in revenue_by_source(sales, users, "u", "src", "r", 1).collect()]
    assert got == [("mail", 30.0, 15.0)]


def test_active_users(spark):
    rows = [("2024-01-01", "a"), ("2024-01-01", "a"), ("2024-01-01", "b"), ("2024-01-08", "a"), ("2024-01-07", "c")]
    events = spark.createDataFrame(rows, "ts string, u string").withColumn("ts", F.to_timestamp("ts"))
    for exact in (True, False):
        got = [tuple(r) for r in weekday_active_users(events, "ts", "u", exact).collect()]
        assert got == [("1-Mon", 1.5), ("7-Sun", 1.0)]
    assert daily_active_users(events, "ts", "u").count() == 3


def test_abandoned_items(spark):
    carts = spark.createDataFrame([("u", 1, "x"), ("u", 1, "x"), ("u", 1, "y"), ("v", 1, "x"), ("u", 2, "x")], "u string, d int, i string")
    bought = spark.createDataFrame([("v", 1), ("v", 1)], "u string, d int")
    got = {r.i: r.n_carts for r in abandoned_items(carts, bought, ["u", "d"], "i").collect()}
    assert got == {"x": 2, "y": 1}


def test_options_of_two_word_orders(spark):
    products = spark.createDataFrame(
        [(1, "Standard Full Mattress"), (2, "King Down Pillow"), (3, "Mattress"), (4, "Lamp")], "p int, name string"
    )
    beds = product_options(products, "name", "Mattress", quality_position=1, size_position=2)
    pillows = product_options(products, "name", "Pillow", quality_position=2, size_position=1)
    both = beds.unionByName(pillows)
    assert {(r.p, r.size, r.quality) for r in both.collect()} == {
        (1, "Full", "Standard"), (2, "King", "Down"), (3, None, "Mattress"),
    }
    orders = spark.createDataFrame([(o, "z") for o in (1, 2, 3)], "p int, c string")
    per = options_per_customer(both, orders, "p", "c").first()
    assert per.size_options == ["Full", "King"] and per.quality_options == ["Down", "Mattress", "Standard"]


def test_conversions_and_revenue(spark):
    users = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "email string, id int")
    buyers = spark.createDataFrame([("a",), ("a",), ("z",)], "email string")
    got = {(r.email, r.id, r.converted) for r in converted_flags(users, buyers, "email").collect()}
    assert got == {("a", 1, True), ("b", 2, False), ("z", None, True)}
    kept = with_revenue(users, F.when(F.col("id") > 1, F.col("id") * 2.0), "id")
    assert kept.columns == ["email", "revenue"] and kept.count() == 2


def test_udfs_travel_by_value(tmp_path):
    """An executor without this package can load and run them."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    for udf, value, expected in (
        (first_letter_udf, "anna", "a"),
        (weekday_label_udf, "Mon", "1-Mon"),
    ):
        path = tmp_path / "udf.pkl"
        path.write_bytes(cloudpickle.dumps(udf.func))
        code = (
            "import pickle, sys; sys.modules['tidemark'] = None\n"
            f"f = pickle.load(open({str(path)!r}, 'rb')); assert f({value!r}) == {expected!r}"
        )
        subprocess.run([sys.executable, "-c", code], check=True, cwd="/", timeout=60)


def test_strides_lose_no_row(spark):
    rows = [(k,) for k in (-5, 0, 1, 50, 99, 100, 1000, None)]
    frame = spark.createDataFrame(rows, "k long")
    parts = stride_partitioned(frame, "k", 0, 99, 4).select(F.spark_partition_id().alias("p"), "k").collect()
    assert sorted((r.k is not None, r.k or 0) for r in parts) == sorted((k is not None, k or 0) for (k,) in rows)
    at = {r.k: r.p for r in parts}
    assert (at[-5], at[0], at[50], at[99], at[1000], at[None]) == (0, 0, 2, 3, 3, 0)


def test_strides_are_filters_of_their_own_scans(spark, tmp_path, capsys):
    rows = [(k,) for k in [-5, 0, 7, 24, 25, 50, 74, 99, 1000, None]]
    spark.createDataFrame(rows, "k bigint").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    for n in (1, 3, 4, 200):
        parts = stride_scans(table, "k", 0, 99, n)
        assert sorted(map(str, parts.collect())) == sorted(map(str, table.collect()))
    stride_scans(table, "k", 0, 99, 4).explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and plan.count("FileScan") == 4
    assert "GreaterThanOrEqual(k,25), LessThan(k,50)" in plan
    assert stride_scans(table, "k", 0, 0, 5).count() == 10


def test_removed_versions_free_their_files(spark, tmp_path):
    root = str(tmp_path / "v")
    for i in range(3):
        write_version(spark.range(10 * (i + 1)), root, i, datetime(2024, 1, 1 + i))
    assert remove_versions(spark, root, keep_from=2) == [0, 1]
    left = [f for f in tmp_path.rglob("*.parquet") if "version=2" not in str(f)]
    assert left == []
    assert read_as_of(all_versions(spark, root)).count() == 30
    assert remove_versions(spark, root, keep_from=2) == []
