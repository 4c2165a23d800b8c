"""Writing and named tables: every query reads back what it wrote."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.aggregates import count_rows
from tidemark.queries.registry import Tables, query
from tidemark.session import scratch_path, stored
from tidemark.sources.readers import read_delimited, read_json
from tidemark.sources.writers import (
    compact,
    compact_by_curve,
    create_external_table,
    keyed_json,
    write_csv,
    write_json,
    write_parquet,
    write_single_file,
    write_table,
)

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "o_orderdate"]
ORDERS_SQL = f"SELECT {', '.join(ORDER_COLUMNS)} FROM orders"


def _fresh_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


@query("sink_parquet", ORDERS_SQL)
def sink_parquet(t: Tables):
    path = scratch_path(t.spark, "orders")
    write_parquet(t.orders.select(*ORDER_COLUMNS), path)
    return t.spark.read.parquet(path)


@query("sink_json", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def sink_json(t: Tables):
    path = scratch_path(t.spark, "customer")
    write_json(t.customer, path)
    return read_json(t.spark, path, schema=t.customer.schema)


@query("sink_table", ORDERS_SQL)
def sink_table(t: Tables):
    """Overwrite a named table, then append to it."""
    name, path = _fresh_name("orders"), scratch_path(t.spark, "orders-table")
    finished = F.col("o_orderstatus") == "F"
    orders = t.orders.select(*ORDER_COLUMNS)
    write_table(orders.filter(finished), name, path)
    write_table(orders.filter(~finished), name, path, mode="append")
    return t.spark.table(name)


@query(
    "sink_partitioned",
    """
    SELECT year(o_orderdate)::INTEGER AS order_year, count(*) AS n_orders,
           round(sum(o_totalprice), 2) AS total
    FROM orders GROUP BY 1
    """,
)
def sink_partitioned(t: Tables):
    """Folders by a derived column; each year is then read from its folder alone."""
    path = scratch_path(t.spark, "orders-by-year")
    derived = t.orders.withColumn("order_year", F.year("o_orderdate"))
    write_parquet(derived, path, partition_by=["order_year"])
    return (
        t.spark.read.parquet(path)
        .groupBy("order_year")
        .agg(F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    )


@query(
    "sink_single_file",
    """
    SELECT o_orderpriority, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total
    FROM orders GROUP BY 1
    """,
)
def sink_single_file(t: Tables):
    """A finished report in exactly one file."""
    path = scratch_path(t.spark, "priority-report")
    report = t.orders.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )
    write_single_file(report, path)
    return t.spark.read.parquet(path)


@query("sink_csv", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def sink_csv(t: Tables):
    path = scratch_path(t.spark, "part")
    write_csv(t.part, path)
    return read_delimited(t.spark, path, schema=t.part.schema)


@query(
    "keyed_json_messages",
    """
    SELECT user_id || '~' || event_type || '~' || event_id AS key,
           user_id, event_type, round(value, 4) AS value
    FROM events
    """,
)
def keyed_json_messages(t: Tables):
    """Key and whole-row JSON; the JSON is parsed back to compare its content."""
    messages = keyed_json(
        t.events.select("user_id", "event_type", "event_id", "value"),
        ["user_id", "event_type", "event_id"],
    )
    body = F.from_json("value", "user_id bigint, event_type string, value double").alias("body")
    return messages.select("key", body).select(
        "key", "body.user_id", "body.event_type", F.round("body.value", 4).alias("value")
    )


@query(
    "view_register",
    "SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1",
)
def view_register(t: Tables):
    t.events.select("event_type", "value").createOrReplaceTempView("readings_view")
    return t.spark.sql(
        "SELECT event_type, count(*) AS n, round(sum(value), 4) AS total "
        "FROM readings_view GROUP BY event_type"
    )


@query("create_external_table", "SELECT p_brand, count(*) AS n FROM part GROUP BY 1")
def external_table(t: Tables):
    name = _fresh_name("part_files")
    table = create_external_table(t.spark, name, t.path("part"))
    return table.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))


CATALOGUED = ["customer", "orders", "part", "supplier"]


@query(
    "table_catalog",
    " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, 'EXTERNAL' AS kind, 'parquet' AS provider, count(*) AS n_rows FROM {n}"
        for n in CATALOGUED
    ),
)
def table_catalog(t: Tables):
    """Named tables of this shop, found by listing them, described, and counted."""
    prefix = _fresh_name("shop")
    for name in CATALOGUED:
        create_external_table(t.spark, f"{prefix}_{name}", t.path(name))
    listed = sorted(x.name for x in t.spark.catalog.listTables() if x.name.startswith(f"{prefix}_"))
    counts = []
    for name in listed:
        described = t.spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name IN ('Type', 'Provider')")
        facts = described.agg(
            F.max(F.when(F.col("col_name") == "Type", F.col("data_type"))).alias("kind"),
            F.max(F.when(F.col("col_name") == "Provider", F.col("data_type"))).alias("provider"),
        ).first()
        counts.append(
            t.spark.table(name).agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(name.removeprefix(f"{prefix}_")).alias("table_name"),
                F.lit(facts["kind"]).alias("kind"),
                F.lower(F.lit(facts["provider"])).alias("provider"),
                "n_rows",
            )
        )
    return reduce(DataFrame.union, counts)


@query(
    "compact_cluster",
    "SELECT event_id, user_id, event_type, value FROM events",
)
def compact_cluster(t: Tables):
    """Many small files rewritten as few, clustered by device and tag."""
    small, path = scratch_path(t.spark, "events-small"), scratch_path(t.spark, "events-compact")
    t.events.select("event_id", "user_id", "event_type", "value").repartition(32).write.parquet(small)
    compact(t.spark.read.parquet(small), path, ["user_id", "event_type"])
    return t.spark.read.parquet(path)


@query(
    "compact_by_curve",
    """
    SELECT c AS filtered_column, n_rows, TRUE AS half_skipped
    FROM (SELECT unnest(['user_id', 'event_type', 'ts']) AS c), (SELECT count(*) AS n_rows FROM events)
    """,
)
def compact_along_curve(t: Tables):
    """64 files along a curve over device, tag and time: a filter on any one of them skips half of the files."""
    small, path = scratch_path(t.spark, "events-small"), scratch_path(t.spark, "events-curve")
    t.events.write.parquet(small)
    columns = ["user_id", "event_type", "ts"]
    compact_by_curve(t.spark.read.parquet(small), path, columns, files=64)
    rows = t.spark.read.parquet(path)
    by_file = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        count_rows(),
        *[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("low", F.min), ("high", F.max), ("some", F.any_value))],
    )
    files = stored(by_file, "bounds")
    checks = []
    for c in columns:
        # Files whose bounds hold a value, for twenty of the values in the middle of a file.
        probes = [r[0] for r in files.select(F.col(f"some_{c}").alias("p")).distinct().orderBy("p").limit(20).collect()]
        held = [F.count_if(F.lit(p).between(F.col(f"low_{c}"), F.col(f"high_{c}"))) for p in probes]
        opened = sum(held, F.lit(0)) / F.lit(max(1, len(probes)))
        checks.append(
            files.agg(F.sum("n").alias("n_rows"), (2 * opened <= F.count(F.lit(1))).alias("half_skipped")).select(
                F.lit(c).alias("filtered_column"), "n_rows", "half_skipped"
            )
        )
    return reduce(DataFrame.union, checks)
