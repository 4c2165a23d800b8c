"""Reading: Parquet, delimited text, JSON, SQL text, generated and literal rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.queries.registry import Tables, query
from tidemark.session import scratch_path
from tidemark.sources.readers import (
    parts_of_size,
    read_delimited,
    read_json,
    schema_as_ddl,
    stride_scans,
    with_source_file,
)
from tidemark.sources.writers import write_csv, write_documents, write_json, write_parquet


@query(
    "scan_parquet",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders",
)
def scan_parquet(t: Tables):
    return t.orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
    )


@query(
    "scan_csv_infer",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def scan_csv_infer(t: Tables):
    path = scratch_path(t.spark, "customer-tsv")
    write_csv(t.customer, path, sep="\t")
    # Inference picks the narrowest type that fits, so the key may come back as int.
    read = read_delimited(t.spark, path, sep="\t")
    return read.withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@query(
    "scan_csv_schema",
    "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part",
)
def scan_csv_schema(t: Tables):
    path = scratch_path(t.spark, "part-csv")
    write_csv(t.part, path)
    return read_delimited(t.spark, path, schema=t.part.schema)


@query("scan_csv_ddl", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def scan_csv_ddl(t: Tables):
    path = scratch_path(t.spark, "supplier-csv")
    write_csv(t.supplier, path)
    ddl = "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"
    return read_delimited(t.spark, path, schema=ddl)


@query("scan_csv_quoted", "SELECT doc_id, lang, source, n_chars, text FROM documents")
def scan_csv_quoted(t: Tables):
    path = scratch_path(t.spark, "documents-csv")
    write_csv(t.documents, path)
    return read_delimited(t.spark, path, schema=t.documents.schema, quoted_newlines=True).select(
        "doc_id", "lang", "source", "n_chars", "text"
    )


@query("scan_colon_sep", "SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer")
def scan_colon_sep(t: Tables):
    path = scratch_path(t.spark, "customer-colon")
    write_csv(t.customer.select("c_custkey", "c_name", "c_mktsegment", "c_acctbal"), path, sep=":")
    ddl = "c_custkey bigint, c_name string, c_mktsegment string, c_acctbal double"
    return read_delimited(t.spark, path, schema=ddl, sep=":")


@query(
    "scan_json_infer",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders",
)
def scan_json_infer(t: Tables):
    path = scratch_path(t.spark, "orders-json")
    write_json(t.orders.drop("o_orderdate"), path)
    return read_json(t.spark, path)


def _nested_lines(t: Tables):
    """Line items as documents with a nested struct and an array of structs."""
    item = t.lineitem
    amounts = [
        F.struct(F.lit(n).alias("name"), F.col(c).alias("amount"))
        for n, c in (("discount", "l_discount"), ("price", "l_extendedprice"), ("tax", "l_tax"))
    ]
    return item.select(
        F.struct(F.col("l_orderkey").alias("key"), F.col("l_linenumber").alias("line")).alias("order"),
        F.col("l_quantity").alias("quantity"),
        F.array(*amounts).alias("amounts"),
    )


@query(
    "scan_json_schema",
    """
    SELECT l_orderkey AS order_key, l_linenumber AS line, l_quantity AS quantity,
           l_discount AS discount, l_extendedprice AS price, l_tax AS tax
    FROM lineitem
    """,
)
def scan_json_schema(t: Tables):
    path = scratch_path(t.spark, "lineitem-json")
    write_json(_nested_lines(t), path)
    ddl = """order struct<key: bigint, line: int>, quantity double,
             amounts array<struct<name: string, amount: double>>"""
    return read_json(t.spark, path, schema=ddl).select(
        F.col("order.key").alias("order_key"),
        F.col("order.line").alias("line"),
        "quantity",
        *[F.col("amounts")[i]["amount"].alias(n) for i, n in enumerate(("discount", "price", "tax"))],
    )


@query(
    "scan_json_multiline",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def scan_json_multiline(t: Tables):
    """Indented JSON documents, one per file, each an array of up to 10,000 customers."""
    path = scratch_path(t.spark, "customer-documents")
    write_documents(t.customer, path, rows_per_document=10_000)
    return read_json(t.spark, path, schema=t.customer.schema, whole_document=True)


@query(
    "schema_to_ddl",
    "SELECT p_partkey, p_name, p_brand, p_type, p_size::BIGINT AS p_size, p_retailprice FROM part",
)
def schema_to_ddl(t: Tables):
    """Infer a JSON schema once, keep it as DDL text, read with the text."""
    path = scratch_path(t.spark, "part-json")
    write_json(t.part, path)
    ddl = schema_as_ddl(read_json(t.spark, path))
    return read_json(t.spark, path, schema=ddl)


@query("scan_table", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def scan_table(t: Tables):
    t.views("orders")
    return t.spark.table("orders").select("o_orderkey", "o_totalprice", "o_orderstatus")


@query(
    "scan_sql",
    """
    SELECT p_brand, p_name, p_retailprice FROM part WHERE p_retailprice > 950
    """,
)
def scan_sql(t: Tables):
    t.views("part")
    return t.spark.sql(
        "SELECT p_brand, p_name, p_retailprice FROM part WHERE p_retailprice > 950 "
        "ORDER BY p_retailprice, p_partkey"
    )


@query(
    "scan_range",
    """
    SELECT coalesce(m, k) AS month_number, coalesce(n, 0) AS n_orders
    FROM generate_series(0, 119) AS g(m)
    FULL JOIN (SELECT (year(o_orderdate) - 1992) * 12 + month(o_orderdate) - 1 AS k, count(*) AS n
               FROM orders GROUP BY 1) ON k = m
    """,
)
def scan_range(t: Tables):
    """Orders per month of ten years, months without orders included, and of other months with any."""
    month = (F.year("o_orderdate") - 1992) * 12 + F.month("o_orderdate") - 1
    counts = t.orders.groupBy(month.cast("bigint").alias("month_number")).count()
    months = t.spark.range(0, 120, 1).select(F.col("id").alias("month_number"))
    return months.join(counts, "month_number", "full").select(
        "month_number", F.coalesce("count", F.lit(0)).cast("bigint").alias("n_orders")
    )


@query(
    "scan_literal",
    """
    SELECT symbol, shares, round(avg(l_extendedprice), 4) AS avg_price
    FROM (VALUES ('A', 3750.0::DOUBLE), ('N', 6750.0::DOUBLE), ('R', 4500.0::DOUBLE)) s(symbol, shares)
    JOIN lineitem ON l_returnflag = symbol GROUP BY ALL
    """,
)
def scan_literal(t: Tables):
    """Rows given by the driver program, joined with per-symbol means."""
    held = t.spark.createDataFrame(
        [("A", 3750.0), ("N", 6750.0), ("R", 4500.0)], "symbol string, shares double"
    )
    means = t.lineitem.groupBy(F.col("l_returnflag").alias("symbol")).agg(
        F.round(F.avg("l_extendedprice"), 4).alias("avg_price")
    )
    return held.join(means, "symbol")


@query(
    "source_file_path",
    "SELECT o_orderkey, o_orderstatus AS status_in_path FROM orders",
)
def source_file_path(t: Tables):
    path = scratch_path(t.spark, "orders-by-status")
    write_parquet(t.orders.select("o_orderkey", "o_orderstatus"), path, partition_by=["o_orderstatus"])
    read = with_source_file(t.spark.read.parquet(path))
    folder = F.regexp_extract("source_file", r"o_orderstatus=([^/]+)/", 1)
    return read.select("o_orderkey", folder.alias("status_in_path"))


@query(
    "jdbc_partitioned_scan",
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE o_orderstatus <> 'P' AND o_totalprice > 1000
    """,
)
def jdbc_partitioned_scan(t: Tables):
    """A filtered table read in strides of its key: both filters reach each of the scans.

    The bounds come from the key, the number of scans from the files' bytes, 64 at most.
    """
    low, high = t.orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    wanted = t.orders.filter("o_orderstatus <> 'P' AND o_totalprice > 1000")
    n = min(64, max(8, parts_of_size(wanted, 128 << 20)))
    return stride_scans(wanted, "o_orderkey", low or 0, high or 0, n).select("o_orderkey", "o_custkey", "o_totalprice")
