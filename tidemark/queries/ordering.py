"""Sorts, limits, top-k and set operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.frequent import top_values
from tidemark.operators.joins import common_members
from tidemark.queries.registry import Tables, query


@query("sort_multi", "SELECT o_orderstatus, o_totalprice, o_orderkey FROM orders")
def sort_multi(t: Tables):
    return t.orders.select("o_orderstatus", "o_totalprice", "o_orderkey").orderBy(
        F.col("o_orderstatus").asc(), F.col("o_totalprice").desc(), "o_orderkey"
    )


@query(
    "sort_nulls_last",
    "SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id)",
)
def sort_nulls_last(t: Tables):
    """Descending with unlabelled documents at the end."""
    scored = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return scored.select("doc_id", "quality").orderBy(F.col("quality").desc_nulls_last(), "doc_id")


@query(
    "limit_rows",
    "SELECT c_custkey, c_name FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 20",
)
def limit_rows(t: Tables):
    return t.customer.orderBy(F.desc("c_acctbal"), "c_custkey").limit(20).select("c_custkey", "c_name")


@query(
    "top_k",
    """
    SELECT l_suppkey, round(sum(l_extendedprice), 2) AS revenue FROM lineitem
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10
    """,
)
def top_k(t: Tables):
    revenue = F.round(F.sum("l_extendedprice"), 2).alias("revenue")
    return t.lineitem.groupBy("l_suppkey").agg(revenue).orderBy(F.desc("revenue"), "l_suppkey").limit(10)


@query(
    "top_k_values",
    "SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
)
def top_k_values(t: Tables):
    """The suppliers with the most lines: summaries of the tasks name candidates, which are then counted."""
    return top_values(t.lineitem, "l_suppkey", 10)


@query(
    "top_words",
    r"""
    SELECT word, count(*) AS n FROM (SELECT unnest(string_split_regex(lower(text), '[^a-z]+')) AS word FROM documents)
    WHERE word <> '' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20
    """,
)
def top_words(t: Tables):
    """The commonest words of all texts: far more values than a task's summary of 500 holds."""
    words = t.documents.select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("word")).filter("word <> ''")
    return top_values(words, "word", 20, size=500)


@query(
    "tail_rows",
    "SELECT event_id, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 25",
)
def tail_rows(t: Tables):
    """Last rows of an order: the first rows of its reverse."""
    return t.events.orderBy(F.desc("ts"), F.desc("event_id")).limit(25).select("event_id", "value")


@query(
    "action_count_take",
    """
    SELECT count(*) AS n, min(o_orderkey) AS first_key, min(o_orderkey) AS head_key,
           (SELECT sum(o_orderkey)::BIGINT FROM (SELECT o_orderkey FROM orders ORDER BY 1 LIMIT 5)) AS taken,
           (SELECT sum(o_orderkey)::BIGINT FROM (SELECT o_orderkey FROM orders ORDER BY 1 DESC LIMIT 5)) AS last,
           (SELECT count(*) FROM (SELECT DISTINCT o_orderpriority FROM orders)) AS collected
    FROM orders
    """,
)
def action_count_take(t: Tables):
    """The actions that bring few rows to the driver, and a count."""
    keys = t.orders.select("o_orderkey").orderBy("o_orderkey")
    row = (
        t.orders.count(),
        keys.first()["o_orderkey"],
        keys.head()["o_orderkey"],
        sum(r["o_orderkey"] for r in keys.take(5)),
        sum(r["o_orderkey"] for r in keys.tail(5)),
        len(t.orders.select("o_orderpriority").distinct().collect()),
    )
    return t.spark.createDataFrame(
        [row], "n long, first_key long, head_key long, taken long, last long, collected long"
    )


@query(
    "union_all",
    "SELECT c_nationkey AS nationkey FROM customer UNION ALL SELECT s_nationkey FROM supplier",
)
def union_all(t: Tables):
    customers = t.customer.select(F.col("c_nationkey").alias("nationkey"))
    return customers.union(t.supplier.select("s_nationkey"))


@query(
    "union_distinct",
    "SELECT l_partkey AS partkey FROM lineitem WHERE l_quantity > 45 UNION SELECT p_partkey FROM part WHERE p_size > 40",
)
def union_distinct(t: Tables):
    large = t.lineitem.filter("l_quantity > 45").select(F.col("l_partkey").alias("partkey"))
    return large.union(t.part.filter("p_size > 40").select("p_partkey")).distinct()


@query(
    "union_by_name",
    """
    SELECT c_name AS name, c_acctbal AS balance, 'customer' AS kind FROM customer
    UNION ALL SELECT s_name, s_acctbal, 'supplier' FROM supplier
    """,
)
def union_by_name(t: Tables):
    customers = t.customer.select(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.lit("customer").alias("kind")
    )
    suppliers = t.supplier.select(
        F.lit("supplier").alias("kind"), F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name")
    )
    return customers.unionByName(suppliers)


@query(
    "intersect_sets",
    """
    SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A'
    INTERSECT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'N'
    INTERSECT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R'
    """,
)
def intersect_sets(t: Tables):
    """Parts seen with every return flag."""
    sets = [t.lineitem.filter(F.col("l_returnflag") == flag) for flag in ("A", "N", "R")]
    return common_members(sets, "l_partkey")
