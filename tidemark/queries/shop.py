"""Sales, clickstream and people questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.text import folded
from tidemark.functions.times import WEEKDAY_LABELS
from tidemark.operators.aggregates import keep_first_copy
from tidemark.operators.joins import salted_join
from tidemark.plans.clickstream import (
    abandoned_items,
    converted_flags,
    options_per_customer,
    product_options,
    revenue_by_source,
    weekday_active_users,
    with_revenue,
)
from tidemark.queries.registry import Tables, query
from tidemark.session import scratch_path
from tidemark.sources.readers import read_delimited
from tidemark.sources.writers import write_csv


@query(
    "revenue_by_source",
    """
    SELECT c_mktsegment, round(sum(o_totalprice), 2) AS total_rev, round(avg(o_totalprice), 4) AS avg_rev
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1 ORDER BY sum(o_totalprice) DESC LIMIT 3
    """,
)
def best_sources(t: Tables):
    """The three segments with most revenue."""
    users = t.customer.withColumnRenamed("c_custkey", "o_custkey")
    best = revenue_by_source(t.orders, users, "o_custkey", "c_mktsegment", "o_totalprice", 3)
    return best.select(
        "c_mktsegment",
        F.round("total_rev", 2).alias("total_rev"),
        F.round("avg_rev", 4).alias("avg_rev"),
    )


@query(
    "active_users",
    f"""
    SELECT CASE strftime(day, '%a') {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in WEEKDAY_LABELS.items())} END AS weekday,
           round(avg(n), 6) AS avg_users
    FROM (SELECT ts::DATE AS day, count(DISTINCT user_id) AS n FROM events GROUP BY 1) GROUP BY 1
    """,
)
def weekday_active(t: Tables):
    """Mean number of different users per day, by weekday."""
    active = weekday_active_users(t.events, "ts", "user_id")
    return active.select("weekday", F.round("avg_users", 6).alias("avg_users"))


def cart_rows(t: Tables):
    """One cart per user and day; its items are the products clicked or viewed."""
    return t.events.filter(F.col("event_type").isin("click", "view")).select(
        "user_id",
        F.to_date("ts").alias("day"),
        F.from_json("props", "k bigint").getField("k").alias("item"),
    )


@query(
    "abandoned_carts",
    """
    WITH carts AS (SELECT DISTINCT user_id, ts::DATE AS day, json_extract(props, '$.k')::BIGINT AS item
                   FROM events WHERE event_type IN ('click', 'view')),
    bought AS (SELECT DISTINCT user_id, ts::DATE AS day FROM events WHERE event_type = 'purchase')
    SELECT item, count(*) AS n_carts FROM carts LEFT JOIN bought b USING (user_id, day)
    WHERE NOT EXISTS (SELECT 1 FROM bought x WHERE x.user_id = carts.user_id AND x.day = carts.day) GROUP BY 1
    """,
)
def abandoned_carts(t: Tables):
    purchases = t.events.filter("event_type = 'purchase'").select(
        "user_id", F.to_date("ts").alias("day")
    )
    return abandoned_items(cart_rows(t), purchases, ["user_id", "day"], "item")


@query(
    "conversions",
    """
    SELECT c_custkey AS custkey, c_name, o_custkey IS NOT NULL AS converted
    FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
    ON c_custkey = o_custkey
    """,
)
def conversions(t: Tables):
    """Every customer, and whether there was an urgent order."""
    users = t.customer.select(F.col("c_custkey").alias("custkey"), "c_name")
    buyers = t.orders.filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("custkey"))
    return converted_flags(users, buyers, "custkey")


@query(
    "customer_options",
    """
    WITH items AS (SELECT DISTINCT o_custkey AS customer, p_type, split_part(p_name, ' ', 1) AS first_word,
                          split_part(p_name, ' ', 2) AS second_word
                   FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey),
    options AS (SELECT customer, first_word AS size, p_type AS quality FROM items WHERE second_word = 'ring'
                UNION ALL SELECT customer, p_type, first_word FROM items WHERE second_word = 'bolt')
    SELECT customer, array_to_string(list_sort(list(DISTINCT size)), ',') AS size_options,
           array_to_string(list_sort(list(DISTINCT quality)), ',') AS quality_options
    FROM options GROUP BY 1
    """,
)
def customer_options(t: Tables):
    """Sizes and qualities each customer bought, from two families with other word orders."""
    products = t.part.select("p_partkey", F.concat_ws(" ", "p_type", "p_name").alias("item_name"))
    rings = product_options(products, "item_name", "ring", quality_position=1, size_position=2)
    bolts = product_options(products, "item_name", "bolt", quality_position=2, size_position=1)
    # Both families in one product table, so the fact tables are joined once.
    products = rings.unionByName(bolts).withColumnRenamed("p_partkey", "l_partkey").drop("item_name")
    lines = t.lineitem.select("l_partkey", "l_orderkey", "l_linenumber")
    items = salted_join(lines, products, ["l_partkey"])
    orders = t.orders.select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("customer")
    )
    options = options_per_customer(items, orders, "l_orderkey", "customer")
    return options.select(
        "customer",
        *[F.array_join(c, ",").alias(c) for c in ("size_options", "quality_options")],
    )


@query(
    "dedup_people",
    """
    SELECT min(doc_id) AS doc_id, source, lang FROM documents
    GROUP BY source, lang, trim(regexp_replace(replace(lower(text), '-', ''), ' +', ' ', 'g'), ' ')
    """,
)
def dedup_people(t: Tables):
    """One row per record that differs in more than case, hyphens and blanks; formats kept."""
    path = scratch_path(t.spark, "people")
    records = t.documents.select("doc_id", "source", "lang", "text")
    kept = keep_first_copy(records, "doc_id", F.col("source"), F.col("lang"), folded(F.col("text")))
    kept.write.parquet(path)
    return t.spark.read.parquet(path).select("doc_id", "source", "lang")


@query(
    "purchase_revenue",
    "SELECT event_id, user_id, event_type, value AS revenue FROM events WHERE event_type = 'purchase' AND value IS NOT NULL",
)
def purchase_revenue(t: Tables):
    """Revenue of the events that have one."""
    events = t.events.select("event_id", "user_id", "event_type", "value")
    return with_revenue(events.filter("event_type = 'purchase'"), F.col("value"), "value")


@query(
    "names_by_year",
    """
    SELECT year(o_orderdate)::INTEGER AS order_year, c_name, count(*) AS n
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE year(o_orderdate) = 1998 GROUP BY ALL
    """,
)
def names_by_year(t: Tables, year: int = 1998):
    """A CSV of names and years, read with inference, filtered by a chosen year."""
    path = scratch_path(t.spark, "names")
    per_customer = t.orders.groupBy(F.year("o_orderdate").alias("order_year"), "o_custkey").count()
    named = per_customer.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    write_csv(named.groupBy("order_year", "c_name").agg(F.sum("count").alias("n")), path)
    names = read_delimited(t.spark, path)
    return names.filter(F.col("order_year") == year).withColumn("n", F.col("n").cast("bigint"))


@query("years_listed", "SELECT DISTINCT year(o_orderdate)::INTEGER AS order_year FROM orders")
def years_listed(t: Tables):
    """The years to choose from, in order."""
    return t.orders.select(F.year("o_orderdate").alias("order_year")).distinct().orderBy("order_year")
