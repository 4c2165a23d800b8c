"""Math functions and scalar ladders."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.numbers import divide_or_null, is_leap_year, ladder
from tidemark.queries.registry import Tables, query


@query("math_ceil", "SELECT o_orderkey, ceil(o_totalprice)::BIGINT AS up FROM orders")
def math_ceil(t: Tables):
    return t.orders.select("o_orderkey", F.ceil("o_totalprice").alias("up"))


@query("math_cos", "SELECT event_id, round(cos(value), 8) AS cosine FROM events")
def math_cos(t: Tables):
    return t.events.select("event_id", F.round(F.cos("value"), 8).alias("cosine"))


@query(
    "math_log",
    "SELECT event_id, CASE WHEN value > 0 THEN round(ln(value), 8) END AS natural_log FROM events",
)
def math_log(t: Tables):
    """Natural logarithm; null where there is none."""
    return t.events.select("event_id", F.round(F.log("value"), 8).alias("natural_log"))


@query("math_sqrt", "SELECT event_id, sqrt(value) AS root FROM events")
def math_sqrt(t: Tables):
    return t.events.select("event_id", F.sqrt("value").alias("root"))


@query(
    "math_round",
    "SELECT o_orderkey, round(o_totalprice / 7, 3) AS three, round(o_totalprice / 7) AS whole, round(o_totalprice / 7, -2) AS hundreds FROM orders",
)
def math_round(t: Tables):
    share = F.col("o_totalprice") / 7
    return t.orders.select(
        "o_orderkey",
        F.round(share, 3).alias("three"),
        F.round(share).alias("whole"),
        F.round(share, -2).alias("hundreds"),
    )


@query("math_rand", "SELECT o_orderkey, TRUE AS in_unit_interval FROM orders")
def math_rand(t: Tables):
    """A seeded uniform number per row; only its range is fit to compare."""
    drawn = t.orders.select("o_orderkey", F.rand(42).alias("u"))
    return drawn.select("o_orderkey", F.col("u").between(0, 1).alias("in_unit_interval"))


@query("math_mod", "SELECT o_orderkey, (o_custkey % 3)::BIGINT AS rest3, o_custkey % 2 = 0 AS is_even FROM orders")
def math_mod(t: Tables):
    return t.orders.select(
        "o_orderkey",
        (F.col("o_custkey") % 3).alias("rest3"),
        (F.col("o_custkey") % 2 == 0).alias("is_even"),
    )


@query(
    "derive_scaled",
    """
    SELECT p_partkey, p_size * 7 AS seven_fold, p_size * 3 - 1 AS shifted,
           p_retailprice * 0.75::DOUBLE AS other_currency
    FROM part
    """,
)
def derive_scaled(t: Tables, rate: float = 0.75):
    return t.part.select(
        "p_partkey",
        (F.col("p_size") * 7).alias("seven_fold"),
        (F.col("p_size") * 3 - 1).alias("shifted"),
        (F.col("p_retailprice") * rate).alias("other_currency"),
    )


@query(
    "case_ladder",
    """
    SELECT o_orderkey, CASE WHEN o_totalprice < 100000 THEN 'low' WHEN o_totalprice < 300000 THEN 'middle' ELSE 'high' END AS band,
           CASE WHEN o_custkey % 15 = 0 THEN 'FizzBuzz' WHEN o_custkey % 3 = 0 THEN 'Fizz'
                WHEN o_custkey % 5 = 0 THEN 'Buzz' ELSE o_custkey::VARCHAR END AS fizz,
           (year(o_orderdate) % 4 = 0 AND year(o_orderdate) % 100 <> 0) OR year(o_orderdate) % 400 = 0 AS leap
    FROM orders
    """,
)
def case_ladder(t: Tables):
    price, n = F.col("o_totalprice"), F.col("o_custkey")
    return t.orders.select(
        "o_orderkey",
        ladder([(price < 100_000, "low"), (price < 300_000, "middle")], "high").alias("band"),
        ladder(
            [(n % 15 == 0, "FizzBuzz"), (n % 3 == 0, "Fizz"), (n % 5 == 0, "Buzz")], n.cast("string")
        ).alias("fizz"),
        is_leap_year(F.year("o_orderdate")).alias("leap"),
    )


@query(
    "safe_divide",
    "SELECT l_orderkey, l_linenumber, l_extendedprice / nullif(l_discount, 0) AS ratio FROM lineitem",
)
def safe_divide(t: Tables):
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        divide_or_null(F.col("l_extendedprice"), F.col("l_discount")).alias("ratio"),
    )
