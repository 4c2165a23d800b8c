"""UDF forms and data-frame idioms."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.text import first_letter
from tidemark.functions.times import weekday_label
from tidemark.functions.udfs import (
    first_letter_udf,
    first_letter_vectorised,
    register_udfs,
    weekday_label_udf,
)
from tidemark.operators.aggregates import count_rows
from tidemark.queries.registry import Tables, query

LETTERS_SQL = "SELECT c_custkey, substr(c_mktsegment, 1, 1) AS letter FROM customer"
WEEKDAY_SQL = """
    CASE strftime(ts, '%a') WHEN 'Mon' THEN '1-Mon' WHEN 'Tue' THEN '2-Tue' WHEN 'Wed' THEN '3-Wed'
        WHEN 'Thu' THEN '4-Thu' WHEN 'Fri' THEN '5-Fri' WHEN 'Sat' THEN '6-Sat' ELSE '7-Sun' END
"""


@query("udf_scalar", LETTERS_SQL)
def udf_scalar(t: Tables):
    return t.customer.select("c_custkey", first_letter_udf("c_mktsegment").alias("letter"))


@query("udf_decorator", f"SELECT event_id, {WEEKDAY_SQL} AS weekday FROM events")
def udf_decorator(t: Tables):
    return t.events.select("event_id", weekday_label_udf(F.date_format("ts", "E")).alias("weekday"))


@query("udf_sql", LETTERS_SQL)
def udf_sql(t: Tables):
    register_udfs(t.spark)
    t.views("customer")
    return t.spark.sql("SELECT c_custkey, first_letter(c_mktsegment) AS letter FROM customer")


@query("udf_pandas", LETTERS_SQL)
def udf_pandas(t: Tables):
    return t.customer.select("c_custkey", first_letter_vectorised("c_mktsegment").alias("letter"))


@query("udf_pandas_sql", LETTERS_SQL)
def udf_pandas_sql(t: Tables):
    register_udfs(t.spark)
    t.views("customer")
    return t.spark.sql("SELECT c_custkey, first_letter_vec(c_mktsegment) AS letter FROM customer")


@query("udf_native_twin", LETTERS_SQL)
def udf_native_twin(t: Tables):
    """The same letters without leaving the JVM: the form to use in jobs."""
    return t.customer.select("c_custkey", first_letter(F.col("c_mktsegment")).alias("letter"))


@query("label_weekday", f"SELECT event_id, {WEEKDAY_SQL} AS weekday FROM events")
def label_weekday(t: Tables):
    return t.events.select("event_id", weekday_label(F.date_format("ts", "E")).alias("weekday"))


@query("value_counts", "SELECT p_type, count(*) AS n FROM part GROUP BY 1")
def value_counts(t: Tables):
    return t.part.groupBy("p_type").agg(count_rows()).orderBy(F.desc("n"), "p_type")


@query("distinct_values_sql", "SELECT DISTINCT o_orderpriority FROM orders")
def distinct_values_sql(t: Tables):
    t.views("orders")
    return t.spark.sql("SELECT DISTINCT(o_orderpriority) FROM orders")


@query(
    "filter_and_group_top",
    """
    SELECT l_suppkey, round(avg(l_extendedprice), 4) AS avg_price FROM lineitem
    WHERE l_returnflag = 'N' AND year(l_shipdate) = 1998 GROUP BY 1 ORDER BY avg(l_extendedprice) DESC, 1 LIMIT 10
    """,
)
def filter_and_group_top(t: Tables):
    """Mean price per supplier for one flag and year: the ten highest."""
    ship = F.col("l_shipdate")
    year_1998 = (ship >= F.lit("1998-01-01").cast("timestamp_ntz")) & (
        ship < F.lit("1999-01-01").cast("timestamp_ntz")
    )
    means = (
        t.lineitem.filter((F.col("l_returnflag") == "N") & year_1998)
        .groupBy("l_suppkey")
        .agg(F.avg("l_extendedprice").alias("mean"))
    )
    best = means.orderBy(F.desc("mean"), "l_suppkey").limit(10)
    return best.select("l_suppkey", F.round("mean", 4).alias("avg_price"))


@query(
    "count_items",
    "SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY 1",
)
def count_items(t: Tables):
    """How often each word occurs in all documents."""
    found = t.documents.select(F.explode(F.split("text", " ")).alias("word"))
    return found.groupBy("word").agg(count_rows())
