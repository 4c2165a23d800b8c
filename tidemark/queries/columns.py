"""Projection, filters, predicates and column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tidemark.functions.numbers import parse_reading, truncate_decimals
from tidemark.functions.times import sane_time, stamp
from tidemark.queries.registry import Tables, query


@query("project", "SELECT c_custkey, c_name FROM customer")
def project(t: Tables):
    return t.customer.select("c_custkey", F.col("c_name"))


def customers_with_geo(t: Tables):
    """Customers with a nested ``geo`` struct."""
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey",
        "c_mktsegment",
        "c_acctbal",
        F.struct(F.col("r_name").alias("region"), F.col("n_name").alias("nation")).alias("geo"),
    )


GEO_FROM = """
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""


@query("project_nested", f"SELECT c_custkey, n_name AS city, r_name AS state {GEO_FROM}")
def project_nested(t: Tables):
    return customers_with_geo(t).select(
        "c_custkey", F.col("geo.nation").alias("city"), F.col("geo.region").alias("state")
    )


@query("project_star_struct", f"SELECT r_name AS region, n_name AS nation {GEO_FROM}")
def project_star_struct(t: Tables):
    return customers_with_geo(t).select("geo.*")


@query(
    "project_expr",
    """
    SELECT c_custkey, c_mktsegment IN ('BUILDING', 'FURNITURE') AS home_segment,
           c_acctbal * 2 AS doubled
    FROM customer
    """,
)
def project_expr(t: Tables):
    return t.customer.selectExpr(
        "c_custkey",
        "c_mktsegment IN ('BUILDING', 'FURNITURE') AS home_segment",
        "c_acctbal * 2 AS doubled",
    )


@query("drop_columns", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def drop_columns(t: Tables):
    return t.customer.drop("c_nationkey").drop(F.col("c_mktsegment"))


@query(
    "with_column",
    """
    SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice,
           p_brand IN ('Brand#1', 'Brand#2') AS is_house_brand
    FROM part
    """,
)
def with_column(t: Tables):
    return t.part.withColumn("is_house_brand", F.col("p_brand").isin("Brand#1", "Brand#2"))


@query(
    "rename_column",
    "SELECT s_suppkey, s_name AS supplier_name, s_nationkey, s_acctbal FROM supplier",
)
def rename_column(t: Tables):
    return t.supplier.withColumnRenamed("s_name", "supplier_name")


@query(
    "filter_expr",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 100000 AND o_orderstatus = 'F'",
)
def filter_expr(t: Tables):
    return t.orders.filter("o_totalprice > 100000 AND o_orderstatus = 'F'").select(
        "o_orderkey", "o_totalprice"
    )


@query(
    "filter_column",
    """
    SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
    WHERE o_orderstatus <> 'P' AND o_orderpriority = '1-URGENT'
    """,
)
def filter_column(t: Tables):
    wanted = (F.col("o_orderstatus") != "P") & (F.col("o_orderpriority") == "1-URGENT")
    return t.orders.filter(wanted).select("o_orderkey", "o_orderstatus", "o_orderpriority")


UNWANTED_BRANDS = [f"Brand#{n}" for n in range(1, 11)]


@query(
    "filter_conjunction_chain",
    "SELECT p_partkey, p_brand FROM part WHERE "
    + " AND ".join(f"p_brand <> '{b}'" for b in UNWANTED_BRANDS),
)
def filter_conjunction_chain(t: Tables):
    """Ten chained filters; the optimiser makes one of them and pushes it down."""
    kept = reduce(lambda f, b: f.filter(F.col("p_brand") != b), UNWANTED_BRANDS, t.part)
    return kept.select("p_partkey", "p_brand")


@query(
    "pred_null",
    """
    SELECT doc_id, quality IS NULL AS unlabelled, quality IS NOT NULL AS labelled,
           isnan(CASE WHEN quality = 0 THEN 'nan'::DOUBLE ELSE quality END) IS TRUE AS not_a_number
    FROM documents LEFT JOIN labels USING (doc_id)
    """,
)
def pred_null(t: Tables):
    score = F.when(F.col("quality") == 0, float("nan")).otherwise(F.col("quality").cast("double"))
    return t.documents.select("doc_id").join(t.labels, "doc_id", "left").select(
        "doc_id",
        F.isnull("quality").alias("unlabelled"),
        F.col("quality").isNotNull().alias("labelled"),
        F.isnan(score).alias("not_a_number"),
    )


@query(
    "pred_in",
    "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')",
)
def pred_in(t: Tables):
    return t.customer.filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select(
        "c_custkey", "c_mktsegment"
    )


@query(
    "pred_like_prefix",
    "SELECT event_id, event_type FROM events WHERE event_type LIKE 'pur%'",
)
def pred_like_prefix(t: Tables):
    return t.events.filter(F.col("event_type").like("pur%")).select("event_id", "event_type")


@query(
    "pred_endswith",
    "SELECT p_partkey, p_name FROM part WHERE ends_with(p_name, 'ring')",
)
def pred_endswith(t: Tables):
    return t.part.filter(F.col("p_name").endswith("ring")).select("p_partkey", "p_name")


@query(
    "pred_time_range",
    """
    SELECT o_orderstatus,
           count(*) FILTER (o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01') AS half_open,
           count(*) FILTER (o_orderdate > TIMESTAMP '1996-01-01' AND o_orderdate <= TIMESTAMP '1997-01-01') AS half_closed
    FROM orders
    WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate <= TIMESTAMP '1997-01-01'
    GROUP BY 1
    """,
)
def pred_time_range(t: Tables):
    """``[start, end)`` as for raw readings and ``(start, end]`` as for period-end stamps."""
    ts = F.col("o_orderdate")
    start = F.lit("1996-01-01").cast("timestamp_ntz")
    end = F.lit("1997-01-01").cast("timestamp_ntz")
    return (
        t.orders.filter((ts >= start) & (ts <= end))
        .groupBy("o_orderstatus")
        .agg(
            F.count_if((ts >= start) & (ts < end)).alias("half_open"),
            F.count_if((ts > start) & (ts <= end)).alias("half_closed"),
        )
    )


@query(
    "pred_sane_time",
    """
    SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts
    FROM (SELECT event_id, CASE WHEN event_type = 'error' AND value > 50 THEN ts + INTERVAL 400 YEAR
                                WHEN event_type = 'error' THEN ts - INTERVAL 80 YEAR ELSE ts END AS ts
          FROM events)
    WHERE ts > TIMESTAMP '1970-01-01' AND ts < TIMESTAMP '2339-03-21 22:20:00'
    """,
)
def pred_sane_time(t: Tables):
    """Error readings get stamps 400 years late or 80 years early, and are then dropped."""
    is_error = F.col("event_type") == "error"
    ts = F.col("ts").cast("timestamp")
    shifted = (
        F.when(is_error & (F.col("value") > 50), ts + F.expr("interval 400 years"))
        .when(is_error, ts - F.expr("interval 80 years"))
        .otherwise(ts)
    )
    stamped = t.events.select("event_id", shifted.alias("ts"))
    return stamped.filter(sane_time(F.col("ts"))).select("event_id", stamp(F.col("ts")).alias("ts"))


@query(
    "arith",
    """
    SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge,
           l_extendedprice / l_quantity AS unit_price, l_quantity + 1 AS q_plus, l_quantity - 1 AS q_minus
    FROM lineitem
    """,
)
def arith(t: Tables):
    price, quantity = F.col("l_extendedprice"), F.col("l_quantity")
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        (price * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("charge"),
        (price / quantity).alias("unit_price"),
        (quantity + 1).alias("q_plus"),
        (quantity - 1).alias("q_minus"),
    )


@query(
    "cast_column",
    """
    SELECT o_orderkey, trunc(o_totalprice)::INTEGER AS price_int,
           trunc(o_totalprice * 100)::BIGINT AS price_long, o_custkey::DOUBLE AS cust_double,
           strftime(make_timestamp(epoch_us(o_orderdate)), '%Y-%m-%d %H:%M:%S') AS from_seconds,
           TRY_CAST(o_orderpriority AS INTEGER) AS not_a_number
    FROM orders
    """,
)
def cast_column(t: Tables):
    seconds = F.col("o_orderdate").cast("timestamp").cast("long")
    return t.orders.select(
        "o_orderkey",
        F.col("o_totalprice").cast("int").alias("price_int"),
        (F.col("o_totalprice") * 100).cast("long").alias("price_long"),
        F.col("o_custkey").cast("double").alias("cust_double"),
        stamp(seconds.cast("timestamp")).alias("from_seconds"),
        F.col("o_orderpriority").try_cast("int").alias("not_a_number"),
    )


@query(
    "alias_sort_expr",
    "SELECT s_suppkey AS supplier, s_acctbal AS balance FROM supplier",
)
def alias_sort_expr(t: Tables):
    return t.supplier.select(
        F.col("s_suppkey").alias("supplier"), F.col("s_acctbal").alias("balance")
    ).orderBy(F.col("balance").desc(), F.col("supplier").asc())


@query("literal", "SELECT c_custkey, TRUE AS converted, 'shop' AS origin, 1 AS weight FROM customer")
def literal(t: Tables):
    return t.customer.select(
        "c_custkey",
        F.lit(True).alias("converted"),
        F.lit("shop").alias("origin"),
        F.lit(1).alias("weight"),
    )


@query(
    "conditional",
    """
    SELECT event_id, CASE WHEN value IS NULL THEN 0.0::DOUBLE WHEN value > 100 THEN
             CASE WHEN event_type = 'error' THEN -1.0::DOUBLE ELSE 100.0::DOUBLE END ELSE value END AS bounded
    FROM events
    """,
)
def conditional(t: Tables):
    high = F.when(F.col("event_type") == "error", -1.0).otherwise(100.0)
    bounded = (
        F.when(F.col("value").isNull(), 0.0).when(F.col("value") > 100, high).otherwise(F.col("value"))
    )
    return t.events.select("event_id", bounded.alias("bounded"))


@query(
    "coalesce_nvl",
    """
    SELECT doc_id, coalesce(quality, toxic, -1) AS quality_or, coalesce(toxic, 9) AS toxic_or
    FROM documents LEFT JOIN labels USING (doc_id)
    """,
)
def coalesce_nvl(t: Tables):
    return t.documents.select("doc_id").join(t.labels, "doc_id", "left").select(
        "doc_id",
        F.coalesce("quality", "toxic", F.lit(-1)).alias("quality_or"),
        F.nvl("toxic", F.lit(9)).alias("toxic_or"),
    )


def reading_text():
    """Sensor text as devices send it: numbers, booleans, junk and nothing."""
    kind = F.col("event_type")
    return (
        F.when(kind == "click", F.when(F.col("value") > 50, "true").otherwise("false"))
        .when(kind == "error", "abc")
        .when(kind == "signup", F.lit(None).cast("string"))
        .otherwise(F.col("value").cast("string"))
    )


@query(
    "parse_numeric_or_bool",
    """
    SELECT event_id, CASE event_type WHEN 'click' THEN CASE WHEN value > 50 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
                                     WHEN 'error' THEN NULL WHEN 'signup' THEN NULL ELSE value END AS reading
    FROM events
    """,
)
def parse_numeric_or_bool(t: Tables):
    return t.events.select("event_id", parse_reading(reading_text()).alias("reading"))


@query(
    "truncate_decimals",
    "SELECT o_orderkey, trunc(o_totalprice / 7 * 100)::BIGINT / 100 AS cut FROM orders",
)
def truncated(t: Tables):
    return t.orders.select(
        "o_orderkey", truncate_decimals(F.col("o_totalprice") / 7, 2).alias("cut")
    )
