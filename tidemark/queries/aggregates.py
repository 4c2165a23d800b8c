"""Aggregation, distinct and deduplication."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import functions as F

from tidemark.functions.text import folded
from tidemark.operators.aggregates import (
    box_stats,
    count_rows,
    describe_columns,
    first_in_order,
    first_rows,
    histogram,
    keep_first_copy,
    last_in_order,
    linear_fit,
    mode_per_group,
    null_counts,
)
from tidemark.queries.columns import GEO_FROM, customers_with_geo
from tidemark.operators.joins import left_lookup
from tidemark.queries.registry import Tables, query

@query("group_count", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def group_count(t: Tables):
    return t.orders.groupBy("o_orderpriority").agg(count_rows())


@query(
    "group_nested_key",
    f"SELECT r_name AS region, n_name AS nation, count(*) AS n, round(sum(c_acctbal), 2) AS total {GEO_FROM} GROUP BY ALL",
)
def group_nested_key(t: Tables):
    return (
        customers_with_geo(t)
        .groupBy("geo.region", "geo.nation")
        .agg(count_rows(), F.round(F.sum("c_acctbal"), 2).alias("total"))
    )


def _shorthand(name: str, method: str, sql_function: str, places: int):
    @query(
        name,
        f"SELECT l_returnflag, round({sql_function}(l_quantity), {places}) AS quantity, "
        f"round({sql_function}(l_extendedprice), {places}) AS price FROM lineitem GROUP BY 1",
    )
    def run(t: Tables):
        grouped = t.lineitem.groupBy("l_returnflag")
        result = getattr(grouped, method)("l_quantity", "l_extendedprice")
        named = result.toDF("l_returnflag", "quantity", "price")
        return named.select(
            "l_returnflag", *[F.round(c, places).alias(c) for c in ("quantity", "price")]
        )

    return run


group_avg = _shorthand("group_avg", "avg", "avg", 6)
group_mean = _shorthand("group_mean", "mean", "avg", 6)
group_sum = _shorthand("group_sum", "sum", "sum", 2)
group_min = _shorthand("group_min", "min", "min", 2)
group_max = _shorthand("group_max", "max", "max", 2)


@query(
    "agg_multi",
    """
    SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty,
           round(sum(l_extendedprice), 2) AS sum_price,
           round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price,
           round(avg(l_discount), 6) AS avg_disc, count(*) AS n
    FROM lineitem GROUP BY 1, 2
    """,
)
def agg_multi(t: Tables):
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_quantity"), 2).alias("sum_qty"),
        F.round(F.sum("l_extendedprice"), 2).alias("sum_price"),
        F.round(F.sum(net), 2).alias("sum_disc_price"),
        F.round(F.avg("l_discount"), 6).alias("avg_disc"),
        count_rows(),
    )


@query(
    "agg_pivot",
    """
    SELECT o_orderpriority, round(sum(o_totalprice) FILTER (o_orderstatus = 'F'), 2) AS "F",
           round(sum(o_totalprice) FILTER (o_orderstatus = 'O'), 2) AS "O",
           round(sum(o_totalprice) FILTER (o_orderstatus = 'P'), 2) AS "P"
    FROM orders GROUP BY 1
    """,
)
def agg_pivot(t: Tables):
    """Values are named, so no extra job looks for them."""
    return (
        t.orders.groupBy("o_orderpriority")
        .pivot("o_orderstatus", ["F", "O", "P"])
        .agg(F.round(F.sum("o_totalprice"), 2))
    )


@query(
    "agg_approx_distinct",
    """
    SELECT event_type, count(DISTINCT user_id) AS exact_users, TRUE AS approx_within_5_percent
    FROM events GROUP BY 1
    """,
)
def agg_approx_distinct(t: Tables):
    """The sketch's answer against the exact one.

    Each in a frame of its own: in one aggregate the exact one would carry the
    sketch along for every single user.
    """
    by_type = t.events.groupBy("event_type")
    exact = by_type.agg(F.count_distinct("user_id").alias("exact_users"))
    approx = by_type.agg(F.approx_count_distinct("user_id", 0.01).alias("approx_users"))
    both = left_lookup(exact, approx, ["event_type"])
    gap = F.abs(F.col("approx_users") - F.col("exact_users")) / F.col("exact_users")
    return both.select("event_type", "exact_users", (gap <= 0.05).alias("approx_within_5_percent"))


@query(
    "agg_collect_list",
    """
    SELECT o_custkey, array_to_string(list_sort(list(n)), ',') AS counts
    FROM (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2) GROUP BY 1
    """,
)
def agg_collect_list(t: Tables):
    """Each customer's order counts by priority, repeats kept: at most one per priority."""
    counts = t.orders.groupBy("o_custkey", "o_orderpriority").agg(count_rows())
    listed = counts.groupBy("o_custkey").agg(F.array_sort(F.collect_list("n")).alias("list"))
    return listed.select("o_custkey", F.array_join(F.col("list").cast("array<string>"), ",").alias("counts"))


@query(
    "agg_collect_set",
    """
    SELECT o_custkey, array_to_string(list_sort(list(DISTINCT o_orderpriority)), ',') AS priorities
    FROM orders GROUP BY 1
    """,
)
def agg_collect_set(t: Tables):
    return t.orders.groupBy("o_custkey").agg(
        F.array_join(F.array_sort(F.collect_set("o_orderpriority")), ",").alias("priorities")
    )


@query(
    "agg_corr",
    "SELECT l_returnflag, round(corr(l_quantity, l_extendedprice), 6) AS r FROM lineitem GROUP BY 1",
)
def agg_corr(t: Tables):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.round(F.corr("l_quantity", "l_extendedprice"), 6).alias("r")
    )


@query(
    "agg_stddev_samp",
    "SELECT l_returnflag, round(stddev_samp(l_quantity), 6) AS sd FROM lineitem GROUP BY 1",
)
def agg_stddev_samp(t: Tables):
    return t.lineitem.groupBy("l_returnflag").agg(F.round(F.stddev_samp("l_quantity"), 6).alias("sd"))


@query(
    "agg_var_pop",
    "SELECT l_returnflag, round(var_pop(l_quantity), 6) AS variance FROM lineitem GROUP BY 1",
)
def agg_var_pop(t: Tables):
    return t.lineitem.groupBy("l_returnflag").agg(F.round(F.var_pop("l_quantity"), 6).alias("variance"))


@query(
    "agg_sum_distinct",
    "SELECT l_returnflag, round(sum(DISTINCT l_quantity), 2) AS total FROM lineitem GROUP BY 1",
)
def agg_sum_distinct(t: Tables):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.round(F.sum_distinct("l_quantity"), 2).alias("total")
    )


@query(
    "agg_first_last",
    """
    SELECT user_id, event_type, arg_min(value, (ts, event_id)) AS first_value,
           arg_max(value, (ts, event_id)) AS last_value
    FROM events GROUP BY 1, 2
    """,
)
def agg_first_last(t: Tables):
    return t.events.groupBy("user_id", "event_type").agg(
        first_in_order("value", "ts", "event_id").alias("first_value"),
        last_in_order("value", "ts", "event_id").alias("last_value"),
    )


@query(
    "agg_mode",
    """
    SELECT l_suppkey, l_quantity AS mode_quantity FROM (
        SELECT l_suppkey, l_quantity,
               row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, l_quantity DESC NULLS LAST) AS rn
        FROM lineitem GROUP BY 1, 2)
    WHERE rn = 1
    """,
)
def agg_mode(t: Tables):
    return mode_per_group(t.lineitem, ["l_suppkey"], "l_quantity", "mode_quantity")


@query(
    "agg_global",
    "SELECT count(*) AS n, round(avg(l_quantity), 6) AS avg_qty, round(sum(l_tax), 2) AS tax FROM lineitem",
)
def agg_global(t: Tables):
    return t.lineitem.agg(
        count_rows(), F.round(F.avg("l_quantity"), 6).alias("avg_qty"), F.round(F.sum("l_tax"), 2).alias("tax")
    )


DESCRIBED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "agg_describe",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 4) AS mean, "
        f"round(stddev_samp({c}), 4) AS stddev, min({c}) AS min_value, max({c}) AS max_value FROM lineitem"
        for c in DESCRIBED
    ),
)
def agg_describe(t: Tables):
    return describe_columns(t.lineitem, DESCRIBED)


@query(
    "agg_null_counts",
    """
    SELECT count(*) FILTER (doc_id IS NULL) AS doc_id, count(*) FILTER (quality IS NULL) AS quality,
           count(*) FILTER (toxic IS NULL) AS toxic
    FROM documents LEFT JOIN labels USING (doc_id)
    """,
)
def agg_null_counts(t: Tables):
    return null_counts(t.documents.select("doc_id").join(t.labels, "doc_id", "left"))


@query(
    "agg_two_level",
    """
    SELECT event_type, round(avg(n), 6) AS avg_per_day FROM (
        SELECT event_type, ts::DATE AS day, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY 1
    """,
)
def agg_two_level(t: Tables):
    daily = t.events.groupBy("event_type", F.to_date("ts").alias("day")).agg(count_rows())
    return daily.groupBy("event_type").agg(F.round(F.avg("n"), 6).alias("avg_per_day"))


@query("distinct_rows", "SELECT DISTINCT l_partkey, l_returnflag FROM lineitem")
def distinct_rows(t: Tables):
    return t.lineitem.select("l_partkey", "l_returnflag").distinct()


@query(
    "dedup_subset",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                  ORDER BY l_shipdate, l_partkey, l_extendedprice, l_suppkey) AS rn FROM lineitem)
    WHERE rn = 1
    """,
)
def dedup_subset(t: Tables):
    """One line per (order, line number): the one shipped first."""
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_shipdate", "l_suppkey"
    )
    kept = first_rows(
        lines, ["l_orderkey", "l_linenumber"], "l_shipdate", "l_partkey", "l_extendedprice", "l_suppkey"
    )
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


def with_variants(t: Tables):
    """Documents plus a hyphenated upper-case copy of each English one.

    Only ASCII letters change case: engines differ on the upper case of others.
    """
    docs = t.documents.select("doc_id", "lang", "text")
    copies = docs.filter("lang = 'en'").select(
        (-F.col("doc_id") - 1).alias("doc_id"),
        "lang",
        F.replace(
            F.translate("text", ascii_lowercase, ascii_uppercase), F.lit("THE"), F.lit("T-HE")
        ).alias("text"),
    )
    return docs.unionByName(copies)


@query(
    "dedup_normalised",
    f"""
    WITH all_docs AS (
        SELECT doc_id, lang, text FROM documents UNION ALL
        SELECT -doc_id - 1, lang, replace(translate(text, '{ascii_lowercase}', '{ascii_uppercase}'), 'THE', 'T-HE')
        FROM documents WHERE lang = 'en')
    SELECT min(doc_id) AS doc_id, lang
    FROM all_docs
    GROUP BY lang, trim(regexp_replace(replace(lower(text), '-', ''), ' +', ' ', 'g'), ' ')
    """,
)
def dedup_normalised(t: Tables):
    kept = keep_first_copy(with_variants(t), "doc_id", F.col("lang"), folded(F.col("text")))
    return kept.select("doc_id", "lang")


@query(
    "histogram_bins",
    """
    SELECT least(floor((o_totalprice - lo) / ((hi - lo) / 20)), 19)::INTEGER AS bin, count(*) AS n
    FROM orders, (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders) GROUP BY 1
    """,
)
def histogram_bins(t: Tables):
    return histogram(t.orders, "o_totalprice", 20)


@query(
    "box_stats",
    """
    SELECT l_returnflag, q1, median, q3, q1 - 1.5 * (q3 - q1) AS low_fence, q3 + 1.5 * (q3 - q1) AS high_fence
    FROM (SELECT l_returnflag, quantile_cont(l_quantity, 0.25) AS q1, quantile_cont(l_quantity, 0.5) AS median,
                 quantile_cont(l_quantity, 0.75) AS q3 FROM lineitem GROUP BY 1)
    """,
)
def boxes(t: Tables):
    return box_stats(t.lineitem, ["l_returnflag"], "l_quantity")


@query(
    "linear_fit",
    """
    SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
           round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept
    FROM lineitem GROUP BY 1
    """,
)
def fitted(t: Tables):
    lines = linear_fit(t.lineitem, ["l_returnflag"], "l_quantity", "l_extendedprice")
    return lines.select("l_returnflag", *[F.round(c, 4).alias(c) for c in ("slope", "intercept")])
