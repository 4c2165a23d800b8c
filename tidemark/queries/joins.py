"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.times import epoch_seconds
from tidemark.operators.joins import carry_previous, merged_outer
from tidemark.plans.sensors import at_second, epoch, grid, whole_periods
from tidemark.queries.registry import Tables, query
from tidemark.session import stored


@query(
    "join_inner_using",
    """
    SELECT o.k AS orderkey, o_custkey, l_linenumber, l_extendedprice
    FROM (SELECT o_orderkey AS k, o_custkey FROM orders) o
    JOIN (SELECT l_orderkey AS k, l_linenumber, l_extendedprice FROM lineitem) USING (k)
    """,
)
def join_inner_using(t: Tables):
    orders = t.orders.select(F.col("o_orderkey").alias("orderkey"), "o_custkey")
    items = t.lineitem.select(F.col("l_orderkey").alias("orderkey"), "l_linenumber", "l_extendedprice")
    return orders.join(items, ["orderkey"], "inner")


@query(
    "join_inner_expr",
    """
    SELECT o_orderkey, l_linenumber, l_quantity, o_orderstatus
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey AND o_orderdate = l_shipdate - INTERVAL 1 DAY
    """,
)
def join_inner_expr(t: Tables):
    """Two differently named equalities: lines shipped the day after the order."""
    o, l = t.orders, t.lineitem
    shipped_next_day = o.o_orderdate == l.l_shipdate - F.expr("interval 1 day")
    return o.join(l, (o.o_orderkey == l.l_orderkey) & shipped_next_day).select(
        "o_orderkey", "l_linenumber", "l_quantity", "o_orderstatus"
    )


@query(
    "join_multiway",
    """
    SELECT n_name, count(*) AS n_lines, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey GROUP BY 1
    """,
)
def join_multiway(t: Tables):
    """Four tables in a chain, added up on the way: per order, per customer, per nation.

    Each exchange then carries sums instead of lines.
    """
    revenue = F.col("l_extendedprice") * (1 - F.col("l_discount"))

    def totals(frame, key):
        return frame.groupBy(key).agg(F.sum("n").alias("n"), F.sum("revenue").alias("revenue"))

    lines = t.lineitem.select("l_orderkey", F.lit(1).alias("n"), revenue.alias("revenue"))
    per_order = totals(lines, "l_orderkey")
    per_customer = totals(
        per_order.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")), "o_custkey"
    )
    per_nation = totals(
        per_customer.join(t.customer, F.col("o_custkey") == F.col("c_custkey")), "c_nationkey"
    )
    return per_nation.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "n_name", F.col("n").alias("n_lines"), F.round("revenue", 2).alias("revenue")
    )


@query(
    "join_full_outer",
    """
    SELECT coalesce(p_partkey, l_partkey) AS partkey, p_brand, n_lines
    FROM part FULL JOIN (SELECT l_partkey, count(*) AS n_lines FROM lineitem
                         WHERE l_returnflag = 'R' AND l_quantity > 48 GROUP BY 1)
    ON p_partkey = l_partkey
    """,
)
def join_full_outer(t: Tables):
    """Parts and their large returns, either of which may be missing."""
    parts = t.part.select(F.col("p_partkey").alias("partkey"), "p_brand")
    returned = (
        t.lineitem.filter("l_returnflag = 'R' AND l_quantity > 48")
        .groupBy(F.col("l_partkey").alias("partkey"))
        .agg(F.count(F.lit(1)).alias("n_lines"))
    )
    return merged_outer(parts, returned, ["partkey"])


@query(
    "join_left_outer",
    """
    SELECT c_custkey, n_orders, spent
    FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS spent
                             FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) ON c_custkey = o_custkey
    """,
)
def join_left_outer(t: Tables):
    totals = (
        t.orders.filter("o_orderstatus = 'F'")
        .groupBy("o_custkey")
        .agg(F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("spent"))
    )
    return t.customer.join(totals, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "c_custkey", "n_orders", "spent"
    )


@query(
    "join_cross",
    """
    SELECT user_id, event_type, d AS day_number
    FROM (SELECT DISTINCT user_id, event_type FROM events),
         (SELECT unnest(range(0, date_diff('day', min(ts), max(ts)) + 1)) AS d FROM events)
    """,
)
def join_cross(t: Tables):
    """Every key with every day from the first to the last; days are generated per key."""
    start, end = whole_periods(t.events, "ts", DAY)
    days = grid(t.events, ["user_id", "event_type"], 0, (end - start) // DAY - 1)
    return days.withColumnRenamed("slot", "day_number")


MIDDLE = epoch("2024-01-16 00:00:00")
DAY = 86_400


@query(
    "join_carry_previous",
    """
    WITH prev AS (SELECT user_id, event_type, arg_max(value, (ts, event_id)) AS before FROM events
                  WHERE ts < TIMESTAMP '2024-01-16' GROUP BY ALL),
    cur AS (SELECT user_id, event_type, date_diff('day', TIMESTAMP '2024-01-16', ts) AS slot,
                   arg_max(value, (ts, event_id)) AS value
            FROM events WHERE ts >= TIMESTAMP '2024-01-16' GROUP BY ALL),
    keys AS (SELECT user_id, event_type FROM prev UNION SELECT user_id, event_type FROM cur)
    SELECT user_id, event_type, slot,
           CASE WHEN value IS NULL AND slot = 0 THEN coalesce(before, 0) ELSE value END AS value
    FROM keys CROSS JOIN (SELECT unnest(range(0, date_diff('day', TIMESTAMP '2024-01-16', max(ts)) + 1)) AS slot FROM events)
    LEFT JOIN cur USING (user_id, event_type, slot) LEFT JOIN prev USING (user_id, event_type)
    """,
)
def join_carry_previous(t: Tables):
    """Day grid from mid-January to the last day, its first day seeded from before."""
    keys = ["user_id", "event_type"]
    end = max(whole_periods(t.events, "ts", DAY)[1], MIDDLE + DAY)
    # What was before is slot -1: one pass over the events, and what is read twice is stored.
    inside = F.col("ts") < at_second(t.events, "ts", end)
    slot = F.greatest(F.floor((epoch_seconds(F.col("ts")) - MIDDLE) / DAY), F.lit(-1)).alias("slot")
    newest = F.max_by("value", F.struct("ts", "event_id")).alias("value")
    known = stored(t.events.filter(inside).groupBy(*keys, slot).agg(newest), "slots")
    full = grid(known, keys, 0, (end - MIDDLE) // DAY - 1).join(known, [*keys, "slot"], "left")
    marked = full.withColumn("is_first", F.col("slot") == 0)
    state = known.filter("slot = -1").drop("slot")
    return carry_previous(marked, state, keys, "value", "is_first").drop("is_first")
