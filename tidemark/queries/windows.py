"""Analytic windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.times import label_bucket, stamp
from tidemark.operators.windows import forward_fill, latest_per_slot, running_max
from tidemark.plans.sensors import grid, observed_slots, whole_periods
from tidemark.queries.registry import Tables, query
from tidemark.session import stored

KEYS = ["user_id", "event_type"]
DAY = 86_400


@query(
    "win_last_per_second",
    """
    SELECT user_id, event_type, epoch(date_trunc('second', ts))::BIGINT AS slot,
           arg_max(value, (ts, event_id)) AS value
    FROM events GROUP BY ALL
    """,
)
def win_last_per_second(t: Tables):
    return latest_per_slot(t.events, KEYS, "ts", "value", 1, ["event_id"])


@query(
    "win_first_value_desc",
    """
    SELECT DISTINCT event_type, strftime(time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR, '%Y-%m-%d %H:%M:%S') AS bucket_end,
           first_value(value) OVER (PARTITION BY event_type, time_bucket(INTERVAL 6 HOUR, ts)
                                    ORDER BY ts DESC, event_id DESC) AS value
    FROM events
    """,
)
def win_first_value_desc(t: Tables):
    """Newest reading per bucket: the first value in descending order, as an aggregate."""
    newest = latest_per_slot(t.events, ["event_type"], "ts", "value", 21_600, ["event_id"])
    end = F.timestamp_seconds(F.col("slot") + 21_600)
    return newest.select("event_type", stamp(end).alias("bucket_end"), "value")


@query(
    "win_forward_fill",
    """
    WITH span AS (SELECT min(ts) AS low, max(ts) AS high FROM events),
    slots AS (SELECT user_id, event_type, date_diff('day', low, ts) AS slot,
                     arg_max(value, (ts, event_id)) AS value FROM events, span GROUP BY ALL),
    full_grid AS (SELECT user_id, event_type, slot FROM (SELECT DISTINCT user_id, event_type FROM events),
                  (SELECT unnest(range(0, date_diff('day', low, high) + 1)) AS slot FROM span))
    SELECT user_id, event_type, slot,
           last_value(value IGNORE NULLS) OVER (PARTITION BY user_id, event_type ORDER BY slot
               ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS filled
    FROM full_grid LEFT JOIN slots USING (user_id, event_type, slot)
    """,
)
def win_forward_fill(t: Tables):
    """Daily grid, gaps filled from at most five days before, in chunks of a week."""
    start, end = whole_periods(t.events, "ts", DAY)
    slots = stored(observed_slots(t.events, KEYS, "ts", "value", start, end, DAY, ["event_id"]), "slots")
    full = stored(grid(slots, KEYS, 0, (end - start) // DAY - 1).join(slots, [*KEYS, "slot"], "left"), "grid")
    filled = forward_fill(full, KEYS, "slot", "value", "filled", max_gap=5, chunk=7)
    return filled.select(*KEYS, "slot", "filled")


@query(
    "win_running_max",
    """
    SELECT o_orderkey, max(o_totalprice) OVER (PARTITION BY date_trunc('month', o_orderdate)
                                               ORDER BY o_orderdate) AS max_so_far
    FROM orders
    """,
)
def win_running_max(t: Tables):
    orders = t.orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    month, week = (F.date_trunc(unit, F.col("o_orderdate")) for unit in ("month", "week"))
    with_max = running_max(
        orders, [month], "o_orderdate", "o_totalprice", "max_so_far", chunk=week
    )
    return with_max.select("o_orderkey", "max_so_far")


@query(
    "batch_time_bucket",
    """
    SELECT event_type,
           strftime(time_bucket(INTERVAL 1 HOUR, date_trunc('second', ts) - INTERVAL 1 SECOND) + INTERVAL 1 HOUR,
                    '%Y-%m-%d %H:%M:%S') AS bucket_end,
           strftime(time_bucket(INTERVAL 1 HOUR, date_trunc('second', ts) - INTERVAL 1 SECOND),
                    '%Y-%m-%d %H:%M:%S') AS bucket_start,
           count(*) AS n
    FROM events GROUP BY ALL
    """,
)
def batch_time_bucket(t: Tables):
    """Both labels of the ``(start, end]`` hour."""
    return (
        t.events.groupBy(
            "event_type",
            stamp(label_bucket(F.col("ts"), 3600, "end")).alias("bucket_end"),
            stamp(label_bucket(F.col("ts"), 3600, "start")).alias("bucket_start"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )
