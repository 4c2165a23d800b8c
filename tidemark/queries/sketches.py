"""Distinct counts and quantiles from sketches that are kept in files and united."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import stamp
from tidemark.operators.aggregates import count_rows
from tidemark.operators.joins import left_lookup
from tidemark.operators.sketches import (
    distinct_estimate,
    distinct_sketches,
    quantile_columns,
    quantile_sketches,
    returning,
    rolling_sketches,
    set_sketches,
    unite_quantiles,
    unite_sketches,
)
from tidemark.queries.registry import Tables, query
from tidemark.session import scratch_path, stored
from tidemark.sources.writers import write_parquet


def close(approx: Column, exact: Column) -> Column:
    return F.coalesce(F.abs(approx - exact) <= 0.05 * exact, F.lit(False)).alias("approx_within_5_percent")


@query(
    "distinct_sketch_rollup",
    """
    SELECT 'day' AS level, event_type, strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS period,
           count(DISTINCT user_id) AS exact_users, TRUE AS approx_within_5_percent
    FROM events GROUP BY event_type, date_trunc('day', ts)
    UNION ALL
    SELECT 'month', event_type, strftime(date_trunc('month', ts), '%Y-%m-%d %H:%M:%S'), count(DISTINCT user_id), TRUE
    FROM events GROUP BY event_type, date_trunc('month', ts)
    UNION ALL
    SELECT 'all', NULL, NULL, count(DISTINCT user_id), TRUE FROM events
    """,
)
def distinct_sketch_rollup(t: Tables):
    """Users per day, month and in all, united from a table of hourly sketches, against exact counts.

    Hourly sketches are written once, in folders by day; the rollups read them
    instead of the events.
    """
    path = scratch_path(t.spark, "hourly-sketches")
    hour = F.date_trunc("hour", "ts").cast("timestamp")
    hourly = distinct_sketches(t.events, ["event_type", hour.alias("hour")], "user_id")
    write_parquet(hourly.withColumn("day", F.to_date("hour")), path, partition_by=["day"])
    sketches = t.spark.read.parquet(path)

    def level(unit: str) -> DataFrame:
        def keys(time: str) -> list:
            return ["event_type", F.date_trunc(unit, time).cast("timestamp").alias("period")]

        united = unite_sketches(sketches, keys("hour"))
        exact = t.events.groupBy(*keys("ts")).agg(F.count_distinct("user_id").alias("exact_users"))
        return united.join(exact, ["event_type", "period"], "full_outer").select(
            F.lit(unit).alias("level"),
            "event_type",
            stamp(F.col("period")).alias("period"),
            "exact_users",
            close(distinct_estimate(), F.col("exact_users")),
        )

    none = F.lit(None).cast("string")
    every = t.events.agg(F.count_distinct("user_id").alias("exact_users")).select(
        F.lit("all").alias("level"),
        none.alias("event_type"),
        none.alias("period"),
        "exact_users",
        close(unite_sketches(sketches, []).select(distinct_estimate()).scalar(), F.col("exact_users")),
    )
    return level("day").union(level("month")).union(every)


@query(
    "distinct_sketch_rolling",
    """
    WITH days AS (SELECT DISTINCT event_type, date_trunc('day', ts)::DATE AS day FROM events)
    SELECT d.event_type, d.day::VARCHAR AS day, count(DISTINCT e.user_id) AS exact_users, TRUE AS approx_within_5_percent
    FROM days d JOIN events e ON e.event_type = d.event_type
         AND e.ts >= d.day - INTERVAL 6 DAY AND e.ts < d.day + INTERVAL 1 DAY
    GROUP BY d.event_type, d.day
    """,
)
def distinct_sketch_rolling(t: Tables):
    """Users of the last seven days for each day: daily sketches are copied ahead, not events."""
    events = t.events.withColumn("day", F.to_date("ts"))
    rolling = rolling_sketches(stored(distinct_sketches(events, ["event_type", "day"], "user_id"), "daily"), ["event_type"], "day", 7)
    # The exact count, for comparison: each user's days are copied instead.
    active = events.select("event_type", "day", "user_id").distinct()
    ahead = active.withColumn("day", F.explode(F.transform(F.sequence(F.lit(0), F.lit(6)), lambda i: F.date_add("day", i))))
    exact = ahead.groupBy("event_type", "day").agg(F.count_distinct("user_id").alias("exact_users"))
    return rolling.join(exact, ["event_type", "day"], "left").select(
        "event_type", F.col("day").cast("string").alias("day"), "exact_users", close(distinct_estimate(), F.col("exact_users"))
    )


@query(
    "returning_users_sketch",
    """
    WITH active AS (SELECT DISTINCT event_type, date_diff('week', TIMESTAMP '2023-12-25', ts) AS week, user_id FROM events),
    marked AS (SELECT a.event_type, a.week, count(*) AS seen, count(b.user_id) AS returned
               FROM active a LEFT JOIN active b
                    ON b.event_type = a.event_type AND b.user_id = a.user_id AND b.week = a.week - 1
               GROUP BY 1, 2)
    SELECT event_type, week::BIGINT AS week, seen, returned, TRUE AS approx_within_5_percent FROM marked
    """,
)
def returning_users_sketch(t: Tables):
    """Users of each week that were there the week before, by intersecting weekly sketches; against exact counts."""
    week = F.floor(F.datediff(F.to_date("ts"), F.lit("2023-12-25").cast("date")) / 7).alias("week")
    events = t.events.select("event_type", week, "user_id")
    found = returning(stored(set_sketches(events, ["event_type", "week"], "user_id"), "weekly"), ["event_type"], "week", 1)
    # The exact counts, for comparison: a user's weeks next to each other.
    active = events.distinct()
    earlier = active.select("event_type", (F.col("week") + 1).alias("week"), "user_id", F.lit(1).alias("again"))
    exact = (
        active.join(earlier, ["event_type", "week", "user_id"], "left")
        .groupBy("event_type", "week")
        .agg(count_rows("exact_seen"), F.count("again").alias("exact_returned"))
    )
    both = found.join(exact, ["event_type", "week"], "full_outer")
    gap = F.greatest(
        F.abs(F.col("seen") - F.col("exact_seen")), F.abs(F.col("returned") - F.col("exact_returned"))
    )
    return both.select(
        "event_type",
        "week",
        F.col("exact_seen").alias("seen"),
        F.col("exact_returned").alias("returned"),
        F.coalesce(gap <= 0.05 * F.col("exact_seen"), F.lit(False)).alias("approx_within_5_percent"),
    )


SHARES = {"q1": 0.25, "median": 0.5, "q3": 0.75, "p99": 0.99}


@query(
    "quantile_sketch_rollup",
    f"""
    SELECT event_type, count(value) AS n, {", ".join(f"TRUE AS {name}_rank_within_2_percent" for name in SHARES)}
    FROM events WHERE value IS NOT NULL GROUP BY event_type
    """,
)
def quantile_sketch_rollup(t: Tables):
    """Quartiles and the 99th percentile of all days, united from daily sketches.

    The share of values up to each (and below it) must enclose the wanted share
    but for 2 % of the rows: the sketch's stated error of the rank, with room.
    """
    daily = quantile_sketches(t.events, ["event_type", F.to_date("ts").alias("day")], "value")
    kept = stored(daily, "daily-quantiles")
    found = unite_quantiles(kept, ["event_type"]).select("event_type", *quantile_columns(SHARES))
    rows = t.events.filter("value IS NOT NULL").select("event_type", F.col("value").cast("double").alias("value"))
    ranked = left_lookup(rows, found, ["event_type"], "inner")
    checks = []
    for name, share in SHARES.items():
        upto, below = (F.avg(F.when(test, 1.0).otherwise(0.0)) for test in (F.col("value") <= F.col(name), F.col("value") < F.col(name)))
        checks.append(((upto >= share - 0.02) & (below <= share + 0.02)).alias(f"{name}_rank_within_2_percent"))
    return ranked.groupBy("event_type").agg(count_rows(), *checks)
