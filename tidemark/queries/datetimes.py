"""Date and time functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.times import epoch_seconds, micros_to_timestamp, millis_to_timestamp, stamp
from tidemark.queries.registry import Tables, query

SHOWN = "%Y-%m-%d %H:%M:%S"


@query(
    "ts_from_micros",
    f"SELECT event_id, strftime(ts, '{SHOWN}.%f') AS created FROM events",
)
def ts_from_micros(t: Tables):
    micros = t.events.select("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("micros"))
    created = micros_to_timestamp(F.col("micros"))
    return micros.select("event_id", F.date_format(created, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("created"))


@query(
    "ts_from_millis",
    f"SELECT event_id, strftime(make_timestamp(epoch_us(ts) // 1000 * 1000), '{SHOWN}.%g') AS created FROM events",
)
def ts_from_millis(t: Tables):
    millis = t.events.select("event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("millis"))
    created = millis_to_timestamp(F.col("millis"))
    return millis.select("event_id", F.date_format(created, "yyyy-MM-dd HH:mm:ss.SSS").alias("created"))


@query(
    "ts_from_text",
    "SELECT o_orderkey, epoch(o_orderdate)::BIGINT AS seconds FROM orders",
)
def ts_from_text(t: Tables):
    text = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return t.orders.select("o_orderkey", epoch_seconds(F.to_timestamp(text)).alias("seconds"))


@query("ts_now", "SELECT event_id, TRUE AS stamped FROM events")
def ts_now(t: Tables):
    """An audit stamp: one value for the whole query, later than every event."""
    audited = t.events.withColumn("insertdate", F.current_timestamp())
    return audited.select(
        "event_id", (F.col("insertdate") > F.col("ts").cast("timestamp")).alias("stamped")
    )


@query("ts_to_unix", "SELECT event_id, epoch(date_trunc('second', ts))::BIGINT AS seconds FROM events")
def ts_to_unix(t: Tables):
    return t.events.select("event_id", epoch_seconds(F.col("ts")).alias("seconds"))


@query("ts_from_unix", f"SELECT event_id, strftime(ts, '{SHOWN}') AS shown FROM events")
def ts_from_unix(t: Tables):
    return t.events.select("event_id", F.from_unixtime(epoch_seconds(F.col("ts"))).alias("shown"))


@query(
    "date_format",
    """
    SELECT event_id, strftime(ts, '%B %d, %Y') AS long_date, strftime(ts, '%H:%M:%S.%f') AS clock,
           strftime(ts, '%a') AS weekday, strftime(ts, '%M') AS minute
    FROM events
    """,
)
def date_format(t: Tables):
    patterns = {
        "long_date": "MMMM dd, yyyy",
        "clock": "HH:mm:ss.SSSSSS",
        "weekday": "E",
        "minute": "mm",
    }
    return t.events.select(
        "event_id", *[F.date_format("ts", p).alias(n) for n, p in patterns.items()]
    )


@query(
    "date_parts",
    """
    SELECT event_id, year(ts)::INTEGER AS year, month(ts)::INTEGER AS month, day(ts)::INTEGER AS day,
           (dayofweek(ts) + 1)::INTEGER AS weekday, hour(ts)::INTEGER AS hour,
           minute(ts)::INTEGER AS minute, second(ts)::INTEGER AS second
    FROM events
    """,
)
def date_parts(t: Tables):
    return t.events.select(
        "event_id",
        F.year("ts").alias("year"),
        F.month("ts").alias("month"),
        F.dayofmonth("ts").alias("day"),
        F.dayofweek("ts").alias("weekday"),  # Sunday is 1
        F.hour("ts").alias("hour"),
        F.minute("ts").alias("minute"),
        F.second("ts").alias("second"),
    )


@query("date_to_date", "SELECT event_id, ts::DATE AS day FROM events")
def date_to_date(t: Tables):
    return t.events.select("event_id", F.to_date("ts").alias("day"))


@query("date_add_days", "SELECT o_orderkey, (o_orderdate::DATE + 2) AS due FROM orders")
def date_add_days(t: Tables):
    return t.orders.select("o_orderkey", F.date_add("o_orderdate", 2).alias("due"))


@query(
    "date_add_months",
    "SELECT o_orderkey, (o_orderdate::DATE + INTERVAL 1 MONTH)::DATE AS next_month, (o_orderdate::DATE - INTERVAL 13 MONTH)::DATE AS before FROM orders",
)
def date_add_months(t: Tables):
    return t.orders.select(
        "o_orderkey",
        F.add_months("o_orderdate", 1).alias("next_month"),
        F.add_months("o_orderdate", -13).alias("before"),
    )


@query(
    "date_trunc_unit",
    f"""
    SELECT event_id, strftime(date_trunc('second', ts), '{SHOWN}.%f') AS second,
           strftime(date_trunc('hour', ts), '{SHOWN}') AS hour, strftime(date_trunc('month', ts), '{SHOWN}') AS month
    FROM events
    """,
)
def date_trunc_unit(t: Tables):
    return t.events.select(
        "event_id",
        F.date_format(F.date_trunc("second", "ts"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("second"),
        stamp(F.date_trunc("hour", "ts")).alias("hour"),
        stamp(F.date_trunc("month", "ts")).alias("month"),
    )


@query(
    "interval_arith",
    f"""
    SELECT event_id, strftime(ts - INTERVAL 1 SECOND, '{SHOWN}') AS second_before,
           strftime(ts + INTERVAL 5 MINUTE, '{SHOWN}') AS later, strftime(ts - INTERVAL 4 HOUR, '{SHOWN}') AS earlier
    FROM events
    """,
)
def interval_arith(t: Tables):
    ts = F.col("ts")
    return t.events.select(
        "event_id",
        stamp(ts - F.expr("interval 1 second")).alias("second_before"),
        stamp(ts + F.expr("interval 5 minutes")).alias("later"),
        stamp(ts - F.expr("interval 4 hours")).alias("earlier"),
    )


@query(
    "date_diff_units",
    """
    SELECT event_id, round((epoch(TIMESTAMP '2024-02-01') - epoch(date_trunc('second', ts))) / 3600) AS hours,
           round((epoch(TIMESTAMP '2024-02-01') - epoch(date_trunc('second', ts))) / 86400) AS days
    FROM events
    """,
)
def date_diff_units(t: Tables):
    """Whole hours and days from each event to a moment, rounded."""
    gap = F.unix_timestamp(F.lit("2024-02-01 00:00:00")) - epoch_seconds(F.col("ts"))
    return t.events.select(
        "event_id", F.round(gap / 3600).alias("hours"), F.round(gap / 86_400).alias("days")
    )
