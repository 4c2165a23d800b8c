"""Structured Streaming over the events files. Every query runs to the end of its input
and then returns what its sink holds, so it can be compared with plain SQL."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.times import epoch_seconds, stamp
from tidemark.operators.aggregates import count_rows
from tidemark.operators.sketches import distinct_estimate, unite_sketches
from tidemark.plans.messages import accepted, between, parse_payload, rejected, split_payload
from tidemark.queries.registry import Tables, query
from tidemark.session import scratch_path
from tidemark.sources.readers import parts_of_size
from tidemark.sources.writers import write_csv, write_json, write_parquet
from tidemark.streaming import monitor
from tidemark.streaming.jobs import (
    closed_hour_users,
    count_users,
    each_once,
    exploded_with,
    filter_and_flag,
    hourly_active_users,
    new_hourly_users,
    new_users,
    running_users,
    windowed_totals,
)
from tidemark.streaming.sinks import (
    append_batches,
    append_compacted,
    append_keys,
    append_sketches,
    compacted,
    distinct_keys,
    for_each_batch,
    newest_batch,
    run_to_end,
    to_files,
    to_memory,
    to_table,
)
from tidemark.streaming.sources import csv_ingest, file_stream
from tidemark.streaming.upserts import upsert_periods

EVENT_COLUMNS = ["event_id", "user_id", "event_type", "value"]
EVENTS_SQL = f"SELECT {', '.join(EVENT_COLUMNS)} FROM events"


def fresh(t: Tables, *labels: str) -> list[str]:
    return [scratch_path(t.spark, label) for label in labels]


def stream_events(t: Tables, **options) -> DataFrame:
    """The events files as a stream, with a zoned event time as watermarks need.

    The pattern finds the table whether it is one file or a folder of files.
    """
    pattern = f"{t.folder}/events*.parquet"
    stream = file_stream(t.spark, pattern, t.events.schema, **options)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


DELIVERIES = 5
_delivered: dict[tuple[str, str], str] = {}


def delivery_number(t: Tables) -> Column:
    """The delivery an event comes in: about as many in each, oldest first."""
    shares = [i / DELIVERIES for i in range(1, DELIVERIES)]
    seconds = epoch_seconds(F.col("ts"))
    cuts = t.events.agg(F.percentile_approx(seconds, shares)).first()[0] or []
    return F.coalesce(sum([F.when(seconds > cut, 1).otherwise(0) for cut in cuts], F.lit(0)), F.lit(0))


def files_per_delivery(t: Tables) -> int:
    """As many files as hold 128 MB each, by the size of the events' files."""
    return parts_of_size(t.events, DELIVERIES * (128 << 20))


def delivered_events(t: Tables) -> str:
    """A folder to which the events came in ``DELIVERIES`` deliveries, oldest first.

    Each is a write of its own, as a stream takes files in the order they came.
    Made once for a session and folder.
    """
    key = t.spark.sparkContext.applicationId, t.folder
    if key not in _delivered:
        (folder,) = fresh(t, "delivered")
        numbered = t.events.withColumn("_delivery", delivery_number(t))
        for i in range(DELIVERIES):
            rows = numbered.filter(F.col("_delivery") == i).drop("_delivery")
            rows.repartition(files_per_delivery(t)).write.mode("append").parquet(folder)
        _delivered[key] = folder
    return _delivered[key]


def many_batches(t: Tables) -> DataFrame:
    """The events as a stream of at least ``DELIVERIES`` micro-batches: one file in each."""
    stream = file_stream(t.spark, delivered_events(t), t.events.schema, files_per_trigger=1)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def run_to_files(t: Tables, stream: DataFrame, label: str, **options) -> DataFrame:
    path, state = fresh(t, label, f"{label}-state")
    run_to_end(to_files(stream, path, state, **options))
    return t.spark.read.parquet(path)


@query("stream_files", EVENTS_SQL)
def stream_files(t: Tables):
    """Rate-limited: one file in a micro-batch."""
    return run_to_files(t, many_batches(t).select(*EVENT_COLUMNS), "copied")


@query("stream_json", EVENTS_SQL)
def stream_json(t: Tables):
    (source,) = fresh(t, "events-json")
    write_json(t.events.select(*EVENT_COLUMNS), source)
    ddl = "event_id bigint, user_id bigint, event_type string, value double"
    return run_to_files(t, file_stream(t.spark, source, ddl, "json"), "from-json")


@query("stream_csv_ingest", EVENTS_SQL)
def stream_csv_ingest(t: Tables):
    (source,) = fresh(t, "events-csv")
    write_csv(t.events.select(*EVENT_COLUMNS), source)
    ddl = "event_id bigint, user_id bigint, event_type string, value double"
    return run_to_files(t, csv_ingest(t.spark, source, ddl, header=True), "from-csv")


@query("stream_sink_files", EVENTS_SQL)
def stream_sink_files(t: Tables):
    """Named append query into folders by event type, few files in each."""
    path, state = fresh(t, "by-type", "by-type-state")
    handle = append_batches(path, partition_by=["event_type"])
    name = f"by_type_{uuid.uuid4().hex[:8]}"
    run_to_end(for_each_batch(stream_events(t).select(*EVENT_COLUMNS), handle, state, name=name))
    return t.spark.read.parquet(path).select(*EVENT_COLUMNS)


@query("stream_sink_table", EVENTS_SQL)
def stream_sink_table(t: Tables):
    path, state = fresh(t, "events-table", "events-table-state")
    name = f"events_{uuid.uuid4().hex[:12]}"
    run_to_end(to_table(stream_events(t).select(*EVENT_COLUMNS), name, path, state))
    return t.spark.table(name)


@query(
    "stream_sink_memory",
    "SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1",
)
def stream_sink_memory(t: Tables):
    """Complete mode into an in-memory table of a few groups, then SQL over it."""
    name = f"totals_{uuid.uuid4().hex[:12]}"
    totals = stream_events(t).groupBy("event_type").agg(count_rows(), F.sum("value").alias("total"))
    (state,) = fresh(t, "totals-state")
    run_to_end(to_memory(totals, name, state))
    return t.spark.sql(f"SELECT event_type, n, round(total, 2) AS total FROM {name}")


@query("foreach_batch", EVENTS_SQL)
def foreach_batch(t: Tables):
    """Each micro-batch written by a function; a repeated batch replaces its own folder."""
    path, state = fresh(t, "batches", "batches-state")
    stream = many_batches(t).select(*EVENT_COLUMNS)
    run_to_end(for_each_batch(stream, append_batches(path), state))
    return t.spark.read.parquet(path).select(*EVENT_COLUMNS)


def with_device(events: DataFrame) -> DataFrame:
    k = F.from_json("props", "k int").getField("k")
    return events.withColumn(
        "device", F.when(k < 34, "iOS").when(k < 67, "Android").otherwise("Linux")
    )


FLAGGED_SQL = """
    SELECT event_id, user_id, json_extract(props, '$.k')::INTEGER < 67 AS mobile
    FROM events WHERE event_type = 'click'
"""


@query("stream_filter_project", FLAGGED_SQL)
def stream_filter_project(t: Tables):
    """Clicks with a mobile flag."""
    events = with_device(stream_events(t))
    mobile = F.col("device").isin("iOS", "Android")
    flagged = filter_and_flag(events, F.col("event_type"), "click", mobile, "mobile")
    return run_to_files(t, flagged.select("event_id", "user_id", "mobile"), "flagged")


@query("email_mobile_stream", FLAGGED_SQL)
def email_mobile_stream(t: Tables):
    """The same into named files every second until all input is in, then stopped."""
    events = with_device(stream_events(t))
    mobile = F.col("device").isin("iOS", "Android")
    flagged = filter_and_flag(events, F.col("event_type"), "click", mobile, "mobile")
    path, state = fresh(t, "mobile", "mobile-state")
    name = f"mobile_clicks_{uuid.uuid4().hex[:8]}"
    running = to_files(flagged.select("event_id", "user_id", "mobile"), path, state, name, "1 second")
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return t.spark.read.parquet(path)


def with_items(events: DataFrame) -> DataFrame:
    """Two items per event, of which purchases carry a coupon on the first."""
    k = F.from_json("props", "k bigint").getField("k")
    coupon = F.when(F.col("event_type") == "purchase", F.concat(F.lit("K"), k.cast("string")))
    none = F.lit(None).cast("string")
    items = F.array(
        F.struct(coupon.alias("coupon"), k.alias("item_id"), F.col("value").alias("revenue")),
        F.struct(none.alias("coupon"), (k + 100).alias("item_id"), F.col("value").alias("revenue")),
    )
    return events.select("event_id", "user_id", items.alias("items"))


COUPON_SQL = """
    SELECT event_id, user_id, 'K' || k AS coupon, k AS item_id, value AS revenue
    FROM (SELECT *, json_extract(props, '$.k')::BIGINT AS k FROM events WHERE event_type = 'purchase')
"""


@query("stream_explode_filter", COUPON_SQL)
def stream_explode_filter(t: Tables):
    """Items with a coupon, one per row."""
    sold = exploded_with(with_items(stream_events(t)), "items", "coupon")
    return run_to_files(t, sold.select("event_id", "user_id", "items.*"), "coupons")


@query(
    "coupon_sales_stream",
    f"SELECT coupon, count(*) AS n, round(sum(revenue), 2) AS revenue FROM ({COUPON_SQL}) GROUP BY 1",
)
def coupon_sales_stream(t: Tables):
    """Coupon items streamed to files; the files then give sales per coupon."""
    sold = exploded_with(with_items(stream_events(t)), "items", "coupon")
    files = run_to_files(t, sold, "coupon-sales")
    return files.groupBy("items.coupon").agg(
        count_rows(), F.round(F.sum("items.revenue"), 2).alias("revenue")
    )


CLOSED_SQL = """
    SELECT event_type, strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start,
           count(*) AS n, round(sum(value), 2) AS total
    FROM events {where} GROUP BY event_type, time_bucket(INTERVAL 1 HOUR, ts)
    HAVING time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 2 HOUR FROM events)
"""


def hourly_totals(events: DataFrame) -> DataFrame:
    totals = windowed_totals(
        events, "ts", ["event_type"], "1 hour", "2 hours", count_rows(), F.sum("value").alias("total")
    )
    return totals.select(
        "event_type",
        stamp(F.col("window.start")).alias("window_start"),
        "n",
        F.round("total", 2).alias("total"),
    )


@query("stream_watermark", CLOSED_SQL.format(where=""))
def stream_watermark(t: Tables):
    """Append mode: the hours that closed two hours before the newest event."""
    return run_to_files(t, hourly_totals(stream_events(t)), "closed-hours")


def in_two_deliveries(t: Tables, late_first: bool):
    """(folder, deliver the rest): events delivered half-month by half-month."""
    (folder,) = fresh(t, "deliveries")
    older = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    first, rest = (~older, older) if late_first else (older, ~older)
    t.events.filter(first).write.parquet(folder)
    return folder, lambda: t.events.filter(rest).write.mode("append").parquet(folder)


@query(
    "stream_late_data",
    f"""
    SELECT *, (SELECT count(DISTINCT event_id) FROM events WHERE ts < TIMESTAMP '2024-01-16') AS late_events
    FROM ({CLOSED_SQL.format(where="WHERE ts >= TIMESTAMP '2024-01-16'")})
    """,
)
def stream_late_data(t: Tables):
    """The first half-month arrives last, behind the watermark, and is dropped.

    A second stream over the same deliveries keeps each event once and so tells
    how many events came too late: an aggregate's reports count combined rows.
    """
    folder, deliver_rest = in_two_deliveries(t, late_first=True)
    path, state, kept, kept_state = fresh(t, "hours", "hours-state", "kept", "kept-state")

    def run() -> tuple[StreamingQuery, StreamingQuery]:
        events = file_stream(t.spark, folder, t.events.schema).withColumn("ts", F.col("ts").cast("timestamp"))
        each_once = events.withWatermark("ts", "2 hours").dropDuplicates(["event_id", "ts"])
        return (
            run_to_end(to_files(hourly_totals(events), path, state)),
            run_to_end(to_files(each_once.select("event_id"), kept, kept_state)),
        )

    run()
    deliver_rest()
    with monitor.progress_totals(t.spark) as totals:
        late = totals.of(run()[1]).rows_dropped_late
    return t.spark.read.parquet(path).withColumn("late_events", F.lit(late).cast("bigint"))


@query("stream_checkpoint_resume", EVENTS_SQL)
def stream_checkpoint_resume(t: Tables):
    """Two runs over one checkpoint: the second reads only what came in between."""
    folder, deliver_rest = in_two_deliveries(t, late_first=False)
    path, state = fresh(t, "resumed", "resumed-state")

    def run():
        events = file_stream(t.spark, folder, t.events.schema)
        return run_to_end(to_files(events.select(*EVENT_COLUMNS), path, state))

    run()
    deliver_rest()
    run()
    return t.spark.read.parquet(path)


@query(
    "stream_tumbling_agg",
    """
    SELECT event_type, strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start,
           hour(time_bucket(INTERVAL 1 HOUR, ts))::INTEGER AS hour, count(DISTINCT user_id) AS exact_users,
           TRUE AS approx_within_5_percent
    FROM events GROUP BY event_type, time_bucket(INTERVAL 1 HOUR, ts)
    """,
)
def stream_tumbling_agg(t: Tables):
    """Approximate distinct users per source and hour, sorted, in complete mode; against exact ones."""
    path, state = fresh(t, "hourly-users", "hourly-users-state")
    hourly = hourly_active_users(stream_events(t), "ts", "event_type", "user_id")
    run_to_end(for_each_batch(hourly.orderBy("hour", "window", "event_type"), append_batches(path), state, "complete"))
    start = stamp(F.col("window.start")).alias("window_start")
    exact = (
        t.events.groupBy("event_type", F.window("ts", "1 hour").alias("window"))
        .agg(F.count_distinct("user_id").alias("exact_users"))
        .select("event_type", start, "exact_users")
    )
    approx = newest_batch(t.spark, path).select("event_type", start, "hour", "active_users")
    gap = F.abs(F.col("active_users") - F.col("exact_users")) / F.col("exact_users")
    return approx.join(exact, ["event_type", "window_start"]).select(
        "event_type",
        "window_start",
        "hour",
        "exact_users",
        (gap <= 0.05).alias("approx_within_5_percent"),
    )


@query(
    "hourly_activity_stream",
    """
    SELECT event_type, strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start,
           count(DISTINCT user_id) AS active_users
    FROM events GROUP BY event_type, time_bucket(INTERVAL 1 HOUR, ts)
    """,
)
def hourly_activity_stream(t: Tables):
    """Exact distinct users per source and hour, however late: each batch leaves its distinct keys."""
    path, state = fresh(t, "hourly-exact", "hourly-exact-state")
    events = many_batches(t).withColumn("window", F.window("ts", "1 hour"))
    run_to_end(for_each_batch(events, append_keys(path, ["event_type", "window", "user_id"]), state))
    return count_users(distinct_keys(t.spark, path), "event_type", "window").select(
        "event_type", stamp(F.col("window.start")).alias("window_start"), "active_users"
    )


@query(
    "hourly_first_seen_stream",
    """
    SELECT event_type, strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start,
           count(DISTINCT user_id) AS active_users
    FROM events GROUP BY event_type, time_bucket(INTERVAL 1 HOUR, ts)
    """,
)
def hourly_first_seen_stream(t: Tables):
    """The same from a stream in time order that gives out each user once, when first seen."""
    keys = run_to_files(t, new_hourly_users(many_batches(t), "ts", "event_type", "user_id"), "hourly-first")
    return count_users(keys, "event_type", "window").select(
        "event_type", stamp(F.col("window.start")).alias("window_start"), "active_users"
    )


@query(
    "hourly_sketch_stream",
    """
    SELECT 'hour' AS level, event_type, strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS period,
           count(DISTINCT user_id) AS exact_users, TRUE AS approx_within_5_percent
    FROM events GROUP BY event_type, time_bucket(INTERVAL 1 HOUR, ts)
    UNION ALL
    SELECT 'day', event_type, strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S'), count(DISTINCT user_id), TRUE
    FROM events GROUP BY event_type, date_trunc('day', ts)
    """,
)
def hourly_sketch_stream(t: Tables):
    """Hours and days from the sketches that each micro-batch leaves; the events are not read again."""
    path, state = fresh(t, "sketches", "sketches-state")
    events = many_batches(t).withColumn("hour", F.date_trunc("hour", "ts"))
    run_to_end(for_each_batch(events, append_sketches(path, ["event_type", "hour"], "user_id"), state))
    sketches = t.spark.read.parquet(path)
    levels = []
    for level in ("hour", "day"):
        united = unite_sketches(sketches, ["event_type", F.date_trunc(level, "hour").alias("period")])
        exact = t.events.groupBy("event_type", F.date_trunc(level, "ts").cast("timestamp").alias("period")).agg(
            F.count_distinct("user_id").alias("exact_users")
        )
        both = united.join(exact, ["event_type", "period"], "full_outer")
        levels.append(
            both.select(
                F.lit(level).alias("level"),
                "event_type",
                stamp(F.col("period")).alias("period"),
                "exact_users",
                within_5_percent(distinct_estimate(), F.col("exact_users")).alias("approx_within_5_percent"),
            )
        )
    return levels[0].union(levels[1])


def within_5_percent(approx: Column, exact: Column) -> Column:
    return F.coalesce(F.abs(approx - exact) <= 0.05 * exact, F.lit(False))


@query(
    "hourly_activity_closed",
    """
    SELECT event_type, strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start,
           count(DISTINCT user_id) AS active_users
    FROM events GROUP BY event_type, time_bucket(INTERVAL 1 HOUR, ts)
    HAVING time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 2 HOUR FROM events)
    """,
)
def hourly_activity_closed(t: Tables):
    """The same in append mode, for the hours that have closed."""
    users = closed_hour_users(stream_events(t), "ts", "event_type", "user_id")
    start = stamp(F.col("window.start")).alias("window_start")
    return run_to_files(t, users.select("event_type", start, "active_users"), "closed-users")


@query(
    "stream_group_agg",
    "SELECT event_type, TRUE AS approx_within_5_percent FROM events GROUP BY 1",
)
def stream_group_agg(t: Tables):
    """Running approximate distinct users against the exact batch count."""
    path, state = fresh(t, "running-users", "running-users-state")
    running = running_users(many_batches(t), "event_type", "user_id")
    run_to_end(for_each_batch(running, append_batches(path), state, "complete"))
    exact = t.events.groupBy("event_type").agg(F.count_distinct("user_id").alias("exact"))
    both = newest_batch(t.spark, path).join(exact, "event_type")
    gap = F.abs(F.col("active_users") - F.col("exact")) / F.col("exact")
    return both.select("event_type", (gap <= 0.05).alias("approx_within_5_percent"))


@query(
    "traffic_stream",
    "SELECT event_type, count(DISTINCT user_id) AS active_users FROM events GROUP BY 1",
)
def traffic_stream(t: Tables):
    """Exact running distinct users per source, without state: each batch leaves its distinct keys."""
    path, state = fresh(t, "traffic", "traffic-state")
    run_to_end(for_each_batch(many_batches(t), append_keys(path, ["event_type", "user_id"]), state))
    return count_users(distinct_keys(t.spark, path), "event_type")


@query(
    "traffic_first_seen_stream",
    "SELECT event_type, count(DISTINCT user_id) AS active_users FROM events GROUP BY 1",
)
def traffic_first_seen_stream(t: Tables):
    """The same from a stream that gives out each user of a source once; its state has all of them."""
    keys = run_to_files(t, new_users(many_batches(t), "event_type", "user_id"), "traffic-first")
    return count_users(keys, "event_type")


@query(
    "stream_output_modes",
    """
    SELECT 'append' AS mode, event_type, count(*) AS n FROM events GROUP BY 2
    UNION ALL SELECT 'complete', event_type, count(*) FROM events GROUP BY 2
    UNION ALL SELECT 'update', event_type, count(*) FROM events GROUP BY 2
    """,
)
def stream_output_modes(t: Tables):
    """The same counts by the rows of append mode and the groups of complete and update mode."""
    appended = run_to_files(t, many_batches(t).select("event_type"), "appended")
    counts = [
        appended.groupBy("event_type").agg(count_rows()).select(F.lit("append").alias("mode"), "*")
    ]
    for mode in ("complete", "update"):
        path, state = fresh(t, mode, f"{mode}-state")
        totals = many_batches(t).groupBy("event_type").agg(count_rows())
        # The last that a batch says of a group is its total.
        run_to_end(for_each_batch(totals, append_batches(path), state, mode))
        rows = t.spark.read.parquet(path)
        newest = rows.groupBy("event_type").agg(F.max_by("n", "batch").alias("n"))
        counts.append(newest.select(F.lit(mode).alias("mode"), "event_type", "n"))
    return counts[0].union(counts[1]).union(counts[2])


@query("stream_trigger", EVENTS_SQL)
def stream_trigger(t: Tables):
    """Processing-time trigger, one file per batch."""
    path, state = fresh(t, "triggered", "triggered-state")
    stream = stream_events(t, files_per_trigger=1).select(*EVENT_COLUMNS)
    running = to_files(stream, path, state, every="1 second")
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return t.spark.read.parquet(path)


@query(
    "stream_monitor",
    "SELECT 'monitored' AS name, FALSE AS active, count(*) AS n_rows, TRUE AS many_batches FROM events",
)
def stream_monitor(t: Tables):
    """Name, state and rows read of a finished query, as its progress reports tell."""
    path, state = fresh(t, "monitored", "monitored-state")
    name = f"monitored_{uuid.uuid4().hex[:8]}"
    with monitor.progress_totals(t.spark) as totals:
        done = run_to_end(to_files(many_batches(t).select(*EVENT_COLUMNS), path, state, name))
        read = totals.of(done)
    seen = monitor.describe(done)
    return t.spark.createDataFrame(
        [(seen["name"].split("_")[0], seen["active"], read.rows_read, read.batches >= 4)],
        "name string, active boolean, n_rows bigint, many_batches boolean",
    )


@query("stream_manage", "SELECT event_type, count(*) AS n, TRUE AS found, TRUE AS stopped FROM events GROUP BY 1")
def stream_manage(t: Tables):
    """A running query found by name, let finish its input, stopped and awaited."""
    path, state = fresh(t, "managed", "managed-state")
    name = f"managed_{uuid.uuid4().hex[:8]}"
    to_files(stream_events(t).select(*EVENT_COLUMNS), path, state, name, "1 second")
    running = monitor.find(t.spark, name)
    running.processAllAvailable()
    running.stop()
    running.awaitTermination(60)
    stopped = monitor.find(t.spark, name) is None
    return t.spark.read.parquet(path).groupBy("event_type").agg(
        count_rows(), F.lit(running.name == name).alias("found"), F.lit(stopped).alias("stopped")
    )


def messages(events: DataFrame, broken: str | None = "error") -> DataFrame:
    """Sensor messages as a broker would give them: a binary JSON ``value``.

    Readings of the tag ``broken`` have a stray brace in front, so their payload
    cannot be parsed.
    """
    ts = F.col("ts").cast("timestamp")
    payload = F.to_json(
        F.struct(
            F.col("user_id").cast("string").alias("deviceName"),
            F.col("event_type").alias("tagName"),
            F.col("event_id").cast("string").alias("deviceID"),
            F.lit(True).alias("success"),
            F.lit("double").alias("datatype"),
            F.unix_millis(ts).alias("timestamp"),
            F.col("value").cast("string").alias("value"),
            F.lit("r1").alias("registerId"),
            F.col("props").alias("description"),
        )
    )
    brace = F.when(F.col("event_type") == F.lit(broken), "{").otherwise("")
    return events.select(F.concat(brace, payload).cast("binary").alias("value"))


BRONZE_SQL = """
    SELECT event_id::VARCHAR AS "deviceID", user_id::VARCHAR AS "deviceName", event_type AS "tagName",
           value, props AS description, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, year(ts)::INTEGER AS year,
           month(ts)::INTEGER AS month, day(ts)::INTEGER AS day, hour(ts)::INTEGER AS hour
    FROM events WHERE event_type <> 'error'
"""


def shown_bronze(rows: DataFrame) -> DataFrame:
    return rows.select(
        "deviceID",
        "deviceName",
        "tagName",
        F.col("value").try_cast("double").alias("value"),
        "description",
        stamp(F.col("timestamp")).alias("ts"),
        "year",
        "month",
        "day",
        "hour",
    )


@query("stream_payload_parse", BRONZE_SQL)
def stream_payload_parse(t: Tables):
    return shown_bronze(run_to_files(t, parse_payload(messages(stream_events(t))), "payloads"))


@query("bronze_parse", BRONZE_SQL)
def bronze_parse(t: Tables):
    """Messages to typed, null-free rows in folders by date, which later reads prune."""
    path, state = fresh(t, "bronze", "bronze-state")
    handle = append_batches(path, partition_by=["year", "month", "day"])
    run_to_end(for_each_batch(parse_payload(messages(stream_events(t))), handle, state))
    return shown_bronze(t.spark.read.parquet(path))


@query(
    "bronze_time_range",
    f"SELECT * FROM ({BRONZE_SQL}) WHERE ts >= '2024-01-10 06:00:00' AND ts < '2024-01-20 18:00:00'",
)
def bronze_time_range(t: Tables):
    """A time range of the bronze table: only its days' folders are opened."""
    path = scratch_path(t.spark, "bronze-days")
    write_parquet(parse_payload(messages(t.events)), path, partition_by=["year", "month", "day"])
    rows = between(t.spark.read.parquet(path), datetime(2024, 1, 10, 6), datetime(2024, 1, 20, 18))
    return shown_bronze(rows)


@query("bronze_parse_batch", BRONZE_SQL)
def bronze_parse_batch(t: Tables):
    """The same transformation on a batch frame."""
    return shown_bronze(parse_payload(messages(t.events)))


def replayed_events(t: Tables) -> str:
    """The deliveries of ``delivered_events``, each with the last hour of the one before again."""
    (folder,) = fresh(t, "replayed")
    files = [r["file"] for r in t.spark.read.parquet(delivered_events(t)).groupBy(
        F.col("_metadata.file_path").alias("file")).agg(F.min("ts").alias("first")).orderBy("first").collect()]
    before = None
    for file in files:
        rows = t.spark.read.parquet(file)
        again = rows if before is None else rows.unionByName(before)
        again.repartition(files_per_delivery(t)).write.mode("append").parquet(folder)
        newest = rows.agg(F.max("ts")).scalar()
        before = rows.filter(F.col("ts") > newest - F.expr("interval 1 hour"))
    return folder


@query("bronze_deduplicated", BRONZE_SQL)
def bronze_deduplicated(t: Tables):
    """A source that delivers some messages twice: each is written once, with the keys of two hours as state."""
    stream = file_stream(t.spark, replayed_events(t), t.events.schema, files_per_trigger=1)
    bronze = parse_payload(messages(stream))
    once = each_once(bronze, ["deviceName", "tagName", "timestamp", "deviceID"], "timestamp", "2 hours")
    return shown_bronze(run_to_files(t, once, "bronze-once"))


def incomplete(events: DataFrame) -> DataFrame:
    """Every eleventh event loses its text."""
    lost = F.when(F.col("event_id") % 11 != 0, F.col("props"))
    return events.withColumn("props", lost)


@query(
    "bronze_with_rejects",
    """
    SELECT 'good' AS kind, NULL AS reason, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, value
    FROM events WHERE event_type <> 'error' AND event_id % 11 <> 0
    UNION ALL
    SELECT 'rejected', CASE WHEN event_type = 'error' THEN 'malformed' ELSE 'missing description' END, event_id, NULL, NULL
    FROM events WHERE event_type = 'error' OR event_id % 11 = 0
    """,
)
def bronze_with_rejects(t: Tables):
    """Good rows and rejected messages of each batch in two folders, written by one pass."""
    path, state = fresh(t, "checked", "checked-state")
    split = split_payload(messages(incomplete(stream_events(t))))
    run_to_end(for_each_batch(split, append_batches(path, partition_by=["kind", "year", "month", "day"]), state))
    written = t.spark.read.schema(split.schema).parquet(path)
    good, bad = accepted(written), rejected(written)
    no_text, no_number = F.lit(None).cast("string"), F.lit(None).cast("double")
    event_id = F.regexp_extract(F.col("raw").cast("string"), '"deviceID":"([0-9]+)"', 1)
    return good.select(
        F.lit("good").alias("kind"),
        no_text.alias("reason"),
        F.col("deviceID").cast("bigint").alias("event_id"),
        stamp(F.col("timestamp")).alias("ts"),
        F.col("value").try_cast("double").alias("value"),
    ).unionByName(
        bad.select(
            F.lit("rejected").alias("kind"),
            "reason",
            event_id.cast("bigint").alias("event_id"),
            no_text.alias("ts"),
            no_number.alias("value"),
        )
    )


@query(
    "stream_upsert_rollup",
    """
    WITH latest AS (SELECT user_id, event_type, time_bucket(INTERVAL 5 MINUTE, ts) AS b, arg_max(value, (ts, event_id)) AS v
                    FROM events GROUP BY ALL)
    SELECT user_id, event_type, strftime(time_bucket(INTERVAL 1 HOUR, b) + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end,
           arg_min(v, b) AS first_value, arg_max(v, b) AS last_value, min(v) AS min_value, max(v) AS max_value,
           round(avg(v), 10) AS avg_value
    FROM latest GROUP BY user_id, event_type, time_bucket(INTERVAL 1 HOUR, b)
    """,
)
def stream_upsert_rollup(t: Tables):
    """An hourly table kept by a stream: every seventh reading comes a delivery late and corrects its hour."""
    deliveries, readings, table, state = fresh(t, "late", "readings", "hourly", "upsert-state")
    number = delivery_number(t) + F.when(F.col("event_id") % 7 == 0, 1).otherwise(0)
    numbered = t.events.withColumn("_delivery", number)
    for i in range(DELIVERIES + 1):
        rows = numbered.filter(F.col("_delivery") == i).drop("_delivery")
        rows.repartition(files_per_delivery(t)).write.mode("append").parquet(deliveries)
    stream = file_stream(t.spark, deliveries, t.events.schema, files_per_trigger=1)
    stream = stream.withColumn("ts", F.col("ts").cast("timestamp"))
    handle = upsert_periods(readings, table, ["user_id", "event_type"], "ts", "value", 3600, ["event_id"])
    run_to_end(for_each_batch(stream.drop("props"), handle, state))
    return t.spark.read.parquet(table).select(
        "user_id",
        "event_type",
        stamp(F.col("window_end")).alias("window_end"),
        *["first_value", "last_value", "min_value", "max_value"],
        F.round("avg_value", 10).alias("avg_value"),
    )


CHECKED = ["event_id", "description", "value"]


@query(
    "stream_observed",
    """
    SELECT count(*) AS n_rows, count(*) FILTER (event_type = 'error') AS malformed,
           count(*) FILTER (event_type <> 'error' AND event_id % 11 = 0) AS incomplete,
           count(*) FILTER (event_type = 'error' OR event_id % 11 = 0) AS null_description, TRUE AS all_written
    FROM events
    """,
)
def stream_observed(t: Tables):
    """Counts of rows, rejects and nulls, reported by the pass that parses and writes the messages."""
    path, state = fresh(t, "observed", "observed-state")
    stream = file_stream(t.spark, delivered_events(t), t.events.schema, files_per_trigger=1)
    split = split_payload(messages(incomplete(stream)))
    malformed, missing = F.col("reason") == "malformed", F.col("reason").startswith("missing")
    watched = monitor.checked(split, "messages", malformed=malformed, incomplete=missing)
    with monitor.progress_totals(t.spark) as totals:
        seen = totals.of(run_to_end(to_files(watched, path, state))).observed["messages"]
    # Broken payloads have no fields at all, so their texts count as null.
    counts = [seen[name] for name in ("rows", "malformed", "incomplete", "null_description")]
    written = t.spark.read.parquet(path).count()
    return t.spark.createDataFrame(
        [(*counts, written == seen["rows"])],
        "n_rows bigint, malformed bigint, incomplete bigint, null_description bigint, all_written boolean",
    )


@query(
    "observed_write",
    """
    SELECT count(*) AS rows, count(*) - count(user_id) AS null_user_id, count(*) - count(value) AS null_value,
           count(*) FILTER (value < 0) AS negative FROM events
    """,
)
def observed_write(t: Tables):
    """Nulls and odd values counted while the table is written, not in a pass of their own."""
    (path,) = fresh(t, "observed-write")
    seen = Observation("written")
    monitor.checked(t.events.select("user_id", "value"), seen, negative=F.col("value") < 0).write.parquet(path)
    names = ["rows", "null_user_id", "null_value", "negative"]
    return t.spark.createDataFrame([tuple(seen.get[n] for n in names)], ", ".join(f"{n} bigint" for n in names))


@query(
    "stream_compacted",
    """
    SELECT event_type, count(*) AS n, round(sum(value), 2) AS total, TRUE AS few_files FROM events GROUP BY 1
    """,
)
def stream_compacted(t: Tables):
    """Batches appended by event type; every second one, those since the last are moved into few files."""
    path, state = fresh(t, "compacted", "compacted-state")
    stream = many_batches(t).select(*EVENT_COLUMNS)
    handle = append_compacted(path, ["event_type"], every=2, cluster_by=["user_id"])
    run_to_end(for_each_batch(stream, handle, state))
    rows = compacted(t.spark, path, stream.schema)
    files = t.spark.read.parquet(f"{path}/whole").select("event_type", F.col("_metadata.file_path").alias("file"))
    per_type = files.distinct().groupBy("event_type").agg(count_rows("files"))
    totals = rows.groupBy("event_type").agg(count_rows(), F.round(F.sum("value"), 2).alias("total"))
    return totals.join(per_type, "event_type", "left").select(
        "event_type", "n", "total", (F.coalesce("files", F.lit(0)) <= 1).alias("few_files")
    )
