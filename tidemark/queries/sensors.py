"""Sensor summaries over all events: device = user, tag = event type."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import stamp
from tidemark.plans.messages import parse_payload, readings
from tidemark.plans.sensors import (
    MEASURES,
    at_second,
    catch_up,
    catch_up_held,
    epoch,
    latest_descriptions,
    pending_after,
    roll_up_range,
    rollup,
    summarise_held,
    summarise_latest,
    upsert_in_days,
    upsert_tags,
    whole_periods,
    with_audit,
    with_day,
)
from tidemark.queries.registry import Tables, query
from tidemark.queries.streams import messages
from tidemark.session import scratch_path, stored
from tidemark.sources.partitioned import merge_into_partitions
from tidemark.sources.writers import write_parquet

KEYS = ["user_id", "event_type"]
MIDDLE = epoch("2024-01-16 00:00:00")
HOUR, DAY = 3600, 86_400


def shown(summary: DataFrame, keys=KEYS, time: str = "window_end") -> DataFrame:
    """Comparable form: the stamp as text, the mean without its last digits."""
    exact = [m for m in MEASURES if m != "avg_value"]
    return summary.select(
        *keys, stamp(F.col(time)).alias(time), *exact, F.round("avg_value", 10).alias("avg_value")
    )


def half_month_state(t: Tables) -> DataFrame:
    """Value each key holds at the middle of the month."""
    return (
        t.events.filter(F.col("ts") < at_second(t.events, "ts", MIDDLE))
        .groupBy(*KEYS)
        .agg(F.max_by("value", F.struct("ts", "event_id")).alias("value"))
    )


# Dense grid, filled forward, as plain SQL says it: windows of ``per`` slots from ``start``
# to the day after the newest event.
GAPFILL_SQL = """
    WITH span AS (SELECT s, date_diff('second', s, e) // {slot} AS n_slots
                  FROM (SELECT {start} AS s, date_trunc('day', max(ts)) + INTERVAL 1 DAY AS e FROM events)),
    size AS (SELECT s, n_slots, {per} AS per FROM span),
    slots AS (
        SELECT user_id, event_type, date_diff('second', s, date_trunc('second', ts)) // {slot} AS slot,
               arg_max(value, (ts, event_id)) AS value
        FROM events, size WHERE ts >= s GROUP BY ALL),
    prev AS (SELECT user_id, event_type, arg_max(value, (ts, event_id)) AS before
             FROM events, size WHERE ts < s GROUP BY ALL),
    keys AS (SELECT user_id, event_type, min(w) AS w0 FROM (
                 SELECT user_id, event_type, slot // per AS w FROM slots, size
                 UNION ALL SELECT user_id, event_type, 0 FROM prev) GROUP BY ALL),
    grid AS (SELECT user_id, event_type, w0, per, g.slot AS slot
             FROM keys, (SELECT per, unnest(range(0, n_slots)) AS slot FROM size) g WHERE g.slot >= w0 * per),
    seeded AS (SELECT user_id, event_type, slot, per,
                   CASE WHEN value IS NULL AND slot = w0 * per THEN coalesce(before, 0) ELSE value END AS value
               FROM grid LEFT JOIN slots USING (user_id, event_type, slot)
               LEFT JOIN prev USING (user_id, event_type)),
    filled AS (SELECT user_id, event_type, slot, slot // per AS w,
                   last_value(value IGNORE NULLS) OVER (PARTITION BY user_id, event_type ORDER BY slot) AS v
               FROM seeded),
    measures AS (SELECT user_id, event_type, w, arg_min(v, slot) AS first_value, arg_max(v, slot) AS last_value,
                   min(v) AS min_value, max(v) AS max_value, round(avg(v), 10) AS avg_value
                 FROM filled GROUP BY ALL),
    modes AS (SELECT user_id, event_type, w, v AS mode_value,
                   row_number() OVER (PARTITION BY user_id, event_type, w ORDER BY count(*) DESC, v DESC) AS rn
              FROM filled GROUP BY user_id, event_type, w, v)
    SELECT user_id, event_type,
           strftime(s + to_seconds(((w + 1) * per * {slot})::BIGINT), '%Y-%m-%d %H:%M:%S') AS window_end,
           first_value, last_value, min_value, max_value, mode_value, avg_value
    FROM measures JOIN modes USING (user_id, event_type, w), size WHERE rn = 1
"""


@query(
    "silver_gapfill_5min",
    GAPFILL_SQL.format(start="TIMESTAMP '2024-01-16'", slot=3600, per="n_slots"),
)
def silver_gapfill(t: Tables):
    """One window: from the middle of January to the last day, hourly, seeded by what was before."""
    _, end = whole_periods(t.events, "ts", DAY)
    end = max(end, MIDDLE + DAY)
    summary = summarise_held(
        t.events,
        KEYS,
        "ts",
        "value",
        MIDDLE,
        end,
        window_seconds=end - MIDDLE,
        slot_seconds=HOUR,
        previous=half_month_state(t),
        tiebreak=["event_id"],
    )
    return shown(summary)


@query(
    "catch_up_windows",
    GAPFILL_SQL.format(start="(SELECT date_trunc('day', min(ts)) FROM events)", slot=600, per=144),
)
def silver_gapfill_windows(t: Tables):
    """All daily windows of all events in one job, on a 10-minute grid."""
    start, end = whole_periods(t.events, "ts", DAY)
    summary = summarise_held(
        t.events,
        KEYS,
        "ts",
        "value",
        start,
        end,
        window_seconds=DAY,
        slot_seconds=600,
        tiebreak=["event_id"],
    )
    return shown(summary)


def sparse_summary(t: Tables, seconds: int = 300, run_seconds: int | None = None) -> DataFrame:
    """Last reading per tag and bucket."""
    return summarise_latest(t.events, KEYS, "ts", "value", seconds, ["event_id"], run_seconds)


LATEST_SQL = """
    latest AS (SELECT user_id, event_type, time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end,
                      arg_max(value, (ts, event_id)) AS v FROM events GROUP BY ALL),
    silver AS (SELECT user_id, event_type, window_end, v AS first_value, v AS last_value, v AS min_value,
                      v AS max_value, v AS mode_value, v AS avg_value FROM latest)
"""
SHOWN_SQL = """
    SELECT user_id, event_type, strftime(window_end, '%Y-%m-%d %H:%M:%S') AS window_end, first_value, last_value,
           min_value, max_value, mode_value, round(avg_value, 10) AS avg_value
"""


@query("silver_actionable_5min", f"WITH {LATEST_SQL} {SHOWN_SQL} FROM silver")
def silver_actionable(t: Tables):
    """Run per window, so the mode is that window's."""
    return shown(sparse_summary(t))


@query(
    "silver_actionable_day_runs",
    f"""
    WITH {LATEST_SQL},
    modes AS (SELECT user_id, event_type, date_trunc('day', window_end - INTERVAL 5 MINUTE) AS run, v AS mode_value,
                     row_number() OVER (PARTITION BY user_id, event_type, date_trunc('day', window_end - INTERVAL 5 MINUTE)
                                        ORDER BY count(*) DESC, v DESC NULLS LAST) AS rn
              FROM latest GROUP BY user_id, event_type, date_trunc('day', window_end - INTERVAL 5 MINUTE), v),
    by_run AS (SELECT s.* REPLACE (m.mode_value AS mode_value) FROM silver s JOIN modes m
               ON s.user_id = m.user_id AND s.event_type = m.event_type
                  AND date_trunc('day', s.window_end - INTERVAL 5 MINUTE) = m.run WHERE rn = 1)
    {SHOWN_SQL} FROM by_run
    """,
)
def silver_actionable_day_runs(t: Tables):
    """Run per day: the mode of a day's buckets."""
    return shown(sparse_summary(t, run_seconds=DAY))


def _rollup_cte(name: str, source: str, unit: str, label: str = "end") -> str:
    shift = f" + INTERVAL 1 {unit}" if label == "end" else ""
    bucket = f"time_bucket(INTERVAL 1 {unit}, window_end - INTERVAL 1 SECOND){shift}"
    return f"""
    {name}_m AS (SELECT user_id, event_type, {bucket} AS b, mode_value,
                   row_number() OVER (PARTITION BY user_id, event_type, {bucket}
                                      ORDER BY count(*) DESC, mode_value DESC NULLS LAST) AS rn
                 FROM {source} GROUP BY user_id, event_type, {bucket}, mode_value),
    {name} AS (SELECT s.user_id, s.event_type, s.b AS window_end, first_value, last_value, min_value, max_value, mode_value, avg_value
               FROM (SELECT user_id, event_type, {bucket} AS b, arg_min(first_value, window_end) AS first_value,
                            arg_max(last_value, window_end) AS last_value, min(min_value) AS min_value,
                            max(max_value) AS max_value, avg(avg_value) AS avg_value
                     FROM {source} GROUP BY ALL) s
               JOIN {name}_m m ON s.user_id = m.user_id AND s.event_type = m.event_type AND s.b = m.b AND rn = 1)"""


HOURLY_CTES = f"{LATEST_SQL}, {_rollup_cte('hourly', 'silver', 'HOUR')}"


@query("rollup_hour", f"WITH {HOURLY_CTES} {SHOWN_SQL} FROM hourly")
def rollup_hour(t: Tables):
    """Sparse 5-minute rows to hours, for each device and tag."""
    return shown(rollup(sparse_summary(t), KEYS, HOUR))


@query("rollup_day", f"WITH {HOURLY_CTES}, {_rollup_cte('daily', 'hourly', 'DAY', 'start')} {SHOWN_SQL} FROM daily")
def rollup_day(t: Tables):
    """Hours to days, labelled by the day's start."""
    hourly = rollup(sparse_summary(t), KEYS, HOUR)
    return shown(rollup(hourly, KEYS, DAY, label="start"))


@query("rollup_day_end", f"WITH {HOURLY_CTES}, {_rollup_cte('daily', 'hourly', 'DAY', 'end')} {SHOWN_SQL} FROM daily")
def rollup_day_end(t: Tables):
    """Hours to days, labelled by the day's end."""
    hourly = rollup(sparse_summary(t), KEYS, HOUR)
    return shown(rollup(hourly, KEYS, DAY, label="end"))


@query("upsert_rollup", f"WITH {HOURLY_CTES} {SHOWN_SQL} FROM hourly")
def merged_rollup(t: Tables):
    """An hourly table of the first 20 days, stale from the 11th on, brought up to date in place.

    Only the days that the source's hours lie in are read and written again.
    """
    path = scratch_path(t.spark, "hourly-days")
    hourly = stored(with_day(rollup(sparse_summary(t), KEYS, HOUR)), "hourly")
    day_10, day_20 = (F.lit(f"2024-01-{d}").cast("date") for d in (10, 20))
    stale = F.when(F.col("day") <= day_10, F.col("last_value"))
    upsert_in_days(t.spark, path, hourly.filter(F.col("day") <= day_20).withColumn("last_value", stale), KEYS)
    upsert_in_days(t.spark, path, hourly.filter(F.col("day") > day_10), KEYS)
    return merged_days(t, path)


@query("catch_up_from_target", f"WITH {HOURLY_CTES} {SHOWN_SQL} FROM hourly")
def catch_up_from_target(t: Tables):
    """An hourly table that holds the first half of the events, brought up to the newest hour.

    The range from the target's last stamp on is all that is read of the events.
    """
    begin, end = whole_periods(t.events, "ts", HOUR)
    middle = (begin + (end - begin) // 2) // HOUR * HOUR
    inside = F.col("ts") < at_second(t.events, "ts", middle)
    target = stored(rollup(summarise_latest(t.events.filter(inside), KEYS, "ts", "value", 300, ["event_id"]), KEYS, HOUR), "hourly")
    return shown(catch_up(target, t.events, KEYS, "ts", "value", HOUR, ["event_id"]))


@query(
    "incremental_range",
    """
    WITH last AS (SELECT date_trunc('hour', max(ts)) AS begin FROM events)
    SELECT strftime(begin + to_hours(i), '%Y-%m-%d %H:%M:%S') AS window_start,
           strftime(begin + to_hours(i + 1), '%Y-%m-%d %H:%M:%S') AS window_end
    FROM last, generate_series(0, 99) AS g(i) WHERE begin + to_hours(i + 1) <= TIMESTAMP '2024-02-02 06:30:00'
    """,
)
def incremental_range(t: Tables):
    """Hours still to be computed after the last hour with events, which file footers tell."""
    path = scratch_path(t.spark, "hours-seen")
    hours = t.events.select(F.date_trunc("hour", "ts").cast("timestamp").alias("window_end")).distinct()
    write_parquet(with_day(hours), path, partition_by=["day"])
    windows = pending_after(t.spark, path, datetime(2021, 1, 1), datetime(2024, 2, 2, 6, 30), HOUR)
    return windows.select(*[stamp(F.col(c)).alias(c) for c in windows.columns])


def merged_days(t: Tables, path: str) -> DataFrame:
    return shown(t.spark.read.parquet(path))


@query("merge_into_partitions", f"WITH {HOURLY_CTES} {SHOWN_SQL} FROM hourly")
def merged_in_place(t: Tables):
    """An hourly table in days: the first 20 days, stale from the 11th on, then all hours since in two merges.

    A merge rewrites the days that its rows fall in; the second is sent twice.
    """
    path = scratch_path(t.spark, "hourly-days")
    hourly = stored(with_day(rollup(sparse_summary(t), KEYS, HOUR)), "hourly")
    by_key = [*KEYS, "window_end"]

    def days(low: str, high: str) -> DataFrame:
        return hourly.filter(F.col("day").between(F.lit(low).cast("date"), F.lit(high).cast("date")))

    old = days("1970-01-01", "2024-01-20")
    stale = F.when(F.col("day") <= F.lit("2024-01-10").cast("date"), F.col("last_value"))
    merge_into_partitions(t.spark, path, old.withColumn("last_value", stale), by_key, ["day"], "old")
    merge_into_partitions(t.spark, path, days("2024-01-11", "2024-01-15"), by_key, ["day"], 1)
    for _ in range(2):
        merge_into_partitions(t.spark, path, days("2024-01-16", "9999-01-01"), by_key, ["day"], 2)
    return merged_days(t, path)


WINDOW, SLOT, TAGS = 21_600, 600, "p"

GAPFILLED_DAYS_SQL = f"""
    WITH windows AS ({GAPFILL_SQL.format(start="(SELECT date_trunc('day', min(ts)) FROM events)", slot=SLOT, per=WINDOW // SLOT)
                      .replace("WHERE ts >= s", f"WHERE ts >= s AND event_type LIKE '{TAGS}%'")
                      .replace("round(avg(v), 10)", "avg(v)")}),
    silver AS (SELECT * REPLACE (window_end::TIMESTAMP AS window_end) FROM windows),
    {_rollup_cte('daily', 'silver', 'DAY')}
    {SHOWN_SQL} FROM daily
"""


@query("catch_up_gapfilled", GAPFILLED_DAYS_SQL)
def catch_up_gapfilled(t: Tables):
    """From messages to days without gaps: two runs, the second from where the first one's table ends.

    Messages become readings of the tags with a prefix; all windows that are
    pending are filled from what the table's last window holds and merged into its
    days; so are the daily rows of these windows.
    """
    silver, daily = (scratch_path(t.spark, name) for name in ("silver", "daily"))
    keys = ["device", "tag"]
    begin, end = whole_periods(t.events, "ts", DAY)
    middle = begin + (end - begin) // 2 // WINDOW * WINDOW
    for until in (middle, end):
        arrived = t.events.filter(F.col("ts") < at_second(t.events, "ts", until))
        read = readings(parse_payload(messages(arrived, broken=None)), TAGS).withColumn("id", F.col("id").cast("bigint"))
        done = catch_up_held(
            t.spark, silver, read, keys, "ts", "value", begin, until, WINDOW, SLOT, ["id"], batch_id=until
        )
        if done:
            roll_up_range(t.spark, silver, daily, keys, *done, DAY, batch_id=until)
    days = t.spark.read.parquet(daily)
    named = days.withColumns({"user_id": F.col("device").cast("bigint"), "event_type": F.col("tag")})
    return shown(named)


@query(
    "tag_dimension",
    """
    WITH old AS (SELECT user_id, event_type, arg_max(props, (ts, event_id)) AS description
                 FROM events WHERE ts < TIMESTAMP '2024-01-16' GROUP BY ALL),
    new AS (SELECT user_id, event_type, arg_max(props, (ts, event_id)) AS description
            FROM events WHERE ts >= TIMESTAMP '2024-01-16' GROUP BY ALL)
    SELECT coalesce(o.user_id, n.user_id) AS user_id, coalesce(o.event_type, n.event_type) AS event_type,
           coalesce(n.description, o.description) AS description,
           coalesce(o.user_id, n.user_id) || '~' || coalesce(o.event_type, n.event_type) AS devicetag
    FROM old o FULL JOIN new n ON o.user_id = n.user_id AND o.event_type = n.event_type
    """,
)
def tag_dimension(t: Tables):
    """First half-month's tags, then the second half's newest descriptions from two sources."""
    middle = at_second(t.events, "ts", MIDDLE)
    actionable = F.col("event_type").isin("purchase", "signup")
    older, recent = t.events.filter(F.col("ts") < middle), t.events.filter(F.col("ts") >= middle)
    target = stored(latest_descriptions(older, KEYS, "ts", "props", ["event_id"]), "tags")
    newest = stored(latest_descriptions(recent, KEYS, "ts", "props", ["event_id"]), "new-tags")
    # Two feeds that both know the actionable tags.
    return upsert_tags(target, newest, newest.filter(actionable))


@query(
    "silver_audit_columns",
    """
    SELECT user_id || '~' || event_type AS devicetag, 'actionable' AS proc, TRUE AS stamped, count(*) AS n_windows
    FROM (SELECT DISTINCT user_id, event_type, time_bucket(INTERVAL 1 HOUR, ts) FROM events) GROUP BY ALL
    """,
)
def silver_audit_columns(t: Tables):
    audited = with_audit(sparse_summary(t, HOUR), KEYS, "actionable")
    stamped = F.col("insertdate").isNotNull().alias("stamped")
    return audited.groupBy("devicetag", "proc", stamped).agg(F.count(F.lit(1)).alias("n_windows"))
