"""Sensor time series: typed readings, 5-minute summaries, rollups, tag dimension.

A summary row holds, per key and period, ``last_value first_value min_value
max_value avg_value mode_value`` and is stamped with the period's end.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.times import epoch_seconds, label_bucket, moment, sane_time
from tidemark.operators.aggregates import total_order
from tidemark.operators.joins import left_lookup
from tidemark.operators.merge import merge_upsert
from tidemark.operators.windows import latest_per_slot
from tidemark.session import stored
from tidemark.sources.partitioned import high_water_mark, replace_in_partitions

MEASURES = ("first_value", "last_value", "min_value", "max_value", "mode_value", "avg_value")


def epoch(text: str) -> int:
    """Epoch seconds of a UTC ``yyyy-mm-dd hh:mm:ss`` text."""
    return int(datetime.fromisoformat(text).replace(tzinfo=timezone.utc).timestamp())


def at_second(readings: DataFrame, time: str, second: int) -> Column:
    """A fixed second in the type of the time column, so that filters on it reach the scan."""
    return F.timestamp_seconds(F.lit(second)).cast(readings.schema[time].dataType)


def whole_periods(readings: DataFrame, time: str, seconds: int) -> tuple[int, int]:
    """Start and end, in epoch seconds, of the whole periods that hold all stamps.

    An empty table has the empty range at 0.
    """
    low, high = readings.agg(
        F.min(epoch_seconds(F.col(time))).alias("low"), F.max(epoch_seconds(F.col(time))).alias("high")
    ).first()
    if low is None:
        return 0, 0
    return low // seconds * seconds, (high // seconds + 1) * seconds


def observed_slots(
    readings: DataFrame,
    keys: Sequence[str],
    time: str,
    value: str,
    start: int,
    end: int,
    slot_seconds: int,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """(keys, slot, value): last reading per slot of ``[start, end)``, slots from 0."""
    inside = readings.filter(
        (F.col(time) >= at_second(readings, time, start)) & (F.col(time) < at_second(readings, time, end))
    )
    slot = F.floor((epoch_seconds(F.col(time)) - start) / slot_seconds)
    last = F.max_by(value, total_order(time, *tiebreak))
    return inside.groupBy(*keys, slot.alias("slot")).agg(last.alias("value"))


def window_seeds(
    slots: DataFrame,
    keys: Sequence[str],
    per_window: int,
    n_windows: int,
    previous: DataFrame | None = None,
) -> DataFrame:
    """(keys, window, seed): the value each key holds when a window starts.

    A key starts in the first window it is seen in, with 0, or with its value in
    ``previous`` (keys, value), and is then present in every later window. Only
    one row per (key, window with readings) is ordered, never the readings.
    """
    window = F.floor(F.col("slot") / per_window)
    known = F.when(F.col("value").isNotNull(), F.col("slot"))
    ends = slots.groupBy(*keys, window.alias("window")).agg(
        F.max_by("value", known).alias("value")
    )
    if previous is not None:
        before = previous.select(*keys, F.lit(-1).cast("bigint").alias("window"), "value")
        ends = ends.unionByName(before)
    in_time = Window.partitionBy(*keys).orderBy("window")
    held = F.coalesce(F.last("value", ignorenulls=True).over(in_time), F.lit(0.0))
    following = F.lead("window", 1, n_windows).over(in_time)
    is_first = F.lag("window").over(in_time).isNull() & (F.col("window") >= 0)
    spans = ends.select(
        *keys,
        F.col("window").alias("seen"),
        held.alias("held"),
        # A row seeds the windows after its own, up to and including the next one
        # with readings; the first row of a key also seeds its own window.
        F.when(is_first, F.col("window")).otherwise(F.col("window") + 1).alias("from"),
        F.least(following, F.lit(n_windows - 1)).alias("until"),
    )
    seeded = F.when(F.col("from") <= F.col("until"), F.sequence("from", "until"))
    seed = F.when(F.col("window") == F.col("seen"), F.lit(0.0)).otherwise(F.col("held"))
    return spans.select("*", F.explode(seeded).alias("window")).select(
        *keys, "window", seed.alias("seed")
    )


def summarise_held(
    readings: DataFrame,
    keys: Sequence[str],
    time: str,
    value: str,
    start: int,
    end: int,
    window_seconds: int,
    slot_seconds: int = 1,
    previous: DataFrame | None = None,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Gap-filled summary of every window of ``[start, end)`` in one job.

    Meaning: lay a grid of slots over each window for every key seen so far,
    give an empty first slot the value held before, fill the other empty slots
    forward, then take last, first, min, max, mode and mean over the grid.

    The grid is never built. A reading counts with the number of slots it is
    held for, so the work follows the readings and not keys x slots. Ordering
    is per (key, window), at most one window's slots, so a key with a large
    share of all rows is spread over its windows.
    """
    if (end - start) % window_seconds or window_seconds % slot_seconds:
        raise ValueError("the range must hold whole windows and a window whole slots")
    per_window = window_seconds // slot_seconds
    n_windows = (end - start) // window_seconds
    slots = observed_slots(readings, keys, time, value, start, end, slot_seconds, tiebreak)
    seeds = window_seeds(slots, keys, per_window, n_windows, previous).select(
        *keys,
        "window",
        (F.col("window") * per_window).alias("slot"),
        F.lit(0).alias("is_reading"),
        F.col("seed").alias("value"),
    )
    seen = slots.filter(F.col("value").isNotNull()).select(
        *keys,
        F.floor(F.col("slot") / per_window).alias("window"),
        "slot",
        F.lit(1).alias("is_reading"),
        "value",
    )
    in_window = Window.partitionBy(*keys, "window").orderBy("slot", "is_reading")
    next_slot = F.coalesce(F.lead("slot").over(in_window), (F.col("window") + 1) * per_window)
    runs = seeds.unionByName(seen).withColumn("n", next_slot - F.col("slot")).filter("n > 0")
    stamped = _summarise_runs(runs, keys, "window")
    window_end = F.timestamp_seconds(start + (F.col("window") + 1) * window_seconds)
    return stamped.select(*keys, window_end.alias("window_end"), *MEASURES)


def _summarise_runs(runs: DataFrame, keys: Sequence[str], period: str) -> DataFrame:
    """Measures per (keys, period) of (slot, value, n) runs; n is the weight."""
    per_value = runs.groupBy(*keys, period, "value").agg(
        F.sum("n").alias("n"), F.min("slot").alias("first_slot"), F.max("slot").alias("last_slot")
    )
    return per_value.groupBy(*keys, period).agg(
        F.min_by("value", "first_slot").alias("first_value"),
        F.max_by("value", "last_slot").alias("last_value"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.max(F.struct("n", "value")).getField("value").alias("mode_value"),
        (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("avg_value"),
    )


def grid(frame: DataFrame, keys: Sequence[str], first: int, last: int) -> DataFrame:
    """Each distinct key with every slot number ``first .. last``.

    The slots are generated per key, so no join of keys and grid is planned.
    """
    slots = F.sequence(F.lit(first).cast("bigint"), F.lit(last).cast("bigint"))
    return frame.select(*keys).distinct().select(*keys, F.explode(slots).alias("slot"))


def summarise_latest(
    readings: DataFrame,
    keys: Sequence[str],
    time: str,
    value: str,
    seconds: int,
    tiebreak: Sequence[str] = (),
    run_seconds: int | None = None,
) -> DataFrame:
    """Sparse summary: the last reading of each bucket stands for all measures.

    The mode is that of the buckets of one run, ``run_seconds`` long and counted
    from the epoch. A run is a bucket unless it is given, and then the mode is its
    reading; published rows of closed runs never change. No gaps are filled.
    Readings without a full key are left out.
    """
    run_seconds = seconds if run_seconds is None else run_seconds
    if run_seconds % seconds:
        raise ValueError("a run must hold whole buckets")
    named = readings.na.drop(subset=list(keys))
    slots = latest_per_slot(named, keys, time, value, seconds, tiebreak)
    if run_seconds == seconds:
        with_mode = slots.withColumn("mode_value", F.col(value))
    else:
        slots = slots.withColumn("_run", F.floor(F.col("slot") / run_seconds))
        per_value = slots.groupBy(*keys, "_run", value).agg(F.count(F.lit(1)).alias("n"))
        modes = per_value.groupBy(*keys, "_run").agg(
            F.max(F.struct(F.col("n"), F.col(value))).getField(value).alias("mode_value")
        )
        with_mode = left_lookup(slots, modes, [*keys, "_run"], "inner")
    v = F.col(value).cast("double")
    return with_mode.select(
        *keys,
        F.timestamp_seconds(F.col("slot") + seconds).alias("window_end"),
        v.alias("first_value"),
        v.alias("last_value"),
        v.alias("min_value"),
        v.alias("max_value"),
        F.col("mode_value").cast("double").alias("mode_value"),
        v.alias("avg_value"),
    )


def rollup(
    summary: DataFrame,
    keys: Sequence[str],
    seconds: int,
    time: str = "window_end",
    label: str = "end",
) -> DataFrame:
    """Coarser summary: last of last, first of first, min, max, mode of modes, mean of means.

    A stamp on the boundary closes the period that ends there. Means are not
    weighted. Grouping by mode value first lets one pass give both the mode and
    the other measures, without a self join, and over plain columns, so by
    hashing; only its few rows are then sorted for the mode. Corrupt stamps are
    left out.
    """
    bucket = label_bucket(F.col(time), seconds, label)
    per_mode = (
        summary.filter(sane_time(F.col(time)))
        .groupBy(*keys, bucket.alias("_bucket"), "mode_value")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(time).alias("first_time"),
            F.min_by("first_value", time).alias("first_value"),
            F.max(time).alias("last_time"),
            F.max_by("last_value", time).alias("last_value"),
            F.min("min_value").alias("min_value"),
            F.max("max_value").alias("max_value"),
            F.sum("avg_value").alias("avg_sum"),
            F.count("avg_value").alias("avg_n"),
        )
    )
    return (
        per_mode.groupBy(*keys, "_bucket")
        .agg(
            F.min_by("first_value", "first_time").alias("first_value"),
            F.max_by("last_value", "last_time").alias("last_value"),
            F.min("min_value").alias("min_value"),
            F.max("max_value").alias("max_value"),
            F.max(F.struct("n", "mode_value")).getField("mode_value").alias("mode_value"),
            F.try_divide(F.sum("avg_sum"), F.sum("avg_n")).alias("avg_value"),
        )
        .withColumnRenamed("_bucket", time)
        .select(*keys, time, *MEASURES)
    )


def upsert_rollup(
    target: DataFrame, source: DataFrame, keys: Sequence[str], time: str = "window_end"
) -> DataFrame:
    """Target after the source's periods replaced or joined its own."""
    return merge_upsert(target, source, [*keys, time])


def upsert_in_days(
    spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], batch_id: int | str | None = None
) -> bool:
    """Put a summary's periods, one row each, into a table in days (``with_day``): only their days are rewritten."""
    return replace_in_partitions(spark, path, source, [*keys, "window_end"], ["day"], batch_id)


def pending_windows(
    target: DataFrame, time: str, initial: datetime, now: datetime, seconds: int
) -> DataFrame:
    """(window_start, window_end) of every whole window not yet in ``target``.

    Starts at the last stamp in ``target``, or at ``initial`` if it is empty.
    Stamps in the far future are ignored: one corrupt stamp would otherwise stop
    the job for good. Reads the column; ``pending_after`` takes the last stamp
    from file footers instead.
    """
    last = target.filter(sane_time(F.col(time).cast("timestamp"))).agg(
        F.unix_timestamp(F.max(F.col(time).cast("timestamp"))).alias("last")
    )
    return _windows_after(last, initial, now, seconds)


def pending_after(spark: SparkSession, path: str, initial: datetime, now: datetime, seconds: int) -> DataFrame:
    """``pending_windows`` of a table in days (``with_day``) at ``path``, whose rows are not read."""
    last = high_water_mark(spark, path, "end_second", sane_day())
    return _windows_after(spark.createDataFrame([(last,)], "last bigint"), initial, now, seconds)


def _windows_after(last: DataFrame, initial: datetime, now: datetime, seconds: int) -> DataFrame:
    begin = F.coalesce("last", F.unix_timestamp(moment(initial)))
    count = F.floor((F.unix_timestamp(moment(now)) - begin) / seconds)
    steps = F.when(count > 0, F.sequence(F.lit(1).cast("bigint"), count)).otherwise(
        F.array().cast("array<bigint>")
    )
    return last.select(begin.alias("begin"), F.explode(steps).alias("step")).select(
        F.timestamp_seconds(F.col("begin") + (F.col("step") - 1) * seconds).alias("window_start"),
        F.timestamp_seconds(F.col("begin") + F.col("step") * seconds).alias("window_end"),
    )


def catch_up(
    target: DataFrame,
    readings: DataFrame,
    keys: Sequence[str],
    time: str,
    value: str,
    seconds: int,
    tiebreak: Sequence[str] = (),
    bucket_seconds: int = 300,
    start: int | None = None,
) -> DataFrame:
    """A rolled-up table after the readings since its last period were summed up and merged.

    The last stamp of ``target`` is where the pending range begins: its period is
    computed again, as it may have been open, and only readings from there on are
    read (the range reaches the scan). An empty target takes all readings. ``start``
    (epoch seconds) begins the range earlier, for readings that came late.
    """
    last = target.filter(sane_time(F.col("window_end"))).agg(F.max(F.unix_timestamp("window_end"))).first()[0]
    if last is not None:
        begin = last - seconds if start is None else min(start // seconds * seconds, last - seconds)
        readings = readings.filter(F.col(time) >= at_second(readings, time, begin))
    pending = rollup(summarise_latest(readings, keys, time, value, bucket_seconds, tiebreak), keys, seconds)
    return upsert_rollup(target, stored(pending, "pending"), keys)


def with_day(summary: DataFrame, time: str = "window_end") -> DataFrame:
    """The day a period lies in, as ``day``, and its end as epoch seconds, whose maximum stands in file footers."""
    second = F.unix_timestamp(time)
    return summary.withColumns({"end_second": second, "day": F.to_date(F.timestamp_seconds(second - 1))})


def sane_day(day: str = "day") -> Column:
    """Days of ``sane_time``, as a filter on the folders of ``with_day`` tables."""
    return (F.col(day) >= F.lit("1970-01-01").cast("date")) & (F.col(day) < F.lit("2339-03-21").cast("date"))


def held_at(spark: SparkSession, path: str, keys: Sequence[str], second: int) -> DataFrame:
    """(keys, value): what each key held when the period that ends at ``second`` had ended."""
    rows = spark.read.parquet(path)
    day = F.to_date(F.timestamp_seconds(F.lit(second - 1)))
    ended = rows.filter((F.col("day") == day) & (F.col("end_second") == second))
    return ended.select(*keys, F.col("last_value").alias("value"))


def catch_up_held(
    spark: SparkSession,
    path: str,
    readings: DataFrame,
    keys: Sequence[str],
    time: str,
    value: str,
    first: int,
    until: int,
    window_seconds: int,
    slot_seconds: int = 1,
    tiebreak: Sequence[str] = (),
    start: int | None = None,
    batch_id: int | str | None = None,
) -> tuple[int, int] | None:
    """Bring a gap-filled table at ``path`` up to date: all whole windows that are pending, in one job.

    The range begins where the table's newest window ends (taken from file
    footers), or at ``first`` if there is no table, and holds the whole windows up
    to ``until``. Keys go on with the values that the table's last window left
    them with. ``start``, an end of a window, computes again from there, with what
    was held then, for readings that came late; windows after the range are then
    not changed. Only the days of the range are read and written. Returns the
    range in epoch seconds, or None if nothing is pending.
    """
    newest = high_water_mark(spark, path, "end_second", sane_day())
    begin = first if newest is None else newest if start is None else start
    end = begin + (until - begin) // window_seconds * window_seconds
    if end <= begin:
        return None
    previous = None if newest is None else held_at(spark, path, keys, begin)
    pending = summarise_held(
        readings, keys, time, value, begin, end, window_seconds, slot_seconds, previous, tiebreak
    )
    upsert_in_days(spark, path, with_day(pending), keys, batch_id)
    return begin, end


def roll_up_range(
    spark: SparkSession,
    fine_path: str,
    coarse_path: str,
    keys: Sequence[str],
    begin: int,
    end: int,
    seconds: int,
    batch_id: int | str | None = None,
) -> None:
    """Sum up the periods that ``(begin, end]`` of a finer table touches, and merge them into a coarser one.

    Both tables are in days (``with_day``); only those of the range are read and
    written, so ``seconds`` must divide a day.
    """
    low, high = begin // seconds * seconds, -(-end // seconds) * seconds
    rows = spark.read.parquet(fine_path)
    first_day, last_day = (F.to_date(F.timestamp_seconds(F.lit(s))) for s in (low, high - 1))
    inside = F.col("day").between(first_day, last_day) & (F.col("end_second") > low) & (F.col("end_second") <= high)
    coarse = rollup(rows.filter(inside).drop("end_second", "day"), keys, seconds)
    upsert_in_days(spark, coarse_path, with_day(coarse), keys, batch_id)


def latest_descriptions(
    readings: DataFrame, keys: Sequence[str], time: str, text: str, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """(keys, description, seen, devicetag): each key's newest description and its stamp."""
    newest = F.max_by(text, total_order(time, *tiebreak)).alias("description")
    tag = F.concat(F.col(keys[0]).cast("string"), F.lit("~"), F.col(keys[1]).cast("string"))
    latest = readings.groupBy(*keys).agg(newest, F.max(time).alias("seen"))
    return latest.select(*keys, "description", "seen", tag.alias("devicetag"))


def upsert_tags(target: DataFrame, *sources: DataFrame, time: str = "seen") -> DataFrame:
    """Tag dimension after a merge that updates only the description.

    The sources, feeds of ``latest_descriptions``, may both know a tag: the newest
    description counts, by ``time``; of equally new ones the larger text. They are
    read more than once: pass them stored if they are costly.
    """
    merged = reduce(DataFrame.unionByName, sources)
    rest = [c for c in merged.columns if c not in ("devicetag", time)]
    newest = F.max_by(F.struct(*rest), F.struct(time, "description")).alias("_row")
    latest = merged.groupBy("devicetag").agg(newest).select("_row.*", "devicetag")
    return merge_upsert(target.drop(time), latest, ["devicetag"], ["description"])


def with_audit(summary: DataFrame, keys: Sequence[str], process: str) -> DataFrame:
    """Add insert time, process name and ``device~tag``."""
    tag = F.concat(F.col(keys[0]).cast("string"), F.lit("~"), F.col(keys[1]).cast("string"))
    return summary.select(
        "*",
        F.current_timestamp().alias("insertdate"),
        F.lit(process).alias("proc"),
        tag.alias("devicetag"),
    )
