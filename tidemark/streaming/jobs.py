"""Streaming transformations: streaming frame in, streaming frame out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.sketches import LG_REGISTERS, distinct_estimate


def filter_and_flag(
    events: DataFrame, source: Column, wanted: str, flag: Column, alias: str
) -> DataFrame:
    """Rows from one source, with a boolean flag added. No state."""
    return events.filter(source == wanted).withColumn(alias, flag)


def exploded_with(events: DataFrame, array: str, needed: str) -> DataFrame:
    """One row per array element that has a value in field ``needed``. No state."""
    return events.withColumn(array, F.explode(array)).filter(F.col(f"{array}.{needed}").isNotNull())


def hourly_active_users(
    events: DataFrame,
    time: str,
    source: str,
    user: str,
    lateness: str = "2 hours",
    lg_registers: int = LG_REGISTERS,
) -> DataFrame:
    """Approximate distinct users per source and hour.

    The state of a group is one binary sketch, whatever its number of users. In
    append and update mode rows later than ``lateness`` are dropped; complete mode
    keeps them all.
    """
    return (
        events.withWatermark(time, lateness)
        .groupBy(source, F.window(time, "1 hour"))
        .agg(F.hll_sketch_agg(user, lg_registers).alias("users"))
        .select(source, F.hour("window.start").alias("hour"), "window", distinct_estimate("users").alias("active_users"))
    )


def new_hourly_users(
    events: DataFrame, time: str, source: str, user: str, lateness: str = "2 hours"
) -> DataFrame:
    """Each (source, hour, user) once, when first seen (append mode).

    The rows given out so far, counted with ``count_users``, are the exact distinct
    users. A trigger gives out new keys only, and state goes when its hour has
    closed. Keying the state by user as well spreads a source with a large share
    of the rows over all state partitions. Users whose row is later than
    ``lateness`` are dropped if their hour has closed, and counted in the progress
    reports (``monitor.progress_totals``); ``sinks.append_keys`` keeps all of them.
    """
    keyed = events.withWatermark(time, lateness).select(source, F.window(time, "1 hour").alias("window"), user)
    return keyed.dropDuplicates([source, "window", user])


def new_users(events: DataFrame, source: str, user: str) -> DataFrame:
    """Each (source, user) once, when first seen: ``new_hourly_users`` without an end.

    The state has a row for each key, which an exact count so far cannot do without.
    """
    return events.select(source, user).dropDuplicates([source, user])


def hourly_user_keys(
    events: DataFrame, time: str, source: str, user: str, lateness: str = "2 hours"
) -> DataFrame:
    """One row per (source, hour, user), with its events: state for ``closed_hour_users``."""
    return (
        events.withWatermark(time, lateness)
        .groupBy(source, F.window(time, "1 hour"), user)
        .agg(F.count(F.lit(1)).alias("n_events"))
    )


def closed_hour_users(
    events: DataFrame, time: str, source: str, user: str, lateness: str = "2 hours"
) -> DataFrame:
    """Exact distinct users per source and hour, given out once the hour has closed.

    Append mode with two aggregates in a row: the first keeps one state row per
    user key, the second counts them. State of closed hours is dropped, so a job
    can run on without end, which complete mode cannot.
    """
    keys = hourly_user_keys(events, time, source, user, lateness)
    counted = keys.groupBy(source, F.window("window", "1 hour"))
    return counted.agg(F.count(F.lit(1)).alias("active_users"))


def running_users(events: DataFrame, source: str, user: str, lg_registers: int = LG_REGISTERS) -> DataFrame:
    """Approximate distinct users per source so far (complete mode), one binary sketch of state each."""
    users = events.groupBy(source).agg(F.hll_sketch_agg(user, lg_registers).alias("users"))
    return users.select(source, distinct_estimate("users").alias("active_users"))


def each_once(messages: DataFrame, keys: Sequence[str], time: str, lateness: str) -> DataFrame:
    """Each key once, for a source that can deliver a message again up to ``lateness`` later.

    The state has the keys of the last ``lateness`` only, one row each. A copy that
    comes later than that passes if it is not behind the watermark.
    """
    return messages.withWatermark(time, lateness).dropDuplicatesWithinWatermark(list(keys))


def count_users(user_keys: DataFrame, *group: str | Column) -> DataFrame:
    """Number of user keys per group; for what the ``new_*users`` frames gave out."""
    return user_keys.groupBy(*group).agg(F.count(F.lit(1)).alias("active_users"))


def windowed_totals(
    events: DataFrame, time: str, keys: Sequence[str], width: str, lateness: str, *totals: Column
) -> DataFrame:
    """Tumbling-window aggregate in append mode: a window is given out once, when closed."""
    return events.withWatermark(time, lateness).groupBy(*keys, F.window(time, width)).agg(*totals)
