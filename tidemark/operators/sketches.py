"""Mergeable sketches: distinct counts and quantiles as binary columns of a table.

A group's sketch is one value of bounded size, made with map-side combining, so a
hot group sends one row from each task. Sketches of fine groups (hours) are united
to those of coarse ones (days, months, rolling weeks) without reading the rows again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import quoted

# 2^14 registers: a standard error of 0.8 %, up to 8 KB a group.
LG_REGISTERS = 14
# Size parameter of quantile sketches: a rank error of 0.7 % at 400.
QUANTILE_SIZE = 400


def distinct_sketches(
    frame: DataFrame, keys: Sequence[str | Column], value: str, alias: str = "sketch", lg_registers: int = LG_REGISTERS
) -> DataFrame:
    """(keys, sketch): the distinct values of each group; nulls do not count."""
    return frame.groupBy(*keys).agg(F.hll_sketch_agg(value, lg_registers).alias(alias))


def unite_sketches(sketches: DataFrame, keys: Sequence[str | Column], alias: str = "sketch") -> DataFrame:
    """(keys, sketch) of coarser groups, from sketches of the same size or not."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg(alias, True).alias(alias))


def distinct_estimate(sketch: str | Column = "sketch") -> Column:
    """Approximate number of distinct values; null for a group that has no sketch."""
    return F.hll_sketch_estimate(sketch)


def rolling_sketches(daily: DataFrame, keys: Sequence[str], day: str, days: int, alias: str = "sketch") -> DataFrame:
    """(keys, day, sketch) of the ``days`` days that end with each day of the table.

    Every daily sketch counts for its own and the ``days - 1`` following days, so a
    row is copied ``days`` times: sketches, not events. Days without a sketch of
    their own are left out, as are those after the last.
    """
    own = daily.select(*quoted(keys), F.col(day).alias("_own")).distinct()
    ends = F.sequence(F.lit(0), F.lit(days - 1))
    copied = daily.select(*quoted(keys), F.explode(ends).alias("_ahead"), day, alias)
    moved = copied.withColumn(day, F.date_add(day, F.col("_ahead"))).drop("_ahead")
    united = unite_sketches(moved, [*quoted(keys), day], alias)
    return united.join(own.withColumnRenamed("_own", day), [*keys, day], "left_semi")


def set_sketches(frame: DataFrame, keys: Sequence[str | Column], value: str, alias: str = "sketch") -> DataFrame:
    """(keys, sketch): theta sketches, which can also be intersected and subtracted.

    Their error is that of the larger set: an intersection of two large sets that is
    small is known to a few per cent of these.
    """
    return frame.groupBy(*keys).agg(F.theta_sketch_agg(value, F.lit(LG_REGISTERS)).alias(alias))


def returning(sketches: DataFrame, keys: Sequence[str], period: str, step: int, alias: str = "sketch") -> DataFrame:
    """(keys, period, seen, returned, left): of each period's distinct values, those of the period before.

    ``period`` is a whole number or date, ``step`` the distance of two periods.
    ``returned`` were there before as well, ``left`` were there before and are not
    now; both are 0 where the period before has no sketch.
    """
    before = sketches.withColumn(period, F.col(period) + step).withColumnRenamed(alias, "_before")
    both = sketches.join(before, [*keys, period], "left")
    none = F.lit(0).cast("bigint")
    return both.select(
        *quoted(keys),
        period,
        F.theta_sketch_estimate(alias).alias("seen"),
        F.coalesce(F.theta_sketch_estimate(F.theta_intersection(alias, "_before")), none).alias("returned"),
        F.coalesce(F.theta_sketch_estimate(F.theta_difference("_before", alias)), none).alias("left"),
    )


def quantile_sketches(
    frame: DataFrame, keys: Sequence[str | Column], value: str, alias: str = "sketch", size: int = QUANTILE_SIZE
) -> DataFrame:
    """(keys, sketch): KLL sketches of a number's distribution in each group; nulls do not count."""
    return frame.groupBy(*keys).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), size).alias(alias))


def unite_quantiles(
    sketches: DataFrame, keys: Sequence[str | Column], alias: str = "sketch", size: int = QUANTILE_SIZE
) -> DataFrame:
    """(keys, sketch) of coarser groups."""
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_double(alias, size).alias(alias))


def quantile_columns(shares: dict[str, float], sketch: str = "sketch") -> list[Column]:
    """One column for each named share, with the value below which it lies."""
    return [F.kll_sketch_get_quantile_double(sketch, F.lit(share)).alias(name) for name, share in shares.items()]
