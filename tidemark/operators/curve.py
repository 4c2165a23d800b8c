"""Places on a space-filling curve, from the interleaved ranks of several columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, StringType, TimestampNTZType, TimestampType

from tidemark.functions.times import epoch_seconds

RANK_BITS = 8
# Characters of a text that its rank follows.
TEXT_PREFIX = 6


def as_number(frame: DataFrame, column: str) -> Column:
    """A number in the order of the column's values; texts by their first bytes."""
    kind, value = frame.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, (TimestampType, TimestampNTZType, DateType)):
        return epoch_seconds(value).cast("double")
    if isinstance(kind, StringType):
        prefix = F.rpad(F.hex(F.substring(value.cast("binary"), 1, TEXT_PREFIX)), 2 * TEXT_PREFIX, "0")
        return F.conv(prefix, 16, 10).cast("double")
    if isinstance(kind, NumericType):
        return value.cast("double")
    raise TypeError(f"no order of {kind.simpleString()} is known here")


def with_curve_position(frame: DataFrame, columns: Sequence[str], alias: str, bits: int = RANK_BITS) -> DataFrame:
    """Add a row's place on the curve: the bits of its ranks in each column, highest first, in turn.

    A rank is the number of a column's ``2^bits`` approximate quantiles below
    the value, so that all ranks are about as frequent whatever the distribution;
    nulls rank lowest. The quantiles of all columns come from one pass, as
    ``2^bits - 1`` numbers each. They place rows, and do not enter results.
    """
    if not 1 <= bits * len(columns) <= 62:
        raise ValueError("a place must fit into 62 bits")
    numbers = [as_number(frame, c) for c in columns]
    n = 2**bits
    shares = [i / n for i in range(1, n)]
    found = frame.agg(*[F.percentile_approx(x, shares, 20 * n) for x in numbers]).first()
    ranks = [f"_rank{i}" for i in range(len(columns))]
    values = [f"_number{i}" for i in range(len(columns))]
    rows = frame.withColumns({**dict(zip(values, numbers)), **{r: F.lit(0) for r in ranks}})
    known = [F.array(*[F.lit(float(c)) for c in cuts or []]).cast("array<double>") for cuts in found]
    # The number of cuts below the value, by bisection, a step of all columns at a time.
    for half in range(bits - 1, -1, -1):
        steps = {}
        for rank, value, cuts in zip(ranks, values, known):
            ahead = F.col(rank) + 2**half
            fits = F.coalesce(F.get(cuts, ahead - 1) < F.col(value), F.lit(False))
            steps[rank] = F.col(rank) + F.when(fits, 2**half).otherwise(0)
        rows = rows.withColumns(steps)
    place = F.lit(0).cast("bigint")
    for bit in range(bits - 1, -1, -1):
        for rank in ranks:
            place = place * 2 + F.shiftright(rank, bit).bitwiseAND(1)
    return rows.withColumn(alias, place).drop(*ranks, *values)
