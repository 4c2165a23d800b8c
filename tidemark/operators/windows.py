"""Ordered operators whose tasks stay bounded when one key holds most rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.times import bucket_start
from tidemark.operators.aggregates import total_order


def latest_per_slot(
    frame: DataFrame,
    keys: Sequence[str],
    time: str,
    value: str,
    seconds: int,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Last value per key and time slot; ``slot`` is the slot start in epoch seconds.

    "Last" means the largest raw stamp, then the largest ``tiebreak``. It is an
    aggregate, so many readings in a slot combine before the exchange.
    """
    slot = bucket_start(F.col(time), seconds)
    last = F.max_by(value, total_order(time, *tiebreak))
    return frame.groupBy(*keys, slot.alias("slot")).agg(last.alias(value))


def running_max(
    frame: DataFrame,
    keys: Sequence[Column],
    order: str,
    value: str,
    alias: str,
    chunk: Column,
) -> DataFrame:
    """Maximum so far within each key, peers in ``order`` included.

    Rows are reduced to one per (key, order value) before the window, and the
    result is joined back. ``chunk``, a coarser form of ``order`` such as its
    day, cuts keys with very many order values: the maximum of the chunks
    before, found from one row per chunk, is put in front of each chunk.
    """
    names = [f"_key{i}" for i in range(len(keys))]
    keyed = frame.select("*", *[k.alias(n) for k, n in zip(keys, names)])
    peaks = keyed.groupBy(*names, chunk.alias("_chunk"), order).agg(F.max(value).alias("_peak"))
    before = Window.partitionBy(*names).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    ends = peaks.groupBy(*names, "_chunk").agg(F.max("_peak").alias("_end"))
    opening = ends.select(*names, "_chunk", F.max("_end").over(before).alias("_peak"))
    rows = peaks.withColumn("_opening", F.lit(False)).unionByName(
        opening.withColumn("_opening", F.lit(True)), allowMissingColumns=True
    )
    # Opening rows have no order value, and nulls come first.
    so_far = Window.partitionBy(*names, "_chunk").orderBy(order)
    at = [*names, order]
    running = (
        rows.withColumn(alias, F.max("_peak").over(so_far))
        .filter(~F.col("_opening"))
        .select(*[F.col(n).alias(f"_at{i}") for i, n in enumerate(at)], alias)
    )
    # Null-safe: a null key is a group of its own, as in a window.
    match = [F.col(n).eqNullSafe(F.col(f"_at{i}")) for i, n in enumerate(at)]
    return keyed.join(running, match, "left").select(*frame.columns, alias)


def forward_fill(
    frame: DataFrame,
    keys: Sequence[str],
    slot: str,
    value: str,
    alias: str,
    max_gap: int | None = None,
    chunk: int = 100_000,
) -> DataFrame:
    """Last non-null value at or before each row, at most ``max_gap`` slots back.

    ``slot`` is an integer position, unique per key. Each key is cut into chunks
    of ``chunk`` positions; the last value before each chunk is found from one
    row per chunk and put in front of the chunk's rows. No task then orders more
    than one chunk of a key, however hot the key is. The frame is read twice.
    """
    chunked = frame.withColumn("_chunk", F.floor(F.col(slot) / chunk)).withColumn(
        "_known", F.when(F.col(value).isNotNull(), F.col(slot).cast("bigint"))
    )
    ends = chunked.groupBy(*keys, "_chunk").agg(
        F.max_by(value, "_known").alias(value), F.max("_known").alias("_known")
    )
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    # A chunk's opening row sits in front of its first position.
    opening = ends.select(
        *keys,
        "_chunk",
        (F.col("_chunk") * chunk - 1).cast(frame.schema[slot].dataType).alias(slot),
        F.last(value, ignorenulls=True).over(before).alias(value),
        F.last("_known", ignorenulls=True).over(before).alias("_known"),
        F.lit(True).alias("_opening"),
    )
    rows = chunked.withColumn("_opening", F.lit(False)).unionByName(opening, allowMissingColumns=True)
    inside = Window.partitionBy(*keys, "_chunk").orderBy(slot)
    found = F.last(value, ignorenulls=True).over(inside)
    if max_gap is not None:
        age = F.col(slot) - F.last("_known", ignorenulls=True).over(inside)
        found = F.when(age <= max_gap, found)
    return rows.withColumn(alias, found).filter(~F.col("_opening")).select(*frame.columns, alias)
