"""The k most frequent values, exactly, without an exchange of all values.

Each task keeps a summary of at most ``size`` values, whose counts are too low by a
known amount at most. The summaries, some thousand rows a task, are all that is
exchanged. They name the only values that can be among the first k; these are then
counted exactly, and the result is certified by the summaries' error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.operators.joins import left_lookup, quoted
from tidemark.session import stored

SUMMARY_SIZE = 10_000
# Candidates that are broadcast to be counted; more are joined.
BROADCAST_CANDIDATES = 100_000


def frequency_summaries(frame: DataFrame, column: str, size: int = SUMMARY_SIZE) -> DataFrame:
    """(column, n, error): the values each task kept, and by how much its counts can be too low.

    A task adds up the counts of each batch; beyond ``size`` values it takes the
    next largest count off all of them and drops those that reach nothing. Each
    value, kept or not, was seen at most that much more often.
    """
    fields = [frame.schema[column], StructField("n", LongType()), StructField("error", LongType())]
    schema = StructType([StructField(f.name, f.dataType) for f in fields])
    types = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, error = None, 0
        for batch in batches:
            seen = pc.value_counts(batch.column(0))
            values, n = seen.field(0), seen.field(1)
            table = pa.table({"v": values, "n": n})
            if kept is not None:
                table = pa.concat_tables([kept, table]).group_by("v").aggregate([("n", "sum")])
                table = table.rename_columns(["v", "n"])
            if len(table) > size:
                counts = table.column("n").to_numpy()
                off = int(np.partition(counts, len(counts) - size - 1)[len(counts) - size - 1])
                error += off
                left = pc.subtract(table.column("n"), pa.scalar(off, pa.int64()))
                table = table.set_column(1, "n", left).filter(pc.greater(left, 0))
            kept = table
        # A task's error counts even if none of its values were kept: null n marks that row.
        if kept is not None:
            n = len(kept)
            values = pa.concat_arrays([*kept.column("v").chunks, pa.nulls(1, types[0].type)])
            counts = pa.concat_arrays([*kept.column("n").chunks, pa.nulls(1, pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [values, counts, pa.array([error] * (n + 1), pa.int64())], names=schema.names
            )

    return frame.select(column).mapInArrow(run, schema)


def top_values(
    frame: DataFrame,
    column: str,
    k: int,
    size: int = SUMMARY_SIZE,
    broadcast_candidates: int = BROADCAST_CANDIDATES,
) -> DataFrame:
    """(column, n): the ``k`` most frequent values and their counts, ties by the smaller value.

    A null is a value like others and comes last among equals. Two passes over the
    column. Where the summaries cannot tell the k-th value from the rest (nearly
    equal counts over very many values), all values are counted: the result is
    exact in any case.
    """
    summaries = stored(frequency_summaries(frame, column, size), "summaries")
    q = quoted([column])[0]
    error = summaries.filter("n IS NULL").agg(F.sum("error")).first()[0] or 0
    low = stored(summaries.filter("n IS NOT NULL").groupBy(q).agg(F.sum("n").alias("n")), "candidates")
    order = [F.desc("n"), F.asc_nulls_last(q)]
    if error == 0:  # no task had to drop a value
        return low.orderBy(*order).limit(k)
    least = low.orderBy(*order).limit(k).agg(F.min("n")).first()[0] or 0
    # Only a value that may reach the k-th lower bound can be among the first k.
    candidates = low.filter(F.col("n") + error >= least).select(q)
    if candidates.count() <= broadcast_candidates:
        candidates = F.broadcast(candidates)
    counted = left_lookup(frame.select(q), candidates, [column], "left_semi").groupBy(q)
    first = stored(counted.agg(F.count(F.lit(1)).alias("n")).orderBy(*order).limit(k), "top")
    last, n = first.agg(F.min("n"), F.count(F.lit(1))).first()
    # A value that no task kept was seen at most ``error`` times in all.
    if n == k and last > error:
        return first.orderBy(*order)
    every = frame.groupBy(q).agg(F.count(F.lit(1)).alias("n"))
    return every.orderBy(*order).limit(k)
