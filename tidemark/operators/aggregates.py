"""Grouped aggregates that need more than one built-in call.

All of them aggregate before the exchange, so a group that holds a large share
of the rows reaches one task only as partial results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.joins import left_lookup, quoted
from tidemark.session import stored

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def count_rows(alias: str = "n") -> Column:
    return F.count(F.lit(1)).alias(alias)


def total_order(*columns: str) -> Column:
    """Ordering for ``min_by`` and ``max_by``.

    A single column stays itself: over a plain number or stamp Spark aggregates
    by hashing, over a struct by sorting, which takes about twice as long. So
    leave tie-breakers out where the first column is unique per group.
    """
    return F.col(columns[0]) if len(columns) == 1 else F.struct(*columns)


def first_in_order(value: str, *order: str) -> Column:
    """Value of the row that comes first in the order of the given columns."""
    return F.min_by(value, total_order(*order))


def last_in_order(value: str, *order: str) -> Column:
    return F.max_by(value, total_order(*order))


def mode_per_group(frame: DataFrame, keys: Sequence[str], value: str, alias: str) -> DataFrame:
    """Most frequent value per group. Ties go to the larger value, nulls lose ties.

    Counting per (group, value) first spreads a hot group over its values.
    """
    counted = frame.groupBy(*keys, value).agg(count_rows())
    best = F.max(F.struct(F.col("n"), F.col(value))).getField(value)
    return counted.groupBy(*keys).agg(best.alias(alias))


def describe_columns(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per numeric column: count, mean, stddev, min and max, in one pass."""
    measures = {
        "n": F.count,
        "mean": lambda c: F.round(F.avg(c), 4),
        "stddev": lambda c: F.round(F.stddev_samp(c), 4),
        "min_value": lambda c: F.min(c).cast("double"),
        "max_value": lambda c: F.max(c).cast("double"),
    }
    totals = frame.agg(
        *[
            F.struct(
                F.lit(c).alias("column_name"), *[fn(F.col(q)).alias(m) for m, fn in measures.items()]
            ).alias(c)
            for c, q in zip(columns, quoted(columns))
        ]
    )
    return totals.select(F.inline(F.array(*quoted(columns))))


def null_counts(frame: DataFrame) -> DataFrame:
    """Number of nulls in each column."""
    return frame.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in frame.columns])


def histogram(frame: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width bin counts between the column's minimum and maximum.

    The bounds come from a one-row scalar subquery; only ``bins`` counters per
    task are exchanged. The maximum falls in the last bin, a
    constant column in the first.
    """
    present = frame.select(F.col(value).cast("double").alias("x")).filter("x IS NOT NULL")
    low = present.agg(F.min("x")).scalar()
    high = present.agg(F.max("x")).scalar()
    width = (high - low) / bins
    index = F.floor(F.try_divide(F.col("x") - low, width)).cast("int")
    clipped = F.least(F.coalesce(index, F.lit(0)), F.lit(bins - 1))
    return present.groupBy(clipped.alias("bin")).agg(count_rows())


def box_stats(frame: DataFrame, keys: Sequence[str], value: str, halvings: int = 6) -> DataFrame:
    """Exact quartiles and 1.5-IQR fences per group; nulls do not count.

    Rows are first counted per (group, value). A sketch of each group then cuts
    its values into ``2 ** halvings`` pieces of about as many rows, and values
    are ordered within a piece only, so a group with very many distinct values
    is spread over its pieces. The cuts just divide the work; they do not enter
    the result.
    """
    values = frame.select(*keys, F.col(value).cast("double").alias("_x"))
    counted = values.groupBy(*keys, "_x").agg(F.count("_x").alias("_n"))
    n_pieces = 2**halvings
    shares = [i / n_pieces for i in range(1, n_pieces)]
    sketch = values.groupBy(*keys).agg(
        F.percentile_approx("_x", shares, 10 * n_pieces).alias("_cuts")
    )
    # Number of cuts below the value, by bisection.
    pieces = left_lookup(counted, sketch, keys, "inner").withColumn("_piece", F.lit(0))
    for half in range(halvings - 1, -1, -1):
        cut = F.get("_cuts", F.col("_piece") + (2**half - 1))
        above = F.when(cut < F.col("_x"), 2**half).otherwise(0)
        pieces = pieces.withColumn("_piece", F.col("_piece") + above)

    inside = Window.partitionBy(*keys, "_piece").orderBy("_x")
    ranked = pieces.select(*keys, "_piece", "_x", F.sum("_n").over(inside).alias("_upto"))
    all_pieces = Window.partitionBy(*keys)
    before = all_pieces.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranked.groupBy(*keys, "_piece")
        .agg(F.max("_upto").alias("_rows"))
        .select(
            *keys,
            "_piece",
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
            F.sum("_rows").over(all_pieces).alias("_total"),
        )
    )
    ranked = left_lookup(ranked, offsets, [*keys, "_piece"], "inner")
    upto = F.col("_before") + F.col("_upto")

    # The value at a position from 0 is the smallest one with more rows up to it.
    position = {n: (F.col("_total") - 1) * share for n, share in QUARTILES.items()}
    at = ranked.groupBy(*keys).agg(
        *[F.min(F.when(upto > F.floor(p), F.col("_x"))).alias(f"_low_{n}") for n, p in position.items()],
        *[F.min(F.when(upto > F.ceil(p), F.col("_x"))).alias(f"_high_{n}") for n, p in position.items()],
        F.any_value("_total").alias("_total"),
    )
    low, high = ({n: F.col(f"_{side}_{n}") for n in QUARTILES} for side in ("low", "high"))
    quartiles = at.select(
        *keys,
        *[
            (low[n] + (high[n] - low[n]) * (p - F.floor(p))).alias(n)
            for n, p in position.items()
        ],
    )
    fence = 1.5 * (F.col("q3") - F.col("q1"))
    return quartiles.select(
        *keys,
        *QUARTILES,
        (F.col("q1") - fence).alias("low_fence"),
        (F.col("q3") + fence).alias("high_fence"),
    )


def box_stats_approx(
    frame: DataFrame, keys: Sequence[str], value: str, accuracy: int = 10000
) -> DataFrame:
    """Quartiles from a bounded sketch, for columns with very many distinct values."""
    q = F.percentile_approx(value, list(QUARTILES.values()), accuracy)
    return (
        frame.groupBy(*keys)
        .agg(q.alias("q"))
        .select(*keys, *[F.element_at("q", i + 1).alias(n) for i, n in enumerate(QUARTILES)])
    )


def linear_fit(frame: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """Least-squares slope and intercept of ``y`` on ``x`` per group."""
    return frame.groupBy(*keys).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept")
    )


def first_rows(frame: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """One row per key: the first in a total order.

    A ``min_by`` over the whole row combines on the map side; ``row_number``
    would sort every row of a key in one task.
    """
    rest = [c for c in frame.columns if c not in keys]
    row = F.min_by(F.struct(*quoted(rest)), total_order(*quoted(order))).alias("row")
    firsts = frame.groupBy(*quoted(keys)).agg(row).select(*quoted(keys), "row.*")
    return firsts.select(*quoted(frame.columns))


def keep_first_copy(frame: DataFrame, id_column: str, *normalised: Column) -> DataFrame:
    """Drop rows whose normalised columns match an earlier row; keep original formats.

    ``id_column`` must be unique and not null. The texts are read twice, to be
    digested and to be given out; in between only digests and ids move. The ids
    to drop are stored, so their size is known when the last join is planned: a
    short list is broadcast and no text is exchanged, a long one is joined by
    the unique id, which spreads even copies holding a large share of the table.
    """
    null_mark = F.lit(b"\0")
    digest = F.concat(*[F.coalesce(F.unhex(F.sha2(c, 256)), null_mark) for c in normalised])
    digests = stored(frame.select(id_column, digest.alias("digest")), "digests")
    copied = (
        digests.groupBy("digest")
        .agg(F.min(id_column).alias("_first"), count_rows("_n"))
        .filter("_n > 1")
        .select("digest", "_first")
    )
    # The lookup is what lets AQE split a digest that most rows share.
    repeated = left_lookup(digests, copied, ["digest"], "inner").filter(F.col(id_column) != F.col("_first"))
    return frame.join(stored(repeated.select(id_column), "copies"), id_column, "left_anti")
