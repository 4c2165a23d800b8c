"""Joins and set operators beyond a single DataFrame call.

No strategy is forced: the planner broadcasts a side only when its size is known to
be below ``spark.sql.autoBroadcastJoinThreshold``, and AQE splits skewed partitions
of the rest. ``salted_join`` does not wait for a partition to be large: it broadcasts
a list of the frequent keys, whose length its parameter bounds.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def quoted(names: Sequence[str]) -> list[str]:
    """Names as they are, also with dots in them."""
    return [f"`{name.replace('`', '``')}`" for name in names]


def merged_outer(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join on shared names, one column per key whichever side has it."""
    return left.join(right, list(keys), "full_outer")


def left_lookup(
    frame: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "left"
) -> DataFrame:
    """Join a large frame, in which a key may be hot, to an aggregate with one row per key.

    AQE splits a hot key only where both sides come straight from an exchange.
    An aggregate is already partitioned by its keys, so an ordinary join would
    take it as it is and the hot key would stay in one task. The null-safe
    comparison is planned over other expressions, which gives the (small)
    aggregate an exchange of its own. Null keys match each other: leave them out
    of ``lookup`` if they should not.
    """
    names = [f"_key{i}" for i in range(len(keys))]
    renamed = lookup.select(
        *[F.col(k).alias(n) for k, n in zip(quoted(keys), names)],
        *quoted([c for c in lookup.columns if c not in keys]),
    )
    match = reduce(and_, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(quoted(keys), names)])
    return frame.join(renamed, match, how).drop(*names)


# Pieces of a frequent key's rows for each partition that an even share would fill.
PIECES_PER_PARTITION = 16


def frequent_keys(
    facts: DataFrame, keys: Sequence[str], partitions: int, pieces_per_partition: int = PIECES_PER_PARTITION
) -> dict[int, int]:
    """Into how many pieces the rows of each frequent key go, by the key's hash.

    Frequent is a key with over a quarter of an even partition's rows, so there are
    ``4 * partitions`` at most. Their counts come from a summary of bounded size,
    made in one pass over the key columns, and are as exact as dealing needs.
    """
    most = 4 * partitions
    tracked = max(1024, 8 * most)
    known = reduce(and_, [F.col(k).isNotNull() for k in quoted(keys)])
    digest = F.when(known, F.xxhash64(*quoted(keys))).alias("_key")
    found = facts.select(digest).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(_key, {most}, {tracked})").alias("top")
    )
    n, top = found.first()
    piece = max(1.0, (n or 0) / (partitions * pieces_per_partition))
    pieces = {r["item"]: math.ceil(r["count"] / piece) for r in top or () if r["item"] is not None}
    return {key: k for key, k in pieces.items() if k > pieces_per_partition / 4}


def salted_join(
    facts: DataFrame,
    other: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    spread: Sequence[str] | None = None,
    partitions: int | None = None,
    pieces_per_partition: int = PIECES_PER_PARTITION,
) -> DataFrame:
    """Join facts, in which some keys hold a large share of the rows, to ``other`` (inner or left).

    The rows of the frequent keys are dealt into pieces by a hash of the
    ``spread`` columns (default: all), and the other side's rows of these keys are
    repeated once for each piece; all other rows are joined as they are. AQE splits
    a partition only beyond its size bound; this also spreads keys below it, and
    keys whose join makes many rows of few. Null keys, which match nothing, are
    spread as well. Without a frequent key it is a plain join. Meant for an
    ``other`` with few rows a key.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', got {how!r}")
    partitions = partitions or int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = frequent_keys(facts, keys, partitions, pieces_per_partition)
    columns = [*facts.columns, *[c for c in other.columns if c not in keys]]
    if not pieces:
        return facts.join(other, list(keys), how).select(*quoted(columns))
    hot = facts.sparkSession.createDataFrame(list(pieces.items()), "_hash long, _pieces int")
    known = reduce(and_, [F.col(k).isNotNull() for k in quoted(keys)])

    def with_pieces(frame: DataFrame) -> DataFrame:
        keyed = frame.withColumn("_hash", F.when(known, F.xxhash64(*quoted(keys))))
        # As long as frequent_keys allows.
        return keyed.join(F.broadcast(hot), "_hash", "left").drop("_hash")

    digest = F.xxhash64(*quoted(spread or facts.columns))
    n = F.when(known, F.coalesce("_pieces", F.lit(1))).otherwise(F.lit(partitions * pieces_per_partition))
    dealt = with_pieces(facts).withColumn("_piece", F.pmod(digest, n).cast("int"))
    repeated = with_pieces(other).withColumn(
        "_piece", F.explode(F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1))
    )
    joined = dealt.drop("_pieces").join(repeated.drop("_pieces"), [*keys, "_piece"], how)
    return joined.select(*quoted(columns))


def carry_previous(
    current: DataFrame,
    state: DataFrame,
    keys: Sequence[str],
    value: str,
    is_first: str,
    default: float = 0.0,
) -> DataFrame:
    """Give empty first rows the value their key held before, else ``default``.

    ``state`` holds one row per key: (keys, value). A null key is a key like others.
    """
    before = state.select(*keys, F.col(value).alias("_before"))
    seeded = F.when(
        F.col(value).isNull() & F.col(is_first), F.coalesce("_before", F.lit(default))
    ).otherwise(F.col(value))
    return left_lookup(current, before, keys).withColumn(value, seeded).drop("_before")


def common_members(frames: Sequence[DataFrame], column: str) -> DataFrame:
    """Values of ``column`` present in every frame.

    One union and one aggregate, whatever the number of frames; repeats of a
    value are removed before the exchange.
    """
    tagged = [f.select(F.col(column), F.lit(i).alias("_set")) for i, f in enumerate(frames)]
    seen = reduce(DataFrame.union, tagged).distinct().groupBy(column)
    return seen.agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") == len(frames)).select(column)
