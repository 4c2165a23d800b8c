"""Keyed upsert on plain Parquet frames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import left_lookup, quoted


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Target after "update matched, insert the rest" from ``source``.

    A matched row takes ``update_columns`` (default: all non-key columns) from
    the source even where the source holds null. Unmatched source rows are
    inserted whole. A key that occurs twice in the source fails the job; a null
    key matches nothing, so such source rows are inserted.

    Written as a left join for the target's rows and an anti join for the new
    ones. A small source is broadcast to both passes over the target, which then
    stays in place, and AQE can split a hot target key; a full outer join allows
    neither. The anti join meets only the target keys that are in the source.
    Both joins that carry source rows read them in the same form, so their
    exchange is computed once. A costly source is better ``stored`` first, as
    its keys and its null-key rows are read apart.
    """
    columns = target.columns
    missing = set(columns) - set(source.columns)
    if missing:
        raise ValueError(f"source lacks columns {sorted(missing)}")
    rest = [c for c in columns if c not in keys]
    updated = rest if update_columns is None else list(update_columns)
    unknown = set(updated) - set(rest)
    if unknown:
        raise ValueError(f"cannot update {sorted(unknown)}")

    source = source.select(*quoted(columns))
    complete = reduce(and_, [F.col(k).isNotNull() for k in quoted(keys)])
    change = unique_per_key(source.filter(complete), keys, "_new")

    found = F.col("_new").isNotNull()
    kept = left_lookup(target, change, keys).select(
        *[
            F.when(found, F.col("_new").getField(c)).otherwise(F.col(q)).alias(c)
            if c in updated
            else F.col(q)
            for c, q in zip(columns, quoted(columns))
        ]
    )
    present = left_lookup(
        target.select(*quoted(keys)), source.filter(complete).select(*quoted(keys)), keys, "left_semi"
    ).distinct()
    added = change.join(present, list(keys), "left_anti").select(*quoted(keys), "_new.*")
    return kept.unionByName(added).unionByName(source.filter(~complete)).select(*quoted(columns))


def unique_per_key(frame: DataFrame, keys: Sequence[str], alias: str) -> DataFrame:
    """(keys, struct of the other columns); a repeated key raises when the job runs.

    The check groups on the keys, so a later join on them needs no new exchange.
    """
    rest = [c for c in frame.columns if c not in keys]
    grouped = frame.groupBy(*quoted(keys)).agg(
        F.any_value(F.struct(*quoted(rest))).alias(alias), F.count(F.lit(1)).alias("_copies")
    )
    repeated = F.raise_error(F.lit(f"merge source repeats a key ({', '.join(keys)})"))
    single = F.when(F.col("_copies") == 1, F.lit(True)).otherwise(repeated.cast("boolean"))
    return grouped.filter(single).drop("_copies")
