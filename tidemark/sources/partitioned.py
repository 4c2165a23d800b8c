"""Parquet tables in folders: upserts that rewrite only the folders they touch, maxima from footers."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from operator import and_, or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.joins import quoted
from tidemark.operators.merge import merge_upsert
from tidemark.session import stored
from tidemark.sources.writers import write_parquet

# Folders named one by one in a filter; more are met in a join.
MOST_NAMED = 1000


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, in any store that Spark reads."""
    try:
        spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def within_folders(table: DataFrame, rows: DataFrame, folders: Sequence[str], most_named: int = MOST_NAMED) -> DataFrame:
    """The rows of ``table`` in the folders that ``rows`` fall in; other folders are not opened.

    Up to ``most_named`` folders are a filter on the folder columns, which the scan
    uses to list them only; more are a semi join.
    """
    touched = rows.select(*quoted(folders)).distinct()
    named = touched.limit(most_named + 1).collect()
    if len(named) > most_named:
        return table.join(touched, list(folders), "left_semi")
    if not named:
        return table.filter(F.lit(False))
    return table.filter(
        reduce(or_, [reduce(and_, [F.col(q).eqNullSafe(F.lit(v)) for q, v in zip(quoted(folders), r)]) for r in named])
    )


def rewrite_folders(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    folders: Sequence[str],
    combine: Callable[[DataFrame, DataFrame], DataFrame],
    batch_id: int | str | None = None,
    sort_by: Sequence[str] = (),
) -> bool:
    """Replace the folders that ``source`` falls in by ``combine(their rows, source)``.

    The table at ``path`` is kept in folders by the ``folders`` columns and made by
    its first rewriting; only the touched folders are read and written. Files are
    few, and ordered by ``sort_by`` inside.

    The new folders are first stored whole beside the table, then put in place,
    then noted as done under ``batch_id``. A rewriting that was cut short while
    folders were being replaced is put in place from there before anything else is
    done; a batch that is noted is not done again, and False is returned. So a
    micro-batch can be repeated at any point. One rewriting at a time; names below
    ``path`` that begin with ``_`` are this function's.
    """
    batch = uuid.uuid4().hex if batch_id is None else str(batch_id)
    source = stored(source, "merge-source")
    last = _noted(spark, f"{path}/_last")
    if last is not None and not has_files(spark, f"{path}/_merged/{last}"):
        _put_in_place(spark, path, source, folders, last, sort_by)
    if has_files(spark, f"{path}/_merged/{batch}"):
        return False
    target = spark.createDataFrame([], source.schema)
    if last is not None:
        target = within_folders(spark.read.schema(source.schema).parquet(path), source, folders)
    write_parquet(combine(target, source), f"{path}/_staged", partition_by=folders)
    # Written after what it stands for, so it never names half a result.
    spark.createDataFrame([(batch,)], "batch string").write.mode("overwrite").parquet(f"{path}/_last")
    _put_in_place(spark, path, source, folders, batch, sort_by)
    return True


def merge_into_partitions(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    folders: Sequence[str],
    batch_id: int | str | None = None,
    update_columns: Sequence[str] | None = None,
) -> bool:
    """Upsert ``source`` into the table at ``path``, as ``merge_upsert`` by ``rewrite_folders``.

    A key must always fall in the same folder. Returns False for a batch that was
    merged before.
    """
    by = list(dict.fromkeys([*keys, *folders]))

    def combine(target: DataFrame, rows: DataFrame) -> DataFrame:
        return merge_upsert(target, rows, by, update_columns)

    return rewrite_folders(spark, path, source, folders, combine, batch_id)


def replace_in_partitions(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    folders: Sequence[str],
    batch_id: int | str | None = None,
) -> bool:
    """``merge_into_partitions`` of a source that is unique per key, as an aggregate by the keys is.

    Its rows take the place of the table's rows of the same keys, so that one anti
    join of the touched folders is all there is to do.
    """
    by = list(dict.fromkeys([*keys, *folders]))

    def combine(target: DataFrame, rows: DataFrame) -> DataFrame:
        kept = target.join(rows.select(*quoted(by)), by, "left_anti")
        return kept.unionByName(rows)

    return rewrite_folders(spark, path, source, folders, combine, batch_id)


def _noted(spark: SparkSession, path: str) -> str | None:
    """Name of the merge that was staged last."""
    if not has_files(spark, path):
        return None
    row = spark.read.schema("batch string").parquet(path).first()
    return row and row["batch"]


def _put_in_place(
    spark: SparkSession, path: str, like: DataFrame, folders: Sequence[str], batch: str, sort_by: Sequence[str]
) -> None:
    """Replace the staged folders' twins in the table, then note the batch as done."""
    staged = spark.read.schema(like.schema).parquet(f"{path}/_staged")
    balanced = staged.select(*quoted(like.columns)).hint("rebalance", *folders)
    if sort_by:
        balanced = balanced.sortWithinPartitions(*quoted([*folders, *sort_by]))
    writer = balanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*folders).parquet(path)
    spark.range(1).write.mode("overwrite").parquet(f"{path}/_merged/{batch}")


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session with other settings inside the ``with`` block."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@contextmanager
def reading_footers(spark: SparkSession) -> Iterator[None]:
    """Frames read and run inside the ``with`` block take maxima and counts from file footers."""
    sources = spark.conf.get("spark.sql.sources.useV1SourceList").split(",")
    push = {
        "spark.sql.sources.useV1SourceList": ",".join(s for s in sources if s != "parquet"),
        "spark.sql.parquet.aggregatePushdown": "true",
    }
    with settings(spark, push):
        yield


def largest(table: DataFrame, column: str, where: Column | None = None) -> DataFrame:
    """One row with the largest value of a number or date column.

    Inside ``reading_footers`` no row is read, if ``where`` names folder columns
    only: the maximum of each row group stands in the footer. Timestamps have none
    there, so keep one as epoch seconds.
    """
    rows = table if where is None else table.filter(where)
    return rows.agg(F.max(column).alias("largest"))


def high_water_mark(spark: SparkSession, path: str, column: str, where: Column | None = None) -> int | None:
    """The ``largest`` value in a table's footers; null for a table that is not there."""
    if not has_files(spark, path):
        return None
    with reading_footers(spark):
        return largest(spark.read.parquet(path), column, where).first()["largest"]
