"""Batch writers and named tables."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.curve import with_curve_position
from tidemark.session import clear_scratch, scratch_path, with_settings
from tidemark.sources.readers import bytes_in_memory, parts_of_size, range_partitioned

# Bytes in memory that one task sorts: about as much as a partition has elsewhere.
RUN_BYTES = 256 << 20
# Files that a job makes of sorted runs, which bounds its plan.
FILES_PER_JOB = 16


def write_parquet(
    frame: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()
) -> None:
    """Snappy Parquet, optionally in Hive-style partition folders.

    Rows are first rebalanced by folder, so that not every task writes a small
    file into every folder; AQE splits a folder that holds most rows over tasks.
    """
    if not partition_by:
        frame.write.mode(mode).option("compression", "snappy").parquet(path)
        return
    balanced = frame.hint("rebalance", *partition_by)
    writer = balanced.write.mode(mode).option("compression", "snappy")
    writer.partitionBy(*partition_by).parquet(path)


def write_json(frame: DataFrame, path: str, mode: str = "overwrite") -> None:
    frame.write.mode(mode).json(path)


def write_documents(frame: DataFrame, path: str, rows_per_document: int) -> None:
    """Indented JSON documents, one per file, each an array of rows.

    Documents are cut by row number within a task, so none grows with the data.
    One row per file gives each document its own file.
    """
    rows = F.collect_list(F.struct(*frame.columns))
    document = F.floor(F.monotonically_increasing_id() / rows_per_document)
    bodies = (
        frame.withColumn("document", document)
        .groupBy("document")
        .agg(F.to_json(rows, {"pretty": "true"}).alias("value"))
    )
    bodies.select("value").write.option("maxRecordsPerFile", 1).text(path)


def write_csv(frame: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> None:
    """Delimited text with a header that ``read_delimited`` gives back unchanged.

    Except empty text, which CSV cannot tell from null and which reads as null.
    """
    (
        frame.write.mode(mode)
        .option("header", True)
        .option("sep", sep)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_single_file(frame: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One Parquet file, for small finished reports only.

    ``repartition(1)`` puts an exchange in front of the write, so the work above
    it keeps its parallelism; ``coalesce(1)`` would run all of it in one task.
    """
    frame.repartition(1).write.mode(mode).parquet(path)


def write_table(frame: DataFrame, name: str, path: str, mode: str = "overwrite") -> None:
    """Named table whose files live at ``path``."""
    frame.write.mode(mode).option("path", path).saveAsTable(name)


def create_external_table(
    spark: SparkSession, name: str, path: str, source_format: str = "parquet", replace: bool = True
) -> DataFrame:
    """Name existing files as a table; dropping it later leaves the files."""
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING {source_format} OPTIONS (path '{path}')")
    return spark.table(name)


def keyed_json(frame: DataFrame, key_columns: Sequence[str], sep: str = "~") -> DataFrame:
    """(key, value) messages: joined key columns, and the whole row as JSON."""
    return frame.select(
        F.concat_ws(sep, *key_columns).alias("key"),
        F.to_json(F.struct("*")).alias("value"),
    )


def compact(
    frame: DataFrame,
    path: str,
    cluster_by: Sequence[str],
    file_bytes: int = 1 << 30,
    mode: str = "overwrite",
) -> None:
    """Rewrite many small files as larger ones of about ``file_bytes``, clustered by key.

    Range partitioning on the cluster columns gives files narrow min/max bounds,
    which lets later scans skip row groups. Give a frame that is read from files;
    a costly one is better ``stored`` first, which also gives its own size.
    """
    write_in_order(frame, path, cluster_by, parts_of_size(frame, file_bytes), mode)


def compact_by_curve(
    frame: DataFrame,
    path: str,
    cluster_by: Sequence[str],
    file_bytes: int = 1 << 30,
    files: int | None = None,
    mode: str = "overwrite",
) -> None:
    """As ``compact``, along a space-filling curve: filters on any one of the columns skip files.

    Sorting by several columns gives narrow bounds to the first only. Rows are
    ranged by ``with_curve_position`` and a row number, so a place on the curve that
    holds most rows is spread over several files.
    """
    files = files or parts_of_size(frame, file_bytes)
    placed = with_curve_position(frame, cluster_by, "_place")
    write_in_order(placed, path, ["_place"], files, mode, without=["_place"])


def write_in_order(
    frame: DataFrame, path: str, columns: Sequence[str], files: int, mode: str, without: Sequence[str] = ()
) -> None:
    """Rows in so many files, each a range of ``columns`` in their order; columns in ``without`` are left out.

    A file can be larger than what a task should sort. It is then made of several
    runs of about ``RUN_BYTES`` in memory: each is sorted by a task of its own and
    stored, and the runs of a file are copied into it one after another. Above
    ``FILES_PER_JOB`` files that takes several jobs, which append to the first one's
    (one job for the mode "ignore"); one that fails leaves the files of those before.
    """
    spark = frame.sparkSession
    runs_per_file = max(1, -(-bytes_in_memory(frame) // (files * RUN_BYTES)))
    runs = range_partitioned(frame, files * runs_per_file, *columns).sortWithinPartitions(*columns).drop(*without)
    if runs_per_file == 1:
        runs.write.mode(mode).parquet(path)
        return
    folder = scratch_path(spark, "runs")
    runs.write.parquet(folder)
    # Spark names a file by the task, which is the run, and by its place in it.
    found = [re.search(r"part-(\d+)[^/]*$", f) for f in spark.read.parquet(folder).inputFiles()]
    by_file = defaultdict(list)
    for run, name in sorted((int(f[1]), f[0]) for f in found):
        by_file[run // runs_per_file].append(spark.read.schema(runs.schema).parquet(f"{folder}/{name}"))
    copies = [reduce(DataFrame.union, parts).coalesce(1) for parts in by_file.values()]
    at_once = len(copies) if mode == "ignore" else FILES_PER_JOB
    # Else Spark makes one part, and so one file, of parts that are single each.
    with with_settings(spark, {"spark.sql.unionOutputPartitioning": "false"}):
        for first in range(0, len(copies), at_once):
            some = reduce(DataFrame.union, copies[first : first + at_once])
            some.write.mode("append" if first else mode).parquet(path)
    clear_scratch(spark, folder)
