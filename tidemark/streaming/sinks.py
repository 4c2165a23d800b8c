"""Streaming sinks and run modes."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter
from pyspark.sql.types import StructType

from tidemark.operators.joins import quoted
from tidemark.operators.sketches import distinct_sketches
from tidemark.sources.partitioned import has_files, rewrite_folders
from tidemark.sources.writers import write_parquet


def _triggered(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """Run every interval, or (None) take all that is there and stop."""
    if every is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=every)


def to_files(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    name: str | None = None,
    every: str | None = None,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Append to Parquet files."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    if name:
        writer = writer.queryName(name)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _triggered(writer, every).start(path)


def to_table(
    stream: DataFrame, table: str, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Append to a named table stored at ``path``."""
    writer = (
        stream.writeStream.outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return _triggered(writer, every).toTable(table)


def to_memory(
    stream: DataFrame, name: str, checkpoint: str | None = None, every: str | None = None
) -> StreamingQuery:
    """Complete result as an in-memory table, for SQL over it.

    The table lives on the driver: only for aggregates with a few groups.
    """
    writer = stream.writeStream.format("memory").outputMode("complete").queryName(name)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    return _triggered(writer, every).start()


def for_each_batch(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    output_mode: str = "append",
    name: str | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Call ``handle(batch, batch_id)`` for each micro-batch.

    A batch may be repeated after a failure, so ``handle`` should write in a way
    that is the same the second time: overwrite a folder named by the batch id.
    """
    writer = (
        stream.writeStream.foreachBatch(handle)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
    )
    if name:
        writer = writer.queryName(name)
    return _triggered(writer, every).start()


def append_batches(
    path: str, partition_by: Sequence[str] = ()
) -> Callable[[DataFrame, int], None]:
    """Batch handler: each batch in its own folder, written once however often it runs.

    Inside it, rows are rebalanced by the folders of ``partition_by``, so a batch
    leaves few files in each, whatever the number of its tasks.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_parquet(batch, f"{path}/batch={batch_id}", partition_by=partition_by)

    return handle


def append_compacted(
    path: str, partition_by: Sequence[str], every: int, cluster_by: Sequence[str] = ()
) -> Callable[[DataFrame, int], None]:
    """Batch handler: as ``append_batches``, and every so many batches moves them into few files.

    Batches gather below ``path/recent``. With each ``every``-th one they are
    added to the folders of ``path/whole`` that they fall in, which alone are
    rewritten (``rewrite_folders``, under the batch id, so it can be repeated), and
    are emptied. ``compacted`` reads both.
    """
    keep = append_batches(f"{path}/recent", partition_by)

    def handle(batch: DataFrame, batch_id: int) -> None:
        keep(batch, batch_id)
        if (batch_id + 1) % every:
            return
        spark = batch.sparkSession
        numbers = range(batch_id + 1 - every, batch_id + 1)
        folders = [f"{path}/recent/batch={n}" for n in numbers if has_files(spark, f"{path}/recent/batch={n}")]
        recent = reduce(
            DataFrame.unionByName, [spark.read.schema(batch.schema).parquet(f).select(*quoted(batch.columns)) for f in folders]
        )
        rewrite_folders(spark, f"{path}/whole", recent, partition_by, DataFrame.unionByName, batch_id, cluster_by)
        for folder in folders:
            write_parquet(spark.createDataFrame([], batch.schema), folder, partition_by=partition_by)

    return handle


def compacted(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows that ``append_compacted`` wrote, between two of its batches."""
    parts = [f"{path}/{p}" for p in ("whole", "recent") if has_files(spark, f"{path}/{p}")]
    frames = [spark.read.schema(schema).parquet(p).select(*quoted(schema.names)) for p in parts]
    return reduce(DataFrame.unionByName, frames, spark.createDataFrame([], schema))


def append_keys(path: str, keys: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """Batch handler: the distinct keys of each batch in its own folder.

    An exact distinct count over all batches that needs no state and no watermark:
    late rows count, and ``distinct_keys`` reads the result. Between batches a key
    may repeat; the files hold it once for each batch that it is in.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_parquet(batch.select(*quoted(keys)).distinct(), f"{path}/batch={batch_id}")

    return handle


def distinct_keys(spark: SparkSession, path: str) -> DataFrame:
    """Each key that ``append_keys`` wrote, once."""
    return spark.read.parquet(path).drop("batch").distinct()


def append_sketches(path: str, keys: Sequence[str], value: str) -> Callable[[DataFrame, int], None]:
    """Batch handler: one distinct-count sketch for each group of a batch, in the batch's folder.

    Reading unites them (``operators.sketches``) to groups of any width. No state is
    kept and late rows count; a batch leaves a few KB for each of its groups.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_parquet(distinct_sketches(batch, quoted(keys), value), f"{path}/batch={batch_id}")

    return handle


def newest_batch(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the last batch that ``append_batches`` wrote: complete mode's result.

    Earlier results stay, so a reader never finds the result half-written. Only
    the newest folder is opened for rows.
    """
    rows = spark.read.parquet(path)
    newest = rows.agg(F.max("batch")).first()[0]
    return rows.filter(F.col("batch") == newest).drop("batch")


def run_to_end(query: StreamingQuery, seconds: int | None = None) -> StreamingQuery:
    """Wait for an available-now query, for ``seconds`` at most if given."""
    if seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(seconds):
        query.stop()
        raise TimeoutError(f"streaming query {query.name} did not end in {seconds} s")
    return query
