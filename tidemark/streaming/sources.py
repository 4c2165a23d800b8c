"""Streaming file sources. All need an explicit schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

Schema = StructType | str


def file_stream(
    spark: SparkSession,
    path: str,
    schema: Schema,
    source_format: str = "parquet",
    files_per_trigger: int | None = None,
    **options: object,
) -> DataFrame:
    """Unbounded frame of the files that arrive below ``path``.

    ``files_per_trigger`` bounds one micro-batch. With a checkpoint every file is
    read once, over restarts too.
    """
    reader = spark.readStream.format(source_format).schema(schema).options(**options)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def csv_ingest(spark: SparkSession, path: str, schema: Schema, header: bool = False) -> DataFrame:
    """Incremental ingest of a folder of CSV files: only new files are read."""
    return file_stream(spark, path, schema, "csv", header=header)
