"""Batch readers. Jobs pass a schema; inference reads the whole source first."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType, VariantType

Schema = StructType | str


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: Schema | None = None,
    sep: str = ",",
    header: bool = True,
    quoted_newlines: bool = False,
) -> DataFrame:
    """CSV, TSV or any other single-separator text.

    ``quoted_newlines`` accepts line breaks and doubled quotes inside quoted
    fields. Such files cannot be split, so keep each below a few hundred MB.
    """
    reader = spark.read.option("sep", sep).option("header", header)
    if quoted_newlines:
        reader = reader.option("multiLine", True).option("escape", '"')
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def read_json(
    spark: SparkSession,
    path: str,
    schema: Schema | None = None,
    whole_document: bool = False,
) -> DataFrame:
    """JSON lines, or one document per file with ``whole_document``."""
    reader = spark.read.option("multiLine", whole_document)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def schema_as_ddl(frame: DataFrame) -> str:
    """DDL text of a frame's schema: infer once, store the text, read with it after."""
    return frame.schema.toDDL()


def with_source_file(frame: DataFrame, column: str = "source_file") -> DataFrame:
    """Attach the path of the file each row was read from."""
    return frame.withColumn(column, F.col("_metadata.file_path"))


def range_partitioned(frame: DataFrame, partitions: int, *columns: str) -> DataFrame:
    """Split rows into ``partitions`` even, contiguous ranges of ``columns``.

    Filter before calling: the predicate is then pushed to the scan and only
    the remaining rows are exchanged. Bounds are sampled, so they need not be
    given. A row number is the last range column, so that one value holding a
    large share of the rows is spread over several ranges.
    """
    numbered = frame.withColumn("_row", F.monotonically_increasing_id())
    return numbered.repartitionByRange(partitions, *columns, "_row").drop("_row")


def bytes_of_files(spark: SparkSession, *paths: str) -> int:
    """Size of the files at and below some paths, which are listed but not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    return files.agg(F.sum("length")).first()[0] or 0


def parts_of_size(frame: DataFrame, part_bytes: int) -> int:
    """How many parts of about so many bytes the files hold that a frame is made of.

    Each file counts once and whole: filters, dropped columns and joins make less
    or more of them. Store a frame first (``stored``) to count its own bytes. A
    frame without files is one part.
    """
    files = frame.inputFiles()
    size = bytes_of_files(frame.sparkSession, *files) if files else 0
    return max(1, -(-size // part_bytes))


def bytes_in_memory(frame: DataFrame) -> int:
    """About how many bytes the rows take while they are sorted, from one pass over texts and nested columns.

    Eight for each column, what texts hold, and 56 for the row and its place in the
    order. Nested values count four times their length as JSON, where an element of
    eight bytes has two characters at least.
    """
    held = []
    for field in frame.schema:
        value = F.col("`" + field.name.replace("`", "``") + "`")
        if isinstance(field.dataType, (StringType, BinaryType)):
            held.append(F.octet_length(value))
        elif isinstance(field.dataType, (ArrayType, MapType, StructType, VariantType)):
            held.append(4 * F.octet_length(F.to_json(F.struct(value), {"ignoreNullFields": "false"})))
    n, *sums = frame.agg(F.count(F.lit(1)), *[F.sum(h.cast("long")) for h in held]).first()
    return n * (56 + 8 * len(frame.columns)) + sum(x or 0 for x in sums)


def stride_partitioned(
    frame: DataFrame, column: str, lower: int, upper: int, partitions: int
) -> DataFrame:
    """Split rows by equal strides of a whole-number column from ``lower`` to ``upper``.

    As a partitioned database scan does: the bounds only set the strides. Rows
    outside them go to the first or last partition, nulls to the first, and none
    is left out. Filter before calling, so that the filter reaches the source.
    """
    stride = max(1, -(-(upper - lower + 1) // partitions))
    number = F.floor((F.col(column) - F.lit(lower)) / F.lit(stride))
    inside = F.greatest(F.lit(0), F.least(F.lit(partitions - 1), F.coalesce(number, F.lit(0))))
    return frame.repartitionById(partitions, inside.cast("int"))


def stride_scans(
    table: DataFrame, column: str, lower: int, upper: int, partitions: int
) -> DataFrame:
    """One filtered scan for each stride of a whole-number column, as a database is read in parallel.

    Each stride's bounds are a filter that reaches its own scan, so that a source
    with statistics or an index on the column reads its part only, and no row is
    exchanged. Rows outside the bounds and nulls are in the first or last stride.
    The number of scans is the caller's, as it is that of connections.
    """
    step = max(1, -(-(upper - lower + 1) // partitions))
    starts = list(range(lower + step, upper + 1, step))
    value = F.col(column)
    if not starts:
        return table
    first = value.isNull() | (value < starts[0])
    middle = [(value >= a) & (value < b) for a, b in zip(starts, starts[1:])]
    return reduce(DataFrame.union, [table.filter(c) for c in (first, *middle, value >= starts[-1])])
