"""What the operators share: session set-up, shipping, texts in batches, ordered ranges."""

from __future__ import annotations

import math
import os
import tempfile
import zipfile
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.operators.joins import left_lookup
from tidemark.session import pin_session, stored

# Texts per Arrow batch and its bytes: bounds what a Python worker holds at a time.
BATCH_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}

_shipped: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """Settings for batches of texts, and this package on every executor."""
    pin_session(spark)
    for key, value in BATCH_SETTINGS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        _shipped.add(context.applicationId)
        context.addPyFile(_package_zip())
    return spark


def _package_zip() -> str:
    """The package as a zip in a driver folder, for Spark's own file server."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    package = os.path.join(root, "tidemark")
    path = os.path.join(tempfile.mkdtemp(prefix="tidemark-"), "tidemark.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(package):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                out.write(full, os.path.relpath(full, root))
    return path


def texts_of(column: pa.Array) -> list[str]:
    """Whole texts; null counts as empty."""
    return [t or "" for t in column.to_pylist()]


def bytes_of(column: pa.Array) -> list[bytes]:
    """Whole texts as UTF-8; null counts as empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


_tables: dict[str, dict] = {}


def worker_tables(owner: str) -> dict:
    """A dict that a Python worker keeps for an operator from task to task.

    Workers are used again by the stages that follow: those of another owner are
    let go, so that a worker holds the tables of one operator at a time.
    """
    if owner not in _tables:
        _tables.clear()
        _tables[owner] = {}
    return _tables[owner]


def map_batches(
    frame: DataFrame,
    kernel: Callable[[pa.RecordBatch], dict[str, Iterable]],
    schema: str,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Apply ``kernel`` to each Arrow batch of the frame.

    ``keep`` names columns passed through as they are; ``schema`` (DDL) gives the
    columns of the kernel's result, which has a value for each row of the batch.
    """
    made = StructType.fromDDL(schema)
    kept = [f for f in frame.schema if f.name in keep]
    types = list(to_arrow_schema(made))
    names = [*(f.name for f in kept), *made.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_tables(kernel.__module__)
        for batch in batches:
            result = kernel(batch)
            arrays = [batch.column(n) for n in names[: len(names) - len(types)]]
            arrays += [pa.array(result[t.name], type=t.type) for t in types]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return frame.mapInArrow(run, StructType([*kept, *made]))


def free_name(frame: DataFrame, name: str) -> str:
    """The name, with a number behind it if the frame has a column of that name (in any case)."""
    taken = {c.lower() for c in frame.columns}
    names = [name, *(f"{name}{i}" for i in range(2, len(taken) + 3))]
    return next(n for n in names if n.lower() not in taken)


def numbered(docs: DataFrame, name: str = "_row") -> DataFrame:
    """``docs`` with a column (see ``free_name``) that tells its rows apart, stored with its rows.

    The number follows from how the files are split among tasks, which may change
    from one read to the next (with the cores registered at the moment), so it is
    given out once and read back afterwards.
    """
    return stored(docs.withColumn(name, F.monotonically_increasing_id()), "numbered")


def without_rows(
    docs: DataFrame, dropped: DataFrame, name: str = "_row", most_rows: int = 1_000_000
) -> DataFrame:
    """The ``numbered`` docs whose number is not in ``dropped``, without the number.

    The numbers to drop are stored and counted: up to ``most_rows`` are broadcast,
    so that the texts stay where they are, more are joined.
    """
    dropped = stored(dropped.select(name), "dropped")
    if dropped.count() <= most_rows:
        dropped = F.broadcast(dropped)
    return docs.join(dropped, name, "left_anti").drop(name)


# Ranges that a table is cut into at most; a sketch of their cuts has some MB.
MOST_RANGES = 20_000


def task_count(frame: DataFrame, rows: int, rows_per_task: int) -> int:
    """Tasks for a frame of so many rows: the session's number, more if that is too few."""
    least = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, least, math.ceil(rows / rows_per_task))


def with_range(frame: DataFrame, key: str, tie: str, n: int) -> tuple[DataFrame, int]:
    """Number of the range of (key, tie), from 0, as ``_range``; and the number of ranges, about ``n``.

    ``key`` is a whole number and ``tie`` a hash, both not null; ranges ascend in
    their order. The cuts are approximate quantiles of the key, ``MOST_RANGES`` at
    most, which the driver gets; they divide the work and do not enter results. A
    key that several quantiles fall on, so that it holds that many ranges' rows,
    gets as many ranges of its own, cut by the tie.
    """
    n = min(n, MOST_RANGES)
    cuts: list[float] = []
    if n > 1:
        shares = [i / n for i in range(1, n)]
        got = frame.agg(F.percentile_approx(F.col(key).cast("double"), shares, 10 * n)).first()[0]
        cuts = sorted(got or [])
    if not cuts:
        return frame.withColumn("_range", F.lit(0)), 1
    times = Counter(cuts)
    hot = {value: times[value] for value in sorted(times) if times[value] > 1}
    value = F.col(key).cast("double")

    def number_of(splits: list[float], alias: str, rows: DataFrame) -> DataFrame:
        """How many of the splits are at or below the value."""
        cutter = Bucketizer(splits=[-math.inf, *splits, math.inf], inputCol="_cut_by", outputCol=alias)
        return cutter.transform(rows)

    rows = number_of(sorted(times), "_below", frame.withColumn("_cut_by", value))
    place = F.col("_below").cast("int")
    if hot:
        # Ranges that the hot keys up to here have of their own.
        rows = number_of(list(hot), "_hot", rows)
        own = list(hot.values())
        upto = F.get(F.array(*map(F.lit, accumulate(own, initial=0))), F.col("_hot").cast("int"))
        parts = F.get(F.array(*map(F.lit, [0, *own])), F.col("_hot").cast("int"))
        last = F.get(F.array(*[F.lit(v) for v in [math.nan, *hot]]), F.col("_hot").cast("int"))
        part = F.least(F.floor((F.col(tie) / 2.0**64 + 0.5) * parts), parts - 1).cast("int")
        place = place + upto - F.when(F.col("_cut_by") == last, parts - part).otherwise(0)
    ranged = rows.withColumn("_range", place).drop("_cut_by", "_below", "_hot")
    return ranged, len(times) + sum(hot.values()) + 1


def sortable(key: Column | str) -> Column:
    """The key with null as the smallest number, for a total order."""
    return F.coalesce(F.col(key) if isinstance(key, str) else key, F.lit(-(2**63)).cast("long"))


def checked_lookup(
    frame: DataFrame, table: DataFrame, keys: list[str], how: str, most_rows: int = 10_000
) -> DataFrame:
    """Join to a table with one row per key, which is usually short (languages, ranges).

    The table is stored and counted: up to ``most_rows`` rows are broadcast, more
    are joined by the keys. Null keys match each other.
    """
    table = stored(table, "lookup")
    if table.count() <= most_rows:
        table = F.broadcast(table)
    return left_lookup(frame, table, keys, how)
