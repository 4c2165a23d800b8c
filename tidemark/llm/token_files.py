"""Token ids in ORC files: integer run-length encoding, row indexes, Bloom filters.

Documents are dealt into ascending ranges of ``doc_id``, one file each, sorted
inside, so that file names, stripes and row groups follow ``doc_id``: a reader
skips files and stripes by their smallest and largest ids, and the Bloom filters
in each row index answer look-ups of single ids.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.pieces import word_coder
from tidemark.llm.shared import checked_lookup, map_batches, prepare, sortable, task_count, texts_of, with_range
from tidemark.session import stored

STRIPE_BYTES = 16 << 20
ROWS_PER_INDEX_ENTRY = 1_000
BLOOM_FALSE_POSITIVES = 0.01
ROWS_PER_FILE = 50_000


def encode_documents(docs: DataFrame, vocabulary: bytes, end_id: int) -> DataFrame:
    """``doc_id``, ``ids`` (array of int) of every whole text, with the end id after it.

    Null and empty texts have the end id alone.
    """
    shared = prepare(docs.sparkSession).sparkContext.broadcast(vocabulary)
    end = end_id.to_bytes(4, "little")

    def kernel(batch: pa.RecordBatch) -> dict:
        encode = word_coder(shared.value)
        packed = [encode(t) + end for t in texts_of(batch.column("text"))]
        sizes = [0]
        for p in packed:
            sizes.append(sizes[-1] + len(p) // 4)
        values = pa.Array.from_buffers(pa.int32(), sizes[-1], [None, pa.py_buffer(b"".join(packed))])
        return {"ids": pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), values)}

    return map_batches(docs, kernel, "ids array<int>", keep=tuple(c for c in docs.columns if c != "text"))


def write_token_files(docs: DataFrame, path: str, vocabulary: bytes, end_id: int) -> None:
    """Encode all documents and write their ids in ascending ``doc_id`` order.

    Null ids come first; rows of one id are ordered by a hash of the text, then by
    text, so the file order is total but for equal rows. ``row`` is a row's number
    in its file. An empty table writes files without rows. Texts are exchanged once,
    before they are encoded. An id, null as well, that holds the rows of several
    files is cut by the hash; only equal rows are never parted.
    """
    prepare(docs.sparkSession)
    keyed = docs.select("doc_id", "text", sortable("doc_id").alias("_key"), F.xxhash64("text").alias("_tie"))
    rows = docs.agg(F.count(F.lit(1))).first()[0]
    ranged, n = with_range(keyed, "_key", "_tie", task_count(docs, rows, ROWS_PER_FILE))
    ranged = ranged.repartitionById(n, F.col("_range"))
    ordered = ranged.sortWithinPartitions("_key", "_tie", "text").select("doc_id", "_range", "text")
    encoded = encode_documents(ordered, vocabulary, end_id)
    numbered = encoded.select(
        "doc_id",
        F.col("_range").alias("file_no"),
        # Rows stay in their order from here to the file.
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("row"),
        "ids",
    )
    numbered.write.mode("overwrite").options(
        **{
            "compression": "zstd",
            "orc.stripe.size": STRIPE_BYTES,
            "orc.row.index.stride": ROWS_PER_INDEX_ENTRY,
            "orc.create.index": "true",
            "orc.bloom.filter.columns": "doc_id",
            "orc.bloom.filter.fpp": BLOOM_FALSE_POSITIVES,
        }
    ).orc(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, file_no, row, ids`` as written; filters on ``doc_id`` reach the stripes."""
    return spark.read.schema("doc_id long, file_no int, row long, ids array<int>").orc(path)


def document_offsets(tokens: DataFrame) -> DataFrame:
    """Start, length and checksum of each document in the sequence of all ids.

    Ids stay in the tasks that read them: only a row of numbers for each document
    is exchanged, summed up within its file, and one total for each file.
    """

    def kernel(batch: pa.RecordBatch) -> dict:
        ids = batch.column("ids")
        sizes = ids.value_lengths().to_pylist()
        raw = memoryview(ids.flatten().to_numpy().astype("<u4")).cast("B")
        checks, at = [], 0
        for size in sizes:
            checks.append(zlib.crc32(raw[at : at + 4 * size]))
            at += 4 * size
        return {"n_tokens": sizes, "ids_crc32": checks}

    keep = ("doc_id", "file_no", "row")
    # Stored, as it is summed in two ways and the ids should be read once.
    sized = stored(map_batches(tokens, kernel, "n_tokens long, ids_crc32 long", keep=keep), "sizes")
    in_file = Window.partitionBy("file_no").orderBy("row")
    upto = sized.withColumn("_upto", F.sum("n_tokens").over(in_file))
    totals = sized.groupBy("file_no").agg(F.sum("n_tokens").alias("_total"))
    earlier = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each file (``MOST_RANGES`` and those of hot ids).
    before = totals.select("file_no", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"))
    return checked_lookup(upto, before, ["file_no"], "inner", most_rows=100_000).select(
        "doc_id",
        (F.col("_before") + F.col("_upto") - F.col("n_tokens")).alias("start"),
        "n_tokens",
        "ids_crc32",
    )
