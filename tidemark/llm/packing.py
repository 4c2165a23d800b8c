"""Bound-certified best-fit packing of documents into sequences of a fixed length.

Pieces are dealt into groups at random and each group is packed best fit
decreasing. Dual feasible functions give a lower bound of a group's sequences and,
from the numbers of pieces of each length, of all. Full sequences stay; the pieces
in sequences with gaps, also those of groups that meet their own bound, are dealt
into new, fewer groups, in which pieces of different groups meet, and are packed
again. This goes on until the whole meets its bound or a round saves no sequence.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.pieces import spaced_coder
from tidemark.llm.shared import prepare, texts_of
from tidemark.session import scratch_path, stored

PIECES_PER_GROUP = 50_000

PLACED = "item long, length int, sequence_id long, offset int, gap int, certified boolean"


def cut_documents(
    docs: DataFrame, vocabulary: bytes, end_id: int, capacity: int, with_ids: bool = True
) -> DataFrame:
    """One row for each piece: ``doc_id, row, piece, start, length, ids_crc32`` and ``ids`` (packed).

    Each whole text, null counting as empty, is encoded and gets the end id.
    Documents over ``capacity`` ids are cut into pieces of that many; the first
    piece holds what is left over. ``row`` tells documents with equal or null
    ``doc_id`` apart: it is unique in a stored result. ``ids`` are left out on
    request, where places and checksums are enough.
    """
    shared = prepare(docs.sparkSession).sparkContext.broadcast(vocabulary)
    end = end_id.to_bytes(4, "little")
    made = {"piece": pa.int32(), "start": pa.int64(), "length": pa.int32(), "ids_crc32": pa.int64()}
    if with_ids:
        made["ids"] = pa.binary()

    def run(batches):
        for batch in batches:
            encode = spaced_coder(shared.value)
            rows, columns = [], {name: [] for name in made}
            for row, text in enumerate(texts_of(batch.column("text"))):
                packed = encode(text) + end
                size = len(packed) // 4
                cuts = [0, *range(size % capacity or capacity, size + 1, capacity)]
                for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    ids = packed[4 * a : 4 * b]
                    rows.append(row)
                    for name, value in zip(made, (piece, a, b - a, zlib.crc32(ids), ids)):
                        columns[name].append(value)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(at),
                    batch.column("row").take(at),
                    *[pa.array(columns[name], kind) for name, kind in made.items()],
                ],
                names=["doc_id", "row", *made],
            )

    numbered = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), "text")
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, row long, piece int, start long, length int, ids_crc32 long"
    return numbered.mapInArrow(run, schema + (", ids binary" if with_ids else ""))


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Fewest bins that any packing needs, by dual feasible functions, from the pieces of each length.

    For each threshold k up to half the capacity: pieces over ``capacity - k``
    count as whole bins, pieces under k as nothing, the others by their length.
    Then, for each whole number m, the length is rounded to parts of m where
    that keeps sums of at most one bin at most one. The largest bound holds.
    """
    sizes = np.arange(capacity + 1)
    upto, weight = np.cumsum(counts), np.cumsum(counts * sizes)
    best = math.ceil(weight[-1] / capacity)
    for k in range(1, capacity // 2 + 1):
        large = upto[-1] - upto[capacity - k]
        middle = weight[capacity - k] - weight[k - 1]
        best = max(best, int(large) + math.ceil(middle / capacity))
    for m in range(1, 101):
        scaled = (m + 1) * sizes
        parts = np.where(scaled % capacity == 0, sizes * m, scaled // capacity * capacity)
        best = max(best, math.ceil(int((counts * parts).sum()) / (m * capacity)))
    return best


def best_fit_decreasing(lengths: Sequence[int], capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each piece, and the number of bins."""
    order = np.argsort(-np.asarray(lengths), kind="stable")
    bins, offsets = np.zeros(len(order), np.int32), np.zeros(len(order), np.int32)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by room left
    rooms, n = 0, 0  # bit r: a bin with room r is open
    for i in order.tolist():
        length = int(lengths[i])
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            chosen = open_bins[room].pop()
            if not open_bins[room]:
                rooms &= ~(1 << room)
        else:
            room, chosen, n = capacity, n, n + 1
        bins[i], offsets[i] = chosen, capacity - room
        if left := room - length:
            open_bins[left].append(chosen)
            rooms |= 1 << left
    return bins, offsets, n


def _pack_groups(pieces: DataFrame, groups: int, capacity: int, seed: int) -> DataFrame:
    """Pack each of ``groups`` random groups of the pieces."""

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("item", kind="stable").reset_index(drop=True)
        lengths = frame["length"].to_numpy()
        bins, offsets, n = best_fit_decreasing(lengths, capacity)
        room = capacity - np.bincount(bins, weights=lengths, minlength=n).astype(np.int32)
        # A sequence is named by the piece at its start, which no other has.
        name = np.empty(n, np.int64)
        name[bins[offsets == 0]] = frame["item"].to_numpy()[offsets == 0]
        return frame.assign(
            sequence_id=name[bins],
            offset=offsets,
            gap=room[bins],
            certified=n == lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity),
        )[["item", "length", "sequence_id", "offset", "gap", "certified"]]

    dealt = pieces.select(
        "item", "length", F.pmod(F.xxhash64("item", F.lit(seed)), F.lit(groups)).alias("group")
    )
    return dealt.groupBy("group").applyInPandas(pack, PLACED)


def least_sequences(pieces: DataFrame, capacity: int) -> int:
    """Lower bound of the sequences of all pieces, whose lengths are counted by Spark."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in pieces.groupBy("length").count().toArrow().to_pandas().itertuples(index=False):
        counts[length] = n
    return lower_bound(counts, capacity)


def pack_pieces(
    pieces: DataFrame, capacity: int, pieces_per_group: int = PIECES_PER_GROUP
) -> tuple[DataFrame, int, int]:
    """``item, sequence_id, offset`` of all pieces, the number of sequences, and the least possible.

    ``pieces`` has ``item`` (unique) and ``length`` (1 to capacity). Pieces of full
    length have a sequence of their own at once. Each round packs the rest in
    groups of about ``pieces_per_group``; pieces in sequences with gaps go on to
    the next round. The first round that saves no sequence is dropped, and what
    the round before it made stays; so does a packing that meets the bound of all
    pieces, or that was made in one group. Groups are random and of bounded size,
    whatever the lengths. Rounds are written to the shared folder, so a lost
    executor repeats at most one. An empty table gives no rows; the order in a
    sequence is that of packing.
    """
    spark = prepare(pieces.sparkSession)
    folder = scratch_path(spark, "packing")
    least = least_sequences(pieces, capacity)
    full = pieces.filter(F.col("length") == capacity)
    done = full.select("item", F.col("item").alias("sequence_id"), F.lit(0).alias("offset"))
    rest = pieces.filter(F.col("length") < capacity).select("item", "length")
    n_done, left = full.count(), rest.count()
    n_open = left  # each in a sequence of its own
    placed, number = None, 0
    while left:
        groups = max(1, math.ceil(left / pieces_per_group))
        path = f"{folder}/{number}"
        _pack_groups(rest, groups, capacity, number).write.parquet(path)
        packed = spark.read.parquet(path)
        starts = F.col("offset") == 0
        n_full, n_gaps, left, certified = packed.agg(
            F.count_if(starts & (F.col("gap") == 0)),
            F.count_if(starts & (F.col("gap") > 0)),
            F.count_if(F.col("gap") > 0),
            F.min("certified"),
        ).first()
        if placed is not None and n_full + n_gaps >= n_open:
            break
        if placed is not None:
            done = done.union(placed.filter("gap = 0").select("item", "sequence_id", "offset"))
        placed, n_open, number = packed, n_gaps, number + 1
        n_done += n_full
        if n_done + n_open == least or groups == 1:
            break
        rest = packed.filter("gap > 0").select("item", "length")
    if placed is not None:
        done = done.union(placed.select("item", "sequence_id", "offset"))
    return done.withColumn("offset", F.col("offset").cast("long")), n_done + n_open, least


def pack_documents(docs: DataFrame, vocabulary: bytes, end_id: int, capacity: int) -> DataFrame:
    """Cut and pack whole documents.

    ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``: checksum and
    place of each piece; and, the same in each row, ``n_sequences`` and the lower
    bound ``least_sequences``. Rows with equal or null ``doc_id`` are packed as
    documents of their own; empty texts are one end id; an empty table gives no
    rows; other columns are not used.
    """
    pieces = cut_documents(docs, vocabulary, end_id, capacity, with_ids=False)
    # Stored: the texts are encoded once, and row numbers stay as they are.
    small = stored(pieces.withColumn("item", F.monotonically_increasing_id()), "pieces")
    places, n, least = pack_pieces(small.select("item", "length"), capacity)
    return small.join(places, "item").select(
        "doc_id",
        "piece",
        "start",
        F.col("length").cast("long"),
        "ids_crc32",
        "sequence_id",
        "offset",
        F.lit(n).cast("long").alias("n_sequences"),
        F.lit(least).cast("long").alias("least_sequences"),
    )


def fill_sequences(pieces: DataFrame, places: DataFrame) -> DataFrame:
    """``sequence_id, ids``: the packed ids of each sequence, from pieces with ``item, ids``."""
    parts = pieces.join(places, "item").groupBy("sequence_id")
    ordered = parts.agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("_parts"))
    whole = F.aggregate("_parts", F.lit(b""), lambda ids, part: F.concat(ids, part["ids"]))
    return ordered.select("sequence_id", whole.alias("ids"))
