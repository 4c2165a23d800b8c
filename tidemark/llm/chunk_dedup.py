"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes of a text; a chunk ends after white space where
the hash of the bytes before is below a threshold, so cuts follow the content
and an insertion moves only the cuts around it. Chunks are known by a digest. A
chunk that occurred before, in the order of ``doc_id`` and place, is repeated; a
run of repeated chunks with at least so many words is removed, shorter ones are
chance and stay.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import bytes_of, checked_lookup, map_batches, prepare, sortable
from tidemark.operators.joins import left_lookup

WINDOW = 16  # bytes that the 16-bit gear hash remembers
WORDS_PER_CHUNK = 4
# Of a passage of 51 words some four stay at either end, in the chunks that its
# surroundings share and as far as the window reaches.
LEAST_WORDS_REMOVED = 20
# Where white space is missing for so many bytes, chunks end at any character, after
# as many on average; such a chunk counts as a word for so many bytes.
BLIND_BYTES = 48
BYTES_PER_WORD = 8
CHUNKS_AT_ONCE = 500_000


def gear_table() -> np.ndarray:
    """A pseudo-random 16-bit number for each byte."""
    return np.array([xxhash.xxh32_intdigest(bytes([b])) & 0xFFFF for b in range(256)], np.uint16)


GEAR = gear_table()
IS_SPACE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """Gear hash at each byte: h = 2 h + gear[byte], modulo 2**16.

    The sum over the last 16 bytes is doubled up from the sums over 1, 2, 4, ...
    """
    hashes = GEAR[data]
    span = 1
    while span < WINDOW:
        shifted = hashes[:-span] << np.uint16(span)
        hashes = hashes.copy()
        hashes[span:] += shifted
        span *= 2
    return hashes


def chunk_ends(text: bytes, words_per_chunk: int = WORDS_PER_CHUNK) -> list[int]:
    """Ends of the chunks of a text; the last is its length, none if it is empty."""
    if not text:
        return []
    data = np.frombuffer(text, np.uint8)
    hashes = gear_hashes(data)
    space = IS_SPACE[data]
    # After the last of some white space; elsewhere never inside a character.
    follows = np.append(data[1:], np.uint8(0x20))
    at_space = space & ~IS_SPACE[follows] & (hashes < np.uint16(2**16 // words_per_chunk))
    at = np.arange(len(data), dtype=np.int32)
    unspaced = at - np.maximum.accumulate(np.where(space, at, np.int32(-1))) >= BLIND_BYTES
    blind = unspaced & (hashes < np.uint16(2**16 // BLIND_BYTES)) & ((follows & 0xC0) != 0x80)
    ends = (np.flatnonzero(at_space | blind) + 1).tolist()
    if not ends or ends[-1] != len(text):
        ends.append(len(text))
    return ends


def _identified(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_id`` and ``_twin``, which tell its rows apart and order them.

    ``_twin`` is a hash of the text where a ``doc_id`` is null or repeated, else 0.
    """
    docs = docs.withColumn("_id", sortable("doc_id"))
    again = docs.groupBy("_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    marked = checked_lookup(docs, again, ["_id"], "left")
    twin = F.when(F.col("_n").isNull(), F.lit(0)).otherwise(F.xxhash64("text"))
    return marked.withColumn("_twin", twin.cast("long")).drop("_n")


CHUNK_FIELDS = {
    "high": pa.int64(),
    "low": pa.int32(),
    "_id": pa.int64(),
    "_twin": pa.int64(),
    "place": pa.int32(),
    "n_words": pa.int32(),
    "repeated": pa.bool_(),
}
CHUNK_SCHEMA = "high long, low int, _id long, _twin long, place int, n_words int, repeated boolean"


def _first_of_each(table: list[np.ndarray]) -> np.ndarray:
    """Whether a chunk is the first of its digest among high, low, id, twin, place.

    So are the same chunks of an equal row.
    """
    order = np.lexsort(table[::-1])
    ordered = [column[order] for column in table]
    starts = np.ones(len(order), bool)
    starts[1:] = (np.diff(ordered[0]) != 0) | (np.diff(ordered[1]) != 0)
    leader = np.flatnonzero(starts)[np.cumsum(starts) - 1]
    result = np.empty(len(order), bool)
    result[order] = np.all([column == column[leader] for column in ordered[2:]], axis=0)
    return result


def chunks(docs: DataFrame, words_per_chunk: int = WORDS_PER_CHUNK) -> DataFrame:
    """The chunks of every text: digest (96 bits in ``high``, ``low``), place, words.

    ``n_words`` is that of a chunk's words or, if larger, its bytes by
    ``BYTES_PER_WORD``, so that text without white space counts as well.

    The digest is of the chunk's words with a blank between them; chunks without
    words are left out. A task compares ``CHUNKS_AT_ONCE`` chunks at a time and
    marks those ``repeated`` that another of them precedes. Decided ones need no
    digest any more and get their place for it, so that after an exchange by
    digest even one in every document has few rows together.
    """

    def run(batches):
        waiting: list[list[np.ndarray]] = []

        def flush():
            table = [np.concatenate(c) for c in zip(*waiting)]
            waiting.clear()
            repeated = ~_first_of_each(table[:5])
            table[0][repeated] = table[2][repeated]
            table[1][repeated] = table[4][repeated]
            arrays = [*table, repeated]
            for at in range(0, len(repeated), 50_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a[at : at + 50_000], t) for a, t in zip(arrays, CHUNK_FIELDS.values())],
                    names=list(CHUNK_FIELDS),
                )

        for batch in batches:
            ids = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("_id", "_twin")]
            places, words, digests, sizes = [], [], [], []
            for text in bytes_of(batch.column("text")):
                begin, before = 0, len(places)
                for place, end in enumerate(chunk_ends(text, words_per_chunk)):
                    parts = text[begin:end].split()
                    begin = end
                    if parts:
                        joined = b" ".join(parts)
                        places.append(place)
                        words.append(max(len(parts), len(joined) // BYTES_PER_WORD))
                        digests.append(xxhash.xxh3_128_digest(joined))
                sizes.append(len(places) - before)
            halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            waiting.append(
                [
                    halves[:, 0].copy(),
                    halves[:, 1].astype(np.int32).astype(np.int64),
                    *(np.repeat(i, sizes) for i in ids),
                    np.array(places, np.int64),
                    np.array(words, np.int64),
                ]
            )
            if sum(len(w[0]) for w in waiting) >= CHUNKS_AT_ONCE:
                yield from flush()
        if waiting:
            yield from flush()

    return docs.select("_id", "_twin", "text").mapInArrow(run, CHUNK_SCHEMA)


def repeated_chunks(all_chunks: DataFrame) -> DataFrame:
    """``_id, _twin, place, n_words`` of the chunks that are not the first of their digest.

    One exchange by digest, in which a digest has a row for each of the tasks'
    rounds at most (see ``chunks``).
    """
    of_digest = Window.partitionBy("high", "low", "repeated").orderBy("_id", "_twin", "place")
    # Chunks of equal rows have the same rank.
    ranked = all_chunks.withColumn("_nth", F.rank().over(of_digest))
    return ranked.filter("repeated OR _nth > 1").select("_id", "_twin", "place", "n_words")


def remove_places(docs: DataFrame, places: DataFrame, words_per_chunk: int, least_words: int) -> DataFrame:
    """``docs`` with the long runs of repeated places cut out of ``text``.

    Adds ``n_removed`` (chunks), ``removed_words`` and ``removed`` (the bytes from
    ``begin`` to ``end`` of the old text).
    """
    by_row = places.groupBy("_id", "_twin").agg(
        F.collect_set(F.struct("place", "n_words")).alias("_places")
    )
    marked = left_lookup(docs, by_row, ["_id", "_twin"])

    def kernel(batch: pa.RecordBatch) -> dict:
        made = {"kept_text": [], "n_removed": [], "removed_words": [], "removed": []}
        for text, marks in zip(batch.column("text").to_pylist(), batch.column("_places").to_pylist()):
            gone = _long_runs(sorted((m["place"], m["n_words"]) for m in marks or ()), least_words)
            spans: list[dict] = []
            if gone:
                data = text.encode()
                ends = chunk_ends(data, words_per_chunk)
                starts = [0, *ends]
                text = b"".join(data[a:b] for i, (a, b) in enumerate(zip(starts, ends)) if i not in gone).decode()
                for place in gone:
                    if spans and spans[-1]["end"] == starts[place]:
                        spans[-1]["end"] = ends[place]
                    else:
                        spans.append({"begin": starts[place], "end": ends[place]})
            made["kept_text"].append(text)
            made["n_removed"].append(len(gone))
            made["removed_words"].append(sum(gone.values()))
            made["removed"].append(spans)
        return made

    keep = tuple(c for c in docs.columns if c != "text")
    schema = "kept_text string, n_removed int, removed_words int, removed array<struct<begin:int,end:int>>"
    cut = map_batches(marked, kernel, schema, keep=keep)
    return cut.withColumnRenamed("kept_text", "text")


def _long_runs(marks: list[tuple[int, int]], least_words: int) -> dict[int, int]:
    """Words by place, for the places in runs of at least so many words."""
    kept: dict[int, int] = {}
    run: dict[int, int] = {}
    for place, words in [*marks, (-1, 0)]:
        if run and place != next(reversed(run)) + 1:
            if sum(run.values()) >= least_words:
                kept |= run
            run = {}
        run[place] = words
    return kept


def dedup_substrings(
    docs: DataFrame,
    words_per_chunk: int = WORDS_PER_CHUNK,
    least_words: int = LEAST_WORDS_REMOVED,
    carry: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """The ``carry`` columns, ``text, n_removed, removed_words, removed`` of every row of ``docs``.

    ``text`` is less what earlier texts, or it itself, had before. The first
    occurrence, by ``doc_id`` (null first) and place, stays. Rows with equal
    ``doc_id`` are ordered by a hash of the text; rows equal in both are one
    document and come out equal. A null text stays null, a text that is all
    repeated becomes empty. Other columns are not used.
    """
    prepare(docs.sparkSession)
    carried = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in carry]).alias("_carry"))
    identified = _identified(carried).drop("doc_id")
    places = repeated_chunks(chunks(identified, words_per_chunk))
    cut = remove_places(identified, places, words_per_chunk, least_words)
    return cut.select(
        *[F.col("_carry").getField(c).alias(c) for c in carry],
        "text",
        "n_removed",
        "removed_words",
        "removed",
    )
