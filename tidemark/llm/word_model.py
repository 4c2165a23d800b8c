"""A language model over pairs of words, counted and looked up in buckets of hashed keys.

Words and pairs of words, each with its language, are 64-bit keys. Tasks combine
the keys of their texts and send them to buckets, in which they are merged to sorted
arrays of keys and counts. To be scored, a text sends its keys to the same buckets
and gets back sums, so no table of the model is held by the driver or by a task as
a whole. Buckets follow from the bytes of the texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import bytes_of, prepare
from tidemark.session import stored

BYTES_PER_BUCKET = 8 << 20
LEAST_BUCKETS = 64
KEYS_AT_ONCE = 2_000_000
# Added to a pair's count; and to a word's, times the number of words.
ADDED = 0.1

PACKS = "bucket int, row long, keys binary, counts binary"
MIX = np.uint64(0x9E3779B97F4A7C15)


def text_keys(text: bytes, lang: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of the text's pairs (odd) and their first words (even), and how often each is there."""
    seed = 0 if lang is None else xxhash.xxh3_64_intdigest(lang, 1)
    words = np.array([xxhash.xxh3_64_intdigest(w, seed) for w in text.split()], np.uint64)
    if len(words) < 2:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    pairs = (words[:-1] * MIX) ^ (words[:-1] >> np.uint64(29))
    pairs = (pairs + words[1:]) * MIX
    pairs ^= pairs >> np.uint64(32)
    one = np.uint64(1)
    return np.unique(np.concatenate([words[:-1] & ~one, pairs | one]), return_counts=True)


def _packs(keys: np.ndarray, counts: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes, bytes]]:
    """Sorted keys and their counts by bucket; a bucket is a range of keys."""
    of = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    starts = np.flatnonzero(np.diff(of, prepend=np.uint64(buckets)))
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(keys)]):
        yield int(of[a]), keys[a:b].tobytes(), counts[a:b].astype(np.int64).tobytes()


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    counts = np.bincount(place, np.concatenate([c for _, c in parts]), len(keys))
    return keys, counts.astype(np.int64)


def _arrays(keys: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(keys, np.uint64), np.frombuffer(counts, np.int64)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = {"bucket": pa.int32(), "row": pa.int64(), "keys": pa.binary(), "counts": pa.binary()}
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), types.values())], names=list(types)
    )


def bucket_count(docs: DataFrame) -> int:
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return max(LEAST_BUCKETS, math.ceil(size / BYTES_PER_BUCKET))


def count_words(docs: DataFrame, buckets: int) -> DataFrame:
    """The model, a row for each bucket: ``bucket``, sorted ``keys``, ``counts`` and ``n_words``.

    ``n_words`` is the number of different first words. Keys that occur once are
    left out, as a text's own occurrences never count for it.
    """

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held = [], 0

        def flush():
            rows = [(b, None, k, c) for b, k, c in _packs(*_merged(waiting), buckets)]
            waiting.clear()
            yield _batch(rows)

        for batch in batches:
            for text, lang in zip(bytes_of(batch.column("text")), batch.column("lang").to_pylist()):
                found = text_keys(text, lang)
                if len(found[0]):
                    waiting.append(found)
                    held += len(found[0])
                if held >= KEYS_AT_ONCE:
                    merged = [_merged(waiting)]
                    waiting[:] = merged
                    held = len(merged[0][0])
                    if held >= KEYS_AT_ONCE // 2:
                        yield from flush()
                        held = 0
        if waiting:
            yield from flush()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list] = {}
        for batch in batches:
            for bucket, keys, counts in zip(*(batch.column(c).to_pylist() for c in ("bucket", "keys", "counts"))):
                parts.setdefault(bucket, []).append(_arrays(keys, counts))
        for bucket in sorted(parts):
            keys, counts = _merged(parts.pop(bucket))
            n_words, often = int((keys & np.uint64(1) == 0).sum()), counts > 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([bucket], pa.int32()),
                    pa.array([keys[often].tobytes()], pa.binary()),
                    pa.array([counts[often].tobytes()], pa.binary()),
                    pa.array([n_words], pa.int64()),
                ],
                names=["bucket", "keys", "counts", "n_words"],
            )

    packs = docs.select("text", "lang").mapInArrow(combine, PACKS).drop("row")
    return packs.repartition(buckets, "bucket").mapInArrow(
        merge, "bucket int, keys binary, counts binary, n_words long"
    )


def score_words(docs: DataFrame) -> DataFrame:
    """``row, word_nll``: mean negative log probability of a word after the one before it.

    ``docs`` has ``row``, ``text`` and ``lang``. A pair's probability is its count in
    all other texts, plus ``ADDED``, over that of its first word there. Equal ``row``
    is for equal text and language. Texts of less than two words have no row.
    """
    prepare(docs.sparkSession)
    buckets = bucket_count(docs)
    model = stored(count_words(docs, buckets), "word-model")
    n_words = model.agg(F.sum("n_words")).first()[0] or 1
    added = ADDED * n_words

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.column("row").to_pylist(), batch.column("lang").to_pylist()
            rows = []
            for text, row, lang in zip(bytes_of(batch.column("text")), *columns):
                rows += [(b, row, k, c) for b, k, c in _packs(*text_keys(text, lang), buckets)]
                if len(rows) > 50_000:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.empty(0, np.uint64), np.empty(0, np.int64)
        at, known = None, none
        for batch in batches:
            rows, sums, sizes = [], [], []
            for bucket, row, keys, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if bucket != at:
                    at, known = bucket, none
                if row is None:
                    known = _arrays(keys, counts)
                    continue
                keys, own = _arrays(keys, counts)
                pair = (keys & np.uint64(1)) == 1
                others = np.zeros(len(keys))
                if len(known[0]):
                    place = np.minimum(np.searchsorted(known[0], keys), len(known[0]) - 1)
                    others = np.where(known[0][place] == keys, known[1][place] - own, 0)
                logs = np.log(others + np.where(pair, ADDED, added))
                rows.append(row)
                sums.append(float((np.where(pair, -own, own) * logs).sum()))
                sizes.append(int(own[pair].sum()))
            arrays = [pa.array(rows, pa.int64()), pa.array(sums, pa.float64()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["row", "part", "pairs"])

    sent = docs.select("row", "text", "lang").mapInArrow(send, PACKS)
    known = model.select("bucket", F.lit(None).cast("long").alias("row"), "keys", "counts")
    dealt = sent.unionByName(known).repartition(buckets, "bucket")
    dealt = dealt.sortWithinPartitions("bucket", F.col("row").asc_nulls_first())
    parts = dealt.mapInArrow(look_up, "row long, part double, pairs long")
    return parts.groupBy("row").agg((F.sum("part") / F.sum("pairs")).alias("word_nll"))
