"""Lempel-Ziv phrase fingerprints.

A text is parsed into phrases: each is the shortest string, from where the last
one ended, that is not in the dictionary yet, and joins it. Texts that compress
each other well share phrases. The phrase set is hashed, and the smallest hash
in each of a fixed number of bins is the text's signature; the likeness of two
texts is the share of bins in which their signatures agree.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from xxhash import xxh64_intdigest

from tidemark.llm.shared import (
    checked_lookup,
    map_batches,
    prepare,
    sortable,
    task_count,
    texts_of,
    with_range,
)

BIN_BITS = 7
BINS = 1 << BIN_BITS
EMPTY = 0xFFFF  # marks a bin without a hash
DOCS_PER_RANGE = 5_000


class PhraseParser:
    """Parses text fed to it piece by piece; a copy goes on from where it is."""

    def __init__(self):
        self.phrases: set[str] = set()
        self.hashes: list[int] = []
        self.phrase = ""  # begun, but in the dictionary so far

    def copy(self) -> PhraseParser:
        twin = PhraseParser()
        twin.phrases, twin.hashes, twin.phrase = set(self.phrases), list(self.hashes), self.phrase
        return twin

    def feed(self, text: str) -> PhraseParser:
        phrases, hashes, phrase = self.phrases, self.hashes, self.phrase
        for char in text:
            phrase += char
            if phrase not in phrases:
                phrases.add(phrase)
                hashes.append(xxh64_intdigest(phrase))
                phrase = ""
        self.phrase = phrase
        return self

    def signature(self) -> np.ndarray:
        """16 bits of the smallest phrase hash in each bin."""
        hashes = np.array(self.hashes, np.uint64)
        hashes.sort()
        bins = (hashes >> np.uint64(64 - BIN_BITS)).astype(np.int64)
        first = np.flatnonzero(np.diff(bins, prepend=-1))
        signature = np.full(BINS, EMPTY, np.uint16)
        signature[bins[first]] = np.minimum(hashes[first] & np.uint64(0xFFFF), EMPTY - 1)
        return signature


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal bins among those not empty in both; 1 for two empty signatures."""
    used = (a != EMPTY) | (b != EMPTY)
    return float((a[used] == b[used]).mean()) if used.any() else 1.0


def as_text(signature: np.ndarray) -> str:
    return signature.astype(">u2").tobytes().hex()


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` of every whole text; null texts are empty. No exchange."""
    prepare(docs.sparkSession)

    def kernel(batch: pa.RecordBatch) -> dict:
        texts = texts_of(batch.column("text"))
        return {"fingerprint": [as_text(PhraseParser().feed(t).signature()) for t in texts]}

    return map_batches(docs.select("doc_id", "text"), kernel, "fingerprint string", keep=("doc_id",))


COMPARED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def with_following(docs: DataFrame) -> tuple[DataFrame, int]:
    """``docs`` in ranges of (``doc_id``, hash of the text), each followed by the document after its last.

    Documents are in descending order (null ids last; equal ids by the hash, then
    by text); after the last comes the first. A range's ``_extra`` rows are the
    first ones of the next range, found from one row for each range. Sort a range
    by ``_extra`` and the order to get every document with its follower behind it.
    """
    keyed = docs.select("doc_id", "text", sortable("doc_id").alias("_key"), F.xxhash64("text").alias("_tie"))
    rows = docs.agg(F.count(F.lit(1))).first()[0]
    ranged, n = with_range(keyed, "_key", "_tie", task_count(docs, rows, DOCS_PER_RANGE))
    # One row for each range that has rows: the range above it, whose last document they follow.
    tops = ranged.groupBy("_range").agg(F.max(F.struct("_key", "_tie")).alias("_top"))
    tops = tops.select("_range", "_top.*").orderBy("_range").collect()
    above = [*tops[1:], *tops[:1]]
    heads = [(top["_key"], top["_tie"], after["_range"]) for top, after in zip(tops, above)]
    head = docs.sparkSession.createDataFrame(heads, "_key long, _tie long, _to int")
    tagged = checked_lookup(ranged, head, ["_key", "_tie"], "left", most_rows=100_000)
    own = F.struct(F.col("_range").alias("range"), F.lit(0).alias("extra"))
    extra = F.struct(F.col("_to").alias("range"), F.lit(1).alias("extra"))
    copies = F.when(F.col("_to").isNull(), F.array(own)).otherwise(F.array(own, extra))
    dealt = tagged.select("doc_id", "text", "_key", "_tie", F.explode(copies).alias("_c"))
    parts = [F.col("_c.range").alias("_range"), F.col("_c.extra").alias("_extra")]
    return dealt.select("doc_id", "text", "_key", "_tie", *parts), n


def compare_edited(docs: DataFrame) -> DataFrame:
    """Fingerprint every whole text, its edited text, and their likeness.

    In the edited text the last half of the code points (rounded down) is that
    many from the start of the next document, or all it has, in descending
    ``doc_id``; after the last comes the first, and a single document follows
    itself. ``near_edited`` is the likeness to the edited text, ``near_next`` that
    to the next document. Null texts are empty; rows with equal or null ``doc_id``
    follow each other, in the order of a hash of the text, which also parts them
    among tasks if there are very many; an empty table gives no rows. The common
    first half is parsed once. Texts are exchanged once.
    """
    prepare(docs.sparkSession)
    dealt, n = with_following(docs)
    ordered = dealt.repartitionById(n, F.col("_range")).sortWithinPartitions(
        "_range", "_extra", F.col("_key").desc(), F.col("_tie").desc(), F.col("text").desc()
    )

    schema = COMPARED.replace("long", dict(docs.dtypes)["doc_id"], 1)
    fields = list(to_arrow_schema(StructType.fromDDL(schema)))

    def run(batches):
        waiting = None  # the document whose follower comes next
        for batch in batches:
            rows: list[tuple] = []
            columns = (batch.column("doc_id").to_pylist(), texts_of(batch.column("text")))
            for doc_id, text, of_range, extra in zip(
                *columns, batch.column("_range").to_pylist(), batch.column("_extra").to_pylist()
            ):
                if waiting and waiting[0] != of_range:
                    raise ValueError("a range lacks the document after its last")
                if extra and not waiting:
                    continue
                half = len(text) // 2
                parser = PhraseParser().feed(text[: len(text) - half])
                start = parser.copy() if not extra else None
                own = parser.feed(text[len(text) - half :]).signature()
                if waiting:
                    rows.append(_compared(*waiting[1:], text, own))
                waiting = None if extra else (of_range, doc_id, text, own, start)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(fields), fields)],
                names=[f.name for f in fields],
            )

    return ordered.select("doc_id", "text", "_range", "_extra").mapInArrow(run, schema)


def _compared(doc_id, text: str, own: np.ndarray, start: PhraseParser, following: str, next_own: np.ndarray) -> tuple:
    half = len(text) // 2
    added = following[:half]
    edited = start.feed(added).signature()
    digest = hashlib.sha256((text[: len(text) - half] + added).encode()).hexdigest()
    return (
        doc_id,
        len(text),
        digest,
        as_text(own),
        as_text(edited),
        likeness(own, edited),
        likeness(own, next_own),
    )
