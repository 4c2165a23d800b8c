"""SimHash near-duplicates by covering locality-sensitive hashing.

Each bit position of a fingerprint has a non-zero vector of ``radius + 1`` bits.
Mask v keeps the positions whose vector has an odd product with v. The vectors of
up to ``radius`` differing positions leave some non-zero v with even products
throughout, so two fingerprints within the radius agree under that mask: every
such pair meets in a table, and the exact distance is checked there.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import connected_components
from tidemark.llm.shared import bytes_of, map_batches, prepare, task_count
from tidemark.operators.joins import left_lookup
from tidemark.session import stored

SHINGLE_WORDS = 4
RADIUS = 4
SEED = 42
BITS = 64
# Fingerprints compared with each other in one piece of work.
BLOCK = 256
SHINGLES_AT_ONCE = 1 << 16
ROWS_PER_SLOT = 10_000


def fingerprint(text: bytes, words_per_shingle: int = SHINGLE_WORDS) -> int:
    """SimHash of a text: a bit is set if it is in over half of the shingles' hashes.

    A-Z count as lower case; words end at ASCII white space; repeated shingles
    count each time. Fewer words than a shingle has are one shingle; a text
    without words has the fingerprint zero.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    last = min(words_per_shingle, len(words)) - 1
    digest, totals = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    spans = list(zip(starts, ends[last:].tolist()))
    for at in range(0, len(spans), SHINGLES_AT_ONCE):
        some = [digest(joined[a:b], SEED) for a, b in spans[at : at + SHINGLES_AT_ONCE]]
        bits = np.unpackbits(np.array(some, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        totals += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * totals > len(spans), bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, words_per_shingle: int = SHINGLE_WORDS, carry: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """The ``carry`` columns and ``fp`` (signed 64-bit) of every whole text; null texts are empty."""
    prepare(docs.sparkSession)

    def kernel(batch: pa.RecordBatch) -> dict:
        prints = [fingerprint(t, words_per_shingle) for t in bytes_of(batch.column("text"))]
        return {"fp": np.array(prints, np.uint64).view(np.int64)}

    return map_batches(docs.select(*carry, "text"), kernel, "fp long", keep=carry)


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """Masks such that any two prints within the radius agree under one of them.

    Positions take the non-zero vectors in turn, so each mask keeps about half.
    """
    vectors = [1 + i % (2 ** (radius + 1) - 1) for i in range(bits)]
    return [
        sum(1 << i for i, v in enumerate(vectors) if (v & mask).bit_count() % 2)
        for mask in range(1, 2 ** (radius + 1))
    ]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _forest(prints: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links within the radius that connect what all such links connect.

    Each step finds every print that is near one of the group found so far and
    not in a group yet, so there are fewer links than prints.
    """
    signed = prints.view(np.int64)
    links, free = [], np.ones(len(prints), bool)
    for first in range(len(prints)):
        if not free[first]:
            continue
        free[first] = False
        found = [first]
        while found:
            one = found.pop()
            rest = np.flatnonzero(free)
            near = rest[np.bitwise_count(prints[rest] ^ prints[one]) <= radius]
            free[near] = False
            links += [(int(signed[one]), int(signed[i])) for i in near]
            found += near.tolist()
    return links


def near_links(prints: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """``a, b``: links that connect all distinct prints (column ``fp``) within the radius.

    Only table entries with company go on. A large entry is cut into blocks by a
    hash, and every two blocks are compared in a piece of work of their own, so
    an entry of any size is compared in full, spread over the tasks. A piece
    returns a spanning forest of its links, not its pairs. Pieces share tasks,
    ``ROWS_PER_SLOT`` rows on average. ``prints`` is read twice: pass it stored.
    """
    entries = prints.select(
        "fp",
        F.posexplode(
            F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in covering_masks(radius)])
        ).alias("table", "key"),
    )
    counted = stored(
        entries.groupBy("table", "key")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .withColumn("blocks", F.ceil(F.col("n") / block).cast("int")),
        "crowded",
    )
    rows = counted.agg(F.sum(F.col("n") * F.col("blocks"))).first()[0] or 0
    slots = task_count(prints, rows, ROWS_PER_SLOT)

    crowded = left_lookup(entries, counted, ["table", "key"], "inner")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: (j != F.col("own")) | (F.col("blocks") == 1))
    dealt = (
        crowded.withColumn("own", own)
        .select("table", "key", "fp", "own", F.explode(others).alias("other"))
        .select("table", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")
        .withColumn("slot", F.pmod(F.xxhash64("table", "key", "i", "j"), F.lit(slots)).cast("int"))
    )

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        keys = [frame[c].to_numpy() for c in ("j", "i", "key", "table")]
        order = np.lexsort(keys)
        prints = frame["fp"].to_numpy()[order].view(np.uint64)
        changes = np.zeros(len(order), bool)
        for key in keys:
            changes[1:] |= np.diff(key[order]) != 0
        cuts = [0, *np.flatnonzero(changes).tolist(), len(order)]
        links = [link for a, b in zip(cuts, cuts[1:]) for link in _forest(prints[a:b], radius)]
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return dealt.groupBy("slot").applyInPandas(compare, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    words_per_shingle: int = SHINGLE_WORDS,
    radius: int = RADIUS,
    carry: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """The ``carry`` columns (with ``doc_id``), ``fp, root, component_id`` of every row of ``docs``.

    ``root``, a fingerprint, is the same in a component and in no other.

    Prints within ``radius`` bits are linked; the component is named by the
    smallest ``doc_id`` reachable over links. Equal prints are one node, so copies
    are never paired with each other. Rows with equal ``doc_id`` stay rows of
    their own; a null id counts as none for the name (null if there is no other);
    texts without words have print zero and are linked by it like others.
    """
    prepare(docs.sparkSession)
    printed = stored(fingerprints(docs, words_per_shingle, carry), "prints")
    nodes = stored(printed.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "nodes")
    links = near_links(nodes.select("fp"), radius)
    groups = connected_components(links, "simhash")
    rooted = nodes.join(groups, F.col("fp") == F.col("node"), "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = left_lookup(rooted, names, ["root"], "inner").select("fp", "root", "component_id")
    return left_lookup(printed, named, ["fp"], "inner").select(*carry, "fp", "root", "component_id")


def hex_print(column: str = "fp") -> Column:
    """16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))
