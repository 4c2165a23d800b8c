"""Alignment of two tokenizers' tokens over the same bytes, by merging in lockstep.

The tokens of a batch of documents lie end to end in two arrays of byte ends. One
state vector holds a pointer into each array for every document, or for every
stretch of a long one; a step moves all of them at once. Each step emits a link
per pointer pair, the tokens it stands on, and a cut where both tokens end; what
has reached its end is taken out of the state.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as model_pb2
from tokenizers import Tokenizer

from tidemark.llm.byte_bpe import BPE
from tidemark.llm.pieces import MARKS, PieceIds, byte_alphabet, spaced_coder
from tidemark.llm.shared import map_batches, prepare, texts_of
from tidemark.operators.joins import left_lookup
from tidemark.session import stored

BLANK = "▁"  # fixed value: stands for a blank in pieces
NOT_SPELLED = 2**32 - 1  # instead of an id, in parts that their ids do not spell out
# First tokens to a stretch of a document that is merged on its own.
STRETCH = 32
BYTES_AT_ONCE = 1 << 20
# Pairs that a task counts before it gives them out.
PAIRS_AT_ONCE = 1 << 21
# Pairs sent to all executors, 16 bytes each; a larger table is joined.
BROADCAST_PAIRS = 2_000_000

COUNTS = ("n_a", "n_b", "n_groups", "n_links")


class Coder(NamedTuple):
    """Ids of texts, None for a text that its ids do not spell out; and what bytes each id stands for."""

    encode: Callable[[list[str]], list[np.ndarray | None]]
    token_bytes: list[bytes]


def _spelled(ids: Sequence[int], token_bytes: list[bytes], text: str) -> bool:
    return b"".join(map(token_bytes.__getitem__, ids)) == text.encode()


@lru_cache(maxsize=2)
def byte_level_coder(vocabulary: bytes) -> Coder:
    """A byte-level vocabulary (tokenizers JSON); texts get a blank in front."""
    to_byte = {c: b for b, c in enumerate(byte_alphabet())}
    tokenizer = Tokenizer.from_str(vocabulary.decode())
    entries = tokenizer.get_vocab()
    token_bytes = [b""] * (max(entries.values()) + 1)
    for entry, number in entries.items():
        known = all(c in to_byte for c in entry)
        token_bytes[number] = bytes(map(to_byte.__getitem__, entry)) if known else entry.encode()
    # With an entry for every byte and texts taken as they are, ids always spell the text.
    lossless = tokenizer.normalizer is None and all(c in entries for c in to_byte)
    code = spaced_coder(vocabulary)

    def encode(texts: list[str]) -> list[np.ndarray | None]:
        found = [np.frombuffer(code(" " + t), "<u4").astype(np.int64) for t in texts]
        if lossless:
            return found
        return [f if _spelled(f.tolist(), token_bytes, " " + t) else None for f, t in zip(found, texts)]

    return Coder(encode, token_bytes)


@lru_cache(maxsize=2)
def piece_coder(model: bytes) -> Coder:
    """A sentencepiece BPE model that puts a blank before texts itself.

    Merges never cross a place whose two characters are side by side in no piece.
    Where blanks, line feeds and marks behind a word are such places, texts are cut
    there, and the ids of the parts are kept; other texts and models go to the
    library as a whole.
    """
    proto = model_pb2.ModelProto()
    proto.ParseFromString(model)
    whole = sentencepiece.SentencePieceProcessor(model_proto=model)
    numbers = range(whole.get_piece_size())
    token_bytes = [
        bytes([int(piece[3:5], 16)]) if whole.is_byte(i) else piece.replace(BLANK, " ").encode()
        for i, piece in zip(numbers, map(whole.id_to_piece, numbers))
    ]
    side_by_side = {p.piece[i : i + 2] for p in proto.pieces for i in range(len(p.piece) - 1)}
    rules = proto.normalizer_spec
    cuttable = (
        proto.trainer_spec.model_type == BPE
        and rules.name == "identity"
        and rules.add_dummy_prefix
        and not rules.remove_extra_whitespaces
        and not any("\n" in pair or (pair[1] == BLANK and pair[0] != BLANK) for pair in side_by_side)
    )
    before_marks = {pair[0] for pair in side_by_side if pair[1] in MARKS}
    rules.add_dummy_prefix = False
    parts = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())

    def part_ids(part: str) -> list[int]:
        ids = parts.encode(part)
        return ids if _spelled(ids, token_bytes, part) else [*ids, NOT_SPELLED]

    def is_apart(stem: str) -> bool:
        return stem[-1:] not in before_marks and stem[:1] not in ("", "\n")

    own = PieceIds(part_ids, is_word=is_apart).__getitem__

    def after_blank(word: str) -> list[int]:
        if word[:1] == "\n":  # the blank is one that was put in to cut there
            return memoryview(own("\n") + own(word[1:])).cast("I").tolist()
        return part_ids(" " + word)

    after = PieceIds(after_blank, mark=own, is_word=is_apart).__getitem__

    def encode(texts: list[str]) -> list[np.ndarray | None]:
        found: list[np.ndarray | None] = []
        for text in texts:
            if cuttable and "  " not in text and BLANK not in text and text[0] != " ":
                ids = np.frombuffer(b"".join(map(after, text.replace("\n", " \n").split(" "))), "<u4")
                if not (ids == NOT_SPELLED).any():
                    found.append(ids.astype(np.int64))
                    continue
            ids = whole.encode(text)
            found.append(np.array(ids, np.int64) if _spelled(ids, token_bytes, " " + text) else None)
        return found

    return Coder(encode, token_bytes)


def lockstep(
    ends_a: np.ndarray, ends_b: np.ndarray, first_tokens: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links and cuts of token sequences over the same bytes.

    ``ends_a`` and ``ends_b`` are where the tokens of all documents end, one after
    another; ``first_tokens`` are the A tokens at which a document begins. Result:
    A and B token of each link, and for each A and B token whether a cut follows.
    """
    n = len(ends_a)
    sizes = np.diff(first_tokens, append=n)
    per_document = -(-sizes // STRETCH)
    within = np.arange(per_document.sum()) - np.repeat(np.cumsum(per_document) - per_document, per_document)
    a = np.repeat(first_tokens, per_document) + within * STRETCH
    stop = np.append(a[1:], n)
    # The first B token that ends behind the stretch's beginning overlaps it.
    b = np.searchsorted(ends_b, np.where(a > 0, ends_a[a - 1], 0), side="right")
    cut_a, cut_b = np.zeros(n, bool), np.zeros(len(ends_b), bool)
    links_a, links_b = [a[:0]], [b[:0]]
    while len(a):
        links_a.append(a)
        links_b.append(b)
        end_a, end_b = ends_a[a], ends_b[b]
        both = end_a == end_b
        cut_a[a[both]] = True
        cut_b[b[both]] = True
        a, b = a + (end_a <= end_b), b + (end_b <= end_a)
        running = a < stop
        if not running.all():
            a, b, stop = a[running], b[running], stop[running]
    return np.concatenate(links_a), np.concatenate(links_b), cut_a, cut_b


@lru_cache(maxsize=4)
def _marked(size: int) -> dict[str, np.ndarray]:
    """All ids up to ``size`` as text, with each mark that can follow."""
    return {mark: np.array([f"{i}{mark}" for i in range(size)], object) for mark in ",|;"}


def group_texts(
    a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray, size_a: int, size_b: int, ends: np.ndarray
) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` for each document; ``ends`` is where its tokens of both kinds end.

    The place of a token is the number of tokens of its own kind before it and of
    the other kind in the groups before (A) or up to (B) its own.
    """
    last_a, last_b = np.flatnonzero(cut_a), np.flatnonzero(cut_b)
    group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
    before = np.append(0, last_b + 1)
    place_a = np.arange(len(a)) + before[group_a]
    place_b = np.arange(len(b)) + last_a[group_b] + 1
    words_a, words_b = _marked(size_a), _marked(size_b)
    parts = np.empty(len(a) + len(b), object)
    parts[place_a] = np.where(cut_a, words_a["|"][a], words_a[","][a])
    parts[place_b] = np.where(cut_b, words_b[";"][b], words_b[","][b])
    begins = np.append(0, ends[:-1])
    return ["".join(parts[x:y].tolist())[:-1] for x, y in zip(begins.tolist(), ends.tolist())]


def packed(numbers: np.ndarray) -> bytes:
    """Ascending whole numbers as differences, lowest bytes first, then the next: files compress it."""
    differences = np.diff(numbers, prepend=0).astype("<u8")
    return differences.view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel().astype(np.int64))


def _blocks(texts: list[str]) -> Iterator[list[int]]:
    block, held = [], 0
    for i, text in enumerate(texts):
        if not text:
            continue
        if held + len(text) > BYTES_AT_ONCE and block:
            yield block
            block, held = [], 0
        block.append(i)
        held += len(text)
    if block:
        yield block


def align_texts(texts: list[str], first: Coder, second: Coder) -> list[dict]:
    """What is in the columns of ``align_documents``, for each text."""
    nothing = dict.fromkeys(COUNTS, 0) | {"groups": "", "pairs": b"", "times": b""}
    results = [nothing] * len(texts)
    sizes_a, sizes_b = (np.fromiter(map(len, c.token_bytes), np.int64) for c in (first, second))
    n_a, n_b = len(sizes_a), len(sizes_b)
    for block in _blocks(texts):
        chosen = [texts[i] for i in block]
        rows, tokens_a, tokens_b = [], [], []
        for i, a, b in zip(block, first.encode(chosen), second.encode(chosen)):
            if a is not None and b is not None:
                rows.append(i)
                tokens_a.append(a)
                tokens_b.append(b)
        if not rows:
            continue
        a, b = np.concatenate(tokens_a), np.concatenate(tokens_b)
        many_a, many_b = (np.fromiter(map(len, t), np.int64) for t in (tokens_a, tokens_b))
        firsts = np.cumsum(many_a) - many_a
        links_a, links_b, cut_a, cut_b = lockstep(np.cumsum(sizes_a[a]), np.cumsum(sizes_b[b]), firsts)
        groups = group_texts(a, b, cut_a, cut_b, n_a, n_b, np.cumsum(many_a + many_b))
        document = np.repeat(np.arange(len(rows)), many_a)
        n_groups = np.bincount(document[cut_a], minlength=len(rows))
        n_links = np.bincount(document[links_a], minlength=len(rows))
        keys = (document[links_a] * n_a + a[links_a]) * n_b + b[links_b]
        keys, times = np.unique(keys, return_counts=True)
        bounds = np.searchsorted(keys, np.arange(len(rows) + 1) * (n_a * n_b))
        for k, i in enumerate(rows):
            x, y = bounds[k], bounds[k + 1]
            results[i] = {
                "n_a": int(many_a[k]),
                "n_b": int(many_b[k]),
                "n_groups": int(n_groups[k]),
                "n_links": int(n_links[k]),
                "groups": groups[k],
                "pairs": packed(keys[x:y] - k * n_a * n_b),
                "times": packed(np.cumsum(times[x:y])),
            }
    return results


def align_documents(
    docs: DataFrame, byte_vocabulary: bytes, piece_model: bytes, keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """The ``keep`` columns and the alignment of every whole text's tokens.

    ``n_a, n_b, n_groups, n_links``; ``groups``, the ids of both in order; and the
    different linked pairs of ids, ascending, with how often each is linked:
    ``pairs`` (a number of both ids, see ``pair_sizes``) and ``times``, packed.
    Null and empty texts, and texts that the ids of one tokenizer do not spell
    out, have no tokens: zeros and empty values. One pass, no exchange.
    """
    shared = prepare(docs.sparkSession).sparkContext.broadcast((byte_vocabulary, piece_model))
    schema = ", ".join(f"{c} long" for c in COUNTS) + ", groups string, pairs binary, times binary"

    def kernel(batch: pa.RecordBatch) -> dict:
        first, second = byte_level_coder(shared.value[0]), piece_coder(shared.value[1])
        rows = align_texts(texts_of(batch.column("text")), first, second)
        return {c: [r[c] for r in rows] for c in (*COUNTS, "groups", "pairs", "times")}

    return map_batches(docs.select(*keep, "text"), kernel, schema, keep=keep)


def pair_size(piece_model: bytes) -> int:
    """A pair is its A id times this, plus its B id."""
    return len(piece_coder(piece_model).token_bytes)


def pair_counts(aligned: DataFrame, size: int) -> DataFrame:
    """``pair, n_docs, best``: documents that hold each pair linked, and whether no other pair of its A id has more.

    Tasks count their documents before the exchange.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, waiting, held = np.empty(0, np.int64), np.empty(0, np.int64), [], 0

        def merge():
            nonlocal known, n, held
            keys, place = np.unique(np.concatenate([known, *waiting]), return_inverse=True)
            ones = np.ones(held, np.int64)
            n = np.bincount(place, np.concatenate([n, ones]), len(keys)).astype(np.int64)
            known, held = keys, 0
            waiting.clear()

        def given():
            for at in range(0, len(known), 100_000):
                some = slice(at, at + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(known[some]), pa.array(n[some])], names=["pair", "n_docs"])

        for batch in batches:
            for data in batch.column("pairs").to_pylist():
                if data:
                    waiting.append(unpacked(data))
                    held += len(waiting[-1])
                if held > PAIRS_AT_ONCE:
                    merge()
                    if len(known) > PAIRS_AT_ONCE:
                        yield from given()
                        known, n = known[:0], n[:0]
        merge()
        yield from given()

    partial = aligned.select("pairs").mapInArrow(run, "pair long, n_docs long")
    counted = stored(partial.groupBy("pair").agg(F.sum("n_docs").alias("n_docs")), "pairs")
    counted = counted.withColumn("a", F.floor(F.col("pair") / size))
    most = counted.groupBy("a").agg(F.max("n_docs").alias("most"))
    return left_lookup(counted, most, ["a"], "inner").select(
        "pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("best")
    )


def _document_pairs(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of a batch's documents one after another, their times, and where documents begin."""
    pairs, times = (
        [unpacked(d) for d in batch.column(c).to_pylist()] for c in ("pairs", "times")
    )
    starts = np.cumsum([0, *map(len, pairs)])
    nothing = np.empty(0, np.int64)
    times = [np.diff(t, prepend=0) for t in times]
    return np.concatenate([nothing, *pairs]), np.concatenate([nothing, *times]), starts


def score_by_arrays(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """``aligned`` with ``n_best`` and ``count_sum``; the counts are sent to all tasks, sorted by pair."""
    table = counts.toArrow().sort_by("pair")
    n_docs = table.column("n_docs").to_numpy()
    best = table.column("best").to_numpy(zero_copy_only=False)
    arrays = table.column("pair").to_numpy(), np.where(best, -n_docs, n_docs)
    shared = prepare(aligned.sparkSession).sparkContext.broadcast(arrays)

    def kernel(batch: pa.RecordBatch) -> dict:
        known, signed = shared.value
        pairs, times, starts = _document_pairs(batch)
        found = signed[np.searchsorted(known, pairs)] if len(known) else pairs
        best_sum = np.append(0, np.cumsum(np.where(found < 0, times, 0)))
        all_sum = np.append(0, np.cumsum(times * np.abs(found)))
        return {"n_best": np.diff(best_sum[starts]), "count_sum": np.diff(all_sum[starts])}

    keep = tuple(c for c in aligned.columns if c not in ("pairs", "times"))
    return map_batches(aligned, kernel, "n_best long, count_sum long", keep=keep)


def score_by_join(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """As ``score_by_arrays``, for any number of pairs. ``aligned`` is stored and has ``row``, which is unique."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, times, starts = _document_pairs(batch)
            rows = np.repeat(batch.column("row").to_numpy(), np.diff(starts))
            for at in range(0, len(pairs), 100_000):
                some = slice(at, at + 100_000)
                columns = [pa.array(x[some]) for x in (rows, pairs, times)]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "pair", "times"])

    held = aligned.select("row", "pairs", "times").mapInArrow(run, "row long, pair long, times long")
    scored = left_lookup(held, counts, ["pair"], "inner").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("n_docs")).alias("count_sum"),
    )
    whole = aligned.drop("pairs", "times").join(scored, "row", "left")
    return whole.withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in ("n_best", "count_sum")})


def score_alignment(aligned: DataFrame, size: int, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """A stored ``aligned`` (with ``row``) less its pairs, with ``n_best`` and ``count_sum``.

    ``count_sum`` adds up, over a document's links, the documents that hold the
    link's pair; ``n_best`` is its links whose pair has the most documents of all
    pairs of the A id. Repeated rows count each as a document. Up to
    ``broadcast_pairs`` pairs are sent to the tasks, more are joined.
    """
    counts = stored(pair_counts(aligned, size), "pair-counts")
    by = score_by_arrays if counts.count() <= broadcast_pairs else score_by_join
    return by(aligned, counts).drop("row")


def groups_digest() -> Column:
    return F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise(F.lit(""))


def alignment_digests(
    docs: DataFrame, byte_vocabulary: bytes, piece_model: bytes, broadcast_pairs: int = BROADCAST_PAIRS
) -> DataFrame:
    """Counts, scores and the digest of the groups of every row of ``docs``.

    Rows with equal or null ``doc_id`` are documents of their own; other columns
    are not used; an empty table gives no rows.
    """
    aligned = align_documents(docs, byte_vocabulary, piece_model)
    kept = aligned.withColumns({"groups_sha256": groups_digest(), "row": F.monotonically_increasing_id()})
    kept = stored(kept.drop("groups"), "aligned")
    scored = score_alignment(kept, pair_size(piece_model), broadcast_pairs)
    return scored.select("doc_id", *COUNTS, "n_best", "count_sum", "groups_sha256")
