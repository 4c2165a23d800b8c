"""Alignment against the libraries' own tokens, compared pair by pair."""

import hashlib
import json
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest import SMALL
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import alignment
from tidemark.llm.queries import QUERIES

BYTES = Path(public_tokenizers.path("byte_bpe_50k.json")).read_bytes()
PIECES = Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()


@pytest.fixture(scope="module")
def plain():
    """Tokens of a text as (id, begin, end) for both tokenizers, by their libraries alone."""
    tokenizer = Tokenizer.from_str(BYTES.decode())
    tokenizer.encode_special_tokens = True
    processor = sentencepiece.SentencePieceProcessor(model_proto=PIECES)
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    to_byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
    entries = {i: e for e, i in json.loads(BYTES)["model"]["vocab"].items()}

    def spans(ids, token_bytes, whole):
        found, at = [], 0
        joined = b"".join(map(token_bytes, ids))
        for i in ids:
            size = len(token_bytes(i))
            found.append((i, at, at + size))
            at += size
        return found if joined == whole else None

    def piece_bytes(i):
        piece = processor.id_to_piece(i)
        if len(piece) == 6 and piece.startswith("<0x"):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def tokens(text):
        if not text:
            return None
        whole = (" " + text).encode()
        a = spans(
            tokenizer.encode(" " + text, add_special_tokens=False).ids,
            lambda i: bytes(to_byte[c] for c in entries[i]),
            whole,
        )
        b = spans(processor.encode(text), piece_bytes, whole)
        return (a, b) if a and b else None

    return tokens


def plain_alignment(a, b):
    links = [(x, y) for x, p, q in a for y, r, s in b if p < s and r < q]
    cuts = sorted({q for _, _, q in a} & {s for _, _, s in b})
    groups, begin = [], 0
    for end in cuts:
        sides = [",".join(str(i) for i, p, q in t if begin <= p and q <= end) for t in (a, b)]
        groups.append("|".join(sides))
        begin = end
    return links, ";".join(groups), len(cuts)


def expected(rows, tokens):
    found = [(doc_id, tokens(text)) for doc_id, text in rows]
    made = [(doc_id, t, plain_alignment(*t) if t else None) for doc_id, t in found]
    n_docs = Counter(pair for _, _, m in made if m for pair in set(m[0]))
    most = Counter()
    for (x, _), n in n_docs.items():
        most[x] = max(most[x], n)
    result = []
    for doc_id, t, m in made:
        if not t:
            result.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        links, groups, n_groups = m
        best = sum(n_docs[p] == most[p[0]] for p in links)
        digest = hashlib.sha256(groups.encode()).hexdigest()
        result.append((doc_id, len(t[0]), len(t[1]), n_groups, len(links), best, sum(n_docs[p] for p in links), digest))
    return sorted(result, key=str)


ODD = [
    "a", " ", "\n", "  two  blanks", "▁", "x ▁ y", "日本語 text 😀😀", "é", "é", "\x00\x01", "<s> </s> <|endoftext|> <unk> <0x41>",
    "\t\ttabs\r\n\r\n", " " * 300, "ab" * 40, "  　", "naïve café — “quoted”", "12345678901234567890",
]


@pytest.mark.parametrize("stretch, at_once, broadcast", [(32, 1 << 20, 1 << 20), (1, 10, 0), (3, 1 << 20, 0)])
def test_alignment_of_odd_and_edge_texts(spark, edge_docs, plain, monkeypatch, stretch, at_once, broadcast):
    """Also with stretches of one token, one text at a time, and pairs met in a join."""
    monkeypatch.setattr(alignment, "STRETCH", stretch)
    monkeypatch.setattr(alignment, "BYTES_AT_ONCE", at_once)
    texts = spark.createDataFrame(list(enumerate(ODD, 1000)), "doc_id long, text string")
    docs = texts.unionByName(edge_docs.filter(F.length("text").isNull() | (F.length("text") < 9_000)).select("doc_id", "text"))
    got = alignment.alignment_digests(docs, BYTES, PIECES, broadcast_pairs=broadcast)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected(rows, plain)


def test_query(spark, plain):
    got = QUERIES["op13_token_alignment"](spark, SMALL)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    short = docs.filter("length(text) < 700").select("doc_id", "text").collect()
    counted = {r["doc_id"]: r for r in got.collect()}
    assert len(counted) == docs.count()
    for doc_id, text in short:
        t, r = plain(text), counted[doc_id]
        links, groups, n_groups = plain_alignment(*t)
        assert (r["n_a"], r["n_b"], r["n_groups"], r["n_links"]) == (len(t[0]), len(t[1]), n_groups, len(links))
        assert r["groups_sha256"] == hashlib.sha256(groups.encode()).hexdigest()
    assert all(r["n_best"] <= r["n_links"] <= r["count_sum"] for r in counted.values())


def test_sums_of_arrays_and_join_agree(spark, small_docs):
    by_arrays = alignment.alignment_digests(small_docs, BYTES, PIECES)
    by_join = alignment.alignment_digests(small_docs, BYTES, PIECES, broadcast_pairs=0)
    assert sorted(map(tuple, by_arrays.collect())) == sorted(map(tuple, by_join.collect()))


def test_pairs_given_out_early_are_added_up(spark, small_docs, monkeypatch):
    aligned = alignment.align_documents(small_docs, BYTES, PIECES)
    size = alignment.pair_size(PIECES)
    whole = sorted(map(tuple, alignment.pair_counts(aligned, size).collect()))
    monkeypatch.setattr(alignment, "PAIRS_AT_ONCE", 100)
    assert sorted(map(tuple, alignment.pair_counts(aligned, size).collect())) == whole


def test_no_documents(spark, no_docs):
    assert alignment.alignment_digests(no_docs, BYTES, PIECES).collect() == []
    assert alignment.alignment_digests(no_docs, BYTES, PIECES, broadcast_pairs=-1).collect() == []


@given(st.lists(st.tuples(st.lists(st.integers(1, 9), min_size=1), st.randoms(use_true_random=False)), min_size=1, max_size=6))
def test_lockstep_of_random_cuts(documents):
    """Random cuts of the same bytes, against all overlapping ranges."""
    ends_a, ends_b, firsts, at = [], [], [], 0
    for sizes, rng in documents:
        firsts.append(len(ends_a))
        own = np.cumsum(sizes)
        ends_a += (at + own).tolist()
        ends_b += sorted(at + x for x in {*(i for i in range(1, own[-1]) if rng.random() < 0.3), int(own[-1])})
        at += int(own[-1])
    a, b, cut_a, cut_b = alignment.lockstep(np.array(ends_a), np.array(ends_b), np.array(firsts))
    ranges = [list(zip([0, *ends], ends)) for ends in (ends_a, ends_b)]
    overlaps = {(i, j) for i, (p, q) in enumerate(ranges[0]) for j, (r, s) in enumerate(ranges[1]) if p < s and r < q}
    assert len(a) == len(overlaps) and set(zip(a.tolist(), b.tolist())) == overlaps
    assert [e for e, c in zip(ends_a, cut_a) if c] == [e for e, c in zip(ends_b, cut_b) if c] == sorted({*ends_a} & {*ends_b})


@given(st.lists(st.integers(0, 2**62)))
def test_packed_numbers(numbers):
    assert alignment.unpacked(alignment.packed(np.array(sorted(numbers), np.int64))).tolist() == sorted(numbers)
