"""Spelling variants against a comparison of all words with each other."""

import random
import re
import zlib
from collections import Counter

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tidemark.llm import spelling
from tidemark.llm.queries import QUERIES, SLIPS


def plain_counts(rows, slips):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if slips and h % slips == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def is_near(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def plain_variants(counts):
    by_size = {}
    for w in counts:
        by_size.setdefault(len(w), []).append(w)
    near = {
        w: [x for k in (-1, 0, 1) for x in by_size.get(len(w) + k, ()) if is_near(w, x)] for w in counts
    }
    forms = {}
    for w, n in counts.items():
        if near[w]:
            best = min(near[w], key=lambda x: (-counts[x], x))
            if counts[best] >= 2 * n:
                forms[w] = best
    result = set()
    for w, n in counts.items():
        root = w
        while root in forms:
            root = forms[root]
        result.add((w, forms.get(w), root, n, len(near[w]), counts[forms[w]] if w in forms else None))
    return result


def test_variants_of_random_words(spark):
    """Few letters, equal letters in a row and ties: all kinds of neighbours."""
    rng = random.Random(5)
    words = {"".join(rng.choice("aabÿ") for _ in range(rng.randint(1, 7))) for _ in range(400)}
    counts = {w: rng.choice([1, 1, 2, 2, 3, 5, 8, 20, 50]) for w in words}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5)
    got = [tuple(r) for r in spelling.spelling_variants(frame).collect()]
    assert len(got) == len(counts)
    assert set(got) == plain_variants(counts)


def test_long_chains_end_at_their_root(spark):
    letters = "abcdefghijklmnop"
    words = [(letters[: i + 1], 3 << i) for i in range(len(letters))]
    got = spelling.spelling_variants(spark.createDataFrame(words, "word string, n long")).collect()
    assert {r["root"] for r in got} == {letters}


def test_a_range_has_a_word_for_each_character_at_most(spark):
    """Words that differ in one place only: one range, whose size the alphabet bounds."""
    letters = [chr(c) for c in [*range(97, 123), *range(0xC0, 0x100)]]
    frame = spark.createDataFrame([(f"wo{c}rd", 3) for c in letters], "word string, n long")
    got = spelling.near_words(frame).collect()
    assert {r["n_near"] for r in got} == {len(letters) - 1}
    most = spelling.rotations(frame).groupBy("skipped").count().agg(F.max("count")).first()[0]
    assert most == len(letters)


@pytest.mark.parametrize("slips", [None, 5, SLIPS])
def test_counts_of_edge_documents(spark, edge_docs, slips):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    got = {r["word"]: r["n"] for r in spelling.count_words(edge_docs, slips).collect()}
    assert got == plain_counts(rows, slips)


def test_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = {tuple(r) for r in QUERIES["op12_spelling_variants"](spark, SMALL).collect()}
    assert got == plain_variants(plain_counts(rows, SLIPS))


def test_counts_given_out_early_are_added_up(spark, small_docs, monkeypatch):
    whole = {tuple(r) for r in spelling.count_words(small_docs, SLIPS).collect()}
    monkeypatch.setattr(spelling, "WORDS_AT_ONCE", 50)
    assert {tuple(r) for r in spelling.count_words(small_docs, SLIPS).collect()} == whole


def test_no_words(spark, no_docs):
    assert spelling.document_variants(no_docs, SLIPS).collect() == []
