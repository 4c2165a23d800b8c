"""Tokenizers against the libraries' own results, token files and packing."""

import base64
import json
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import byte_bpe, packing, pieces, token_files
from tidemark.llm.queries import vocabulary
from tidemark.llm.shared import with_range

RANKS = vocabulary("byte_bpe_50k.tiktoken")


def text_hash(text):
    """Spark's hash of a text; null has the seed."""
    return 42 if text is None else (xxhash.xxh64_intdigest(text, 42) + 2**63) % 2**64 - 2**63


def unpack(ids):
    return np.frombuffer(ids, "<u4").tolist()


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, RANKS.splitlines())}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def library(name):
    tokenizer = Tokenizer.from_str(vocabulary(name).decode())
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def random_texts(n=3000):
    rng = random.Random(11)
    alphabet = "abzAZ09 .,;:!?'\n\t\r\x0b\x1c\x85\xa0  　éßŁ日😀́ſİ-_<|>sdmt"
    yield from ("'s 'll don't we'VE I'm", " x", "x ", "a\n b", "a \nb", "a\n\nb", "a  b.", "b.\nc,", "é.", "İ.", "ſ")
    for _ in range(n):
        yield "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25)))


def test_byte_bpe_is_the_same_as_the_library(reference, edge_rows):
    encode, decode = byte_bpe.coder(RANKS, public_tokenizers.PATTERN)
    for text in [*random_texts(), *(r[1] or "" for r in edge_rows)]:
        ids = unpack(encode(text))
        assert ids == reference.encode_ordinary(text), repr(text)
        assert decode(ids) == text.encode()


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_piece_coders_are_the_same_as_the_library(name, edge_rows):
    coder = pieces.spaced_coder if name.startswith("byte") else pieces.word_coder
    encode, expected = coder(vocabulary(name)), library(name)
    for text in [*random_texts(), *(r[1] or "" for r in edge_rows)]:
        assert unpack(encode(text)) == expected(text), repr(text)


def test_pieces_kept_are_bounded(monkeypatch):
    monkeypatch.setattr(pieces, "PIECES_KEPT", 10)
    ids = pieces.PieceIds(lambda piece: [len(piece)])
    for i in range(1000):
        assert unpack(ids["x" * (i % 37) + "y"]) == [i % 37 + 1]
    assert len(ids) <= 10 and len(ids.earlier) <= 10


def test_model_is_refused_with_gaps_in_its_ranks():
    with pytest.raises(ValueError):
        byte_bpe.build_model({b"a": 0, b"b": 2})


def test_byte_bpe_of_edge_documents(edge_docs, no_docs, reference):
    encoded = byte_bpe.encode_documents(edge_docs, RANKS, public_tokenizers.PATTERN)
    decoded = byte_bpe.decode_documents(encoded, RANKS, public_tokenizers.PATTERN)
    got = sorted((r["doc_id"] or -1, bytes(r["ids"]), bytes(r["decoded"])) for r in decoded.collect())
    want = sorted(
        (r["doc_id"] or -1, np.array(reference.encode_ordinary(t), "<u4").tobytes(), t.encode())
        for r in edge_docs.collect()
        for t in [r["text"] or ""]
    )
    assert got == want
    assert byte_bpe.encode_documents(no_docs, RANKS, public_tokenizers.PATTERN).count() == 0


def test_token_files_hold_the_documents_in_order(spark, edge_docs, no_docs, tmp_path):
    words = vocabulary("word_bpe_49k.json")
    expected = library("word_bpe_49k.json")
    path = str(tmp_path / "tokens")
    token_files.write_token_files(edge_docs, path, words, end_id=1)
    tokens = token_files.read_token_files(spark, path)
    rows = sorted(edge_docs.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, text_hash(r["text"]), r["text"] or ""))
    sequence = [expected(r["text"] or "") + [1] for r in rows]
    stored = tokens.orderBy("file_no", "row").collect()
    assert [(r["doc_id"], list(r["ids"])) for r in stored] == [(r["doc_id"], i) for r, i in zip(rows, sequence)]

    offsets = token_files.document_offsets(tokens).orderBy("start").collect()
    starts = np.cumsum([0, *map(len, sequence)])[:-1].tolist()
    checks = [zlib.crc32(np.array(i, "<u4").tobytes()) for i in sequence]
    assert [(r["start"], r["n_tokens"], r["ids_crc32"]) for r in offsets] == [
        (s, len(i), c) for s, i, c in zip(starts, sequence, checks)
    ]
    token_files.write_token_files(no_docs, path, words, end_id=1)
    empty = token_files.read_token_files(spark, path)
    assert empty.count() == 0 and token_files.document_offsets(empty).count() == 0


def test_an_id_with_most_rows_is_spread_over_files(spark, tmp_path):
    """A third of the rows with a null id, a third with one id: the longest file has twice the median's rows at most."""
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"text number {i} of all") for i in range(6_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "20")
        token_files.write_token_files(docs, str(tmp_path / "t"), vocabulary("word_bpe_49k.json"), end_id=1)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    tokens = token_files.read_token_files(spark, str(tmp_path / "t"))
    sizes = sorted(r["count"] for r in tokens.groupBy("file_no").count().collect())
    assert len(sizes) >= 18 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    assert tokens.count() == 6_000
    by_file = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in tokens.orderBy("file_no", "row").select("doc_id").collect()]
    assert by_file == sorted(by_file)
    offsets = token_files.document_offsets(tokens)
    assert offsets.agg(F.max(F.col("start") + F.col("n_tokens"))).first()[0] == offsets.agg(F.sum("n_tokens")).first()[0]


@pytest.mark.parametrize("n", [1, 2, 7, 50])
def test_ranges_ascend_and_are_all_numbered(spark, n):
    rng = random.Random(n)
    rows = [(rng.choice([1, 1, 1, 5, 5, rng.randrange(40)]), rng.getrandbits(64) - 2**63) for _ in range(4_000)]
    frame = spark.createDataFrame(rows, "k long, t long")
    ranged, count = with_range(frame, "k", "t", n)
    got = sorted((r["k"], r["t"], r["_range"]) for r in ranged.collect())
    assert [r[2] for r in got] == sorted(r[2] for r in got)
    assert 0 <= got[0][2] and got[-1][2] < count <= 2 * n
    if n == 50:
        sizes = Counter(r[2] for r in got)
        assert max(sizes.values()) <= 2.5 * 4_000 / 50


def test_token_files_have_row_indexes_and_bloom_filters(spark, edge_docs, tmp_path):
    import pyarrow.orc as orc

    path = tmp_path / "tokens"
    token_files.write_token_files(edge_docs, str(path), vocabulary("word_bpe_49k.json"), end_id=1)
    files = sorted(p for p in path.iterdir() if p.name.endswith(".orc") and orc.ORCFile(p).nrows)
    first = orc.ORCFile(files[0])
    assert first.row_index_stride == token_files.ROWS_PER_INDEX_ENTRY
    found = token_files.read_token_files(spark, str(path)).filter("doc_id = 105")
    assert found.count() == 1
    assert "EqualTo(doc_id,105)" in found._jdf.queryExecution().executedPlan().toString()


def counts_of(lengths, capacity):
    return np.bincount(lengths, minlength=capacity + 1)


def fewest_bins(lengths, capacity):
    """The optimum, by trying all ways to put the longest piece left into an open bin or a new one."""
    ordered, best = sorted(lengths, reverse=True), len(lengths)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(ordered):
            best = len(rooms)
            return
        for k in {r: k for k, r in enumerate(rooms) if r >= ordered[i]}.values():
            place(i + 1, [*rooms[:k], rooms[k] - ordered[i], *rooms[k + 1 :]])
        place(i + 1, [*rooms, capacity - ordered[i]])

    place(0, [])
    return best


def test_small_packings_against_all_ways_to_pack(spark):
    rng = random.Random(2)
    for _ in range(60):
        capacity = rng.choice([10, 12, 30])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 11))]
        _, _, n = packing.best_fit_decreasing(lengths, capacity)
        best = fewest_bins(lengths, capacity)
        assert packing.lower_bound(counts_of(lengths, capacity), capacity) <= best <= n <= best + 1


@pytest.mark.parametrize("groups, most", [(4, 1.0025), (1, 1.001)])
def test_rounds_come_close_to_the_bound_of_all_pieces(spark, groups, most):
    """Uniform lengths: gaps of groups that meet their own bound are offered too."""
    rng = random.Random(13)
    lengths = [rng.randint(1, 1024) for _ in range(20_000)]
    frame = spark.createDataFrame(list(enumerate(lengths)), "item long, length int")
    places, n, least = packing.pack_pieces(frame, 1024, 20_000 // groups)
    assert least == packing.lower_bound(counts_of(lengths, 1024), 1024)
    assert n == places.select("sequence_id").distinct().count()
    assert n <= most * least


def test_lower_bound_never_exceeds_a_packing_and_is_met_by_easy_ones():
    rng = random.Random(5)
    for _ in range(200):
        capacity = rng.choice([10, 64, 100])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 40))]
        bins, offsets, n = packing.best_fit_decreasing(lengths, capacity)
        used = np.bincount(bins, weights=lengths, minlength=n)
        assert used.max() <= capacity and len(set(bins.tolist())) == n
        taken = {(b, o + i) for b, o, size in zip(bins, offsets, lengths) for i in range(size)}
        assert len(taken) == sum(lengths)
        assert packing.lower_bound(counts_of(lengths, capacity), capacity) <= n
    assert packing.lower_bound(counts_of([6, 6, 6], 10), 10) == 3  # the sum alone says 2
    assert packing.lower_bound(counts_of([4, 4, 4, 4], 10), 10) == 2


def test_packing_places_every_piece_once_over_several_rounds(spark):
    rng = random.Random(9)
    lengths = [rng.randint(1, 100) for _ in range(3000)] + [100] * 50
    pieces_frame = spark.createDataFrame(list(enumerate(lengths)), "item long, length int")
    for per_group in (100_000, 200):
        places, n, least = packing.pack_pieces(pieces_frame, 100, pieces_per_group=per_group)
        got = places.collect()
        assert sorted(r["item"] for r in got) == list(range(len(lengths)))
        sequences = {}
        for r in got:
            sequences.setdefault(r["sequence_id"], []).append((r["offset"], lengths[r["item"]]))
        for placed in sequences.values():
            at = 0
            for offset, length in sorted(placed):
                assert offset == at
                at += length
            assert at <= 100
        assert len(sequences) == n and least <= n <= 1.02 * least


def test_entries_that_are_not_merged_to_themselves_are_left_to_the_library():
    """Ranks stand for merges only if every entry is what its own text is merged to."""
    name = "byte_bpe_50k.json"
    whole = json.loads(vocabulary(name))
    ranked = pieces._ranked_coder(Tokenizer.from_str(json.dumps(whole)))
    assert "_ranked_coder" in ranked.__qualname__
    whole["model"]["merges"][300:302] = whole["model"]["merges"][301:299:-1]
    whole["model"]["merges"].pop(0)
    other = pieces._ranked_coder(Tokenizer.from_str(json.dumps(whole)))
    assert "_split_coder" in other.__qualname__


@pytest.mark.parametrize("text", [" word", "word", " naïveté", "Straße", "русский", " x" * 3, "aaaaaaaaaaaaaaaa", "ﬁ"])
def test_words_by_rank_are_those_by_merges(text):
    tokenizer = Tokenizer.from_str(vocabulary("byte_bpe_50k.json").decode())
    assert pieces._ranked_coder(tokenizer)(text) == pieces._split_coder(tokenizer)(text)


def test_documents_are_cut_and_packed(spark, edge_docs, no_docs):
    name = "byte_bpe_50k.json"
    expected = library(name)
    packed = packing.pack_documents(edge_docs, vocabulary(name), 2, 64)
    want = []
    for r in edge_docs.collect():
        ids = [*expected(r["text"] or ""), 2]
        first = len(ids) % 64 or 64
        cuts = [0, *range(first, len(ids) + 1, 64)]
        want += [
            (r["doc_id"] or -1, i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))
            for i, (a, b) in enumerate(zip(cuts, cuts[1:]))
        ]
    got = [(r["doc_id"] or -1, r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed.collect()]
    assert sorted(got) == sorted(want)
    assert packing.pack_documents(no_docs, vocabulary(name), 2, 64).count() == 0


def test_sequences_are_filled_with_the_ids_of_their_pieces(spark, edge_docs):
    from tidemark.session import stored

    cut = packing.cut_documents(edge_docs, vocabulary("byte_bpe_50k.json"), 2, 64)
    cut = stored(cut.withColumn("item", F.monotonically_increasing_id()), "cut")
    places = stored(packing.pack_pieces(cut.select("item", "length"), 64)[0], "places")
    filled = {r["sequence_id"]: bytes(r["ids"]) for r in packing.fill_sequences(cut, places).collect()}
    for r in cut.join(places, "item").collect():
        at = 4 * r["offset"]
        assert filled[r["sequence_id"]][at : at + 4 * r["length"]] == bytes(r["ids"])
