"""SimHash, chunks and Lempel-Ziv fingerprints against brute force."""

import hashlib
import itertools
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import chunk_dedup, components, lz_fingerprint, simhash


def text_hash(text):
    """Spark's hash of a text; null has the seed."""
    return 42 if text is None else (xxhash.xxh64_intdigest(text, 42) + 2**63) % 2**64 - 2**63


def slow_simhash(text):
    words = text.encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(ids, linked):
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in linked:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    return {i: find(i) for i in ids}


def test_simhash_of_texts(edge_rows):
    for _, text, *_ in edge_rows[:12]:
        assert simhash.fingerprint((text or "").encode()) == slow_simhash(text or "")


def test_simhash_agrees_with_sparks_own_hash(spark):
    assert spark.sql("SELECT xxhash64('a b c d') AS h").first()["h"] % 2**64 == xxhash.xxh64_intdigest(b"a b c d", 42)


def test_every_pair_within_the_radius_agrees_under_a_mask():
    masks = simhash.covering_masks(4)
    assert len(masks) == 31 and all(30 <= m.bit_count() <= 34 for m in masks)
    for n in (1, 2, 3):
        for bits in itertools.islice(itertools.combinations(range(64), n), 0, None, 1 if n < 3 else 7):
            flipped = sum(1 << b for b in bits)
            assert any(m & flipped == 0 for m in masks)
    rng = random.Random(1)
    for _ in range(20_000):
        flipped = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(m & flipped == 0 for m in masks)


def around(rng, centre, flips):
    return centre ^ sum(1 << b for b in rng.sample(range(64), flips))


@pytest.mark.parametrize("block", [8, 256])
def test_links_connect_what_all_pairs_connect(spark, block):
    rng = random.Random(2)
    prints = {rng.getrandbits(64) for _ in range(300)}
    dense = rng.getrandbits(64)
    prints |= {around(rng, dense, rng.randint(0, 3)) for _ in range(150)}
    chain = [rng.getrandbits(64)]
    for _ in range(40):
        chain.append(around(rng, chain[-1], 4))
    prints |= set(chain)
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    table = spark.createDataFrame([(p,) for p in signed], "fp long")
    links = [(r["a"], r["b"]) for r in simhash.near_links(table, 4, block).collect()]
    array = np.array(signed, np.int64).view(np.uint64)
    near = [
        (signed[i], signed[j]) for i in range(len(signed)) for j in np.flatnonzero(np.bitwise_count(array ^ array[i]) <= 4)
    ]
    assert set(links) <= set(near)
    assert slow_components(signed, links) == slow_components(signed, near)


def test_near_duplicates_of_edge_documents(edge_docs, no_docs):
    rows = edge_docs.select("doc_id", "text").collect()
    got = simhash.near_duplicates(edge_docs).collect()
    prints = [slow_simhash(r["text"] or "") for r in rows]
    linked = [
        (i, j) for i, j in itertools.combinations(range(len(rows)), 2) if (prints[i] ^ prints[j]).bit_count() <= 4
    ]
    groups = slow_components(range(len(rows)), linked)
    least = {}
    for i, group in groups.items():
        least.setdefault(group, []).append(rows[i]["doc_id"])
    name = {g: min((i for i in ids if i is not None), default=None) for g, ids in least.items()}
    want = sorted((str(r["doc_id"]), f"{p:016x}", str(name[groups[i]])) for i, (r, p) in enumerate(zip(rows, prints)))
    assert want == sorted(
        (str(r["doc_id"]), f"{r['fp'] % 2**64:016x}", str(r["component_id"])) for r in got
    )
    assert simhash.near_duplicates(no_docs).count() == 0


def test_components_of_random_links(spark):
    rng = random.Random(4)
    links = [(rng.randint(-60, 60), rng.randint(-60, 60)) for _ in range(70)]
    links += [(i, i + 1) for i in range(1000, 1100)] + [(2000, i) for i in range(2001, 2100)] + [(5, 5)]
    got = components.connected_components(spark.createDataFrame(links, "a long, b long"))
    used = {i for link in links for i in link if link[0] != link[1]}
    want = slow_components(used, [link for link in links if link[0] != link[1]])
    assert {r["node"]: r["root"] for r in got.collect()} == want
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- chunks ------------------------------------------------------------------


def test_gear_hash_is_the_rolling_one():
    data = np.frombuffer(random.Random(1).randbytes(500), np.uint8)
    rolling, hashes = 0, chunk_dedup.gear_hashes(data)
    for byte, fast in zip(data.tolist(), hashes.tolist()):
        rolling = ((rolling << 1) + int(chunk_dedup.GEAR[byte])) & 0xFFFF
        assert rolling == fast


def test_chunks_shift_with_insertions(words):
    rng = random.Random(2)
    text = " ".join(rng.choice(words) for _ in range(800)).encode()

    def chunks_of(data):
        ends = chunk_dedup.chunk_ends(data)
        return [data[a:b] for a, b in zip([0, *ends], ends)]

    first = chunks_of(text)
    assert b"".join(first) == text and len(first) > 80
    second = chunks_of(text[:1000] + b"inserted words " + text[1000:])
    assert len(set(first) - set(second)) <= 8
    for data in ("é" * 9000, "日本語" * 5000, "x" * 10_000):
        encoded = data.encode()
        assert "".join(c.decode() for c in chunks_of(encoded)) == data


def slow_dedup(rows):
    """Texts by row, with the repeated runs cut out, from one ordered pass."""
    order = sorted(
        range(len(rows)), key=lambda i: (rows[i]["doc_id"] is not None, rows[i]["doc_id"] or 0, rows[i]["h"])
    )
    seen, result, earlier = set(), {}, {}
    for i in order:
        text, same = rows[i]["text"], (rows[i]["doc_id"], rows[i]["text"])
        if same in earlier:  # equal rows are one document
            result[i] = result[earlier[same]]
            continue
        earlier[same] = i
        data = (text or "").encode()
        ends = chunk_dedup.chunk_ends(data)
        marks = []
        for place, (a, b) in enumerate(zip([0, *ends], ends)):
            words = data[a:b].split()
            key = b" ".join(words)
            if words and key in seen:
                marks.append((place, max(len(words), len(key) // 8)))
            if words:
                seen.add(key)
        runs = []
        for place, n in marks:
            if runs and runs[-1][-1][0] == place - 1:
                runs[-1].append((place, n))
            else:
                runs.append([(place, n)])
        gone = {p for run in runs if sum(n for _, n in run) >= chunk_dedup.LEAST_WORDS_REMOVED for p, _ in run}
        kept = b"".join(data[a:b] for p, (a, b) in enumerate(zip([0, *ends], ends)) if p not in gone).decode()
        result[i] = kept if gone else text
    return sorted((str(rows[i]["doc_id"]), str(t)) for i, t in result.items())


@pytest.mark.parametrize("at_once", [50, 500_000])
def test_dedup_is_the_ordered_pass(edge_docs, small_docs, monkeypatch, at_once):
    monkeypatch.setattr(chunk_dedup, "CHUNKS_AT_ONCE", at_once)
    for docs in (edge_docs, small_docs):
        rows = docs.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()
        got = chunk_dedup.dedup_substrings(docs).collect()
        assert sorted((str(r["doc_id"]), str(r["text"])) for r in got) == slow_dedup(rows)


def test_planted_passages_are_removed_and_clean_texts_stay(spark, words):
    rng = random.Random(6)

    def prose(n):
        return " ".join(rng.choice(words) + str(rng.randint(0, 99)) for _ in range(n))

    passages = [prose(51) for _ in range(40)]
    rows, clean = [], []
    for i in range(400):
        own = [prose(40), prose(40)]
        if i % 4 == 0:
            own.insert(1, passages[i // 4 % 40])
        else:
            clean.append(i)
        rows.append((i, "\n".join(own)))
    got = {r["doc_id"]: r for r in chunk_dedup.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    text = dict(rows)
    assert all(got[i]["text"] == text[i] and got[i]["removed"] == [] for i in clean)
    later = [i for i in range(0, 400, 4) if i // 4 >= 40]
    caught = [i for i in later if got[i]["removed_words"] >= 20]
    assert len(caught) >= 0.98 * len(later)
    # Some four words stay at either end.
    assert sum(51 - got[i]["removed_words"] for i in caught) <= 9 * len(caught)
    for i in caught:
        data = text[i].encode()
        left, at = b"", 0
        for span in got[i]["removed"]:
            left, at = left + data[at : span["begin"]], span["end"]
        assert (left + data[at:]).decode() == got[i]["text"]


def test_repeated_text_without_white_space_is_found(spark):
    rng = random.Random(3)

    def letters(n):
        return "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(n))

    passage = letters(700)
    rows = [(1, letters(300) + passage + letters(200)), (2, letters(500) + passage + letters(100)), (3, letters(1500))]
    got = {r["doc_id"]: r for r in chunk_dedup.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1]["removed"] == got[3]["removed"] == []
    assert len(rows[1][1]) - len(got[2]["text"]) >= 600 and passage[350:400] not in got[2]["text"]


def test_short_common_lines_stay(spark, words):
    """Lines of under twenty words are in many texts and are no passage."""
    rng = random.Random(7)
    line = " ".join(rng.choice(words) for _ in range(18)) + "."
    rows = [(i, " ".join(rng.choice(words) + str(rng.randint(0, 99)) for _ in range(60)) + "\n" + line) for i in range(50)]
    got = chunk_dedup.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["text"] for r in got} == dict(rows)


def test_dedup_of_no_documents(no_docs):
    assert chunk_dedup.dedup_substrings(no_docs).count() == 0


# --- Lempel-Ziv --------------------------------------------------------------


def test_parser_takes_the_shortest_new_phrases():
    parser = lz_fingerprint.PhraseParser().feed("aababcab")
    assert parser.phrases == {"a", "ab", "abc"} and parser.phrase == "ab"
    whole = lz_fingerprint.PhraseParser().feed("the cat sat on the mat, the cat sat")
    parts = lz_fingerprint.PhraseParser().feed("the cat s").copy().feed("at on the mat, the cat sat")
    assert whole.phrases == parts.phrases and sorted(whole.hashes) == sorted(parts.hashes)


def test_likeness_follows_the_shared_phrases(words):
    rng = random.Random(8)
    text = " ".join(rng.choice(words) for _ in range(900))
    half = " ".join(rng.choice(words) for _ in range(450))
    other = " ".join("".join(rng.choice("stuvwxyz") for _ in range(5)) for _ in range(900))

    def parse(t):
        return lz_fingerprint.PhraseParser().feed(t)

    a, b, c = parse(text), parse(text[: len(text) // 2] + half), parse(other)
    for x, y in ((a, b), (a, c), (b, c)):
        exact = len(x.phrases & y.phrases) / len(x.phrases | y.phrases)
        assert abs(lz_fingerprint.likeness(x.signature(), y.signature()) - exact) < 0.17
    assert lz_fingerprint.likeness(a.signature(), parse(text).signature()) == 1.0
    empty = parse("").signature()
    assert lz_fingerprint.likeness(empty, empty) == 1.0 and lz_fingerprint.likeness(empty, a.signature()) == 0.0


@pytest.mark.parametrize("per_range", [3, 5_000])
def test_edited_texts_follow_the_order(spark, edge_docs, no_docs, monkeypatch, per_range):
    monkeypatch.setattr(lz_fingerprint, "DOCS_PER_RANGE", per_range)
    rows = sorted(
        ((r["doc_id"], r["text"]) for r in edge_docs.collect()),
        key=lambda r: (r[0] is not None, r[0] or 0, text_hash(r[1]), r[1] or ""),
        reverse=True,
    )
    want = []
    for i, (doc_id, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        prints = [lz_fingerprint.PhraseParser().feed(t).signature() for t in (text, edited, following)]
        want.append(
            (
                str(doc_id),
                len(text),
                hashlib.sha256(edited.encode()).hexdigest(),
                *map(lz_fingerprint.as_text, prints[:2]),
                lz_fingerprint.likeness(prints[0], prints[1]),
                lz_fingerprint.likeness(prints[0], prints[2]),
            )
        )
    got = [(str(r[0]), *r[1:]) for r in lz_fingerprint.compare_edited(edge_docs).collect()]
    assert sorted(got) == sorted(want)
    assert lz_fingerprint.compare_edited(no_docs).count() == 0
    one = spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")
    assert lz_fingerprint.compare_edited(one).first()["edited_sha256"] == hashlib.sha256(b"abcabc").hexdigest()


def test_equal_texts_have_equal_fingerprints(edge_docs):
    prints = {}
    for r in lz_fingerprint.fingerprints(edge_docs).join(edge_docs.select("doc_id", "text"), "doc_id").collect():
        prints.setdefault(r["text"], set()).add(r["fingerprint"])
    assert all(len(p) == 1 for p in prints.values())
