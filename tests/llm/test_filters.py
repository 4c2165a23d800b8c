"""Quality rules, toxicity and license scans."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import licenses, quality, toxicity, word_model


def slow_counts(text):
    words = text.encode().split()
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    marked = [False] * len(words)
    for i in range(len(words) - 4):
        if windows[tuple(words[i : i + 5])] > 1:
            marked[i : i + 5] = [True] * 5
    lines = [line for line in text.split("\n") if line.encode().split()]
    return (
        len(words),
        sum(len(w.decode()) for w in words),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        sum(marked),
    )


def test_rule_counts(edge_rows):
    rng = random.Random(1)
    texts = [r[1] or "" for r in edge_rows]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    texts += ["a b\n\na b\n a b\n#*$%&|<>\n\t\n\t\n", "a b c d e a b c d e", "a a a a a a"]
    for text in texts:
        assert quality.rule_counts(text.encode()) == slow_counts(text), repr(text[:50])


def slow_kneser_ney(texts, order):
    """Probabilities and scores of all n-grams of the highest order, from plain counts."""
    levels = {order: Counter()}
    for text in texts:
        padded = bytes(order - 1) + text
        levels[order].update(padded[i : i + order] for i in range(len(text)))
    for k in range(order - 1, 0, -1):
        levels[k] = Counter(gram[1:] for gram in levels[k + 1])
    lower = defaultdict(lambda: (1 / 256, 1 / 256))
    for k in range(1, order + 1):
        counts = levels[k]
        n = [sum(c == i for c in counts.values()) for i in range(5)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else 0.5
        d = [0.0] * 4
        for i in (1, 2, 3):
            raw = i - (i + 1) * y * n[i + 1] / n[i] if n[i] else y
            d[i] = max(0.01, min(raw, i - 0.01))
        total, held = Counter(), Counter()
        for gram, c in counts.items():
            total[gram[:-1]] += c
            held[gram[:-1]] += d[min(c, 3)]
        found = {}
        for gram, c in counts.items():
            context, (p, score) = gram[:-1], lower[gram[1:]]
            own = (c - d[min(c, 3)] + held[context] * p) / total[context]
            if c > 1:
                score = own
            elif total[context] > 1:
                score = held[context] * score / total[context]
            found[gram] = own, score
        lower = found
    return lower


def test_model_is_modified_kneser_ney(spark, words):
    rng = random.Random(4)
    rows = [(" ".join(rng.choice(words[:60]) for _ in range(30)), lang) for lang in ("en", None) for _ in range(20)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    model = quality.kneser_ney(quality.count_ngrams(docs))
    got = {(r["lang"], r["key"].to_bytes(5, "big")): (r["p"], r["logp"]) for r in model.collect()}
    want = {}
    for lang in ("en", None):
        slow = slow_kneser_ney([t.encode() for t, own in rows if own == lang], 5)
        want |= {(lang, gram): found for gram, found in slow.items()}
        contexts = defaultdict(float)
        for gram, (p, _) in slow.items():
            contexts[gram[:-1]] += p
        assert max(contexts.values()) < 1 + 1e-9
    assert got.keys() == want.keys()
    for k, (p, score) in want.items():
        assert math.isclose(got[k][0], p, rel_tol=1e-9) and abs(got[k][1] - math.log(score)) < 1e-5
    arrays = quality.sorted_arrays(model)
    assert all((np.diff(keys) > 0).all() for keys, _ in arrays.values())


def test_joined_scores_are_those_of_the_arrays(edge_docs):
    both = [
        {(r["doc_id"], r["n_words"]): (r["kept"], r["perplexity"]) for r in quality.quality(edge_docs, broadcast_entries=n).collect()}
        for n in (0, 10**9)
    ]
    assert both[0].keys() == both[1].keys()
    for key, (kept, perplexity) in both[0].items():
        assert kept == both[1][key][0]
        assert (perplexity is None) == (both[1][key][1] is None)
        assert perplexity is None or math.isclose(perplexity, both[1][key][1], rel_tol=1e-6)


def test_quality_of_edge_documents(edge_docs, no_docs):
    got = sorted(
        (str(r["doc_id"]), r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
        for r in quality.quality(edge_docs).collect()
    )
    want = []
    for r in edge_docs.collect():
        counts = slow_counts(r["text"] or "")
        want.append((str(r["doc_id"]), *counts, counts[0] < 10 or 100 * counts[4] > 20 * counts[0]))
    assert got == sorted(want)
    assert quality.quality(no_docs).count() == 0


def test_odd_perplexity_is_rejected_and_the_others_kept(spark, words):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(15, 200))), "en") for i in range(300)]
    rows.append((1000, " ".join("".join(rng.choice("QZXJ0189%@") for _ in range(6)) for _ in range(150)), "en"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r["doc_id"]: r["kept"] for r in quality.quality(docs).collect()}
    assert not kept.pop(1000) and all(kept.values())


def test_band_is_no_wider_than_a_few_times_the_scores(spark):
    rng = random.Random(9)
    rows = [(i, "en", rng.gauss(1.4, 0.03), 1000, False) for i in range(1000)]
    rows += [(2000 + i, "en", 1.4 + off, 1000, False) for i, off in enumerate((-0.15, 0.15, -0.2, 0.2))]
    rows += [(3000, "en", 1.5, 60, False), (3001, "en", 9.9, 1000, True)]
    scored = spark.createDataFrame(rows, "doc_id long, lang string, nll double, n_bytes int, base_failed boolean")
    judged = scored.join(quality.bands(scored), "lang").filter(quality.outside_band())
    outside = {r["doc_id"] for r in judged.collect()}
    assert {2000, 2001, 2002, 2003} <= outside and 3000 not in outside
    assert len(outside - {3001}) <= 4 + 10


def word_docs(words):
    rng = random.Random(12)
    after = {w: rng.sample(words, 3) for w in words}

    def prose(n):
        text = [rng.choice(words)]
        while len(text) < n:
            text.append(rng.choice(after[text[-1]]))
        return text

    rows = [(i, " ".join(prose(rng.randint(80, 160))), "en") for i in range(400)]
    for i in range(5):
        mixed = prose(120)
        rng.shuffle(mixed)
        rows.append((1000 + i, " ".join(mixed), "en"))
    return rows + [(2000, None, "en"), (2001, "one", None), (2002, "two words", None)]


def test_word_scores_are_those_of_plain_counts(spark, words):
    rows = word_docs(words)
    docs = spark.createDataFrame(rows, "row long, text string, lang string").repartition(5)
    got = {r["row"]: r["word_nll"] for r in word_model.score_words(docs).collect()}
    firsts, pairs = Counter(), Counter()
    split = {i: [(lang, w) for w in (text or "").split()] for i, text, lang in rows}
    for text in split.values():
        firsts.update(text[:-1])
        pairs.update(zip(text, text[1:]))
    assert got.keys() == {i for i, text in split.items() if len(text) > 1}
    for i, nll in got.items():
        text = split[i]
        own, own_pairs = Counter(text[:-1]), Counter(zip(text, text[1:]))
        logs = [
            math.log((pairs[a, b] - own_pairs[a, b] + 0.1) / (firsts[a] - own[a] + 0.1 * len(firsts)))
            for a, b in zip(text, text[1:])
        ]
        assert math.isclose(nll, -sum(logs) / len(logs), rel_tol=1e-9)


def test_mixed_words_are_rejected(spark, words):
    docs = spark.createDataFrame(word_docs(words), "doc_id long, text string, lang string")
    kept = {r["doc_id"]: r["kept"] for r in quality.quality(docs, words=True).collect()}
    assert not any(kept[1000 + i] for i in range(5))
    assert sum(kept[i] for i in range(400)) >= 390


# --- toxicity ----------------------------------------------------------------


def distance(a, b):
    """Edits between two words; two neighbours changed round are one."""
    rows = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(rows[-1][j] + 1, row[-1] + 1, rows[-1][j - 1] + (x != y)))
            if i > 1 and j > 1 and x == b[j - 2] and y == a[i - 2]:
                row[j] = min(row[j], rows[-2][j - 2] + 1)
        rows.append(row)
    return rows[-1][-1]


def test_matcher_finds_terms_within_their_edits():
    rng = random.Random(2)
    terms = ["".join(rng.choice("abcd") for _ in range(rng.randint(2, 11))) for _ in range(30)]
    matcher = toxicity.TermMatcher(terms)
    for _ in range(4000):
        word = "".join(rng.choice("abcde") for _ in range(rng.randint(0, 12)))
        if rng.random() < 0.5:  # two edits of a term, at times a change of neighbours
            letters = list(rng.choice(terms))
            for _ in range(2):
                i = rng.randrange(len(letters))
                letters[i : i + 2] = rng.choice([letters[i : i + 2][::-1], ["e"], letters[i : i + 2] + ["a"]])
            word = "".join(letters)
        near = sorted((distance(word, t), t) for t in set(terms) if distance(word, t) <= toxicity.edits_allowed(t))
        assert matcher.match(word) == (near[0][::-1] if near else None)


def test_states_kept_are_bounded(monkeypatch):
    monkeypatch.setattr(toxicity, "STATES_KEPT", 20)
    matcher = toxicity.TermMatcher(["pathetic", "worthless"])
    for word in ("pathetik", "wrthless", "pathos", "worthles", "x" * 50, "scumabg", "phatetci", "wrothlses"):
        for _ in range(50):
            found = matcher.match(word)
        assert (found is not None) == (word in ("pathetik", "wrthless", "worthles", "wrothlses"))


@pytest.mark.parametrize("length", [10, 500, 50_000])
def test_quotations_of_any_length(length):
    long = "word " * (length // 10) + "\n" + "word " * (length // 10)
    text = f'Before "{long}end" and after, “{long}x”. «{long}».'
    spans = [text[a:b] for a, b in toxicity.quotations(text)]
    assert spans == [f'"{long}end"', f"“{long}x”", f"«{long}»"]


def test_a_missing_mark_does_not_turn_the_rest_inside_out():
    text = 'He is 6" tall. She said "open and never closed. Then "one two" and „drei“ (")x" and end.'
    spans = [text[a:b] for a, b in toxicity.quotations(text)]
    assert spans == ['"one two"', "„drei“", '")x"']
    assert toxicity.quotations('"') == [] and toxicity.quotations('a"b"c') == []


def plain_scores(docs, labels):
    """The whole score by plain Python: lexicon, near words, features, logistic regression."""
    def held_out(i):
        return zlib.crc32(str(i).encode()) % 5 == 0

    known = {}
    for i, toxic in labels:
        if i is not None and toxic is not None and not held_out(i):
            known[i] = max(known.get(i, 0), toxic)
    training = [(i, text or "", known[i]) for i, text in docs if i in known]
    counts = defaultdict(lambda: [0, 0])
    for _, text, toxic in training:
        for word in {toxicity.normal_word(w) for w in text.split()} - {""}:
            counts[word][not toxic] += 1
    n_toxic = sum(t for _, _, t in training)
    n_other = len(training) - n_toxic
    share = n_toxic / len(training)
    terms, lows = {}, {}
    for word, (x, y) in counts.items():
        odds = math.log((x + 0.5) / (n_toxic + 1)) - math.log((y + 0.5) / (n_other + 1))
        lows[word] = odds - math.sqrt(1 / (x + 0.5) + 1 / (y + 0.5))
        g = sum(2 * k * math.log(k / ((x + y) * p)) for k, p in ((x, share), (y, 1 - share)) if k)
        enough = x >= max(toxicity.LEAST_DOCUMENTS, math.ceil(toxicity.LEAST_SHARE * n_toxic))
        if enough and odds >= math.log(toxicity.LEAST_LIFT) and g >= 2 * math.log(len(counts)):
            terms[word] = max(0.1, min(toxicity.MOST_WEIGHT, lows[word]))

    def hit(word):
        plain = toxicity.normal_word(word)
        if plain in terms:
            return plain, terms[plain]
        near = sorted((d, t) for t in terms if (d := distance(plain, t)) <= toxicity.edits_allowed(t))
        if not near:
            return None
        if plain in counts:
            weight = max(0.0, min(toxicity.MOST_WEIGHT, lows[plain]))
            return (plain, weight) if weight else None
        return near[0][1], terms[near[0][1]] * toxicity.EDIT_FACTOR ** near[0][0]

    cache = {}

    def features(text):
        spans = toxicity.quotations(text)
        sums, out, n = ({}, {}), [], 0
        for place, m in enumerate(re.finditer(r"\S+", text)):
            n += 1
            found = cache.setdefault(m.group(), hit(m.group()))
            if found:
                inside = any(a < m.end() and m.start() < b for a, b in spans)
                sums[inside][found[0]] = max(sums[inside].get(found[0], 0.0), found[1])
                if not inside:
                    out.append((place, found[1]))
        window = max((sum(w for q, w in out if p <= q < p + toxicity.WINDOW) for p, _ in out), default=0.0)
        density = 100 * sum(w for _, w in out) / max(n, 50)
        parts = (sum(sums[0].values()), sum(sums[1].values()), window, density, len(sums[0]))
        return [math.log1p(x) for x in parts]

    x = np.array([features(t) for _, t, _ in training])
    y = np.array([t for _, _, t in training], float)
    weights = np.zeros(6)
    design = np.column_stack([x, np.ones(len(x))])
    ridge = np.array([1.0] * 5 + [1e-3])
    for _ in range(200):  # Newton's method, with the gradient as the only test
        p = 1 / (1 + np.exp(-design @ weights))
        gradient = design.T @ (p - y) + ridge * weights
        if np.abs(gradient).max() < 1e-10:
            break
        weights -= np.linalg.solve((design.T * (p * (1 - p))) @ design + np.diag(ridge), gradient)
    return [(i, 1 / (1 + math.exp(-(np.array([*features(text or ""), 1.0]) @ weights)))) for i, text in docs]


def test_scores_are_those_of_a_plain_version(toxic_tables):
    docs, labels, _ = toxic_tables
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = dict(plain_scores(rows, [tuple(r) for r in labels.collect()]))
    got = {r["doc_id"]: r["score"] for r in toxicity.score_documents(docs, labels).collect()}
    assert got.keys() == want.keys()
    assert all(math.isclose(got[i], want[i], rel_tol=1e-6, abs_tol=1e-9) for i in want)


def test_repeated_ids_do_not_grow_what_is_collected(spark, toxic_tables):
    docs, labels, _ = toxic_tables
    again = docs.unionByName(docs.filter("doc_id = 1").crossJoin(spark.range(300)).select("doc_id", "text"))
    rows = toxicity.training_rows(again, labels)
    assert rows.count() > 700
    scored = toxicity.score_documents(again, labels)
    assert scored.count() == again.count()
    assert len({r["score"] for r in scored.filter("doc_id = 1").collect()}) == 1


def labelled(words, n=600):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(n):
        toxic = i % 5 == 1 or i % 7 == 3
        text = [rng.choice(words) for _ in range(rng.randint(20, 120))]
        if toxic:
            for term in rng.sample(["zornwort", "qualmkopf", "wurstig"], 2):
                text.insert(rng.randrange(len(text)), term + rng.choice(["", ",", "!"]))
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def toxic_tables(spark, words):
    rows, labels = labelled(words)
    extra = [
        (9001, "you zornwrt and " + " ".join(words[:30]) + " qualmkopff wurtsig"),
        (9002, " ".join(words[:40]) + ' he said "zornwort" and left ' + " ".join(words[40:60])),
        (9003, None),
        (9004, ""),
        (9005, " ".join(words[:300])),
    ]
    docs = spark.createDataFrame(rows + extra, "doc_id long, text string")
    return docs, spark.createDataFrame(labels + [(3, None), (None, 1)], "doc_id long, toxic int"), dict(labels)


def test_held_out_documents_are_told_apart(toxic_tables):
    docs, labels, known = toxic_tables
    scored = toxicity.score_documents(docs, labels).withColumn("held_out", toxicity.is_held_out())
    rows = {r["doc_id"]: r for r in scored.collect()}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows.values())
    held = [i for i in known if rows[i]["held_out"]]
    assert 80 < len(held) < 160
    assert sum(rows[i]["predicted"] == known[i] for i in held) >= 0.98 * len(held)
    assert rows[9001]["predicted"] == 1  # misspelled
    assert rows[9002]["predicted"] == 0 and rows[9002]["quoted"] > 0
    assert rows[9003]["predicted"] == rows[9004]["predicted"] == rows[9005]["predicted"] == 0


def test_held_out_labels_are_never_learnt_from(toxic_tables):
    docs, labels, _ = toxic_tables
    turned = labels.withColumn("toxic", F.when(toxicity.is_held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    scores = [
        sorted((r["doc_id"], r["score"]) for r in toxicity.score_documents(docs, table).collect())
        for table in (labels, turned)
    ]
    assert scores[0] == scores[1]


def test_toxicity_of_edge_documents(spark, edge_docs, no_docs, toxic_tables):
    _, labels, _ = toxic_tables
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.score_documents(edge_docs, none).collect()} == {0.0}
    assert toxicity.score_documents(edge_docs, labels).count() == edge_docs.count()
    assert toxicity.score_documents(no_docs, labels).count() == 0


# --- licenses ----------------------------------------------------------------


def test_licenses_are_inherited_from_the_nearest_directory(spark):
    mit, apache = "Released under the MIT License.", "# Licensed under the Apache License, Version 2.0."
    rows = [
        (1, "a/LICENSE", mit),
        (2, "a/b/c/x.py", "no word of it"),
        (3, "a/b/COPYING.txt", "Intro.\n" + apache + "\nmore"),
        (4, "a/y.py", None),
        (5, "a/b/z.py", "text\n// " + mit + "\n"),
        (6, "q/w.py", "nothing"),
        (7, "LICENSE.md", "This work is licensed under the GNU General Public License, version 3."),
        (8, None, ""),
        (9, "a/bb/LICENSE", "a license, in a way"),
        (10, "a/bb/k.py", "x"),
        (11, "q/LICENSES/file", "an unrelated licensed driver"),
    ]
    files = spark.createDataFrame(rows, "file long, path string, text string").withColumn("license", F.lit("?"))
    got = {r["file"]: (r["license"], r["inherited_from"]) for r in licenses.scan_licenses(files).collect()}
    assert got == {
        1: ("MIT", None),
        2: ("Apache-2.0", "a/b"),
        3: ("Apache-2.0", None),
        4: ("MIT", "a"),
        5: ("MIT", None),
        6: ("GPL-3.0", ""),
        7: ("GPL-3.0", None),
        8: (None, None),
        9: ("MIT", "a"),
        10: ("MIT", "a"),
        11: ("GPL-3.0", ""),
    }
    assert licenses.scan_licenses(files.limit(0)).count() == 0


def licenses_of(spark, texts, **options):
    frame = spark.createDataFrame(list(enumerate(texts)), "file long, text string")
    return {r["file"]: r["license"] for r in licenses.own_licenses(frame, **options).collect()}


MIT_TEXT = """MIT License

Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND.
"""
FOUND = {
    "SPDX-License-Identifier: MIT": "MIT",
    "// SPDX-License-Identifier: Apache-2.0": "Apache-2.0",
    "# SPDX-License-Identifier: GPL-2.0-or-later": "GPL-2.0",
    "Released under MIT": "MIT",
    "This is free and unencumbered software released into the public domain.": "Unlicense",
    "a text.\nDistributed under the GPL v3\nmore": "GPL-3.0",
    "CC BY 4.0": "CC-BY-4.0",
    MIT_TEXT: "MIT",
    "prose before it. " + MIT_TEXT.replace("\n", "\n * "): "MIT",
    # By a GPL header as it is usually wrapped, in a comment.
    "# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General"
    " Public License as published by\n# the Free Software Foundation, either version 3 of the License, or\n# (at your"
    " option) any later version.": "GPL-3.0",
    "SPDX-License-Identifier: Foo-1.0": None,
    "Nothing of it.": None,
    "an unrelated licensed driver": None,
    "": None,
}


@pytest.fixture(scope="module")
def prose(small_docs):
    """Texts that say nothing of a license."""
    texts = small_docs.filter("length(text) < 5000 AND NOT text ILIKE '%licen%' AND NOT text ILIKE '%reserved%'").collect()
    return [r["text"] for r in texts[:150]]


def test_headers_and_whole_licenses_are_found(spark, prose):
    got = licenses_of(spark, [*FOUND, *prose])
    assert [got[i] for i in range(len(FOUND))] == list(FOUND.values())
    clauses = "Redistributions in binary form must reproduce the above copyright notice, this list of conditions"
    assert licenses_of(spark, [clauses, *prose])[0].startswith("BSD")


def test_every_wording_is_its_own_license(spark, prose):
    given = [(name, text) for name, texts in licenses.TEMPLATES.items() for text in texts]
    got = licenses_of(spark, [f"{prose[i % len(prose)]}\n\n * {text}\n\n{prose[-i % len(prose)]}" for i, (_, text) in enumerate(given)])
    assert [got[i] for i in range(len(given))] == [name for name, _ in given]


def slow_licenses(texts, least):
    """Every unit against every template sentence, without anchors."""
    given = licenses.template_units(licenses.TEMPLATES)
    df = Counter(t for text in texts for t in set(licenses.terms_of((text or "").lower())))
    n = len(texts)

    def vector(counts):
        known = {t for _, _, c in given for t in c}
        v = {t: k * (math.log((1 + n) / (1 + (df[t] if t in known else 0))) + 1) for t, k in counts.items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / norm for t, x in v.items()}

    wanted = [vector(c) for _, _, c in given]
    result = []
    for text in texts:
        found = {}
        for unit in licenses.units((text or "").lower()):
            terms = Counter(licenses.terms_of(unit))
            if not terms:
                continue
            own = vector(terms)
            for i, w in enumerate(wanted):
                cosine = round(sum(x * own.get(t, 0.0) for t, x in w.items()), 6)
                short = sum(given[i][2].values()) < licenses.SHORT_TERMS
                if cosine >= (max(least, licenses.LEAST_SHORT_COSINE) if short else least):
                    found[i] = max(cosine, found.get(i, 0.0))
        result.append(found)
    return result


@pytest.mark.parametrize("least", [0.4, 0.6])
def test_anchors_lose_nothing(small_docs, least):
    """All cosines of all units, with common words shared on purpose, by plain counts."""
    rng = random.Random(8)
    pool = [t for _, _, c in licenses.template_units(licenses.TEMPLATES) for t in c]
    texts = [r["text"] for r in small_docs.limit(60).collect()] + list(FOUND)
    for _ in range(150):
        _, _, counts = rng.choice(licenses.template_units(licenses.TEMPLATES))
        words = [w for w in counts.elements() if rng.random() < 0.8] + rng.choices(pool, k=rng.randint(0, 6))
        rng.shuffle(words)
        texts.append("prose. " + " ".join(words) + ".")
    texts.append(None)
    vocabulary = frozenset(pool)
    frame = small_docs.sparkSession.createDataFrame([(t,) for t in texts], "text string")
    n, frequencies = licenses.document_frequencies(frame, vocabulary)
    assert n == len(texts)
    matcher = licenses.LicenseMatcher(licenses.TEMPLATES, n, frequencies, least)
    assert [matcher.near(t or "") for t in texts] == slow_licenses(texts, least)


def test_licenses_of_edge_documents(spark, edge_docs, no_docs):
    """Null and repeated ids and paths: each row for itself, none lost."""
    found = licenses.scan_licenses(edge_docs.withColumns({"file": F.col("doc_id"), "path": F.lit(None).cast("string")}))
    assert found.count() == edge_docs.count() and found.filter("license IS NOT NULL").count() == 0
    none = no_docs.withColumns({"file": F.col("doc_id"), "path": F.lit("a/b")})
    assert licenses.scan_licenses(none).count() == 0
    rows = [
        (None, "x/LICENSE", "Released under the MIT License"),
        (1, "y/LICENSE", "Released under the MIT License"),
        (1, "z/a", "nothing"),
        (2, "z/b", "Released under the MIT License"),
        (2, "z/b", "Licensed under the Apache License, Version 2.0"),
        (None, None, "Released under the MIT License"),
        (3, None, None),
    ]
    frame = spark.createDataFrame(rows, "file long, path string, text string")
    got = sorted(map(str, licenses.scan_licenses(frame).select("file", "path", "license").collect()))
    wanted = ["MIT", "MIT", None, "MIT", "Apache-2.0", "MIT", None]
    expected = spark.createDataFrame([(f, p, w) for (f, p, _), w in zip(rows, wanted)], "file long, path string, license string")
    assert got == sorted(map(str, expected.collect()))


def test_planted_headers_are_found(spark, prose):
    """One in three texts gets a header somewhere; prose around it, line ends and case differ."""
    rng = random.Random(4)
    given = [(name, text) for name, texts in licenses.TEMPLATES.items() for text in texts]
    rows, wanted = [], {}
    for i, text in enumerate(prose):
        if i % 3 == 0:
            name, header = rng.choice(given)
            lines = text.split("\n")
            header = rng.choice([header, header.upper(), f"# {header}", f"/* {header} */"])
            lines.insert(rng.randint(0, len(lines)), header)
            text, wanted[i] = "\n".join(lines), name
        rows.append((i, text))
    got = {r["file"]: r["license"] for r in licenses.own_licenses(spark.createDataFrame(rows, "file long, text string")).collect()}
    right = sum(got[i] == name for i, name in wanted.items())
    assert right >= 0.95 * len(wanted)
    assert all(got[i] is None for i in range(len(prose)) if i not in wanted)
