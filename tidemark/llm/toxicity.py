"""Toxicity scores from a learnt lexicon, matched with its misspellings in context.

Terms are words far more frequent in documents labelled toxic than in others.
They form a trie; a Levenshtein automaton, which follows all alignments of a word
with up to so many edits, runs through it, and the states of the two together
are made deterministic as words need them. A term found counts by its log odds,
less for each edit. Hits inside quotation marks are summed apart from the others,
and the largest sum in a window of words tells abuse from a passing mention.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import map_batches, prepare, texts_of
from tidemark.session import stored

# Labelled rows that are learnt from, at most; fixes the size of what is broadcast.
MOST_LABELLED = 200_000
LEAST_DOCUMENTS = 3
LEAST_SHARE = 0.005  # of the toxic documents; bounds the number of terms
LEAST_LIFT = 20.0
MOST_WEIGHT = 6.0
EDIT_FACTOR = 0.7  # weight left for each edit
WINDOW = 15  # words
STATES_KEPT = 50_000
WORDS_KEPT = 200_000

_WORD = re.compile(r"\S+")
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")


def normal_word(word: str) -> str:
    """Lower case, without the punctuation around it."""
    word = word.lower()
    return word if word.isalnum() else _EDGES.sub("", word)


# Marks that open a quotation, and those that end it; straight ones tell by what stands around them.
CLOSING = {"“": "”", "«": "»", "„": "“”"}
_MARK = re.compile('["“”«»„]')


def quotations(text: str) -> list[tuple[int, int]]:
    """Where quotations begin and end, of any length and over line breaks.

    A straight mark opens after white space or an opening bracket and before
    other text, and closes the other way round; in another place it closes what is
    open. A quotation that is opened again before its end has none: its first mark
    is passed over, so that a missing mark does not turn the rest inside out.
    """
    found = []
    begin, ends = 0, ""
    for m in _MARK.finditer(text):
        mark, at = m.group(), m.start()
        if mark == '"':
            after_gap = at == 0 or text[at - 1].isspace() or text[at - 1] in "([{"
            before_gap = at + 1 == len(text) or text[at + 1].isspace()
            opens, closes = after_gap and not before_gap, '"' in ends
        else:
            opens, closes = mark in CLOSING, mark in ends
        if closes and not (opens and mark == '"'):
            found.append((begin, at + 1))
            ends = ""
        elif opens:
            begin, ends = at, CLOSING.get(mark, '"')
    return found


def edits_allowed(term: str) -> int:
    """Short terms are near too many other words. Two neighbours changed round are one edit."""
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class TermMatcher:
    """The terms of a trie within their number of edits of a word."""

    def __init__(self, terms: Iterable[str]):
        self.children: list[dict[str, int]] = [{}]
        self.term_at: list[str | None] = [None]
        for term in sorted(set(terms)):
            node = 0
            for char in term:
                if char not in self.children[node]:
                    self.children[node][char] = len(self.children)
                    self.children.append({})
                    self.term_at.append(None)
                node = self.children[node][char]
            self.term_at[node] = term
        # Most edits that any term at or below a node allows; children come after parents.
        self.allowed = [edits_allowed(t) if t else 0 for t in self.term_at]
        for node in reversed(range(len(self.children))):
            for child in self.children[node].values():
                self.allowed[node] = max(self.allowed[node], self.allowed[child])
        self._restart()

    def _restart(self) -> None:
        # A state holds the fewest edits for each trie node, and for each node that is
        # reached if a certain character follows, the first of two changed round;
        # 0 is the start, -1 dead.
        self.numbers: dict[frozenset, int] = {}
        self.states: list[dict[int | tuple[int, str], int]] = []
        self.steps: list[dict[str, int]] = []
        self.found: list[tuple[str, int] | None] = []
        self._state(self._closed({0: 0}))

    def _closed(self, nodes: dict[int, int]) -> dict[int, int]:
        """With the nodes reached by leaving out characters of terms."""
        todo = [n for n in nodes if isinstance(n, int)]
        while todo:
            node = todo.pop()
            edits = nodes[node] + 1
            for child in self.children[node].values():
                if edits <= self.allowed[child] and edits < nodes.get(child, edits + 1):
                    nodes[child] = edits
                    todo.append(child)
        return nodes

    def _state(self, nodes: dict[int, int]) -> int:
        if not nodes:
            return -1
        key = frozenset(nodes.items())
        if key not in self.numbers:
            self.numbers[key] = len(self.states)
            self.states.append(nodes)
            self.steps.append({})
            plain = ((n, e) for n, e in nodes.items() if isinstance(n, int))
            ends = [(e, t) for n, e in plain if (t := self.term_at[n]) and e <= edits_allowed(t)]
            self.found.append(min(ends)[::-1] if ends else None)
        return self.numbers[key]

    def _step(self, state: int, char: str) -> int:
        following: dict[int | tuple[int, str], int] = {}

        def reach(node: int, edits: int, awaited: str | None = None) -> None:
            key = node if awaited is None else (node, awaited)
            if edits <= self.allowed[node] and edits < following.get(key, edits + 1):
                following[key] = edits

        for node, edits in self.states[state].items():
            if not isinstance(node, int):
                if node[1] == char:
                    reach(node[0], edits)
                continue
            reach(node, edits + 1)  # a character too many
            for other, child in self.children[node].items():
                reach(child, edits + (other != char))
                if other != char and char in self.children[child]:
                    reach(self.children[child][char], edits + 1, awaited=other)
        result = self.steps[state][char] = self._state(self._closed(following))
        return result

    def match(self, word: str) -> tuple[str, int] | None:
        """The nearest term and its edits, the first by name among the nearest."""
        if len(self.states) > STATES_KEPT:
            self._restart()
        state, steps = 0, self.steps
        for char in word:
            state = steps[state].get(char, -2)
            if state == -2:
                return self._match_new(word)
            if state == -1:
                return None
        return self.found[state]

    def _match_new(self, word: str) -> tuple[str, int] | None:
        state = 0
        for char in word:
            known = self.steps[state].get(char, -2)
            state = self._step(state, char) if known == -2 else known
            if state == -1:
                return None
        return self.found[state]


@dataclass
class Lexicon:
    """Weights of the terms, and of learnt words near them, which are no misspellings."""

    terms: dict[str, float]
    near: dict[str, float] = field(default_factory=dict)

    def matcher(self) -> WordWeights:
        return WordWeights(self)


class WordWeights(dict):
    """(term, weight) of a word of a text, None if it is none; found when first met."""

    def __init__(self, lexicon: Lexicon):
        super().__init__()
        self.lexicon, self.terms = lexicon, TermMatcher(lexicon.terms)

    def __missing__(self, word: str) -> tuple[str, float] | None:
        plain = normal_word(word)
        result = None
        if plain in self.lexicon.terms:
            result = plain, self.lexicon.terms[plain]
        elif plain in self.lexicon.near:
            weight = self.lexicon.near[plain]
            result = (plain, weight) if weight > 0 else None
        elif (found := self.terms.match(plain)) is not None:
            term, edits = found
            result = term, self.lexicon.terms[term] * EDIT_FACTOR**edits
        if len(self) >= WORDS_KEPT:
            self.clear()
        self[word] = result
        return result


FEATURES = ("abuse", "quoted", "window", "density", "terms")


def features(text: str, weights: WordWeights) -> tuple[float, ...]:
    """Sums of weights outside and inside quotation marks, and how close they stand.

    Each term counts once for a sum, by its best hit. ``window`` is the largest sum
    over ``WINDOW`` successive words outside quotation marks, ``density`` the sum
    for each hundred words, ``terms`` the number of terms; all as logarithms.
    """
    words = text.split()
    if not any(map(weights.__getitem__, dict.fromkeys(words))):
        return (0.0,) * len(FEATURES)
    inside = quotations(text)
    sums: tuple[dict, dict] = ({}, {})
    hits: list[tuple[int, float]] = []
    at = 0
    for place, m in enumerate(_WORD.finditer(text)):
        hit = weights[m.group()]
        if hit is None:
            continue
        while at < len(inside) and inside[at][1] <= m.start():
            at += 1
        quoted = at < len(inside) and inside[at][0] < m.end()
        own = sums[quoted]
        own[hit[0]] = max(own.get(hit[0], 0.0), hit[1])
        if not quoted:
            hits.append((place, hit[1]))
    best, total, start = 0.0, 0.0, 0
    for place, weight in hits:
        total += weight
        while hits[start][0] <= place - WINDOW:
            total -= hits[start][1]
            start += 1
        best = max(best, total)
    abuse, quote = (sum(s.values()) for s in sums)
    density = 100 * sum(w for _, w in hits) / max(len(words), 50)
    return tuple(math.log1p(max(0.0, x)) for x in (abuse, quote, best, density, len(sums[0])))


# --- learning --------------------------------------------------------------


def is_held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> DataFrame:
    """``doc_id, text, toxic`` of up to ``most`` labelled documents that are not held out.

    The labels are few enough to be sent to the texts, which stay where they are. A
    ``doc_id`` that is repeated there gives a row for each.
    """
    rows = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~is_held_out())
    chosen = rows.groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic")


def word_counts(rows: DataFrame) -> DataFrame:
    """``word, toxic_docs, other_docs``: documents that have the word, by label.

    Tasks count their documents' words before the exchange.
    """

    def run(batches):
        for batch in batches:
            counts: dict[str, list[int]] = {}
            for text, toxic in zip(texts_of(batch.column("text")), batch.column("toxic").to_pylist()):
                for word in set(map(normal_word, set(text.split()))):
                    counts.setdefault(word, [0, 0])[not toxic] += 1
            counts.pop("", None)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(counts), pa.string()),
                    pa.array([c[0] for c in counts.values()], pa.int64()),
                    pa.array([c[1] for c in counts.values()], pa.int64()),
                ],
                names=["word", "toxic_docs", "other_docs"],
            )

    partial = rows.mapInArrow(run, "word string, toxic_docs long, other_docs long")
    sums = [F.sum(c).alias(c) for c in ("toxic_docs", "other_docs")]
    return partial.groupBy("word").agg(*sums)


def learn_lexicon(rows: DataFrame) -> Lexicon:
    """Terms by their log odds, less one standard error.

    The odds must be high and, by the likelihood ratio of a word's documents,
    unlikely to be chance among so many words. A term is in ``LEAST_SHARE`` of the toxic documents at least, so the number of
    terms is bounded by the words of some hundreds of documents.
    """
    toxic, other = rows.agg(F.count_if("toxic"), F.count_if(~F.col("toxic"))).first()
    if not toxic:
        return Lexicon({})
    counts = stored(word_counts(rows), "words")
    words = counts.count()
    a, c = F.col("toxic_docs") + 0.5, F.col("other_docs") + 0.5
    odds = F.log(a / (toxic + 1)) - F.log(c / (other + 1))
    share = toxic / (toxic + other)
    seen = F.col("toxic_docs") + F.col("other_docs")

    def surprise(column: str, expected: float) -> Column:
        n = F.col(column)
        return F.when(n > 0, 2 * n * F.log(n / (seen * max(expected, 1e-9)))).otherwise(0.0)

    g = surprise("toxic_docs", share) + surprise("other_docs", 1 - share)
    low = odds - F.sqrt(1 / a + 1 / c)
    weighed = counts.select("word", "toxic_docs", low.alias("low"), odds.alias("odds"), g.alias("g"))
    least = max(LEAST_DOCUMENTS, math.ceil(LEAST_SHARE * toxic))
    found = weighed.filter(
        (F.col("toxic_docs") >= least)
        & (F.col("odds") >= math.log(LEAST_LIFT))
        & (F.col("g") >= 2 * math.log(words))  # about one word by chance
    )
    terms = {r["word"]: max(0.1, min(MOST_WEIGHT, r["low"])) for r in found.collect()}

    def near(batch: pa.RecordBatch) -> dict:
        matcher = TermMatcher(terms)
        return {"near": [w not in terms and matcher.match(w) is not None for w in batch.column("word").to_pylist()]}

    # Words met in training are judged by their own counts, however like a term.
    close = map_batches(weighed, near, "near boolean", keep=("word", "low")).filter("near")
    return Lexicon(terms, {r["word"]: max(0.0, min(MOST_WEIGHT, r["low"])) for r in close.collect()})


def document_features(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """The columns of ``docs`` but ``text``, and the features of every whole text."""
    shared = prepare(docs.sparkSession).sparkContext.broadcast(lexicon)
    made: list[WordWeights] = []

    def kernel(batch: pa.RecordBatch) -> dict:
        if not made:
            made.append(shared.value.matcher())
        rows = [features(t, made[0]) for t in texts_of(batch.column("text"))]
        return dict(zip(FEATURES, zip(*rows))) if rows else {f: [] for f in FEATURES}

    keep = tuple(c for c in docs.columns if c != "text")
    return map_batches(docs, kernel, ", ".join(f"{f} double" for f in FEATURES), keep=keep)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """Weights and, last, the intercept, by Newton's method with a ridge on the weights."""
    design = np.column_stack([x, np.ones(len(x))])
    penalty = np.diag([ridge] * x.shape[1] + [1e-3])
    w = np.zeros(design.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (p - y) + penalty @ w
        hessian = (design * (p * (1 - p))[:, None]).T @ design + penalty
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    most_labelled: int = MOST_LABELLED,
    carry: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """The ``carry`` columns, ``score``, ``predicted`` and the features of every row of ``docs``.

    Learns from ``labels`` (``doc_id, toxic``) where crc32(doc_id as text) mod 5 is
    not 0, ``most_labelled`` of them at most, chosen by a hash. Only texts enter a
    score. Null and empty texts get the score of a text without terms; without
    any toxic label every score is 0. Repeated labels of a document count once,
    as toxic if one is; repeated documents are scored each for itself; an empty
    table gives no rows. Two passes over the texts, no exchange of them.
    """
    prepare(docs.sparkSession)
    rows = training_rows(docs, labels, most_labelled)
    lexicon = learn_lexicon(rows)
    scored = document_features(docs.select(F.struct(*carry).alias("_carry"), "text"), lexicon)
    if not lexicon.terms:
        score: Column = F.lit(0.0)
    else:
        # One row for each labelled id, however often it is repeated: that bounds what is collected.
        every = document_features(rows, lexicon).groupBy("doc_id")
        learnt = every.agg(F.min(F.struct(*FEATURES, "toxic")).alias("r")).select("r.*").toArrow()
        x = np.column_stack([learnt.column(f).to_numpy() for f in FEATURES])
        y = learnt.column("toxic").to_numpy(zero_copy_only=False).astype(float)
        *weights, intercept = fit_logistic(x, y).tolist()
        total = F.lit(intercept)
        for name, weight in zip(FEATURES, weights):
            total = total + F.lit(weight) * F.col(name)
        score = 1 / (1 + F.exp(-total))
    scored = scored.withColumn("score", score)
    return scored.select(
        *[F.col("_carry").getField(c).alias(c) for c in carry],
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        *FEATURES,
    )
