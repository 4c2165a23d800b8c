"""License scans: sparse TF-IDF cosine to templates, then the nearest ancestor directory.

The lines and sentences of a text are compared with those of the templates as sparse
vectors of weighed terms. A file without a license of its own takes that of the
license file in the nearest directory above it, by joins on paths.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.license_texts import TEMPLATES
from tidemark.llm.shared import map_batches, prepare, texts_of
from tidemark.operators.joins import left_lookup
from tidemark.session import stored

LEAST_COSINE = 0.6
# A template sentence of fewer terms needs the larger cosine: one other term changes what it says.
SHORT_TERMS, LEAST_SHORT_COSINE = 7, 0.84
LICENSE_FILE = r"(?i)(^|/)(licen[cs]e|copying|unlicense|notice)([-._][^/]*)?$"
TERM = re.compile("[a-z]+|[0-9]+(?:[.][0-9]+)*")
# Marks of comments and lists in front of a line, and what ends one in a comment.
MARKS = re.compile(r"^[ \t\r#/*;%<!>|-]+|[ \t\r*/>-]+$", re.MULTILINE)
SENTENCE = re.compile(r"(?<=[.;!?])\s+")
# Of two wordings that differ in a word, the nearer one must win, even if it is the shorter.
SHARPNESS = 12

Vector = dict[str, float]


def units(text: str) -> Iterator[str]:
    """The lines of a text, and the sentences of its paragraphs, whose lines are joined."""
    plain = MARKS.sub("", text)
    seen = set()
    for paragraph in re.split(r"\n\s*\n", plain):
        lines = paragraph.split("\n")
        for unit in (*lines, *SENTENCE.split(" ".join(lines)), *(s for line in lines for s in SENTENCE.split(line))):
            if unit and unit not in seen:
                seen.add(unit)
                yield unit


def terms_of(text: str) -> list[str]:
    """Words and numbers of a lower-case text; version numbers stay whole."""
    return TERM.findall(text)


def template_units(templates: Mapping[str, Sequence[str]]) -> list[tuple[str, int, Counter]]:
    """(license, text, counts of terms) of each sentence of the templates, each text's own number with it."""
    return [
        (name, number, Counter(terms_of(sentence.lower())))
        for name, texts in templates.items()
        for number, text in enumerate(texts)
        for sentence in SENTENCE.split(" ".join(text.split()))
        if terms_of(sentence.lower())
    ]


def document_frequencies(files: DataFrame, vocabulary: frozenset[str]) -> tuple[int, dict[str, int]]:
    """The number of texts, and of those that hold each term of the templates; other terms are not counted."""
    shared = prepare(files.sparkSession).sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for text in texts_of(batch.column("text")):
                counts[""] += 1  # all texts
                counts.update(shared.value.intersection(terms_of(text.lower())))
        columns = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["term", "n"])

    partial = files.select("text").mapInArrow(run, "term string, n long")
    # A row for each term of the templates at most.
    found = {r["term"]: r["n"] for r in partial.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    return found.pop("", 0), found


class LicenseMatcher:
    """Finds the sentences of a text that are near one of the templates' sentences.

    A term weighs its count times its inverse document frequency. A term that no
    template has counts as if no text had it, the most that a term can weigh.

    Two vectors whose cosine is at least c share terms that hold at least c squared
    of the template's squared weight. So they share one of its heaviest terms, those
    without which less than that is left: texts and sentences without any of these
    anchors cannot be near and are passed over, which changes no result.
    """

    def __init__(
        self, templates: Mapping[str, Sequence[str]], n_texts: int, frequencies: Mapping[str, int], least: float
    ):
        self.rare = math.log(1 + n_texts) + 1
        given = template_units(templates)
        known = {t for _, _, counts in given for t in counts}
        self.idf = {t: math.log((1 + n_texts) / (1 + frequencies.get(t, 0))) + 1 for t in known}
        self.sizes = Counter((name, number) for name, number, _ in given)
        self.sentences: list[tuple[str, int, Vector, int, float]] = []
        self.by_anchor: dict[str, list[int]] = {}
        for i, (name, number, counts) in enumerate(given):
            vector, size = self.unit_vector(counts), sum(counts.values())
            needed = least if size >= SHORT_TERMS else max(least, LEAST_SHORT_COSINE)
            self.sentences.append((name, number, vector, size, needed))
            left = 1.0
            for term, weight in sorted(vector.items(), key=lambda x: (-x[1], x[0])):
                if left < needed * needed - 1e-6:
                    break
                self.by_anchor.setdefault(term, []).append(i)
                left -= weight * weight
        self.automaton = ahocorasick.Automaton()
        for term in self.by_anchor:
            self.automaton.add_word(term, term)
        self.automaton.make_automaton()

    def unit_vector(self, counts: Mapping[str, int]) -> Vector:
        weights = {t: n * self.idf.get(t, self.rare) for t, n in counts.items()}
        norm = math.sqrt(sum(w * w for w in weights.values()))
        return {t: w / norm for t, w in weights.items()}

    def has_anchor(self, lower: str) -> bool:
        return next(self.automaton.iter(lower), None) is not None

    def near(self, text: str) -> dict[int, float]:
        """The largest cosine of any sentence of the text with each template sentence that it reaches."""
        found: dict[int, float] = {}
        lower = text.lower()
        if not self.by_anchor or not self.has_anchor(lower):
            return found
        for unit in units(lower):
            if not self.has_anchor(unit):
                continue
            counts = Counter(terms_of(unit))
            possible = {i for t in counts for i in self.by_anchor.get(t, ())}
            if not possible:
                continue
            own = self.unit_vector(counts)
            for i in possible:
                cosine = round(sum(w * own.get(t, 0.0) for t, w in self.sentences[i][2].items()), 6)
                if cosine >= self.sentences[i][4]:
                    found[i] = max(cosine, found.get(i, 0.0))
        return found

    def best(self, text: str) -> tuple[str, float] | None:
        """The license of a text, and its largest cosine.

        A template text counts with the sum of its sentences' terms, each times a
        power of its cosine; of equal ones the text of which more was found, then the
        first name, wins.
        """
        found = self.near(text)
        if not found:
            return None
        totals: dict[tuple[str, int], list[tuple[float, float]]] = {}
        for i, cosine in found.items():
            name, number, _, size, _ = self.sentences[i]
            totals.setdefault((name, number), []).append((cosine, size * cosine**SHARPNESS))

        def order(key: tuple[str, int]):
            weighed = round(sum(w for _, w in totals[key]), 4)
            return -weighed, -len(totals[key]) / self.sizes[key], key

        name, _ = min(totals, key=order)
        return name, max(c for (n, _), found in totals.items() if n == name for c, _ in found)


def own_licenses(
    files: DataFrame,
    templates: Mapping[str, Sequence[str]] = TEMPLATES,
    least_cosine: float = LEAST_COSINE,
    carry: Sequence[str] = ("file",),
) -> DataFrame:
    """The ``carry`` columns, ``license`` and ``cosine`` of every row of ``files``.

    The license is that of the templates whose sentences are nearest to any of the
    whole text, null if none is at ``least_cosine`` or more (``LEAST_SHORT_COSINE``
    for short ones). Frequencies are those of all texts. Null and empty texts have no license; equal rows equal ones. Two
    passes over the texts, no exchange of them.
    """
    vocabulary = frozenset(t for _, _, counts in template_units(templates) for t in counts)
    n, frequencies = document_frequencies(files, vocabulary)
    matcher = templates, n, frequencies, least_cosine
    shared = files.sparkSession.sparkContext.broadcast(matcher)
    made: list[LicenseMatcher] = []

    def kernel(batch: pa.RecordBatch) -> dict:
        if not made:
            made.append(LicenseMatcher(*shared.value))
        best = [made[0].best(t) for t in texts_of(batch.column("text"))]
        return {"license": [b and b[0] for b in best], "cosine": [b and b[1] for b in best]}

    carried = files.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("_carry"), "text")
    found = map_batches(carried, kernel, "license string, cosine double", keep=("_carry",))
    return found.select(*[F.col("_carry").getField(c).alias(c) for c in carry], "license", "cosine")


def directory_of(path: Column | str) -> Column:
    """The directory of a path without a slash at its end; "" is the root."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def scan_licenses(
    files: DataFrame,
    templates: Mapping[str, Sequence[str]] = TEMPLATES,
    license_file: str = LICENSE_FILE,
    least_cosine: float = LEAST_COSINE,
) -> DataFrame:
    """``file, path, license, cosine, inherited_from`` for every row of ``files``.

    ``files`` has ``file``, ``path`` and ``text``. A license found in the text is the
    row's own, with its cosine. Other rows take the license of the nearest directory
    at or above theirs that has a license file (its path matches ``license_file``)
    with a license; the nearest cosine, then the first name, wins where a directory
    has several. Null texts have no license, null paths no directory; rows without
    any license have null. Rows with equal or null ``file`` or ``path`` are each
    scanned for themselves; other columns are not used; an empty table gives no
    rows. Only directories, one row each, are joined to their ancestors; texts are
    read twice and stay.
    """
    own = stored(own_licenses(files, templates, least_cosine, carry=("file", "path")), "licenses")
    marked = own.withColumn("_dir", directory_of("path"))
    holders = marked.filter(F.col("license").isNotNull() & F.col("path").rlike(license_file))
    given = holders.groupBy("_dir").agg(F.min(F.struct((-F.col("cosine")).alias("c"), "license")).alias("b"))
    given = given.select(F.col("_dir").alias("above"), F.col("b.license").alias("inherited"))

    directories = marked.filter(F.col("_dir").isNotNull()).select("_dir").distinct()
    parts = F.split("_dir", "/")
    depths = F.sequence(F.lit(0), F.size(parts))
    above = F.transform(depths, lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    chains = directories.select("_dir", F.posexplode(above).alias("depth", "above"))
    nearest = left_lookup(chains, given, ["above"], "inner").groupBy("_dir").agg(
        F.max(F.struct("depth", "above", "inherited")).alias("n")
    )
    nearest = nearest.select("_dir", F.col("n.above").alias("from"), F.col("n.inherited").alias("inherited"))
    joined = left_lookup(marked, nearest, ["_dir"])
    return joined.select(
        "file",
        "path",
        F.coalesce("license", "inherited").alias("license"),
        "cosine",
        F.when(F.col("license").isNull(), F.col("from")).alias("inherited_from"),
    )
