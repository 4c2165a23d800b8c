"""Language identification by multinomial naive Bayes over hashed character n-grams.

Tasks add up the hashed n-grams of their texts by language before the exchange.
The log probabilities are one matrix of features by languages, of bounded size,
that is sent to all tasks; a batch of texts is a sparse matrix of features (row
starts and column numbers), whose product with it gives the batch's scores.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import map_batches, prepare, texts_of
from tidemark.llm.toxicity import is_held_out
from tidemark.session import stored

ORDERS = (1, 2, 3)
FEATURE_BITS = 16
# Features times languages: 64 MB. With more languages there are fewer features.
MOST_ENTRIES = 1 << 24
SMOOTHING = 0.1
UNDETERMINED = "und"
CHARS_AT_ONCE = 1 << 19
# Languages that a task counts side by side, half a MB each.
LANGUAGES_AT_ONCE = 128

AHEAD = max(ORDERS) - 1
has_letter = regex.compile(r"\p{L}").search


def blocks(texts: Iterable[str], size: int = CHARS_AT_ONCE) -> Iterator[tuple[list[int], list[str]]]:
    """Lower-case texts in blocks of about ``size`` characters, with each part's number.

    A part is followed by the characters (blanks behind a text) that its last
    n-grams reach. Long texts are cut at multiples of ``size``.
    """
    numbers, parts, held = [], [], 0
    for number, text in enumerate(texts):
        lower = text.lower()
        end, padded = len(lower), lower + " " * AHEAD
        for at in range(0, end, size):
            part = padded[at : min(at + size, end) + AHEAD]
            if held + len(part) > size and parts:
                yield numbers, parts
                numbers, parts, held = [], [], 0
            numbers.append(number)
            parts.append(part)
            held += len(part)
    if parts:
        yield numbers, parts


def feature_rows(parts: list[str], bits: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The hashed n-grams that begin at each character, by order; where parts begin and end."""
    codes = np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    begins = np.cumsum(sizes) - sizes
    n = len(codes) - AHEAD
    found = []
    for order in ORDERS:
        keys = codes[:n].copy()
        for i in range(1, order):
            keys *= np.uint32(0x01000193)
            keys += codes[i : n + i]
        keys += np.uint32(order << 27)
        keys ^= keys >> np.uint32(15)
        keys *= np.uint32(0x2C1B3C6D)
        keys ^= keys >> np.uint32(12)
        keys *= np.uint32(0x297A2D39)
        keys >>= np.uint32(32 - bits)
        found.append(keys)
    return found, begins, begins + sizes - AHEAD


def count_features(docs: DataFrame, bits: int = FEATURE_BITS) -> DataFrame:
    """``lang, feature, n``: how often each feature occurs in each language.

    Feature -1 counts the documents. Rows without text or language are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}  # the documents are counted at the end

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, counts in totals.items():
                some = np.flatnonzero(counts)
                numbers = np.where(some == 1 << bits, -1, some)
                columns = [pa.array([lang] * len(some), pa.string()), pa.array(numbers), pa.array(counts[some])]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "feature", "n"])
            totals.clear()

        for batch in batches:
            by_lang: dict[str, list[str]] = {}
            for text, lang in zip(texts_of(batch.column("text")), batch.column("lang").to_pylist()):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                if len(totals) >= LANGUAGES_AT_ONCE and lang not in totals:
                    yield from flush()
                counts = totals.setdefault(lang, np.zeros((1 << bits) + 1, np.int64))
                counts[-1] += len(texts)
                for _, parts in blocks(texts):
                    found, begins, ends = feature_rows(parts, bits)
                    own = np.zeros(len(found[0]) + 1, np.int8)
                    own[begins] += 1
                    own[ends] -= 1
                    own = np.cumsum(own[:-1], dtype=np.int8).astype(bool)
                    for keys in found:
                        counts[:-1] += np.bincount(keys[own], minlength=1 << bits)
        yield from flush()

    labelled = docs.select("text", "lang").filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    partial = labelled.mapInArrow(run, "lang string, feature long, n long")
    return partial.groupBy("lang", "feature").agg(F.sum("n").alias("n"))


class LanguageModel:
    """Languages in order, the matrix of log probabilities, and the log shares of documents."""

    def __init__(self, languages: list[str], bits: int, logs: np.ndarray, prior: np.ndarray):
        self.languages, self.bits, self.logs, self.prior = languages, bits, logs, prior

    def posterior(self, texts: list[str]) -> np.ndarray:
        """Probability of each language for each text.

        Every character is in as many n-grams as there are orders, so their mean
        log probability counts as one character's.
        """
        sums = np.zeros((len(texts), len(self.languages)))
        for numbers, parts in blocks(texts, max(1024, CHARS_AT_ONCE * 4 // max(4, len(self.languages)))):
            found, begins, ends = feature_rows(parts, self.bits)
            rows = np.column_stack([begins, ends]).ravel()[:-1]
            for keys in found:
                scores = np.add.reduceat(self.logs[keys], rows, axis=0, dtype=np.float64)[::2]
                np.add.at(sums, numbers, scores)
        sums = sums / len(ORDERS) + self.prior
        odds = np.exp(sums - sums.max(axis=1, keepdims=True))
        return odds / odds.sum(axis=1, keepdims=True)


def learn_languages(docs: DataFrame, bits: int = FEATURE_BITS, most_entries: int = MOST_ENTRIES) -> LanguageModel:
    """The model of all rows of ``docs`` that have a text and a language.

    The matrix has 2^bits rows, or as many fewer as keep it below
    ``most_entries``, which is all that the driver gets.
    """
    counts = stored(count_features(docs, bits), "language-features")
    n = counts.filter("feature = -1").count()
    folded = max(0, min(bits, (most_entries // max(1, n)).bit_length() - 1))
    feature = F.when(F.col("feature") >= 0, F.shiftright("feature", bits - folded)).otherwise(F.col("feature"))
    table = counts.groupBy("lang", feature.alias("feature")).agg(F.sum("n").alias("n")).toArrow()
    found, numbers, times = (table.column(c).to_numpy() for c in ("lang", "feature", "n"))
    languages = sorted(set(found.tolist()))
    column = {lang: i for i, lang in enumerate(languages)}
    at = np.fromiter(map(column.__getitem__, found.tolist()), np.int64, len(found))
    seen, documents = np.zeros((1 << folded, n)), np.zeros(n)
    whole = numbers < 0
    documents[at[whole]] = times[whole]
    seen[numbers[~whole], at[~whole]] = times[~whole]
    logs = np.log(seen + SMOOTHING) - np.log(seen.sum(axis=0) + SMOOTHING * len(seen))
    return LanguageModel(languages, folded, logs.astype(np.float32), np.log(documents / max(1.0, documents.sum())))


def identify(docs: DataFrame, model: LanguageModel, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns, ``lang_pred`` and ``score`` of every whole text.

    ``und`` with score 0 stands for texts that are null or have no letter, and for
    all texts if nothing was learnt. Among equal scores the first language in
    order wins.
    """
    shared = prepare(docs.sparkSession).sparkContext.broadcast(model)

    def kernel(batch: pa.RecordBatch) -> dict:
        texts, known = texts_of(batch.column("text")), shared.value
        named, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        lettered = [i for i, t in enumerate(texts) if has_letter(t)] if known.languages else []
        if lettered:
            odds = known.posterior([texts[i] for i in lettered])
            for i, best, score in zip(lettered, odds.argmax(axis=1).tolist(), odds.max(axis=1).tolist()):
                named[i], scores[i] = known.languages[best], score
        return {"lang_pred": named, "score": scores}

    return map_batches(docs.select(*keep, "text"), kernel, "lang_pred string, score double", keep=keep)


def identify_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row of ``docs``.

    Learns from ``text`` and ``lang`` of the rows where crc32(doc_id as text) mod 5
    is not 0; of every row only the text enters its prediction. Null ids are
    neither held out nor learnt from. Equal texts have equal results, whatever
    their row; an empty table gives no rows; other columns are not used. Two
    passes over the texts, which are not exchanged.
    """
    prepare(docs.sparkSession)
    model = learn_languages(docs.filter(~is_held_out()))
    found = identify(docs, model)
    return found.withColumn("held_out", F.coalesce(is_held_out(), F.lit(False))).select(
        "doc_id", "held_out", "lang_pred", "score"
    )
