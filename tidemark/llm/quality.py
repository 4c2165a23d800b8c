"""Quality rules: counts of words, symbols and repeats, and a language model's bands.

The language model is an interpolated modified Kneser-Ney model over the bytes
of the texts, one for each language. Spark counts the n-grams of all documents;
an n-gram of up to seven bytes is its own exact 64-bit key. The probabilities of
all n-grams that occur are kept in arrays sorted by key. A document's perplexity
is compared with the band of its language; so is, on request, that by pairs of
words (``word_model``), which tells word order and wrong words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import bytes_of, checked_lookup, map_batches, prepare, worker_tables
from tidemark.llm.word_model import score_words
from tidemark.operators.joins import left_lookup
from tidemark.session import stored

# Fixed values of the rules.
SYMBOLS = b"#*$%&|<>"
WINDOW_WORDS = 5
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20

RULES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RULE_SCHEMA = ", ".join(f"{n} long" for n in RULES)

ORDER = 5
# A band reaches so many times as far from the median as the score that this share
# of all scores of the language lies beyond, on either side; for a bell curve that
# is 3.1 standard deviations.
TAIL_SHARE, REACH = 0.15, 3.0
LEAST_DISTANCE = 0.01
# Scores of pairs of words have longer tails, as there are far fewer words than bytes.
WORD_REACH = 4.0
# Keys that a task holds at a time, besides those that it has combined.
KEYS_AT_ONCE = 1 << 19
# Model entries sent to all executors, 12 bytes each; a larger model is joined.
BROADCAST_ENTRIES = 4_000_000


# --- rules -----------------------------------------------------------------


def repeated_words(words: list[bytes], size: int = WINDOW_WORDS) -> int:
    """Words inside windows of ``size`` words that occur twice or more in the text.

    Words are numbered, then windows by the numbers of a shorter window and the
    next word, so windows are compared exactly in a few arrays.
    """
    if len(words) <= size:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    windows = ids
    for i in range(1, size):
        _, windows = np.unique(windows[:-1] * len(numbers) + ids[i:], return_inverse=True)
    repeated = np.flatnonzero(np.bincount(windows)[windows] > 1)
    covered = np.zeros(len(words) + 1, np.int64)
    np.add.at(covered, repeated, 1)
    np.add.at(covered, repeated + size, -1)
    return int((np.cumsum(covered[:-1]) > 0).sum())


def rule_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols, repeated lines and repeated words."""
    words = text.split()
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return (
        len(words),
        len(b"".join(words).decode("utf-8", "replace")),
        symbols,
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )


# --- model -----------------------------------------------------------------


def ngram_keys(text: bytes, order: int = ORDER) -> np.ndarray:
    """Keys of a text's n-grams, byte after byte; ``order - 1`` zero bytes stand before it."""
    padded = np.frombuffer(bytes(order - 1) + text, np.uint8)
    keys = np.zeros(len(text), np.uint64)
    for i in range(order):
        keys = (keys << np.uint64(8)) | padded[i : i + len(text)]
    return keys


def key_blocks(texts: Iterable[bytes], order: int) -> Iterator[list[tuple[int, np.ndarray]]]:
    """The keys of texts in blocks of up to ``KEYS_AT_ONCE``, with each text's number.

    A longer text is cut; the parts overlap, so that its n-grams are all there once.
    """
    block: list[tuple[int, np.ndarray]] = []
    held = 0
    for number, text in enumerate(texts):
        for at in range(0, len(text), KEYS_AT_ONCE):
            lead = min(at, order - 1)
            keys = ngram_keys(text[at - lead : at + KEYS_AT_ONCE], order)[lead:]
            if held + len(keys) > KEYS_AT_ONCE and block:
                yield block
                block, held = [], 0
            block.append((number, keys))
            held += len(keys)
    if block:
        yield block


def count_ngrams(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """``lang, key, n``: how often each n-gram of bytes occurs in each language.

    Tasks combine their texts before the exchange. Null languages are one
    language of their own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        worker_tables(__name__)

        def combine(lang, found):
            keys, n = np.unique(found, return_counts=True)
            if lang in totals:
                old, old_n = totals[lang]
                merged, place = np.unique(np.concatenate([old, keys]), return_inverse=True)
                n = np.bincount(place, np.concatenate([old_n, n])).astype(np.int64)
                keys = merged
            totals[lang] = keys, n

        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for block in key_blocks(bytes_of(batch.column("text")), order):
                by_lang: dict[str, list[np.ndarray]] = {}
                for number, keys in block:
                    by_lang.setdefault(langs[number], []).append(keys)
                for lang, found in by_lang.items():
                    combine(lang, np.concatenate(found))
        for lang, (keys, n) in totals.items():
            for at in range(0, len(keys), 100_000):
                some = keys[at : at + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(some), pa.string()),
                        pa.array(some.view(np.int64)),
                        pa.array(n[at : at + 100_000].astype(np.int64)),
                    ],
                    names=["lang", "key", "n"],
                )

    partial = docs.select("lang", "text").mapInArrow(run, "lang string, key long, n long")
    return partial.groupBy("lang", "key").agg(F.sum("n").alias("n"))


def _discounted(counts: DataFrame) -> DataFrame:
    """Discounts of a level by language, from the numbers of n-grams seen 1 to 4 times."""
    seen = counts.groupBy("lang").agg(
        *[F.count_if(F.col("n") == i).cast("double").alias(f"n{i}") for i in (1, 2, 3, 4)]
    )
    y = F.coalesce(F.try_divide("n1", F.col("n1") + 2 * F.col("n2")), F.lit(0.5))

    def discount(i: int) -> Column:
        ratio = F.try_divide(F.col(f"n{i + 1}"), F.col(f"n{i}"))
        return F.greatest(F.lit(0.01), F.least(F.coalesce(i - (i + 1) * y * ratio, y), F.lit(i - 0.01)))

    return seen.select("lang", *[discount(i).alias(f"d{i}") for i in (1, 2, 3)])


def kneser_ney(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """``lang, key, p, logp``: probability of each n-gram's last byte, and its score.

    Orders below the highest count the different bytes seen before an n-gram.
    Contexts and suffixes are shifts and masks of the key, so each order is one
    aggregate of the order above. The lowest order interpolates with 1/256.

    ``logp`` is what a document is scored by: the natural log of ``p``, but that of
    the lower orders' share where an n-gram occurs once. That one is the
    document's own, and would vouch for any text, however odd.
    """
    levels = {order: counts}
    for k in range(order - 1, 0, -1):
        suffix = F.col("key").bitwiseAND(F.lit((1 << 8 * k) - 1)).alias("key")
        levels[k] = stored(
            levels[k + 1].select("lang", suffix).groupBy("lang", "key").agg(F.count(F.lit(1)).alias("n")),
            f"ngrams-{k}",
        )
    model = None
    for k in range(1, order + 1):
        level = checked_lookup(levels[k], _discounted(levels[k]), ["lang"], "inner")
        taken = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        level = level.select("lang", "key", "n", taken.alias("taken"), F.shiftright("key", 8).alias("context"))
        contexts = level.groupBy("lang", "context").agg(
            F.sum("n").alias("total"), F.sum("taken").alias("held")
        )
        level = left_lookup(level, contexts, ["lang", "context"], "inner")
        if model is None:
            level = level.withColumns({"lower": F.lit(1 / 256), "lower_score": F.lit(1 / 256)})
        else:
            suffix = F.col("key").bitwiseAND(F.lit((1 << 8 * (k - 1)) - 1))
            below = model.select(
                "lang", F.col("key").alias("suffix"), F.col("p").alias("lower"), F.col("score").alias("lower_score")
            )
            level = left_lookup(level.withColumn("suffix", suffix), below, ["lang", "suffix"], "inner")
        p = (F.col("n") - F.col("taken") + F.col("held") * F.col("lower")) / F.col("total")
        without = F.when(F.col("total") == 1, F.col("lower_score")).otherwise(
            F.col("held") * F.col("lower_score") / F.col("total")
        )
        score = F.when(F.col("n") == 1, without).otherwise(p)
        model = stored(level.select("lang", "key", p.alias("p"), score.alias("score")), f"model-{k}")
    return model.select("lang", "key", "p", F.log("score").cast("float").alias("logp"))


def sorted_arrays(model: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """The model as arrays sorted by key, for each language."""
    table = model.toArrow()
    langs, keys = table.column("lang").to_pandas(), table.column("key").to_numpy()
    logs, arrays = table.column("logp").to_numpy(), {}
    for lang in set(langs):
        own = (langs.isna() if lang is None else langs == lang).to_numpy()
        order = np.argsort(keys[own], kind="stable")
        arrays[lang] = keys[own][order], logs[own][order].astype(np.float32)
    return arrays


def rule_columns(batch: pa.RecordBatch) -> dict:
    rows = [rule_counts(t) for t in bytes_of(batch.column("text"))]
    return dict(zip(RULES, zip(*rows))) if rows else {n: [] for n in RULES}


def count_rules(docs: DataFrame) -> DataFrame:
    """``docs`` with the counts of the rules."""
    return map_batches(docs, rule_columns, RULE_SCHEMA, keep=tuple(docs.columns))


def score_by_arrays(docs: DataFrame, model: DataFrame, order: int = ORDER) -> DataFrame:
    """``docs`` without ``text``, with the counts of the rules and ``nll``: mean negative log probability of a byte.

    Both in one pass, so that a task has one Python worker.
    """
    shared = prepare(docs.sparkSession).sparkContext.broadcast(sorted_arrays(model))

    def kernel(batch: pa.RecordBatch) -> dict:
        texts, langs = bytes_of(batch.column("text")), batch.column("lang").to_pylist()
        sums = [0.0] * len(texts)
        for block in key_blocks(texts, order):
            for lang in {langs[number] for number, _ in block}:
                keys, logs = shared.value[lang]
                own = [(number, found) for number, found in block if langs[number] == lang]
                found = np.concatenate([f for _, f in own])
                values = logs[np.searchsorted(keys, found.view(np.int64))].astype(np.float64)
                starts = np.cumsum([0, *(len(f) for _, f in own)])[:-1]
                for (number, _), total in zip(own, np.add.reduceat(values, starts).tolist()):
                    sums[number] += total
        return {**rule_columns(batch), "nll": [-s / len(t) if t else None for s, t in zip(sums, texts)]}

    keep = tuple(c for c in docs.columns if c != "text")
    return map_batches(docs, kernel, f"{RULE_SCHEMA}, nll double", keep=keep)


def score_by_join(docs: DataFrame, model: DataFrame, order: int = ORDER) -> DataFrame:
    """``docs`` without ``text`` and with ``nll``, by a model of any size: n-grams meet it in a join.

    ``docs`` needs a column ``row`` that tells its rows apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c) for c in ("row", "lang")]
            for i, text in enumerate(bytes_of(batch.column("text"))):
                for block in key_blocks([text], order):
                    keys, n = np.unique(block[0][1], return_counts=True)
                    at = pa.array(np.full(len(keys), i))
                    arrays = [*(c.take(at) for c in columns), pa.array(keys.view(np.int64)), pa.array(n)]
                    yield pa.RecordBatch.from_arrays(arrays, names=["row", "lang", "key", "n"])

    grams = docs.select("row", "lang", "text").mapInArrow(run, "row long, lang string, key long, n long")
    scored = left_lookup(grams, model, ["lang", "key"], "inner")
    sums = scored.groupBy("row").agg(
        (-F.sum(F.col("n") * F.col("logp").cast("double")) / F.sum("n")).alias("nll")
    )
    return docs.drop("text").join(sums, "row", "left")


def bands(scored: DataFrame, nll: str = "nll", size: str = "n_bytes") -> DataFrame:
    """``lang, middle, low, high, low_of_one, high_of_one``: what a language's band is made of.

    ``middle`` is the median log perplexity. ``low`` and ``high`` are the distances
    from it that ``TAIL_SHARE`` of the scores lie beyond. The ones ``of_one`` are
    those of a text of size one, as means over n bytes (words) vary by its n-th root
    more. All over the documents that pass the rules; a language without any has no band.
    """
    good = scored.filter(~F.col("base_failed") & F.col(nll).isNotNull())
    middle = good.groupBy("lang").agg(F.percentile_approx(nll, 0.5, 10_000).alias("middle"))
    off = F.col(nll) - F.col("middle")
    around = checked_lookup(good, middle, ["lang"], "inner")

    def beyond(distance: Column) -> Column:
        return F.percentile_approx(distance, 1 - TAIL_SHARE, 10_000)

    return around.groupBy("lang", "middle").agg(
        beyond(-off).alias("low"),
        beyond(off).alias("high"),
        beyond(-off * F.sqrt(size)).alias("low_of_one"),
        beyond(off * F.sqrt(size)).alias("high_of_one"),
    )


def outside_band(nll: str = "nll", size: str = "n_bytes", reach: float = REACH) -> Column:
    """Below or above the band of the language, which is wider for short texts.

    Its width is that of the language or, if larger, that of the text's length; the
    first holds what length adds already, so they are not summed.
    """
    root = F.sqrt(F.greatest(size, F.lit(1)))

    def distance(side: str) -> Column:
        return reach * F.greatest(F.lit(LEAST_DISTANCE), F.col(side), F.col(f"{side}_of_one") / root)

    off = F.col(nll) - F.col("middle")
    return F.coalesce(~off.between(-distance("low"), distance("high")), F.lit(False))


BAND = ("middle", "low", "high", "low_of_one", "high_of_one")


def text_row() -> Column:
    """The same number for equal text and language: such rows have equal word scores."""
    return F.xxhash64("text", "lang", F.octet_length("text"), F.lit(1))


def quality(
    docs: DataFrame,
    order: int = ORDER,
    broadcast_entries: int = BROADCAST_ENTRIES,
    carry: Sequence[str] = ("doc_id",),
    words: bool = False,
) -> DataFrame:
    """The ``carry`` columns, counts, perplexity and verdict for every row of ``docs``.

    ``docs`` has ``text`` and ``lang``.

    Null texts count as empty: they have no words, fail the rules and have a null
    perplexity. Null languages are one language. Rows with equal or null
    ``doc_id`` are judged each for itself; other columns are not used. The model
    counts all documents, whatever the rules say of them. A model of bytes over
    ``broadcast_entries`` n-grams is joined instead of being sent to all
    executors, with the same result. ``words`` has the verdict look at pairs of
    words as well and adds their perplexity; its exchanges are several times the
    size of the texts.
    """
    prepare(docs.sparkSession)
    texts = docs.select(F.struct(*carry).alias("_carry"), "text", "lang")
    counts = stored(count_ngrams(texts, order), f"ngrams-{order}")
    model = stored(kneser_ney(counts, order).drop("p"), "model")
    sized = texts.withColumns({"n_bytes": F.octet_length(F.coalesce("text", F.lit(""))), "text_row": text_row()})
    if model.count() <= broadcast_entries:
        scored = score_by_arrays(sized, model, order)
    else:
        numbered = stored(count_rules(sized).withColumn("row", F.monotonically_increasing_id()), "numbered")
        scored = score_by_join(numbered, model, order).drop("row")
    scored = scored.withColumn("base_failed", base_failed())
    if words:
        by_pairs = stored(score_words(texts.withColumn("row", text_row())), "word-scores")
        scored = left_lookup(scored, by_pairs.withColumnRenamed("row", "text_row"), ["text_row"])
    scored = stored(scored, "scored")
    judged = checked_lookup(scored, bands(scored), ["lang"], "left")
    judged = judged.withColumn("_odd", outside_band()).drop(*BAND)
    if words:
        judged = checked_lookup(judged, bands(scored, "word_nll", "n_words"), ["lang"], "left")
        judged = judged.withColumn("_odd", F.col("_odd") | outside_band("word_nll", "n_words", WORD_REACH))
    return judged.select(
        *[F.col("_carry").getField(c).alias(c) for c in carry],
        *RULES,
        "base_failed",
        (~F.col("base_failed") & ~F.col("_odd")).alias("kept"),
        F.exp("nll").alias("perplexity"),
        *([F.exp("word_nll").alias("word_perplexity")] if words else []),
    )
