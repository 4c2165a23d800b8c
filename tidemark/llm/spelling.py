"""Spelling variants of words, by sorting all rotations of terminator-marked words.

The rotations of ``word$`` that end in an edited character differ from those of the
word without it, or with another there, in that last character only: skipping it,
near words are one range of the sorted rotations. A range holds a word for each
character of the alphabet at most, and one without any. Each pair of near words
meets in one range only, so counts and best neighbours are sums over ranges.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import bytes_of, prepare
from tidemark.operators.joins import left_lookup
from tidemark.session import stored

# Fixed value: runs of letters, after A-Z have been lowered.
RUN = re.compile("[a-zÀ-ÿ]+")
END = "$"
LEAST_LENGTH, LEAST_COUNT = 5, 3
# A word stands for another one if it occurs so many times as often.
LEAST_RATIO = 2
WORDS_AT_ONCE = 400_000


def slipped(run: str, start: int, slips: int) -> str:
    """The run, in one of ``slips`` cases without a character, both chosen by a checksum.

    ``start`` is the checksum of what stands before the run.
    """
    h = zlib.crc32(run.encode(), start)
    if h % slips:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def count_words(
    docs: DataFrame, slips: int | None = None, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT
) -> DataFrame:
    """``word, n``: words of at least ``least_length`` characters and ``least_count`` occurrences.

    Null texts have no words; a null id counts as empty in the checksums of
    ``slips``. Tasks count their texts before the exchange.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            columns = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
            counts.clear()
            return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for doc_id, text in zip(ids, bytes_of(batch.column("text"))):
                found = Counter(RUN.findall(text.lower().decode()))  # of bytes: lowers A-Z only
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in found.items():
                    if len(word) >= least_length:
                        counts[word if slips is None else slipped(word, start, slips)] += n
                if len(counts) > WORDS_AT_ONCE:
                    yield flush()
        if counts:
            yield flush()

    partial = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    counted = partial.groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter((F.length("word") >= least_length) & (F.col("n") >= least_count))


def rotations(words: DataFrame) -> DataFrame:
    """``skipped, last, opens, n``: all rotations of each word, whole and less their last character.

    ``skipped`` is the rotation without ``last``, which is empty for whole ones.
    ``opens`` tells the first of equal characters in a row: dropping any of them
    gives the same word, so that only this one stands for it.
    """
    word, size = F.col("word"), F.length("word")

    def rotation(i: Column, skip: int) -> Column:
        return F.concat(F.substring(word, i + 1 + skip, size), F.lit(END), F.substring(word, F.lit(1), i))

    def whole(i: Column) -> Column:
        return F.struct(rotation(i, 0).alias("skipped"), F.lit("").alias("last"), F.lit(False).alias("opens"))

    def less_one(i: Column) -> Column:
        last = F.substring(word, i + 1, F.lit(1))
        opens = (i == 0) | (F.substring(word, F.greatest(i, F.lit(1)), F.lit(1)) != last)
        return F.struct(rotation(i, 1).alias("skipped"), last.alias("last"), opens.alias("opens"))

    every = F.concat(
        F.transform(F.sequence(F.lit(0), size), whole), F.transform(F.sequence(F.lit(0), size - 1), less_one)
    )
    return words.select("n", F.inline(every))


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, best``: words that have near words, how many, and the most frequent.

    ``words`` has ``word`` (unique, not empty, without the terminator) and ``n``.
    ``best`` is a struct of ``minus_n`` and ``word``, the smallest in that order.
    """
    ranges = Window.partitionBy("skipped")
    shared = rotations(words).withColumn("_size", F.count(F.lit(1)).over(ranges)).filter("_size > 1")
    member = F.struct("n", "last", "opens")
    groups = shared.groupBy("skipped").agg(F.collect_list(member).alias("members"))
    behind, before = F.substring_index("skipped", END, 1), F.substring_index("skipped", END, -1)

    def spelled(m: Column) -> Column:
        return F.concat(before, m["last"], behind)

    def near(x: Column, m: Column) -> Column:
        whole_x, whole_m = x["last"] == "", m["last"] == ""
        replaced = ~whole_x & ~whole_m & (x["last"] != m["last"])
        return replaced | (whole_x & ~whole_m & m["opens"]) | (whole_m & ~whole_x & x["opens"])

    def scanned(m: Column) -> Column:
        others = F.filter("members", lambda x: near(x, m))
        ordered = F.transform(others, lambda x: F.struct((-x["n"]).alias("minus_n"), spelled(x).alias("word")))
        return F.struct(
            spelled(m).alias("word"), F.size(others).cast("long").alias("n_near"), F.array_min(ordered).alias("best")
        )

    found = groups.select(F.inline(F.transform("members", scanned))).filter("n_near > 0")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def follow(forms: DataFrame) -> DataFrame:
    """``word, root``: the end of the chain of forms of each word that has a ``form``.

    Frequencies grow by ``LEAST_RATIO`` at each form, so chains are short and free
    of circles; each round doubles how far they are followed.
    """
    roots = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("_further"))
        if roots.join(further, "root", "left_semi").isEmpty():
            return roots
        ahead = left_lookup(roots, further, ["root"])
        roots = stored(ahead.select("word", F.coalesce("_further", "root").alias("root")), "roots")


def spelling_variants(words: DataFrame, least_ratio: int = LEAST_RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of ``words`` (``word, n``).

    A word's form is its most frequent near word (the smallest in code-point order
    among equals) if that occurs ``least_ratio`` times as often at least. An empty
    table gives no rows.
    """
    words = stored(words, "words")
    judged = words.join(near_words(words), "word", "left")
    best_n = -F.col("best.minus_n")
    has_form = best_n >= least_ratio * F.col("n")
    judged = stored(
        judged.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(has_form, F.col("best.word")).alias("form"),
            F.when(has_form, best_n).alias("form_n"),
        ),
        "forms",
    )
    roots = follow(judged.filter(F.col("form").isNotNull()))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def document_variants(docs: DataFrame, slips: int | None = None) -> DataFrame:
    """The variants among the words of all documents; ``slips`` plants misspellings.

    Repeated and null ids, other columns: texts are counted each for itself, and
    nothing but ``doc_id`` and ``text`` is used. Only counts leave the texts.
    """
    prepare(docs.sparkSession)
    return spelling_variants(count_words(docs, slips))
