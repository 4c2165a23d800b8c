"""The corpus pipeline: quality, toxicity, near duplicates, repeated passages, packing.

``run`` applies the stages to ``documents``; each result is written as Parquet
and read again as the next stage's input. All stages but the last return the
columns of ``documents``. A stage removes what the one before it had stored for
itself, so that must have been written by then.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from pathlib import Path

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chunk_dedup, packing, quality, simhash, toxicity
from tidemark.llm.shared import free_name, numbered, prepare, without_rows
from tidemark.operators.joins import left_lookup
from tidemark.session import clear_scratch, scratch_scope, stored

SEQUENCE_TOKENS = 1024
END_ID = 2

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_stored_before: dict[str, str] = {}


def cleared(stage: Stage) -> Stage:
    """The stage, which stores its intermediate results in a folder of its own and clears the last stage's."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        prepare(spark)
        before = _stored_before.pop(spark.sparkContext.applicationId, None)
        if before:
            clear_scratch(spark, before)
        with scratch_scope(spark, stage.__name__) as folder:
            _stored_before[spark.sparkContext.applicationId] = folder
            return stage(spark, docs, sf_dir)

    return run_stage


@cleared
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    row = free_name(docs, "_row")
    rows = numbered(docs, row)
    verdicts = quality.quality(rows, carry=(row,))
    return without_rows(rows, verdicts.filter("NOT kept"), row)


@cleared
def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    row = free_name(docs, "_row")
    rows = numbered(docs, row)
    scores = toxicity.score_documents(rows, labels, carry=(row,))
    return without_rows(rows, scores.filter("predicted = 1"), row)


@cleared
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component: that of the smallest id.

    Ids that are null come last; among equal ids the first row of the table stays.
    """
    row = free_name(docs, "_row")
    rows = numbered(docs, row)
    near = stored(simhash.near_duplicates(rows, carry=("doc_id", row)), "near")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", row)
    firsts = near.groupBy("root").agg(F.min(order)[row].alias("first"))
    others = left_lookup(near, firsts, ["root"], "inner").filter(F.col(row) != F.col("first"))
    return without_rows(rows, others, row)


@cleared
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that earlier ones have; ``n_chars`` follows the text.

    A document that is left without a word still has its row.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    cut = chunk_dedup.dedup_substrings(docs.select("doc_id", "text", F.struct(*others).alias("_doc")), carry=("_doc",))

    def column(name: str) -> Column:
        if name == "text":
            return F.col("text")
        old = F.col("_doc").getField(name)
        if name == "n_chars":
            old = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(old).cast(docs.schema[name].dataType)
        return old.alias(name)

    return cut.select(*map(column, docs.columns))


@cleared
def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of every piece of the documents in sequences of 1024 tokens."""
    words = Path(public_tokenizers.path("byte_bpe_50k.json")).read_bytes()
    return packing.pack_documents(docs, words, END_ID, SEQUENCE_TOKENS)


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", toxic_documents),
    ("simhash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("best-fit packing", best_fit_packing),
]

# No stage but the quality rules' counts can be said in SQL; the tests compare the
# stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another, from the documents of a folder of tables."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    packed = STAGES[-1][1](spark, docs, sf_dir)
    # The result reads what its stage has stored: no later run clears that.
    _stored_before.pop(spark.sparkContext.applicationId)
    return packed
