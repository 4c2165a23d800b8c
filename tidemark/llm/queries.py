"""The registered queries of the operators, with production parameters, and their SQL.

Each takes (spark, folder of Parquet tables) like the library's other queries.
Tokenizer files are parameters of the operators; the queries use the public ones.
"""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    alignment,
    byte_bpe,
    chat,
    chunk_dedup,
    language_id,
    licenses,
    lz_fingerprint,
    packing,
    quality,
    simhash,
    spelling,
    token_files,
    toxicity,
)
from tidemark.llm.shared import prepare
from tidemark.queries.registry import Tables
from tidemark.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SEQUENCE_TOKENS = 1024
# Words that lose a character, one in so many.
SLIPS = 97


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(prepare(spark), folder))

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def vocabulary(name: str) -> bytes:
    return Path(public_tokenizers.path(name)).read_bytes()


@query("op1_toxicity")
def toxicity_scores(t: Tables) -> DataFrame:
    """Score of every document, learnt from the labels that are not held out."""
    scored = toxicity.score_documents(t.documents, t.labels)
    return scored.withColumn("held_out", F.coalesce(toxicity.is_held_out(), F.lit(False)))


@query("op2_byte_bpe")
def byte_bpe_round_trip(t: Tables) -> DataFrame:
    """Ids of every document and the bytes they decode to, as digests."""
    ranks, split = vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = byte_bpe.encode_documents(t.documents, ranks, split)
    decoded = byte_bpe.decode_documents(encoded, ranks, split)
    return decoded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op3_lz_fingerprint")
def lz_fingerprints(t: Tables) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    return lz_fingerprint.compare_edited(t.documents)


@query("op4_chunk_dedup")
def substring_dedup(t: Tables) -> DataFrame:
    """Every document less the passages that earlier ones have."""
    return chunk_dedup.dedup_substrings(t.documents)


@query("op5_token_files")
def token_file_offsets(t: Tables) -> DataFrame:
    """Place and checksum of every document's ids, read back from the files."""
    path = scratch_path(t.spark, "tokens")
    token_files.write_token_files(t.documents, path, vocabulary("word_bpe_49k.json"), end_id=1)
    return token_files.document_offsets(token_files.read_token_files(t.spark, path))


@query("op6_licenses")
def license_scan(t: Tables) -> DataFrame:
    """License of every document, its own or its nearest directory's.

    The table has no paths. Its stand-in has a tree for each source, directories by
    thousand and hundred of the id in it; a hash of the id puts a document at one of
    these three depths and makes one in four a license file there.
    """
    thousand, hundred = (F.floor(F.col("doc_id") / n).cast("string") for n in (1000, 100))
    depth, kind = (F.pmod(F.xxhash64("doc_id", F.lit(i)), F.lit(n)) for i, n in ((1, 3), (2, 4)))
    name = F.concat(F.when(kind == 0, F.lit("LICENSE-")).otherwise(F.lit("")), F.col("doc_id").cast("string"))
    path = F.concat_ws("/", "source", F.when(depth > 0, thousand), F.when(depth > 1, hundred), name)
    files = t.documents.select(F.col("doc_id").alias("file"), path.alias("path"), "text")
    return licenses.scan_licenses(files).withColumnRenamed("file", "doc_id")


@query("op7_packing")
def packed_pieces(t: Tables) -> DataFrame:
    """Place of every piece in sequences of 1024 tokens."""
    return packing.pack_documents(t.documents, vocabulary("byte_bpe_50k.json"), 2, SEQUENCE_TOKENS)


@query("op8_simhash")
def simhash_components(t: Tables) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    near = simhash.near_duplicates(t.documents)
    return near.select("doc_id", simhash.hex_print().alias("fingerprint"), "component_id")


@query("op9_quality")
def quality_verdicts(t: Tables) -> DataFrame:
    """Counts, perplexity and verdict of every document."""
    return quality.quality(t.documents)


CHAT_SQL = r"""
WITH all_rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('<|turn|><|text|><|end|>') + 1
           + length(replace(replace(role, '\', '\\'), '<|', '<\|'))
           + length(replace(replace(text, '\', '\\'), '<|', '<\|')))::BIGINT AS formatted_chars,
       false AS rewrites
FROM all_rows GROUP BY conv_id
"""


@query("op10_chat", CHAT_SQL)
def formatted_chats(t: Tables) -> DataFrame:
    """Every conversation formatted, and what can be read back from the output."""
    said = "</s>[INST] ok [/INST]"
    extra = t.spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)],
        "conv_id long, turn long, role string, text string",
    )
    rows = t.conversations.select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(chat.format_conversations(rows))


@query("op11_language_id")
def language_predictions(t: Tables) -> DataFrame:
    """Language of every document, learnt from those that are not held out."""
    return language_id.identify_documents(t.documents)


@query("op12_spelling_variants")
def word_variants(t: Tables) -> DataFrame:
    """Near words of every word of the documents, some of which lose a character."""
    return spelling.document_variants(t.documents, SLIPS)


@query("op13_token_alignment")
def token_alignments(t: Tables) -> DataFrame:
    """Groups and links between the tokens of two tokenizers in every document."""
    return alignment.alignment_digests(
        t.documents, vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
    )
