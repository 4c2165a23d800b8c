"""String functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.numbers import parse_currency
from tidemark.functions.text import file_name, file_number, first_letter, folded
from tidemark.queries.registry import Tables, query


@query(
    "str_split",
    "SELECT p_partkey, split_part(p_name, ' ', 1) AS quality, split_part(p_name, ' ', 2) AS family, len(string_split(p_name, ' '))::INTEGER AS n FROM part",
)
def str_split(t: Tables):
    parts = F.split("p_name", " ")
    return t.part.select(
        "p_partkey",
        F.try_element_at(parts, F.lit(1)).alias("quality"),
        F.try_element_at(parts, F.lit(2)).alias("family"),
        F.size(parts).alias("n"),
    )


@query("str_translate", "SELECT o_orderkey, replace(o_orderpriority, '-', '') AS plain FROM orders")
def str_translate(t: Tables):
    return t.orders.select("o_orderkey", F.translate("o_orderpriority", "-", "").alias("plain"))


@query(
    "str_regexp_replace",
    r"SELECT c_custkey, regexp_replace(c_name, '(\d{3})(\d{2})(\d{4})', '\1-\2-\3') AS numbered FROM customer",
)
def str_regexp_replace(t: Tables):
    """Nine digits written as 3-2-4."""
    return t.customer.select(
        "c_custkey",
        F.regexp_replace("c_name", r"(\d{3})(\d{2})(\d{4})", "$1-$2-$3").alias("numbered"),
    )


@query(
    "str_regexp_extract",
    r"""
    SELECT page_id, regexp_extract(url, '([^/]+)$', 1) AS file_name,
           TRY_CAST(regexp_extract('ticks/' || page_id || '/' || split_part(url, '/', 4) || '_' || page_id || '.csv',
                                   '_(\d+)\.csv$', 1) AS BIGINT) AS file_id
    FROM pages
    """,
)
def str_regexp_extract(t: Tables):
    path = F.concat(
        F.lit("ticks/"), "page_id", F.lit("/"), F.split_part("url", F.lit("/"), F.lit(4)),
        F.lit("_"), "page_id", F.lit(".csv"),
    )
    return t.pages.select(
        "page_id", file_name(F.col("url")).alias("file_name"), file_number(path).alias("file_id")
    )


@query(
    "str_ltrim",
    "SELECT doc_id, ltrim(t, ' ') AS trimmed, length(ltrim(t, ' ')) AS n FROM (SELECT doc_id, '   ' || text AS t FROM documents)",
)
def str_ltrim(t: Tables):
    padded = t.documents.select("doc_id", F.concat(F.lit("   "), "text").alias("padded"))
    trimmed = F.ltrim("padded")
    return padded.select(
        "doc_id", trimmed.alias("trimmed"), F.length(trimmed).cast("bigint").alias("n")
    )


@query("str_lower", "SELECT c_custkey, lower(c_name) AS handle, lower(c_mktsegment) AS segment FROM customer")
def str_lower(t: Tables):
    return t.customer.select(
        "c_custkey", F.lower("c_name").alias("handle"), F.lower("c_mktsegment").alias("segment")
    )


@query(
    "str_concat",
    """
    SELECT doc_id, lang || '~' || source AS tag,
           CASE WHEN quality IS NULL THEN NULL ELSE source || '~' || quality END AS null_if_any
    FROM documents LEFT JOIN labels USING (doc_id)
    """,
)
def str_concat(t: Tables):
    labelled = t.documents.select("doc_id", "lang", "source").join(t.labels, "doc_id", "left")
    return labelled.select(
        "doc_id",
        F.concat("lang", F.lit("~"), "source").alias("tag"),
        F.expr("source || '~' || quality").alias("null_if_any"),
    )


@query(
    "str_concat_ws",
    "SELECT doc_id, concat_ws('~', lang, quality, source) AS tag FROM documents LEFT JOIN labels USING (doc_id)",
)
def str_concat_ws(t: Tables):
    """Nulls are skipped, with their separator."""
    labelled = t.documents.select("doc_id", "lang", "source").join(t.labels, "doc_id", "left")
    return labelled.select(
        "doc_id", F.concat_ws("~", "lang", F.col("quality").cast("string"), "source").alias("tag")
    )


@query("str_first_char", "SELECT doc_id, substr(text, 1, 1) AS letter FROM documents")
def str_first_char(t: Tables):
    return t.documents.select("doc_id", first_letter(F.col("text")).alias("letter"))


@query(
    "str_currency_parse",
    "SELECT o_orderkey, o_totalprice AS price, NULL::DOUBLE AS junk FROM orders",
)
def str_currency_parse(t: Tables):
    """``$1,234.50`` texts back to numbers; other text gives null."""
    shown = F.concat(F.lit("$"), F.format_number("o_totalprice", 2))
    return t.orders.select(
        "o_orderkey",
        parse_currency(shown).alias("price"),
        parse_currency(F.col("o_orderpriority")).alias("junk"),
    )


@query(
    "str_fold_case",
    "SELECT o_orderkey, trim(regexp_replace(replace(lower(o_orderpriority), '-', ''), ' +', ' ', 'g'), ' ') AS folded FROM orders",
)
def str_fold_case(t: Tables):
    return t.orders.select("o_orderkey", folded(F.col("o_orderpriority")).alias("folded"))
