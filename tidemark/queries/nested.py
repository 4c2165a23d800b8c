"""Arrays, structs, JSON and nulls."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.flatten import flatten
from tidemark.operators.variants import flatten_json
from tidemark.queries.registry import Tables, query
from tidemark.session import scratch_path
from tidemark.sources.readers import read_json
from tidemark.sources.writers import write_documents

LINKS_SQL = """SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS links FROM pages"""


def page_links(t: Tables):
    """Link targets of each page, in an array."""
    links = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))
    return t.pages.select("page_id", links.alias("links"))


@query("arr_explode", f"SELECT page_id, unnest(links) AS link FROM ({LINKS_SQL})")
def arr_explode(t: Tables):
    return page_links(t).select("page_id", F.explode("links").alias("link"))


@query(
    "arr_explode_outer",
    f"""
    SELECT page_id, unnest(CASE WHEN len(far) = 0 THEN [NULL] ELSE far END) AS link
    FROM (SELECT page_id, list_filter(links, lambda x: length(x) > 9) AS far FROM ({LINKS_SQL}))
    """,
)
def arr_explode_outer(t: Tables):
    """Long links only; a page without any keeps one row."""
    far = F.filter("links", lambda x: F.length(x) > 9)
    return page_links(t).select("page_id", F.explode_outer(far).alias("link"))


@query(
    "arr_contains",
    "SELECT p_partkey, list_contains(string_split(p_name, ' '), 'ring') AS is_ring FROM part",
)
def arr_contains(t: Tables):
    return t.part.select(
        "p_partkey", F.array_contains(F.split("p_name", " "), "ring").alias("is_ring")
    )


@query(
    "arr_element_at",
    "SELECT vec_id, embedding[1]::DOUBLE AS head, embedding[-1]::DOUBLE AS tail, embedding[9999]::DOUBLE AS missing FROM embeddings",
)
def arr_element_at(t: Tables):
    """Positions from 1, from the end with a minus sign; null past the end."""
    at = {"head": 1, "tail": -1, "missing": 9999}
    return t.embeddings.select(
        "vec_id",
        *[
            F.try_element_at("embedding", F.lit(i)).cast("double").alias(n)
            for n, i in at.items()
        ],
    )


@query("arr_size", f"SELECT page_id, len(links)::INTEGER AS links FROM ({LINKS_SQL})")
def arr_size(t: Tables):
    return page_links(t).withColumn("links", F.size("links"))


@query(
    "arr_filter_transform",
    """
    SELECT vec_id, len(kept)::INTEGER AS n, round(list_sum(kept), 4) AS total FROM (
        SELECT vec_id, list_transform(list_filter(embedding::DOUBLE[], lambda x: x > 0.1), lambda x: x * 2) AS kept
        FROM embeddings)
    """,
)
def arr_filter_transform(t: Tables):
    """Keep the large components, then double them."""
    numbers = F.col("embedding").cast("array<double>")
    kept = F.transform(F.filter(numbers, lambda x: x > 0.1), lambda x: x * 2)
    total = F.aggregate("kept", F.lit(0.0), lambda a, x: a + x)
    sizes = t.embeddings.select("vec_id", kept.alias("kept"))
    empty_as_null = F.when(F.size("kept") > 0, F.round(total, 4))
    return sizes.select("vec_id", F.size("kept").alias("n"), empty_as_null.alias("total"))


@query(
    "struct_pack",
    "SELECT l_suppkey, (max((l_quantity, l_extendedprice)))[2] AS price_of_largest FROM lineitem GROUP BY 1",
)
def struct_pack(t: Tables):
    """Structs compare field by field: the price that goes with the largest quantity."""
    pair = F.struct("l_quantity", "l_extendedprice")
    return t.lineitem.groupBy("l_suppkey").agg(
        F.max(pair).getField("l_extendedprice").alias("price_of_largest")
    )


@query(
    "struct_field_after_explode",
    """
    SELECT l_orderkey, l_linenumber, unnest(['discount', 'tax']) AS item_name,
           unnest([l_discount, l_tax]) AS item_rate
    FROM lineitem
    """,
)
def struct_field_after_explode(t: Tables):
    items = F.array(
        F.struct(F.lit("discount").alias("item_name"), F.col("l_discount").alias("item_rate")),
        F.struct(F.lit("tax").alias("item_name"), F.col("l_tax").alias("item_rate")),
    )
    exploded = t.lineitem.select("l_orderkey", "l_linenumber", F.explode(items).alias("items"))
    return exploded.select("l_orderkey", "l_linenumber", "items.item_name", "items.item_rate")


@query(
    "json_parse",
    """
    SELECT event_id, json_extract(props, '$.k')::BIGINT AS k,
           CASE WHEN event_type = 'error' THEN NULL ELSE json_extract(props, '$.k')::BIGINT END AS k_or_broken
    FROM events
    """,
)
def json_parse(t: Tables):
    """Payload text by schema; a payload cut short parses to null."""
    broken = F.when(F.col("event_type") == "error", F.concat(F.lit("{"), "props")).otherwise(F.col("props"))
    return t.events.select(
        "event_id",
        F.from_json("props", "k bigint").getField("k").alias("k"),
        F.from_json(broken, "k bigint").getField("k").alias("k_or_broken"),
    )


@query(
    "json_render",
    """
    SELECT s_suppkey, '{"s_suppkey":' || s_suppkey || ',"s_name":"' || s_name || '","s_nationkey":' || s_nationkey || '}' AS body
    FROM supplier
    """,
)
def json_render(t: Tables):
    rows = t.supplier.select("s_suppkey", "s_name", "s_nationkey")
    return rows.select("s_suppkey", F.to_json(F.struct("*")).alias("body"))


def nested_turns(t: Tables):
    """Conversation turns as nested documents: a struct holding an array of line structs."""
    lines = F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("text")))
    turn = F.struct(F.col("turn").alias("number"), "role", lines.alias("lines"))
    return t.conversations.select("conv_id", turn.alias("turn"))


FLAT_SQL = """
    SELECT conv_id, turn AS turn_number, role AS turn_role, unnest(string_split(text, chr(10))) AS turn_lines_text
    FROM conversations
"""


@query("json_flatten", FLAT_SQL)
def json_flatten(t: Tables):
    return flatten(nested_turns(t))


@query("json_to_flat_table", FLAT_SQL)
def json_to_flat_table(t: Tables):
    """Indented JSON documents, read whole, flattened, and kept as a table."""
    documents, table = scratch_path(t.spark, "turns-json"), scratch_path(t.spark, "turns-flat")
    write_documents(nested_turns(t), documents, rows_per_document=10_000)
    schema = nested_turns(t).schema
    flat = flatten(read_json(t.spark, documents, schema=schema, whole_document=True))
    flat.write.parquet(table)
    return t.spark.read.parquet(table)


# Fields that differ by row: amounts of purchases are numbers, of others text; errors have a nested code.
MIXED_SQL = """
    SELECT event_id, json_extract(props, '$.k')::BIGINT AS k,
           CASE WHEN event_type = 'purchase' THEN event_id::VARCHAR
                WHEN event_type = 'signup' THEN 'n' || event_id END AS amount,
           CASE WHEN event_type = 'error' THEN event_id % 7 END AS detail_code
    FROM events
"""


@query("json_variant_flatten", MIXED_SQL)
def json_variant_flatten(t: Tables):
    """JSON text whose fields differ by row to columns: the schema is merged over all rows by an aggregate."""
    k = F.from_json("props", "k bigint").getField("k")
    kind, number = F.col("event_type"), F.col("event_id")
    common = F.concat(F.lit('{"k":'), k.cast("string"))
    amount = F.when(kind == "purchase", F.concat(F.lit(',"amount":'), number.cast("string"))).when(
        kind == "signup", F.concat(F.lit(',"amount":"n'), number.cast("string"), F.lit('"'))
    )
    detail = F.when(kind == "error", F.concat(F.lit(',"detail":{"code":'), (number % 7).cast("string"), F.lit("}")))
    none = F.lit("")
    text = F.concat(common, F.coalesce(amount, none), F.coalesce(detail, none), F.lit("}"))
    path = scratch_path(t.spark, "mixed-json")
    t.events.select("event_id", text.alias("value")).write.parquet(path)
    return flatten_json(t.spark.read.parquet(path), "value", keep=["event_id"]).select(
        "event_id", "k", "amount", "detail_code"
    )


@query(
    "null_drop",
    "SELECT doc_id, quality, toxic FROM documents JOIN labels USING (doc_id)",
)
def null_drop(t: Tables):
    return t.documents.select("doc_id").join(t.labels, "doc_id", "left").na.drop()


@query(
    "null_fill",
    "SELECT doc_id, coalesce(quality, -1) AS quality, coalesce(toxic, 0) AS toxic FROM documents LEFT JOIN labels USING (doc_id)",
)
def null_fill(t: Tables):
    scored = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return scored.na.fill({"quality": -1, "toxic": 0})


@query(
    "null_replace",
    "SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'HOUSES' WHEN 'FURNITURE' THEN 'HOMES' ELSE c_mktsegment END AS c_mktsegment FROM customer",
)
def null_replace(t: Tables):
    segments = t.customer.select("c_custkey", "c_mktsegment")
    return segments.na.replace({"BUILDING": "HOUSES", "FURNITURE": "HOMES"}, subset=["c_mktsegment"])
