"""Upserts and versioned tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import stamp
from tidemark.operators.merge import merge_upsert
from tidemark.operators.snapshots import (
    all_versions,
    history,
    read_as_of,
    read_version,
    remove_versions,
    write_version,
)
from tidemark.queries.registry import Tables, query
from tidemark.session import scratch_path

COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]


def before(day: str):
    return F.col("o_orderdate") < F.lit(day).cast("timestamp_ntz")


def old_and_new(t: Tables):
    """Orders up to 1999, and changed and added orders from 1998 on (null price when in progress)."""
    target = t.orders.filter(before("2000-01-01")).select(*COLUMNS)
    price = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    source = t.orders.filter(~before("1998-01-01")).select(
        "o_orderkey", "o_custkey", F.lit("X").alias("o_orderstatus"), price.alias("o_totalprice")
    )
    return target, source


@query(
    "merge_upsert",
    """
    SELECT o_orderkey, o_custkey, CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
           CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS o_totalprice
    FROM orders
    """,
)
def upserted(t: Tables):
    """Null in a matched source row overwrites."""
    return merge_upsert(*old_and_new(t), ["o_orderkey"])


@query(
    "merge_partial",
    """
    SELECT o_orderkey, o_custkey, CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
           CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' AND o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS o_totalprice
    FROM orders
    """,
)
def partly_upserted(t: Tables):
    """Matched rows change their status only; new rows come whole."""
    return merge_upsert(*old_and_new(t), ["o_orderkey"], ["o_orderstatus"])


def three_versions(t: Tables, root: str | None = None) -> DataFrame:
    """All orders; then only finished ones; then only the dear ones of these."""
    root = root or scratch_path(t.spark, "orders-versions")
    orders = t.orders.select(*COLUMNS)
    finished = orders.filter("o_orderstatus = 'F'")
    write_version(orders, root, 0, datetime(2024, 1, 1, 12))
    write_version(finished, root, 1, datetime(2024, 1, 2, 12))
    write_version(finished.filter("o_totalprice > 100000"), root, 2, datetime(2024, 1, 3, 12))
    return all_versions(t.spark, root)


FIRST_SQL = f"SELECT {', '.join(COLUMNS)} FROM orders"


@query("snapshot_write", f"{FIRST_SQL} WHERE o_orderstatus = 'F' AND o_totalprice > 100000")
def snapshot_write(t: Tables):
    """The latest version after three."""
    return read_as_of(three_versions(t))


@query("read_version_as_of", FIRST_SQL)
def read_version_as_of(t: Tables):
    return read_version(three_versions(t), 0)


@query("read_time_as_of", f"{FIRST_SQL} WHERE o_orderstatus = 'F'")
def read_time_as_of(t: Tables):
    """The version current at noon of the second day and some hours."""
    return read_as_of(three_versions(t), datetime(2024, 1, 2, 18))


@query(
    "history",
    """
    SELECT 0::INTEGER AS version, '2024-01-01 12:00:00' AS committed_at, count(*) AS n_rows FROM orders
    UNION ALL SELECT 1, '2024-01-02 12:00:00', count(*) FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 2, '2024-01-03 12:00:00', count(*) FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000
    """,
)
def version_list(t: Tables):
    return history(three_versions(t)).select(
        "version", stamp(F.col("committed_at")).alias("committed_at"), "n_rows"
    )


@query(
    "schema_change_overwrite",
    "SELECT p_partkey, len(string_split(p_name, ' '))::INTEGER AS words FROM part",
)
def schema_change_overwrite(t: Tables):
    """An array column becomes its size: the new schema has a folder of its own, the old stays readable."""
    arrays, sizes = (scratch_path(t.spark, n) for n in ("part-arrays", "part-sizes"))
    words = t.part.select("p_partkey", F.split("p_name", " ").alias("words"))
    write_version(words, arrays, 0, datetime(2024, 1, 1))
    first = read_version(all_versions(t.spark, arrays), 0)
    write_version(first.withColumn("words", F.size("words")), sizes, 1, datetime(2024, 1, 2))
    return read_as_of(all_versions(t.spark, sizes))


@query("expire_versions", f"{FIRST_SQL} WHERE o_orderstatus = 'F'")
def expired(t: Tables):
    """The oldest version that is left when the first has expired and its files are removed."""
    root = scratch_path(t.spark, "orders-versions")
    three_versions(t, root)
    remove_versions(t.spark, root, keep_from=1)
    kept = all_versions(t.spark, root, keep_from=1)
    oldest = kept.agg(F.min("version")).scalar()
    return kept.filter(F.col("version") == oldest).select(*COLUMNS)
