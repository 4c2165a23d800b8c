"""Ticks from line items: symbol = return flag, file = month, price, volume and ship date."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import file_number
from tidemark.plans.stocks import (
    PRICES,
    TICK_SCHEMA,
    ohlc,
    portfolio_value,
    read_symbol,
    scaled_ohlc,
    write_by_symbol,
)
from tidemark.queries.registry import Tables, query
from tidemark.session import scratch_path
from tidemark.streaming.sinks import run_to_end, to_files
from tidemark.streaming.sources import csv_ingest

# Shares held of each symbol.
SHARES = {"A": 3750, "N": 6750, "R": 4500}
TIEBREAK = ["l_orderkey", "l_linenumber", "l_extendedprice"]
KEYS = ["file_id", "symbol"]


def ticks(t: Tables) -> DataFrame:
    month = (F.year("l_shipdate") * 12 + F.month("l_shipdate")).cast("bigint")
    return t.lineitem.select(
        month.alias("file_id"),
        F.col("l_returnflag").alias("symbol"),
        "l_shipdate",
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        "l_quantity",
    )


def monthly_bars(t: Tables) -> DataFrame:
    return ohlc(ticks(t), KEYS, "l_shipdate", "l_extendedprice", "l_quantity", TIEBREAK)


BARS_SQL = """
    SELECT (year(l_shipdate) * 12 + month(l_shipdate))::BIGINT AS file_id, l_returnflag AS symbol,
           arg_min(l_extendedprice, (l_shipdate, l_orderkey, l_linenumber, l_extendedprice)) AS open,
           min(l_extendedprice) AS low, max(l_extendedprice) AS high,
           arg_max(l_extendedprice, (l_shipdate, l_orderkey, l_linenumber, l_extendedprice)) AS close,
           sum(l_quantity) AS volume
    FROM lineitem GROUP BY 1, 2
"""


@query("ohlc", BARS_SQL)
def bars(t: Tables):
    return monthly_bars(t)


def _held(price: str) -> str:
    cases = " ".join(f"WHEN '{s}' THEN {n}" for s, n in SHARES.items())
    return f"round(sum({price} * CASE symbol {cases} END), 2) AS portfolio_{price}"


@query(
    "portfolio_value",
    f"SELECT file_id, {', '.join(map(_held, PRICES))} FROM ({BARS_SQL}) "
    "WHERE symbol IN ('A', 'N', 'R') GROUP BY 1 HAVING count(*) = 3",
)
def valued(t: Tables):
    totals = portfolio_value(monthly_bars(t), SHARES)
    return totals.select(
        "file_id", *[F.round(c, 2).alias(c) for c in totals.columns if c != "file_id"]
    )


@query(
    "stock_scaled_ohlc",
    f"SELECT *, {', '.join(f'{p} * 3750 AS {p}_value' for p in PRICES)} FROM ({BARS_SQL})",
)
def stock_scaled_ohlc(t: Tables):
    return scaled_ohlc(monthly_bars(t), SHARES["A"])


@query(
    "stock_split",
    """
    SELECT l_returnflag AS symbol, count(*) AS n_ticks, round(sum(l_extendedprice), 2) AS total
    FROM lineitem WHERE l_returnflag IN ('A', 'N', 'R') GROUP BY 1
    """,
)
def stock_split(t: Tables):
    """One table per symbol: a folder each, from one scan and one write."""
    path = scratch_path(t.spark, "ticks-by-symbol")
    write_by_symbol(ticks(t), path)
    tables = [
        read_symbol(t.spark, path, symbol)
        .agg(F.count(F.lit(1)).alias("n_ticks"), F.round(F.sum("l_extendedprice"), 2).alias("total"))
        .select(F.lit(symbol).alias("symbol"), "n_ticks", "total")
        for symbol in SHARES
    ]
    return reduce(DataFrame.union, tables)


def write_tick_files(t: Tables, path: str) -> None:
    """Headerless CSV sets named ``<symbol>_<year>.csv`` below ``path``."""
    rows = t.lineitem.select(
        F.concat_ws("_", "l_returnflag", F.concat(F.year("l_shipdate"), F.lit(".csv"))).alias("file"),
        F.col("l_linenumber").alias("Idx"),
        F.col("l_quantity").cast("int").alias("Volume"),
        F.col("l_returnflag").alias("StockName"),
        F.col("l_extendedprice").alias("StockPrice"),
        F.col("l_shipdate").cast("timestamp").alias("timestamp"),
    )
    rows.hint("rebalance", "file").write.partitionBy("file").csv(path)


@query(
    "stock_ingest",
    """
    SELECT year(l_shipdate)::BIGINT AS file_id, l_returnflag AS symbol, count(*) AS n_ticks,
           sum(trunc(l_quantity)::BIGINT)::BIGINT AS volume, round(sum(l_extendedprice), 2) AS total
    FROM lineitem GROUP BY 1, 2
    """,
)
def stock_ingest(t: Tables):
    """Streaming ingest of the folder of tick files; the file id comes from the file's name."""
    files, out, state = (scratch_path(t.spark, n) for n in ("tick-csv", "ticks", "tick-state"))
    write_tick_files(t, files)
    stream = csv_ingest(t.spark, files, TICK_SCHEMA)
    set_name = F.regexp_extract(F.col("_metadata.file_path"), r"file=([^/]+)/", 1)
    run_to_end(to_files(stream.select("*", file_number(set_name).alias("file_id")), out, state))
    return (
        t.spark.read.parquet(out)
        .groupBy("file_id", F.col("StockName").alias("symbol"))
        .agg(
            F.count(F.lit(1)).alias("n_ticks"),
            F.sum("Volume").alias("volume"),
            F.round(F.sum("StockPrice"), 2).alias("total"),
        )
    )
