"""Stock ticks: open/high/low/close per file and portfolio value."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import file_name, file_number
from tidemark.operators.aggregates import total_order
from tidemark.sources.writers import write_parquet

# Headerless tick files.
TICK_SCHEMA = "Idx int, Volume int, StockName string, StockPrice double, timestamp timestamp"

PRICES = ("open", "low", "high", "close")


def with_file_id(ticks: DataFrame) -> DataFrame:
    """``file_id``: the number in the name of the file a row was read from."""
    name = file_name(F.col("_metadata.file_path"))
    return ticks.select("*", file_number(name).alias("file_id"))


def write_by_symbol(ticks: DataFrame, path: str, column: str = "symbol") -> None:
    """One write for all symbols: each has a folder, which is its table."""
    write_parquet(ticks, path, partition_by=[column])


def read_symbol(spark: SparkSession, path: str, symbol: str, column: str = "symbol") -> DataFrame:
    """The table of one symbol; no other folder is opened."""
    return spark.read.parquet(path).filter(F.col(column) == symbol).drop(column)


def ohlc(
    ticks: DataFrame,
    keys: Sequence[str],
    time: str,
    price: str,
    volume: str,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Open, low, high, close and volume per key, in one aggregate.

    ``(time, *tiebreak)`` should be a total order, as opening and closing prices
    are those of its first and last row.
    """
    order = total_order(time, *tiebreak)
    return ticks.groupBy(*keys).agg(
        F.min_by(price, order).alias("open"),
        F.min(price).alias("low"),
        F.max(price).alias("high"),
        F.max_by(price, order).alias("close"),
        F.sum(volume).alias("volume"),
    )


def shares_of(symbol: str, shares: Mapping[str, float]):
    pairs = [F.lit(x) for item in shares.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), F.col(symbol))


def portfolio_value(
    bars: DataFrame, shares: Mapping[str, float], file_id: str = "file_id", symbol: str = "symbol"
) -> DataFrame:
    """Sum of price x shares per file, for files that have every symbol held.

    One row per (file, symbol) is enough, so this is a plain aggregate over the
    long form instead of a join per symbol and measure.
    """
    held = bars.filter(F.col(symbol).isin(*shares))
    n = shares_of(symbol, shares)
    totals = [F.sum(F.col(p) * n).alias(f"portfolio_{p}") for p in PRICES]
    return (
        held.groupBy(file_id)
        .agg(F.count(F.lit(1)).alias("n_symbols"), *totals)
        .filter(F.col("n_symbols") == len(shares))
        .drop("n_symbols")
    )


def scaled_ohlc(bars: DataFrame, shares: float) -> DataFrame:
    """Bars with each price also multiplied by one number of shares."""
    return bars.select("*", *[(F.col(p) * shares).alias(f"{p}_value") for p in PRICES])
