"""Numeric column functions, null-safe under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_reading(text: Column) -> Column:
    """Sensor text as a number: numeric text, else boolean text as 1.0/0.0, else null."""
    return F.coalesce(text.try_cast("double"), text.try_cast("boolean").cast("double"))


def parse_currency(text: Column) -> Column:
    """``"$1,234.50"`` as a number; null where it is not one."""
    return F.regexp_replace(text, "[$,]", "").try_cast("double")


def truncate_decimals(value: Column, places: int = 2) -> Column:
    """Cut, not round, to ``places`` decimals."""
    scale = 10**places
    return (value * scale).cast("bigint") / scale


def divide_or_null(numerator: Column, denominator: Column) -> Column:
    """Quotient, or null for a zero divisor."""
    return F.try_divide(numerator, denominator)


def is_leap_year(year: Column) -> Column:
    return ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)


def ladder(cases: list[tuple[Column, object]], default: object) -> Column:
    """First matching case's value: an if / elif / else chain as one expression."""
    condition, value = cases[0]
    chain = F.when(condition, value)
    for condition, value in cases[1:]:
        chain = chain.when(condition, value)
    return chain.otherwise(default)
