"""String column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def file_name(path: Column) -> Column:
    """Last segment of a path."""
    return F.regexp_extract(path, r"([^/]+)$", 1)


def file_number(name: Column, suffix: str = "csv") -> Column:
    """Number in a ``<name>_<number>.<suffix>`` file name; null where there is none."""
    return F.regexp_extract(name, rf"_(\d+)\.{suffix}$", 1).try_cast("bigint")


def first_letter(text: Column) -> Column:
    return F.substring(text, 1, 1)


def folded(text: Column) -> Column:
    """Comparison form: lower case, no hyphens, no surrounding or repeated blanks."""
    plain = F.replace(F.lower(text), F.lit("-"), F.lit(""))
    return F.trim(F.regexp_replace(plain, " {2,}", " "))


def words(text: Column) -> Column:
    return F.split(text, " ")
