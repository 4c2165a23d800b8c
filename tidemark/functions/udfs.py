"""Python and vectorised UDF forms. Each has a native twin, which jobs should use.

The functions are made inside factories, so they travel to the executors by
value: nothing of this package has to be installed there.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.functions.times import WEEKDAY_LABELS


def _first_letter_udf():
    def first_letter(text):
        return text[:1] if text is not None else None

    # Wrapped function; Arrow moves the rows in batches.
    return F.udf(first_letter, StringType(), useArrow=True)


def _weekday_label_udf():
    labels = dict(WEEKDAY_LABELS)

    @F.udf(StringType(), useArrow=True)
    def weekday_label(day: str | None) -> str | None:
        return labels.get(day)

    return weekday_label


def _first_letter_vectorised():
    @F.pandas_udf(StringType())
    def first_letter(text: pd.Series) -> pd.Series:
        return text.str[0:1]

    return first_letter


first_letter_udf = _first_letter_udf()
weekday_label_udf = _weekday_label_udf()
first_letter_vectorised = _first_letter_vectorised()


def register_udfs(spark: SparkSession) -> None:
    """Make the UDFs callable from SQL text."""
    spark.udf.register("first_letter", first_letter_udf)
    spark.udf.register("first_letter_vec", first_letter_vectorised)
    spark.udf.register("weekday_label", weekday_label_udf)
