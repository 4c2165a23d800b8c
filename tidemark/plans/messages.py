"""Message payloads to typed rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.numbers import parse_reading
from tidemark.functions.times import calendar_parts, millis_to_timestamp, moment

# Fields of a sensor message.
PAYLOAD_SCHEMA = """
    deviceName string, tagName string, deviceID string, success boolean,
    datatype string, timestamp bigint, value string, registerId string,
    description string
"""
CALENDAR = ("year", "month", "day", "hour")


def parse_payload(messages: DataFrame, schema: str = PAYLOAD_SCHEMA) -> DataFrame:
    """Typed, null-free rows with year, month, day and hour, from a binary ``value``.

    Works on batch and streaming frames. A malformed payload parses to nulls and
    is dropped with the other incomplete rows.

    The payload is opened with ``inline``: a filter cannot be pushed below a
    generator, so each payload is parsed once. Selecting ``payload.*`` instead
    lets the null filter be pushed below the parse, which then runs once more
    per field.
    """
    payload = F.from_json(F.col("value").cast("string"), schema)
    rows = messages.select(F.inline(F.array(payload)))
    typed = rows.withColumn("timestamp", millis_to_timestamp(F.col("timestamp"))).na.drop()
    return typed.select("*", *calendar_parts(F.col("timestamp")))


def split_payload(messages: DataFrame, schema: str = PAYLOAD_SCHEMA) -> DataFrame:
    """All messages: typed rows of kind ``good``, others of kind ``rejected`` with reason and raw value.

    ``reason`` is ``empty`` for a null value, ``malformed`` for text that is no JSON
    or a field of another type, else ``missing`` and the fields that are null. Works
    on batch and streaming frames; each payload is parsed once. Rejected rows have
    the date 0000-00-00 so that they are not among the days of the good ones.
    """
    fields = StructType.fromDDL(schema).names
    text = F.col("value").cast("string")
    payload = F.from_json(text, f"{schema}, _raw string", {"columnNameOfCorruptRecord": "_raw"})
    opened = messages.select(F.inline(F.array(F.struct(payload.alias("_payload"), F.col("value").alias("raw")))))
    rows = opened.select("raw", "_payload.*")
    missing = F.array_compact(F.array(*[F.when(F.col(f).isNull(), F.lit(f)) for f in fields]))
    reason = (
        F.when(F.col("raw").isNull(), F.lit("empty"))
        .when(F.col("_raw").isNotNull() | (F.size(missing) == len(fields)), F.lit("malformed"))
        .when(F.size(missing) > 0, F.concat_ws(" ", F.lit("missing"), missing))
    )
    typed = rows.withColumns({"reason": reason, "timestamp": millis_to_timestamp(F.col("timestamp"))}).drop("_raw")
    good = F.col("reason").isNull()
    return typed.select(
        *fields,
        *[F.when(good, c).otherwise(0).alias(n) for c, n in zip(calendar_parts(F.col("timestamp")), CALENDAR)],
        F.when(good, F.lit("good")).otherwise(F.lit("rejected")).alias("kind"),
        "reason",
        F.when(~good, F.col("raw")).alias("raw"),
    )


def accepted(split: DataFrame) -> DataFrame:
    """The typed rows of ``split_payload``."""
    return split.filter(F.col("kind") == "good").drop("kind", "reason", "raw")


def rejected(split: DataFrame) -> DataFrame:
    """``reason`` and ``raw`` value of the other messages."""
    return split.filter(F.col("kind") == "rejected").select("reason", "raw")


def readings(bronze: DataFrame, tag_prefix: str = "") -> DataFrame:
    """``device, tag, ts, id, value``: numeric readings of the tags that begin with a prefix.

    Text that is no reading has a null value. The prefix reaches the scan.
    """
    return bronze.filter(F.col("tagName").startswith(tag_prefix)).select(
        F.col("deviceName").alias("device"),
        F.col("tagName").alias("tag"),
        F.col("timestamp").alias("ts"),
        F.col("deviceID").alias("id"),
        parse_reading(F.col("value")).alias("value"),
    )


def between(bronze: DataFrame, start: datetime, end: datetime, time: str = "timestamp") -> DataFrame:
    """Rows of ``[start, end)`` from a table in folders by year, month and day.

    The range is also put on the folder columns, so other days are not listed
    or opened; the range on the stamp alone would open every file.
    """
    day = F.make_date("year", "month", "day")
    return bronze.filter(
        (day >= moment(start).cast("date"))
        & (day <= moment(end).cast("date"))
        & (F.col(time) >= moment(start))
        & (F.col(time) < moment(end))
    )
