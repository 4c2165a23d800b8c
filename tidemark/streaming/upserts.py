"""Micro-batches merged into rolled-up tables, with late readings."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import epoch_seconds
from tidemark.plans.sensors import rollup, summarise_latest, upsert_in_days, with_day
from tidemark.session import stored
from tidemark.sources.partitioned import within_folders
from tidemark.streaming.sinks import append_batches


def period_of(time: str, seconds: int) -> Column:
    """Number of the period that a reading falls in, from the epoch."""
    return F.floor(epoch_seconds(F.col(time)) / seconds)


def upsert_periods(
    readings_path: str,
    table_path: str,
    keys: Sequence[str],
    time: str,
    value: str,
    seconds: int,
    tiebreak: Sequence[str] = (),
    bucket_seconds: int = 300,
) -> Callable[[DataFrame, int], None]:
    """Batch handler: each batch's periods summed up from all their readings, and merged.

    A batch's readings go to a folder of its own below ``readings_path``, in days.
    The (key, period) pairs that it touches are summed up again from everything that
    was read of them so far: a reading that comes a day late corrects the period
    that it belongs to. The result is merged into the days of ``table_path`` that
    it falls in (``upsert_in_days``, noted under the batch id), so a batch
    can be repeated at any point, and days without news are not opened for writing.

    ``seconds`` is the length of a period, a divisor of a day; ``bucket_seconds``
    that of the buckets it is made of. Readings without a stamp are left out.
    """
    if 86_400 % seconds or seconds % bucket_seconds:
        raise ValueError("a day must hold whole periods and a period whole buckets")
    keep = append_batches(readings_path, partition_by=["day"])

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        dated = batch.filter(F.col(time).isNotNull()).withColumn("day", F.to_date(time))
        keep(dated, batch_id)
        own = spark.read.schema(dated.schema).parquet(f"{readings_path}/batch={batch_id}")
        number = period_of(time, seconds).alias("_period")
        touched = stored(own.select(*keys, number, "day").distinct(), "touched")
        known = within_folders(spark.read.schema(dated.schema).parquet(readings_path), touched, ["day"])
        again = known.withColumn("_period", period_of(time, seconds)).join(
            touched.drop("day"), [*keys, "_period"], "left_semi"
        )
        buckets = summarise_latest(again, keys, time, value, bucket_seconds, tiebreak)
        upsert_in_days(spark, table_path, with_day(rollup(buckets, keys, seconds)), keys, batch_id)

    return handle

