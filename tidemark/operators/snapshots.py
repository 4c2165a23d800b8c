"""Versions of a table as ordinary partition columns.

A table is a folder of Parquet files partitioned by ``version`` and
``committed_at``. Reading a version, the state at a time, the history and expiry
are filters and groupings over these columns; they open only the folders they
need. A version with another schema goes into a folder of its own.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import moment

VERSION_COLUMNS = ("version", "committed_at")


def write_version(frame: DataFrame, root: str, version: int, committed_at: datetime) -> None:
    """Write ``frame`` as a version; earlier ones stay, the same one is replaced."""
    stamped = frame.withColumn("committed_at", moment(committed_at))
    stamped.write.mode("overwrite").partitionBy("committed_at").parquet(f"{root}/version={version}")


def all_versions(spark: SparkSession, root: str, keep_from: int = 0) -> DataFrame:
    """Rows of all versions from ``keep_from`` on, with ``version`` and ``committed_at``.

    Expiry is the filter: the folders of earlier versions are not opened, and
    ``remove_versions`` frees them when no reader is left.
    """
    return spark.read.parquet(root).filter(F.col("version") >= keep_from)


def remove_versions(spark: SparkSession, root: str, keep_from: int) -> list[int]:
    """Free the files of the versions before ``keep_from``, and tell which these were.

    Their folders stay, without rows: an empty table is written in their place.
    """
    versions = spark.read.parquet(root)
    gone = [r[0] for r in versions.filter(F.col("version") < keep_from).select("version").distinct().collect()]
    nothing = spark.createDataFrame([], versions.drop("version").schema)
    for version in gone:
        nothing.write.mode("overwrite").partitionBy("committed_at").parquet(f"{root}/version={version}")
    return sorted(gone)


def history(versions: DataFrame) -> DataFrame:
    """``version, committed_at, n_rows``; Parquet footers are all that is read."""
    return versions.groupBy(*VERSION_COLUMNS).agg(F.count(F.lit(1)).alias("n_rows"))


def read_version(versions: DataFrame, version: int) -> DataFrame:
    """Rows of one version, none if there is no such version."""
    return versions.filter(F.col("version") == version).drop(*VERSION_COLUMNS)


def read_as_of(versions: DataFrame, when: datetime | None = None) -> DataFrame:
    """Rows of the last version committed at or before ``when``, by default of the last."""
    known = versions if when is None else versions.filter(F.col("committed_at") <= moment(when))
    newest = known.agg(F.max("version")).scalar()
    return versions.filter(F.col("version") == newest).drop(*VERSION_COLUMNS)
