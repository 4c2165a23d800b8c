"""Session set-up and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Results depend on the zone, so it is always set.
REQUIRED_SETTINGS = {"spark.sql.session.timeZone": "UTC"}

# Used where a session has none of its own; all can change at run time.
DEFAULT_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Sizes after compression: 64 MB in a shuffle are some 200 MB in a task. A hot
    # key's rows compress well, so the bound for splitting it is low as well.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128m",
    # Streaming state of any size, off the executors' heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(
    app_name: str = "tidemark",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Start (or reuse) a session with the package's settings.

    ``shuffle_partitions`` is the number AQE starts from before it merges small
    partitions: give a multiple of the cluster's cores that keeps a partition
    near 200 MB in memory. Streaming state keeps the number it was started with.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false")
    for key, value in {**REQUIRED_SETTINGS, **DEFAULT_SETTINGS}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_session(spark: SparkSession) -> SparkSession:
    """Give a session made elsewhere the settings it lacks, and the zone."""
    for key, value in REQUIRED_SETTINGS.items():
        spark.conf.set(key, value)
    for key, value in DEFAULT_SETTINGS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


@contextmanager
def with_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings of the session inside the ``with`` block only."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, from ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder; on
    a cluster a machine-local folder would be lost with its executor, so the
    setting is required there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_scopes: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, not yet existing path below the shared folder, in this application's part of it."""
    return os.path.join(_scratch_root(spark), *_scopes, f"{label}-{uuid.uuid4().hex}")


def _scratch_root(spark: SparkSession) -> str:
    return os.path.join(shared_folder(spark), "tidemark", spark.sparkContext.applicationId)


@contextmanager
def scratch_scope(spark: SparkSession, label: str) -> Iterator[str]:
    """A folder for everything that is stored inside the ``with`` block, to be cleared together."""
    folder = scratch_path(spark, label)
    _scopes.append(os.path.basename(folder))
    try:
        yield folder
    finally:
        _scopes.pop()


def clear_scratch(spark: SparkSession, folder: str | None = None) -> None:
    """Remove what is in a folder of ``scratch_scope``, or everything that this application stored.

    An empty table is written in its place. Frames that read stored results of it
    cannot be used afterwards.
    """
    nothing = spark.createDataFrame([], "nothing int").coalesce(1)
    nothing.write.mode("overwrite").parquet(folder or _scratch_root(spark))


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read back.

    For a costly result that is used more than once: it is computed a single
    time, and a lost executor does not take it along as it would a cached one.
    """
    path = scratch_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)
