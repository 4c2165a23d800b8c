"""Upserts into folders, interrupted and repeated merges, maxima from footers, the gap-filled chain."""

import random
import shutil
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions.times import stamp
from tidemark.plans.sensors import (
    MEASURES,
    catch_up,
    catch_up_held,
    epoch,
    pending_after,
    pending_windows,
    roll_up_range,
    rollup,
    summarise_held,
    summarise_latest,
    with_day,
)
from tidemark.sources import partitioned
from tidemark.sources.partitioned import (
    has_files,
    high_water_mark,
    largest,
    merge_into_partitions,
    reading_footers,
    within_folders,
)

SCHEMA = "id bigint, day string, value double"
KEYS, FOLDERS = ["id"], ["day"]
START = datetime(2024, 1, 1)


def rows_of(spark, path):
    return {r["id"]: (r["day"], r["value"]) for r in spark.read.schema(SCHEMA).parquet(path).collect()}


def files_of(spark, path):
    """File names by day."""
    files = spark.read.parquet(path).select("day", F.col("_metadata.file_name").alias("file")).distinct()
    return {(r["day"], r["file"]) for r in files.collect()}


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "table")
    first = [(i, f"d{i % 5}", float(i)) for i in range(50)]
    assert merge_into_partitions(spark, path, frame(spark, first), KEYS, FOLDERS, "first")
    return path


def test_only_touched_folders_are_rewritten(spark, table):
    before = files_of(spark, table)
    news = frame(spark, [(1, "d1", -1.0), (101, "d1", 7.0), (203, "d3", None)])
    assert merge_into_partitions(spark, table, news, KEYS, FOLDERS, 1)
    after = files_of(spark, table)
    assert {f for f in before if f[0] in ("d0", "d2", "d4")} == {f for f in after if f[0] in ("d0", "d2", "d4")}
    assert not {f for f in before if f[0] in ("d1", "d3")} & after
    expected = {i: (f"d{i % 5}", float(i)) for i in range(50)} | {1: ("d1", -1.0), 101: ("d1", 7.0), 203: ("d3", None)}
    assert rows_of(spark, table) == expected


def test_a_repeated_batch_changes_nothing(spark, table):
    news = frame(spark, [(1, "d1", -1.0)])
    assert merge_into_partitions(spark, table, news, KEYS, FOLDERS, 1)
    assert merge_into_partitions(spark, table, frame(spark, [(1, "d1", -2.0)]), KEYS, FOLDERS, 2)
    before = files_of(spark, table)
    assert not merge_into_partitions(spark, table, news, KEYS, FOLDERS, 1)
    assert files_of(spark, table) == before and rows_of(spark, table)[1] == ("d1", -2.0)


@pytest.mark.parametrize("then", [1, 2])
def test_a_merge_that_was_cut_short_is_finished_first(spark, table, monkeypatch, tmp_path, then):
    """The folders were staged, and some perhaps replaced, when the job ended."""
    news = frame(spark, [(1, "d1", -1.0), (3, "d3", -3.0)])

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as broken:
        broken.setattr(partitioned, "_put_in_place", lost)
        with pytest.raises(RuntimeError):
            merge_into_partitions(spark, table, news, KEYS, FOLDERS, 1)
    # One folder was removed, as a half-done replacement may leave it.
    shutil.rmtree(f"{table}/day=d3")
    later = news if then == 1 else frame(spark, [(4, "d4", -4.0)])
    assert merge_into_partitions(spark, table, later, KEYS, FOLDERS, then) == (then != 1)
    expected = {i: (f"d{i % 5}", float(i)) for i in range(50)} | {1: ("d1", -1.0), 3: ("d3", -3.0)}
    assert rows_of(spark, table) == (expected if then == 1 else expected | {4: ("d4", -4.0)})


def test_repeated_keys_in_a_source_change_nothing(spark, table):
    before = files_of(spark, table)
    with pytest.raises(Exception, match="repeats a key"):
        merge_into_partitions(spark, table, frame(spark, [(1, "d1", 0.0), (1, "d1", 1.0)]), KEYS, FOLDERS, 1)
    assert files_of(spark, table) == before
    assert merge_into_partitions(spark, table, frame(spark, [(1, "d1", 9.0)]), KEYS, FOLDERS, 1)
    assert rows_of(spark, table)[1] == ("d1", 9.0)


def test_empty_sources_and_tables(spark, tmp_path):
    path = str(tmp_path / "none")
    assert not has_files(spark, path)
    assert merge_into_partitions(spark, path, frame(spark, []), KEYS, FOLDERS, 0)
    assert rows_of(spark, path) == {}
    assert merge_into_partitions(spark, path, frame(spark, [(1, None, 2.0)]), KEYS, FOLDERS, 1)
    assert merge_into_partitions(spark, path, frame(spark, [(2, "x", None)]), KEYS, FOLDERS, None)
    assert rows_of(spark, path) == {1: (None, 2.0), 2: ("x", None)}


@pytest.mark.parametrize("most_named", [1000, 1])
def test_other_folders_are_not_opened(spark, table, most_named, capsys):
    """Also where the folders are too many to be named, and are joined."""
    whole = spark.read.schema(SCHEMA).parquet(table)
    inside = within_folders(whole, frame(spark, [(0, "d1", 0.0), (0, "d2", 0.0)]), FOLDERS, most_named)
    assert {r["day"] for r in inside.collect()} == {"d1", "d2"}
    if most_named > 1:
        inside.explain("formatted")
        assert "PartitionFilters: [((day" in capsys.readouterr().out


def test_maximum_is_taken_from_footers(spark, table, capsys):
    with reading_footers(spark):
        newest = largest(spark.read.parquet(table), "id", F.col("day") < "d4")
        newest.explain()
        assert newest.first()["largest"] == 48
    shown = capsys.readouterr().out
    assert "PushedAggregation: [MAX(id)]" in shown and "ReadSchema: struct<max(id):bigint>" in shown
    assert high_water_mark(spark, table, "id") == 49
    assert high_water_mark(spark, table + "-not-there", "id") is None
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")


def test_pending_windows_by_footers_or_rows(spark, tmp_path):
    path = str(tmp_path / "hours")
    now, initial = datetime(2024, 1, 3, 5, 30), datetime(2024, 1, 3, 1)
    stamps = [START, START + timedelta(hours=30), datetime(2400, 1, 1)]
    hours = spark.createDataFrame([(s,) for s in stamps], "window_end timestamp")
    with_day(hours).write.partitionBy("day").parquet(path)
    by_rows = pending_windows(hours, "window_end", initial, now, 3600).collect()
    assert pending_after(spark, path, initial, now, 3600).collect() == by_rows
    assert len(by_rows) == 23
    none = pending_after(spark, path + "-none", initial, now, 3600)
    assert [r["window_start"] for r in none.collect()] == [initial + timedelta(hours=i) for i in range(4)]


READINGS = "device string, tag string, ts timestamp, id bigint, value double"
DEVICE_TAG = ["device", "tag"]
T0 = epoch("2024-01-01 00:00:00")


@pytest.fixture(scope="module")
def sensor_rows():
    rng = random.Random(11)
    made = []
    for i in range(400):
        at = START + timedelta(seconds=rng.randrange(4 * 86_400))
        if not (at.day == 2 and i % 4):  # the second day is nearly empty
            made.append((f"d{rng.randrange(3)}", f"t{rng.randrange(2)}", at, i, rng.choice([None, 1.0, 2.0, 5.0])))
    return made


def measures(frame):
    exact = [m for m in MEASURES if m != "avg_value"]
    rows = frame.select(*DEVICE_TAG, stamp(F.col("window_end")), *exact, F.round("avg_value", 9)).collect()
    return sorted(map(tuple, rows), key=str)


def run_chain(spark, folder, readings, untils, window=21_600, slot=600):
    silver, daily = f"{folder}/silver", f"{folder}/daily"
    for until in untils:
        seen = readings.filter(F.col("ts") < F.timestamp_seconds(F.lit(until)))
        done = catch_up_held(spark, silver, seen, DEVICE_TAG, "ts", "value", T0, until, window, slot, ["id"], batch_id=until)
        if done:
            roll_up_range(spark, silver, daily, DEVICE_TAG, *done, 86_400, batch_id=until)
    return silver, daily


def test_two_half_runs_equal_one(spark, sensor_rows, tmp_path):
    """The second goes on from what the first one's table holds, also within a day."""
    readings = spark.createDataFrame(sensor_rows, READINGS)
    end = T0 + 4 * 86_400
    whole = run_chain(spark, str(tmp_path / "one"), readings, [end])
    halves = run_chain(spark, str(tmp_path / "two"), readings, [T0 + 1000, T0 + 86_400 + 30_000, end, end])
    for one, two in zip(whole, halves):
        assert measures(spark.read.parquet(one)) == measures(spark.read.parquet(two))
    direct = summarise_held(readings, DEVICE_TAG, "ts", "value", T0, end, 21_600, 600, tiebreak=["id"])
    assert measures(spark.read.parquet(whole[0])) == measures(direct)
    assert measures(spark.read.parquet(whole[1])) == measures(rollup(direct, DEVICE_TAG, 86_400))


def test_days_without_news_are_not_written(spark, sensor_rows, tmp_path):
    readings = spark.createDataFrame(sensor_rows, READINGS)
    silver, daily = run_chain(spark, str(tmp_path), readings, [T0 + 2 * 86_400])
    before = files_of(spark, silver), files_of(spark, daily)
    run_chain(spark, str(tmp_path), readings, [T0 + 4 * 86_400])
    assert before[0] <= files_of(spark, silver) and before[1] <= files_of(spark, daily)


def test_late_readings_are_computed_again_on_demand(spark, sensor_rows, tmp_path):
    end = T0 + 4 * 86_400
    on_time = [r for r in sensor_rows if r[3] % 5]
    silver, _ = run_chain(spark, str(tmp_path), spark.createDataFrame(on_time, READINGS), [end])
    everything = spark.createDataFrame(sensor_rows, READINGS)
    again = catch_up_held(
        spark, silver, everything, DEVICE_TAG, "ts", "value", T0, end, 21_600, 600, ["id"], start=T0 + 86_400
    )
    assert again == (T0 + 86_400, end)
    # What was held at the range's start is the table's, without the late readings before it.
    before = [r for r in on_time if r[2] < START + timedelta(days=1)]
    kept = before + [r for r in sensor_rows if r[2] >= START + timedelta(days=1)]
    direct = summarise_held(
        spark.createDataFrame(kept, READINGS), DEVICE_TAG, "ts", "value", T0, end, 21_600, 600, tiebreak=["id"]
    )
    assert measures(spark.read.parquet(silver)) == measures(direct)


def test_sparse_catch_up_from_an_earlier_start(spark, sensor_rows):
    everything = spark.createDataFrame(sensor_rows, READINGS)

    def hourly(readings):
        return rollup(summarise_latest(readings, DEVICE_TAG, "ts", "value", 300, ["id"]), DEVICE_TAG, 3600)

    stale = hourly(everything.filter("id % 3 != 0"))
    done = catch_up(stale, everything, DEVICE_TAG, "ts", "value", 3600, ["id"], start=T0)
    assert measures(done) == measures(hourly(everything))
