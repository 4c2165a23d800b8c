"""Gap filling and rollups against plain Python on small frames."""

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions.numbers import parse_reading
from tidemark.functions.times import label_bucket, stamp
from tidemark.operators.windows import latest_per_slot
from tidemark.plans import sensors
from tidemark.plans.sensors import (
    catch_up,
    epoch,
    grid,
    latest_descriptions,
    pending_windows,
    rollup,
    summarise_held,
    summarise_latest,
    upsert_rollup,
    upsert_tags,
    whole_periods,
)
from tidemark.session import stored

START = datetime(2024, 1, 1)
T0 = epoch("2024-01-01 00:00:00")
SCHEMA = "device string, tag string, ts timestamp, id bigint, value double"
KEYS = ["device", "tag"]


def at(seconds):
    return START + timedelta(seconds=seconds)


def brute_force(rows, n_windows, per_window, previous=None):
    """Dense grid, seeded, filled and summarised as the definition reads. Slots of 1 s."""
    last = {}
    for device, tag, ts, rid, value in rows:
        slot = (ts - START) // timedelta(seconds=1)
        if 0 <= slot < n_windows * per_window:
            key = (device, tag, slot)
            if key not in last or (ts, rid) > last[key][0]:
                last[key] = ((ts, rid), value)
    first_window = {}
    for device, tag, slot in last:
        key = (device, tag)
        first_window[key] = min(first_window.get(key, n_windows), slot // per_window)
    for key in previous or {}:
        first_window[key] = 0
    expected = {}
    for key, w0 in first_window.items():
        held = (previous or {}).get(key)
        held = 0.0 if held is None else held
        for w in range(w0, n_windows):
            filled = []
            for slot in range(w * per_window, (w + 1) * per_window):
                value = last.get((*key, slot), (None, None))[1]
                held = held if value is None else value
                filled.append(held)
            counts = Counter(filled)
            expected[(*key, w)] = (
                filled[0],
                filled[-1],
                min(filled),
                max(filled),
                max(counts, key=lambda v: (counts[v], v)),
                round(sum(filled) / per_window, 9),
            )
    return expected


def summarised(spark, rows, n_windows, per_window, previous=None):
    state = None
    if previous is not None:
        state = spark.createDataFrame(
            [(*k, v) for k, v in previous.items()], "device string, tag string, value double"
        )
    result = summarise_held(
        spark.createDataFrame(rows, SCHEMA),
        KEYS,
        "ts",
        "value",
        T0,
        T0 + n_windows * per_window,
        per_window,
        previous=state,
        tiebreak=["id"],
    )
    return {
        (r.device, r.tag, int((r.window_end - START).total_seconds()) // per_window - 1): (
            r.first_value,
            r.last_value,
            r.min_value,
            r.max_value,
            r.mode_value,
            round(r.avg_value, 9),
        )
        for r in result.collect()
    }


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_readings_equal_the_dense_grid(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(200):
        device = rng.choice(["hot", "hot", "hot", "b", "c"])
        value = rng.choice([None, 1.0, 2.0, 3.5, -1.0])
        rows.append((device, rng.choice(["x", "y"]), at(rng.uniform(-20, 320)), i, value))
    previous = {("hot", "x"): 7.0, ("gone", "x"): 4.0, ("void", "y"): None}
    assert summarised(spark, rows, 5, 60, previous) == brute_force(rows, 5, 60, previous)
    assert summarised(spark, rows, 5, 60) == brute_force(rows, 5, 60)


def test_five_minute_window_of_seconds(spark):
    rows = [
        ("a", "x", at(0.2), 1, 1.0),
        ("a", "x", at(0.9), 2, 2.0),  # same second: the later reading counts
        ("a", "x", at(100), 3, 5.0),
        ("b", "x", at(299), 4, 9.0),
    ]
    got = summarised(spark, rows, 1, 300, {("c", "x"): 3.0})
    assert got[("a", "x", 0)] == (2.0, 5.0, 2.0, 5.0, 5.0, round((2 * 100 + 5 * 200) / 300, 9))
    assert got[("b", "x", 0)] == (0.0, 9.0, 0.0, 9.0, 0.0, round(9 / 300, 9))
    assert got[("c", "x", 0)] == (3.0, 3.0, 3.0, 3.0, 3.0, 3.0)


def test_key_with_only_null_readings_holds_zero(spark):
    rows = [("a", "x", at(70), 1, None)]
    assert summarised(spark, rows, 3, 60) == {
        ("a", "x", 1): (0.0,) * 6,
        ("a", "x", 2): (0.0,) * 6,
    }


def test_mode_tie_goes_to_the_larger_value(spark):
    rows = [("a", "x", at(0), 1, 4.0), ("a", "x", at(5), 2, 3.0)]
    assert summarised(spark, rows, 1, 10)[("a", "x", 0)][4] == 4.0


def test_one_job_equals_a_chain_of_windows(spark):
    rng = random.Random(9)
    rows = [(rng.choice("ab"), "x", at(rng.uniform(0, 240)), i, rng.choice([1.0, 2.0])) for i in range(30)]
    whole = summarised(spark, rows, 4, 60)
    chained, state = {}, None
    for w in range(4):
        frame = spark.createDataFrame(rows, SCHEMA)
        step = summarise_held(
            frame, KEYS, "ts", "value", T0 + 60 * w, T0 + 60 * (w + 1), 60, previous=state, tiebreak=["id"]
        ).collect()
        for r in step:
            chained[(r.device, r.tag, w)] = r.last_value
        state = spark.createDataFrame(
            [(r.device, r.tag, r.last_value) for r in step], "device string, tag string, value double"
        )
    assert chained == {k: v[1] for k, v in whole.items()}


def test_range_must_hold_whole_windows(spark):
    frame = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError):
        summarise_held(frame, KEYS, "ts", "value", T0, T0 + 100, 60)


def test_empty_input(spark):
    assert summarised(spark, [], 2, 60) == {}


def test_reading_text(spark):
    texts = [("12.5", 12.5), ("true", 1.0), ("False", 0.0), ("abc", None), (None, None), ("7", 7.0), ("", None)]
    frame = spark.createDataFrame(texts, "text string, expected double")
    for row in frame.withColumn("got", parse_reading(F.col("text"))).collect():
        assert row.got == row.expected


def test_boundary_stamp_belongs_to_the_period_it_closes(spark):
    frame = spark.createDataFrame([(datetime(2024, 1, 1, 10),), (datetime(2024, 1, 1, 10, 0, 1),)], "ts timestamp")
    rows = frame.select(
        stamp(label_bucket(F.col("ts"), 3600, "start")), stamp(label_bucket(F.col("ts"), 3600, "end"))
    ).collect()
    assert [tuple(r) for r in rows] == [
        ("2024-01-01 09:00:00", "2024-01-01 10:00:00"),
        ("2024-01-01 10:00:00", "2024-01-01 11:00:00"),
    ]
    with pytest.raises(ValueError):
        label_bucket(F.col("ts"), 3600, "middle")


SUMMARY = (
    "devicetag string, window_end timestamp, first_value double, last_value double, min_value double, "
    "max_value double, mode_value double, avg_value double"
)


def test_rollup(spark):
    rows = [
        ("a~x", datetime(2024, 1, 1, 9, 5), 1.0, 2.0, 0.0, 3.0, 5.0, 1.0),
        ("a~x", datetime(2024, 1, 1, 9, 30), 4.0, 5.0, -1.0, 9.0, 6.0, 2.0),
        ("a~x", datetime(2024, 1, 1, 10, 0), 7.0, 8.0, 1.0, 4.0, None, 6.0),
        ("a~x", datetime(2024, 1, 1, 10, 5), 1.5, 1.5, 1.5, 1.5, 1.5, 1.5),
        ("a~x", datetime(1969, 1, 1), 99.0, 99.0, 99.0, 99.0, 99.0, 99.0),
        ("a~x", datetime(2400, 1, 1), 99.0, 99.0, 99.0, 99.0, 99.0, 99.0),
    ]
    got = rollup(spark.createDataFrame(rows, SUMMARY), ["devicetag"], 3600).orderBy("window_end").collect()
    assert [tuple(r) for r in got] == [
        ("a~x", datetime(2024, 1, 1, 10), 1.0, 8.0, -1.0, 9.0, 6.0, 3.0),
        ("a~x", datetime(2024, 1, 1, 11), 1.5, 1.5, 1.5, 1.5, 1.5, 1.5),
    ]


def test_rollup_mode_null_loses_a_tie_but_wins_by_count(spark):
    def row(minute, mode):
        return ("a~x", datetime(2024, 1, 1, 9, minute), 1.0, 1.0, 1.0, 1.0, mode, 1.0)

    def mode_of(*modes):
        frame = spark.createDataFrame([row(i + 1, m) for i, m in enumerate(modes)], SUMMARY)
        return rollup(frame, ["devicetag"], 3600).first().mode_value

    assert mode_of(None, 2.0) == 2.0
    assert mode_of(None, None, 2.0) is None


def test_upsert_rollup_replaces_and_adds(spark):
    old = [("a~x", datetime(2024, 1, 1, h), 1.0, 1.0, 1.0, 1.0, 1.0, 1.0) for h in (9, 10)]
    new = [("a~x", datetime(2024, 1, 1, h), 2.0, None, 2.0, 2.0, 2.0, 2.0) for h in (10, 11)]
    merged = upsert_rollup(
        spark.createDataFrame(old, SUMMARY), spark.createDataFrame(new, SUMMARY), ["devicetag"]
    )
    got = {r.window_end.hour: (r.first_value, r.last_value) for r in merged.collect()}
    assert got == {9: (1.0, 1.0), 10: (2.0, None), 11: (2.0, None)}


def test_sparse_summary_takes_the_last_reading_and_a_mode_of_the_run(spark):
    rows = [
        ("a", "x", at(10), 1, 1.0),
        ("a", "x", at(20), 2, 4.0),
        ("a", "x", at(310), 3, 4.0),
        ("a", "x", at(700), 4, 6.0),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = summarise_latest(frame, KEYS, "ts", "value", 300, ["id"]).orderBy("window_end").collect()
    assert [(r.window_end, r.last_value, r.mode_value) for r in got] == [
        (at(300), 4.0, 4.0),
        (at(600), 4.0, 4.0),
        (at(900), 6.0, 6.0),
    ]
    long_run = summarise_latest(frame, KEYS, "ts", "value", 300, ["id"], run_seconds=86_400)
    assert {r.mode_value for r in long_run.collect()} == {4.0}
    with pytest.raises(ValueError):
        summarise_latest(frame, KEYS, "ts", "value", 300, ["id"], run_seconds=500)


def test_one_sparse_job_equals_a_chain_of_runs(spark):
    rows = [("a", "x", at(i * 97), i, float(i % 3)) for i in range(60)]
    frame = spark.createDataFrame(rows, SCHEMA)
    whole = summarise_latest(frame, KEYS, "ts", "value", 300, ["id"], run_seconds=900)
    chain = []
    for start in range(0, 60 * 97, 900):
        inside = frame.filter((F.col("ts") >= F.lit(at(start))) & (F.col("ts") < F.lit(at(start + 900))))
        chain += summarise_latest(inside, KEYS, "ts", "value", 300, ["id"], run_seconds=900).collect()
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, chain))


def test_two_half_runs_equal_one_run_and_read_only_their_range(spark, tmp_path, monkeypatch):
    rng = random.Random(12)
    rows = [(rng.choice("ab"), "x", at(rng.randint(0, 40_000)), i, rng.random()) for i in range(400)]
    path = str(tmp_path / "readings")
    spark.createDataFrame(rows, SCHEMA).write.parquet(path)
    frame = spark.read.parquet(path)
    early = frame.filter(F.col("ts") < F.lit(at(19_000)))
    empty = rollup(summarise_latest(frame, KEYS, "ts", "value", 300, ["id"]), KEYS, 3600).limit(0)
    half = catch_up(empty, early, KEYS, "ts", "value", 3600, ["id"])
    half.write.parquet(str(tmp_path / "half"))
    full = catch_up(spark.read.parquet(str(tmp_path / "half")), frame, KEYS, "ts", "value", 3600, ["id"])
    whole = rollup(summarise_latest(frame, KEYS, "ts", "value", 300, ["id"]), KEYS, 3600)
    assert sorted(map(tuple, full.collect())) == sorted(map(tuple, whole.collect()))
    # The pending rows are stored; their own plan shows the range that is read.
    plans = []

    def shown(frame, label):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return stored(frame, label)

    monkeypatch.setattr(sensors, "stored", shown)
    catch_up(spark.read.parquet(str(tmp_path / "half")), frame, KEYS, "ts", "value", 3600, ["id"])
    assert len(plans) == 1 and "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in plans[0]


def test_ranges_follow_the_data(spark):
    stamps = [(datetime(2023, 5, 3, 7),), (datetime(2024, 3, 9, 23, 59, 59),)]
    frame = spark.createDataFrame(stamps, "ts timestamp_ntz")
    start, end = whole_periods(frame, "ts", 86_400)
    assert (start, end) == (epoch("2023-05-03 00:00:00"), epoch("2024-03-10 00:00:00"))
    assert whole_periods(frame.limit(0), "ts", 86_400) == (0, 0)


def test_pending_windows(spark):
    target = spark.createDataFrame([(datetime(2024, 1, 1, 3),), (datetime(2500, 1, 1),)], "ts timestamp")
    args = ("ts", datetime(2024, 1, 1), datetime(2024, 1, 1, 5, 30), 3600)
    got = pending_windows(target, *args).orderBy("window_end").collect()
    assert [r.window_end.hour for r in got] == [4, 5]
    assert pending_windows(target.limit(0), *args).count() == 5
    late = pending_windows(target, "ts", datetime(2024, 1, 1), datetime(2024, 1, 1, 3, 59), 3600)
    assert late.count() == 0


def test_latest_descriptions_and_partial_upsert(spark):
    schema = "device string, tag string, ts timestamp, text string"
    first = spark.createDataFrame([("a", "x", at(0), "old"), ("a", "x", at(5), "new")], schema)
    second = spark.createDataFrame([("b", "x", at(0), "bee")], schema)
    tags = [latest_descriptions(f, KEYS, "ts", "text") for f in (first, second)]
    target = spark.createDataFrame(
        [("A", "X", "stale", "a~x"), ("z", "x", "kept", "z~x")],
        "device string, tag string, description string, devicetag string",
    )
    got = {r.devicetag: (r.device, r.description) for r in upsert_tags(target, *tags).collect()}
    assert got == {"a~x": ("A", "new"), "z~x": ("z", "kept"), "b~x": ("b", "bee")}
    later = spark.createDataFrame([("a", "x", at(9), "newest"), ("b", "x", at(-9), "older")], schema)
    both = [*tags, latest_descriptions(later, KEYS, "ts", "text")]
    got = {r.devicetag: r.description for r in upsert_tags(target, *both).collect()}
    assert got == {"a~x": "newest", "z~x": "kept", "b~x": "bee"}


def test_grid_and_slots(spark):
    frame = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y")], "device string, tag string")
    assert grid(frame, KEYS, 0, 9).count() == 20
    readings = spark.createDataFrame([("a", "x", at(1.5), 1, 1.0), ("a", "x", at(1.7), 2, None)], SCHEMA)
    (row,) = latest_per_slot(readings, KEYS, "ts", "value", 1, ["id"]).collect()
    assert row.slot == T0 + 1 and row.value is None
