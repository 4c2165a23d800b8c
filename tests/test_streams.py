"""Streams against their batch twins: lateness, restarts, triggers, ingest, monitoring."""

import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import session
from tidemark.operators.sketches import distinct_estimate, unite_sketches
from tidemark.plans.messages import accepted, parse_payload, rejected, split_payload
from tidemark.plans.sensors import rollup, summarise_latest
from tidemark.plans.stocks import TICK_SCHEMA, ohlc, portfolio_value, with_file_id
from tidemark.streaming import monitor
from tidemark.streaming.jobs import (
    count_users,
    each_once,
    exploded_with,
    hourly_active_users,
    new_hourly_users,
    new_users,
    windowed_totals,
)
from tidemark.streaming.sinks import (
    append_batches,
    append_compacted,
    append_keys,
    append_sketches,
    compacted,
    distinct_keys,
    for_each_batch,
    newest_batch,
    run_to_end,
    to_files,
    to_memory,
)
from tidemark.streaming.sources import csv_ingest, file_stream
from tidemark.streaming.upserts import upsert_periods

START = datetime(2024, 1, 1)
SCHEMA = "ts timestamp, source string, user string"


def write_events(spark, path, rows):
    """One file per call, appended."""
    frame = spark.createDataFrame([(START + timedelta(minutes=m), s, u) for m, s, u in rows], SCHEMA)
    frame.coalesce(1).write.mode("append").parquet(path)


@pytest.fixture
def folder(tmp_path):
    return lambda name: str(tmp_path / name)


def totals(stream):
    n = F.count(F.lit(1)).alias("n")
    return windowed_totals(stream, "ts", ["source"], "1 hour", "2 hours", n).select(
        "source", F.hour("window.start").alias("hour"), "n"
    )


def test_late_rows_are_dropped_and_counted(spark, folder):
    source, out, state = folder("in"), folder("out"), folder("state")

    def run():
        stream = file_stream(spark, source, SCHEMA, files_per_trigger=1)
        return run_to_end(to_files(totals(stream), out, state))

    write_events(spark, source, [(10, "a", "u"), (20, "a", "v"), (600, "a", "u")])
    run()
    write_events(spark, source, [(30, "a", "late"), (605, "b", "w")])
    with monitor.progress_totals(spark) as seen:
        assert seen.of(run()).rows_dropped_late == 1
    got = sorted((r.source, r.hour, r.n) for r in spark.read.parquet(out).collect())
    assert got == [("a", 0, 2)]  # hour 10 is still open, the late row is not in hour 0


def test_restart_repeats_nothing(spark, folder):
    source, out, state = folder("in"), folder("out"), folder("state")
    for minute in range(3):
        write_events(spark, source, [(minute, "a", f"u{minute}")])
        stream = file_stream(spark, source, SCHEMA, files_per_trigger=1)
        run_to_end(to_files(stream, out, state))
    users = [r.user for r in spark.read.parquet(out).collect()]
    assert sorted(users) == ["u0", "u1", "u2"]


def test_complete_mode_over_unsorted_files_equals_batch(spark, folder):
    source, exact, approx = folder("in"), folder("exact"), folder("approx")
    for minutes in ([500, 505], [1, 2, 61], [300]):
        write_events(spark, source, [(m, "a" if m % 2 else "b", f"u{m % 3}") for m in minutes])
    stream = file_stream(spark, source, SCHEMA, files_per_trigger=1)
    every = stream.groupBy("source", F.window("ts", "1 hour")).agg(F.collect_set("user").alias("users"))
    every = every.select("source", "window", F.size("users").alias("active_users"))
    run_to_end(for_each_batch(every, append_batches(exact), folder("s1"), "complete"))
    near = hourly_active_users(stream, "ts", "source", "user").orderBy("hour")
    run_to_end(for_each_batch(near, append_batches(approx), folder("s2"), "complete"))
    batch = (
        spark.read.parquet(source)
        .groupBy("source", F.window("ts", "1 hour"))
        .agg(F.count_distinct("user").alias("n"))
    )
    expected = {(r.source, r.window.start): r.n for r in batch.collect()}
    for path in (exact, approx):
        assert spark.read.parquet(path).select("batch").distinct().count() == 3
        got = {(r.source, r.window.start): r.active_users for r in newest_batch(spark, path).collect()}
        assert got == expected


def test_each_user_is_given_out_once(spark, folder):
    source, seen, out = folder("in"), [], folder("out")
    for user in ("u", "v", "u"):
        write_events(spark, source, [(0, "a", user)])
    keys = new_users(file_stream(spark, source, SCHEMA, files_per_trigger=1), "source", "user")

    def collect(batch, batch_id):
        seen.append([r.user for r in batch.collect()])
        append_batches(out)(batch, batch_id)

    run_to_end(for_each_batch(keys, collect, folder("state")))
    assert sorted(seen, key=str) == sorted([["u"], ["v"], []], key=str)
    assert [tuple(r) for r in count_users(spark.read.parquet(out), "source").collect()] == [("a", 2)]


def test_state_of_closed_hours_goes(spark, folder):
    source, out = folder("in"), folder("out")
    for hour in range(8):
        write_events(spark, source, [(60 * hour + m, "a", f"u{m}") for m in range(20)])
    stream = file_stream(spark, source, SCHEMA, files_per_trigger=1)
    keys = new_hourly_users(stream, "ts", "source", "user")
    done = run_to_end(to_files(keys, out, folder("state")))
    held = [s["numRowsTotal"] for p in done.recentProgress for s in p["stateOperators"]]
    assert spark.read.parquet(out).count() == 160
    assert held[-1] < 160 and max(held) < 160
    counted = count_users(spark.read.parquet(out), "source", "window")
    assert {r.active_users for r in counted.collect()} == {20}


def test_totals_of_more_batches_than_a_query_remembers(spark, folder):
    source = folder("in")
    rows = [(START + timedelta(minutes=m), "a", f"u{m}") for m in range(130)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(130, "user")
    frame.write.option("maxRecordsPerFile", 1).parquet(source)
    stream = file_stream(spark, source, SCHEMA, files_per_trigger=1)
    with monitor.progress_totals(spark) as seen:
        done = run_to_end(to_files(stream, folder("out"), folder("state")))
        totals_seen = seen.of(done)
    assert len(done.recentProgress) <= 100
    assert (totals_seen.rows_read, totals_seen.batches >= 130) == (130, True)


def test_a_batch_leaves_few_files_in_each_folder(spark, folder):
    out = folder("out")
    rows = spark.range(0, 3000, 1, 16).withColumn("day", F.col("id") % 30)
    handle = append_batches(out, partition_by=["day"])
    handle(rows, 0)
    first = len(spark.read.parquet(out).inputFiles())
    handle(rows, 0)
    assert first <= 60 and len(spark.read.parquet(out).inputFiles()) == first
    assert spark.read.parquet(out).count() == 3000


def test_repeated_batch_is_written_once(spark, folder):
    out = folder("out")
    handle = append_batches(out)
    batch = spark.range(4)
    handle(batch, 0)
    handle(batch, 0)
    assert spark.read.parquet(out).count() == 4


def test_memory_sink_and_management(spark, folder):
    source = folder("in")
    write_events(spark, source, [(0, "a", "u"), (1, "b", "v")])
    stream = file_stream(spark, source, SCHEMA)
    running = to_memory(stream.groupBy("source").count(), "by_source", folder("m"), every="1 second")
    try:
        assert monitor.find(spark, "by_source").id == running.id
        running.processAllAvailable()
        assert spark.table("by_source").count() == 2
        state = monitor.describe(running)
        assert state["active"] and set(state) == {"id", "name", "active", "status", "last_progress"}
        assert {"message", "isDataAvailable", "isTriggerActive"} <= set(state["status"])
    finally:
        monitor.stop_all(spark)
    assert not spark.streams.active and monitor.find(spark, "by_source") is None


def test_run_to_end_gives_up(spark, folder):
    source = folder("in")
    write_events(spark, source, [(0, "a", "u")])
    endless = to_files(file_stream(spark, source, SCHEMA), folder("o"), folder("c"), every="1 second")
    with pytest.raises(TimeoutError):
        run_to_end(endless, seconds=1)
    assert not endless.isActive


def test_explode_keeps_items_with_the_field(spark, folder):
    source = folder("in")
    schema = "id int, items array<struct<coupon: string, price: double>>"
    rows = [(1, [("K", 1.0), (None, 2.0)]), (2, []), (3, None), (4, [("L", 3.0)])]
    spark.createDataFrame(rows, schema).write.parquet(source)
    sold = exploded_with(file_stream(spark, source, schema), "items", "coupon")
    assert sold.isStreaming and sold.columns == ["id", "items"]
    run_to_end(to_files(sold, folder("o"), folder("c")))
    assert sorted(r.items.coupon for r in spark.read.parquet(folder("o")).collect()) == ["K", "L"]


def payload(**changes):
    body = {
        "deviceName": "d", "tagName": "A32", "deviceID": "1", "success": True, "datatype": "float",
        "timestamp": 1704067200123, "value": "1.5", "registerId": "r", "description": "x",
    }
    return json.dumps({**body, **changes}).encode()


def test_payloads_are_typed_and_incomplete_ones_dropped(spark):
    missing = json.dumps({"deviceName": "d"}).encode()
    values = [payload(), payload(value=None), missing, b"not json", b"", None, payload(timestamp="soon")]
    parsed = parse_payload(spark.createDataFrame([(v,) for v in values], "value binary"))
    (row,) = parsed.collect()
    assert row.timestamp == datetime(2024, 1, 1, 0, 0, 0, 123000)
    assert (row.year, row.month, row.day, row.hour, row.success) == (2024, 1, 1, 0, True)


def test_named_tick_files_to_portfolio(spark, folder):
    source, out, state = folder("ticks"), folder("out"), folder("state")
    os.makedirs(source)

    def deliver(symbol, n, prices):
        with open(f"{source}/{symbol}_{n}.csv", "w") as f:
            for i, price in enumerate(prices):
                f.write(f"{i},{10 + i},{symbol},{price},2024-01-01 10:00:{59 - i:02d}\n")

    def ingest():
        run_to_end(to_files(with_file_id(csv_ingest(spark, source, TICK_SCHEMA)), out, state))

    deliver("ACME", 1, [5.0, 9.0, 7.0])  # times run backwards: 7.0 opens
    deliver("ZETA", 1, [2.0])
    ingest()
    deliver("ZETA", 2, [3.0])
    ingest()
    ticks = spark.read.parquet(out)
    assert ticks.count() == 5 and sorted({r.file_id for r in ticks.collect()}) == [1, 2]
    bars = ohlc(ticks, ["file_id", "StockName"], "timestamp", "StockPrice", "Volume")
    bar = bars.filter("StockName = 'ACME'").first()
    assert (bar.open, bar.low, bar.high, bar.close, bar.volume) == (7.0, 5.0, 9.0, 5.0, 33)
    total = portfolio_value(bars, {"ACME": 10, "ZETA": 100}, symbol="StockName").collect()
    assert [tuple(r) for r in total] == [(1, 270.0, 250.0, 290.0, 250.0)]  # file 2 lacks a symbol


def test_state_is_off_the_heap(spark, folder):
    source, out = folder("in"), folder("out")
    write_events(spark, source, [(m, "a" if m % 3 else "b", f"u{m % 7}") for m in range(40)])
    keys = new_users(file_stream(spark, source, SCHEMA), "source", "user")
    done = run_to_end(to_files(keys, out, folder("state")))
    assert "rocksdbCommitWriteBatchLatency" in str(done.lastProgress) or "rocksdb" in str(done.lastProgress)
    counted = count_users(spark.read.parquet(out), "source")
    assert {r.source: r.active_users for r in counted.collect()} == {"a": 7, "b": 7}


# --- keys and sketches by batch, replays, rejects, upserts -----------------------------------


def test_late_users_count_in_the_files_of_keys_and_sketches(spark, folder):
    """Five files, the last five hours behind the watermark: a stream with state would drop its row."""
    source, keys, sketches, first = folder("in"), folder("keys"), folder("sketches"), folder("first")
    for rows in ([(0, "a", "u")], [(60, "a", "v")], [(300, "a", "u")], [(600, "a", "w")], [(5, "a", "late"), (601, "a", "w")]):
        write_events(spark, source, rows)

    def stream():
        events = file_stream(spark, source, SCHEMA, files_per_trigger=1)
        return events.withColumn("hour", F.date_trunc("hour", "ts"))

    run_to_end(for_each_batch(stream(), append_keys(keys, ["source", "hour", "user"]), folder("s1")))
    run_to_end(for_each_batch(stream(), append_sketches(sketches, ["source", "hour"], "user"), folder("s2")))
    with monitor.progress_totals(spark) as seen:
        late = seen.of(run_to_end(to_files(new_hourly_users(stream(), "ts", "source", "user"), first, folder("s3"))))
    batch = spark.read.parquet(source).groupBy(F.date_trunc("hour", "ts").alias("hour")).agg(F.count_distinct("user"))
    expected = sorted(map(tuple, batch.collect()))
    counted = count_users(distinct_keys(spark, keys), "hour").collect()
    assert sorted(map(tuple, counted)) == expected and expected[0][1] == 2
    united = unite_sketches(spark.read.parquet(sketches), ["hour"]).select("hour", distinct_estimate())
    assert sorted(map(tuple, united.collect())) == expected
    assert late.rows_dropped_late == 1 and spark.read.parquet(first).filter("user = 'late'").isEmpty()


def test_a_repeated_batch_of_keys_replaces_itself(spark, folder):
    rows = spark.createDataFrame([("a", "u"), ("a", "u"), ("b", None)], "source string, user string")
    for _ in range(2):
        append_keys(folder("keys"), ["source", "user"])(rows, 4)
        append_sketches(folder("sketches"), ["source"], "user")(rows, 4)
    assert sorted(map(tuple, spark.read.parquet(folder("keys")).collect()), key=str) == [("a", "u", 4), ("b", None, 4)]
    assert spark.read.parquet(folder("sketches")).count() == 2


def test_messages_sent_twice_are_kept_once_with_bounded_state(spark, folder):
    source, out, state = folder("in"), folder("out"), folder("state")
    rows_of_state = []
    for hour in range(8):
        rows = [(60 * hour + m, "a", f"u{m}") for m in range(0, 60, 5)]
        again = [(60 * (hour - 1) + m, "a", f"u{m}") for m in range(30, 60, 5)] if hour else []
        write_events(spark, source, rows + again)
        stream = file_stream(spark, source, SCHEMA, files_per_trigger=1)
        once = each_once(stream, ["source", "user", "ts"], "ts", "1 hour")
        done = run_to_end(to_files(once, out, state))
        rows_of_state.append(done.lastProgress.stateOperators[0].numRowsTotal)
    written = spark.read.parquet(out)
    assert written.count() == written.distinct().count() == 8 * 12
    # One row a key of the last hours: it does not grow with the stream, and falls when time passes.
    assert max(rows_of_state) <= 3 * 12 and rows_of_state[-1] <= rows_of_state[2]
    write_events(spark, source, [(60 * 40, "a", "end")])
    stream = file_stream(spark, source, SCHEMA, files_per_trigger=1)
    done = run_to_end(to_files(each_once(stream, ["source", "user", "ts"], "ts", "1 hour"), out, state))
    assert done.lastProgress.stateOperators[0].numRowsTotal <= 1


MESSAGE = {
    "deviceName": "d", "tagName": "t", "deviceID": "1", "success": True, "datatype": "double",
    "timestamp": 1704067200000, "value": "1.5", "registerId": "r", "description": "x",
}


def test_rejected_messages_are_kept_with_their_reason(spark, folder, capsys):
    messages = [
        json.dumps(MESSAGE),
        json.dumps({**MESSAGE, "value": None, "tagName": None}),
        json.dumps({**MESSAGE, "timestamp": "yesterday"}),
        "{" + json.dumps(MESSAGE),
        "",
        "[]",
        None,
        json.dumps({**MESSAGE, "unknown": 1}),
    ]
    frame = spark.createDataFrame([(m if m is None else bytearray(m.encode()),) for m in messages], "value binary")
    split = split_payload(frame)
    split.explain("extended")
    physical = capsys.readouterr().out.split("== Physical Plan ==")[1]
    assert physical.count("from_json") == 1
    for _ in range(2):
        append_batches(folder("out"), ["kind", "year", "month", "day"])(split, 0)
    written = spark.read.schema(split.schema).parquet(folder("out"))
    good, expected = accepted(written).drop("batch"), parse_payload(frame)
    assert sorted(good.columns) == sorted(expected.columns) and good.count() == 2
    assert sorted(map(str, good.collect())) == sorted(map(str, expected.select(good.columns).collect()))
    raws = {None if r.raw is None else bytes(r.raw).decode(): r.reason for r in rejected(written).collect()}
    assert raws == {
        messages[1]: "missing tagName value",
        messages[2]: "malformed",
        messages[3]: "malformed",
        "": "malformed",
        "[]": "malformed",
        None: "empty",
    }


def hourly_of(spark, rows):
    readings = spark.createDataFrame(rows, "device string, ts timestamp, id bigint, value double")
    return rollup(summarise_latest(readings, ["device"], "ts", "value", 300, ["id"]), ["device"], 3600)


def test_hours_merged_by_a_stream_equal_the_batch_result(spark, folder):
    """Five batches: late readings by a day, a replayed batch, a hot device, an hour split over batches."""
    batches = [
        [("a", START + timedelta(hours=h, minutes=m), 100 * h + m, float(m % 7)) for h in hours for m in range(0, 60, 4)]
        for hours in ([0, 1], [1, 2, 30], [50], [55], [56])
    ]
    batches[2] += [("a", START + timedelta(hours=1, minutes=1), 9_001, 99.0), ("b", START + timedelta(hours=2), 9_002, None)]
    batches[4] += [("a", START + timedelta(hours=30, minutes=59), 9_003, -5.0)]  # a day late
    source, readings, table = folder("in"), folder("readings"), folder("hours")
    schema = "device string, ts timestamp, id bigint, value double"
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
    handle = upsert_periods(readings, table, ["device"], "ts", "value", 3600, ["id"])
    days_written = []

    def watched(batch, batch_id):
        handle(batch, batch_id)
        files = spark.read.parquet(table).select("day", F.col("_metadata.file_name").alias("f")).distinct()
        days_written.append({(r.day, r.f) for r in files.collect()})
        if batch_id == 1:
            handle(batch, batch_id)  # sent again

    run_to_end(for_each_batch(file_stream(spark, source, schema, files_per_trigger=1), watched, folder("state")))
    assert len(days_written) == 5
    expected = hourly_of(spark, [r for rows in batches for r in rows])
    got = spark.read.parquet(table).select(expected.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
    # Replaying an old batch changes no file.
    handle(spark.createDataFrame(batches[0], schema), 0)
    files = spark.read.parquet(table).select("day", F.col("_metadata.file_name").alias("f")).distinct()
    assert {(r.day, r.f) for r in files.collect()} == days_written[-1]
    # The fourth batch is of the third day only: the files of the others stay.
    third = (START + timedelta(days=2)).date()
    assert {x for x in days_written[2] if x[0] != third} == {x for x in days_written[3] if x[0] != third}


def test_batches_are_moved_into_few_files(spark, folder):
    """Five batches, every second one moves them; the last batch and the one before are sent again."""
    source, path = folder("in"), folder("out")
    rows = [[(60 * i + m, "a" if m % 2 else "b", f"u{i}{m}") for m in range(6)] for i in range(5)]
    for batch in rows:
        write_events(spark, source, batch)
    handle = append_compacted(path, ["source"], every=2, cluster_by=["user"])
    seen = {}

    def watched(batch, batch_id):
        for _ in range(2):
            handle(batch, batch_id)
        seen[batch_id] = compacted(spark, path, stream.schema).count()

    stream = file_stream(spark, source, SCHEMA, files_per_trigger=1)
    run_to_end(for_each_batch(stream, watched, folder("state")))
    assert seen == {i: 6 * (i + 1) for i in range(5)}
    got = compacted(spark, path, stream.schema)
    assert sorted(r.user for r in got.collect()) == sorted(f"u{i}{m}" for i in range(5) for m in range(6))
    whole = spark.read.parquet(f"{path}/whole")
    assert whole.select("source", "_metadata.file_name").distinct().count() == 2 and whole.count() == 24
    # A batch that is sent again after it was moved comes back neither twice nor in the recent ones.
    handle(spark.read.schema(SCHEMA).parquet(source).filter("user LIKE 'u3%'"), 3)
    assert compacted(spark, path, stream.schema).count() == 30


def test_scratch_is_removed(spark, folder, monkeypatch):
    monkeypatch.setattr(session, "shared_folder", lambda _: folder("shared"))
    files = session.stored(spark.range(10), "numbers").inputFiles()
    assert all(os.path.exists(f.removeprefix("file://")) for f in files)
    session.clear_scratch(spark)
    assert not any(os.path.exists(f.removeprefix("file://")) for f in files)
