"""Live state, in batch and as a stream, and job metrics."""

import json
import os
import random
import time

from pyspark.sql import functions as F

from hailstat.operators import monitor, tracks
from hailstat.sources import lines
from hailstat.streaming import jobs, topics

EVENTS = "seq bigint, order_id string, driver_id string, ts bigint, lng double, lat double, is_end boolean"


def point(seq, order, ts, lng=110.0, lat=20.0):
    return (seq, order, "d", ts, lng, lat, False)


def end(seq, order):
    return (seq, order, None, None, None, None, True)


def events(spark, *rows):
    return spark.createDataFrame(list(rows), EVENTS)


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_span_with_late_points_and_ties(spark):
    gps = events(
        spark, point(1, "o", 100, 1.0), point(2, "o", 300, 2.0), point(3, "o", 50, 3.0), point(4, "o", 300, 4.0),
        point(5, "o", 50, 5.0), point(6, "o", 200, 6.0), end(7, "o"), end(8, "unknown"),
    )
    expected = {("075", "o", 50000, 300000, 20.0, 3.0, 20.0, 2.0)}
    assert as_set(tracks.order_span(gps)) == expected
    assert as_set(tracks.span_of(tracks.order_state(gps))) == expected


def test_live_orders(spark):
    gps = events(
        spark, point(1, "running", 1), point(2, "done", 1), end(3, "done"), point(4, "again", 1), end(5, "again"),
        point(6, "again", 2), end(7, "unknown"),
    )
    expected = {("075_running", "running"), ("075_again", "again")}
    assert as_set(tracks.live_orders(gps)) == expected
    assert as_set(tracks.live_of(tracks.order_state(gps))) == expected


def test_hour_counts_take_the_first_arrival(spark):
    gps = events(
        spark, point(1, "a", 10 * 3600 + 3540), point(2, "a", 11 * 3600 + 60), point(3, "b", 11 * 3600),
        point(4, "b", 10 * 3600), end(5, "c"),
    )
    expected = {("1970-01-01", 10, 1), ("1970-01-01", 11, 1)}
    assert as_set(tracks.hour_counts(gps)) == expected
    assert as_set(tracks.hour_counts_of(tracks.order_state(gps))) == expected
    assert as_set(tracks.hour_board(tracks.hour_counts(gps), "1970-01-01")) == {
        ("075_1970-01-01_10", 1), ("075_1970-01-01_11", 1),
    }


def test_overview_falls_back_to_stored_counts(spark):
    hours = spark.createDataFrame([("d1", 1, 2), ("d1", 2, 3)], "day string, hour int, order_count bigint")
    stored = spark.createDataFrame([("d1", 9, 4), ("d2", 7, 5)], "day string, order_count bigint, passenger_count bigint")
    assert as_set(tracks.overview(hours, stored)) == {("d1", 5, 4), ("d2", 7, 5)}


def test_point_store_keeps_the_last_arrival(spark):
    gps = events(spark, point(1, "o", 100, 1.0), point(2, "o", 100, 2.0), point(3, "o", 101, 3.0))
    stored = tracks.point_store(gps)
    assert as_set(stored.select("rowkey", "time", "lng")) == {
        ("o_100", "1970-01-01 00:01:40", 2.0), ("o_101", "1970-01-01 00:01:41", 3.0),
    }
    assert tracks.query_points(stored).count() == 2
    assert tracks.query_points(stored, start="1970-01-01 00:01:41").count() == 1
    assert tracks.query_points(stored, end="1970-01-01 00:01:40", city="075", brief=True).columns == ["time", "lng", "lat"]
    assert tracks.query_points(stored, city="076").count() == 0


def test_feed_in_arrival_order(spark):
    gps = events(spark, point(2, "o", 100, 1.0), point(1, "o", 200, 2.0), end(3, "o"), point(4, "p", 1))
    feed = [(r["seq"], r["message"]) for r in tracks.track_feed(gps).where("order_id = 'o'").collect()]
    assert feed == [(1, "2.0,20.0"), (2, "1.0,20.0"), (3, "end")]
    wanted = spark.createDataFrame([("o",), ("silent",)], "order_id string")
    assert {(r["order_id"], r["message"]) for r in tracks.feed_for(wanted, gps).collect()} == {
        ("o", "2.0,20.0"), ("o", "1.0,20.0"), ("o", "end"), ("silent", "none"),
    }
    assert as_set(tracks.latest_point(gps)) == {("o", 1.0, 20.0), ("p", 110.0, 20.0)}


def test_track_includes_both_bounds(spark):
    gps = events(spark, *[point(i, "o", 100 + i) for i in range(5)], point(9, "p", 102))
    assert [r["ts"] for r in tracks.track(gps, "o", 101, 103).collect()] == [101, 102, 103]
    spans = tracks.order_span(gps)
    assert tracks.span_track(gps, spans).count() == 6


def _random_lines(seed):
    rng = random.Random(seed)
    out = []
    for seq in range(600):
        order = f"o{rng.choice([0, 0, 0, 1, 2, 3, 4, 5, 6, 7])}"
        if rng.random() < 0.1:
            out.append((seq, f"end,{order}"))
        else:
            ts = 1704067200 + rng.randrange(0, 100000, 50)
            out.append((seq, f"d{seq % 3},{order},{ts},{110 + rng.randrange(999) / 1000},{20 + rng.randrange(999) / 1000}"))
    return out


def test_states_of_parts_fold_into_the_whole(spark):
    gps = lines.parse_gps_events(spark.createDataFrame(_random_lines(1), "seq bigint, value string"))
    parts = [tracks.order_state(gps.where(F.col("seq") % 4 == k)) for k in (2, 0, 3, 1, 1)]
    folded = parts[0]
    for part in parts[1:]:
        folded = tracks.merge_states(folded.unionByName(part))
    assert as_set(folded) == as_set(tracks.order_state(gps))


def test_stream_equals_batch_in_any_file_order(spark, tmp_path):
    data = _random_lines(2)
    chunks = [data[i::5] for i in range(5)]
    random.Random(3).shuffle(chunks)
    source = str(tmp_path / "in")
    for chunk in chunks:
        spark.createDataFrame(chunk, "seq bigint, value string").coalesce(1).write.mode("append").parquet(source)
    batch = spark.read.parquet(source)

    def stream():
        return topics.read_files(spark, source, "seq bigint, value string", max_files=1)

    states = str(tmp_path / "states")
    query = jobs.state_stream(stream(), states, str(tmp_path / "c1"), once=True)
    query.awaitTermination()
    gps = lines.parse_gps_events(batch)
    live = jobs.read_states(spark, states)
    assert as_set(tracks.span_of(live)) == as_set(tracks.order_span(gps))
    assert as_set(tracks.live_of(live)) == as_set(tracks.live_orders(gps))
    assert as_set(tracks.hour_counts_of(live)) == as_set(tracks.hour_counts(gps))

    report = jobs.batch_report(spark, query).collect()
    assert sum(r["records"] for r in report) == len(data) and max(r["finished_batches"] for r in report) == 5

    before = as_set(live)
    jobs.compact_states(spark, states, ["0", "1", "2"], "to-2")
    assert as_set(jobs.read_states(spark, states)) == before
    jobs.drop_folders(spark, states, ["0", "1", "2"])
    assert as_set(jobs.read_states(spark, states)) == before
    jobs.compact_states(spark, states, ["to-2", "3", "4"], "to-4")
    jobs.drop_folders(spark, states, ["to-2", "3", "4"])
    assert as_set(jobs.read_states(spark, states)) == before

    points = str(tmp_path / "points")
    jobs.point_stream(stream(), points, str(tmp_path / "c2"), once=True).awaitTermination()
    stored = tracks.point_store(jobs.read_points(spark, points))
    assert as_set(stored) == as_set(tracks.point_store(lines.parse_gps_points(batch)))


def test_one_consumer_writes_all_and_survives_a_half_written_batch(spark, tmp_path):
    order = "\t".join(["o9", *["x"] * 11, "2024-01-01 00:00:00", *["x"] * 11])
    data = [*_random_lines(4), (700, "d,o,9000000000000000000,110.1,19.9"), (701, "junk"), (702, order), (703, order), (704, "a\tb")]
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    for chunk in (data[:300], data[300:]):
        spark.createDataFrame(chunk, "seq bigint, value string").coalesce(1).write.mode("append").parquet(source)
    # A batch that was cut off while it was written: another table's folder is there, its own is stale.
    spark.createDataFrame(data[:10], "seq bigint, value string").select("seq", "value").write.parquet(f"{root}/rejects/batch=0")
    stream = topics.read_files(spark, source, "seq bigint, value string", max_files=1)
    jobs.gps_stream(stream, root, str(tmp_path / "check"), once=True).awaitTermination()
    whole = spark.createDataFrame(data, "seq bigint, value string")
    assert as_set(tracks.span_of(jobs.read_states(spark, f"{root}/states"))) == as_set(
        tracks.order_span(lines.parse_gps_events(whole.where("seq < 700")))
    )
    assert as_set(tracks.point_store(jobs.read_points(spark, f"{root}/points"))) == as_set(
        tracks.point_store(lines.parse_gps_points(whole.where("seq < 700")))
    )
    assert {r["seq"] for r in spark.read.parquet(f"{root}/rejects").collect()} == {700, 701, 704}
    assert [(r["row_key"], r["seq"]) for r in jobs.read_order_lines(spark, f"{root}/orders").collect()] == [("o9_20240101000000", 703)]


def test_change_stream_restarts_from_its_checkpoint(spark, tmp_path):
    def change(id_, ts, pay, type_="insert"):
        return json.dumps({"table": "order_info_201907", "type": type_, "ts": ts,
                           "data": {"id_": id_, "create_time": "2019-07-15 10:00:00", "pay_all": pay}})

    source, root, checkpoint = (str(tmp_path / n) for n in ("in", "tables", "check"))

    def deliver(*changes, first):
        data = [(first + i, c) for i, c in enumerate(changes)]
        spark.createDataFrame(data, "seq bigint, value string").coalesce(1).write.mode("append").parquet(source)
        stream = topics.read_files(spark, source, "seq bigint, value string")
        jobs.change_stream(stream, root, checkpoint, once=True).awaitTermination()
        stored = jobs.read_changes(spark, root, "order_info")
        return {(r["id"], r["pay_all"]) for r in stored.collect()}

    assert deliver(change("1", 1, 1.0), change("2", 5, 2.0), first=0) == {("1", 1.0), ("2", 2.0)}
    assert deliver(change("1", 2, 3.0, "update"), change("2", 9, 9.0, "delete"), change("2", 4, 7.0), first=2) == {
        ("1", 3.0), ("2", 2.0),
    }


def test_continuous_run(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "states")
    spark.createDataFrame(_random_lines(4), "seq bigint, value string").write.parquet(source)
    stream = topics.read_files(spark, source, "seq bigint, value string")
    query = jobs.state_stream(stream, out, str(tmp_path / "check"))
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    gps = lines.parse_gps_events(spark.read.parquet(source))
    assert as_set(tracks.span_of(jobs.read_states(spark, out))) == as_set(tracks.order_span(gps))


def test_kafka_columns(spark):
    sent = [(0, 1048575, 1700000000000), (0, 1048576, 1700000000000), (1, 1048576, 1700000000000), (0, 3, 1700000000001)]
    records = spark.createDataFrame(sent, "partition int, offset bigint, ms bigint").select(
        F.lit("gps_topic").alias("topic"), "partition", "offset", F.timestamp_millis("ms").alias("timestamp"), F.lit(b"line").alias("value")
    )
    seqs = [r["seq"] for r in topics.from_kafka(records).collect()]
    assert seqs == sorted(set(seqs))


def test_progress_log_keeps_every_report(spark, tmp_path):
    source, out = str(tmp_path / "source"), str(tmp_path / "progress")
    spark.range(3).selectExpr("id seq", "'x' value").repartition(3).write.parquet(source)
    log = jobs.ProgressLog(spark, out)
    spark.streams.addListener(log)
    try:
        stream = topics.read_files(spark, source, "seq bigint, value string", max_files=1)
        query = jobs.start(stream, lambda batch, batch_id: batch.count(), str(tmp_path / "check"), once=True, name="kept")
        query.awaitTermination()
        deadline = time.time() + 30
        while time.time() < deadline and (not os.path.exists(out) or jobs.read_progress(spark, out).count() < 3):
            time.sleep(0.5)
    finally:
        spark.streams.removeListener(log)
    assert jobs.read_progress(spark, out).where("value like '%\"name\" : \"kept\"%' or value like '%\"name\":\"kept\"%'").count() >= 3


SNAPSHOT = (
    "ts bigint, failedStages int, runningStages int, waitingStages int, runningBatches int, waitingBatches int, "
    "totalCompletedBatches int, maxMem_MB int, memUsed_MB int, remainingMem_MB int"
)


def test_health_ratios(spark):
    df = spark.createDataFrame([(1, *[0] * 9), (2, 1, 2, 1, 0, 0, 3, 300, 100, 200)], SNAPSHOT)
    got = {r["ts"]: tuple(r)[1:] for r in monitor.health_ratios(df).collect()}
    assert got[1] == (0.0,) * 9
    assert got[2] == (25.0, 50.0, 25.0, 0.0, 0.0, 100.0, 33.33, 66.67, 100.0)
    many = spark.createDataFrame([(i, *[1] * 9) for i in range(9)], SNAPSHOT)
    assert sorted(r["ts"] for r in monitor.health_board(many).collect()) == [4, 5, 6, 7, 8]


def test_batch_alarm(spark):
    def report(batch, took):
        return (json.dumps({"name": "q", "batchId": batch, "timestamp": "2024-01-01T00:00:00.000Z", "numInputRows": 5,
                            "durationMs": {"triggerExecution": took, "addBatch": took - 10}}),)

    out = monitor.batch_metrics(spark.createDataFrame([report(0, 6000), report(1, 6001)], "value string"), 1000)
    assert {(r["batch_id"], r["blocked"], r["schedule_delay"], r["finished_batches"]) for r in out.collect()} == {
        (0, False, 10, 1), (1, True, 10, 2),
    }


def test_task_metrics_of_a_real_event_log(spark, tmp_path):
    """Lines of the layout that Spark writes, with other events in between."""
    ended = {"Event": "SparkListenerTaskEnd", "Stage ID": 1, "Task Info": {"Task ID": 4, "Host": "h", "Finish Time": 9,
             "Failed": False, "Killed": False, "Speculative": False},
             "Task Metrics": {"Executor CPU Time": 11, "Memory Bytes Spilled": 12, "Result Serialization Time": 13,
                              "Shuffle Read Metrics": {"Remote Bytes Read": 14}, "Input Metrics": {"Bytes Read": 15}}}
    later = json.loads(json.dumps(ended))
    later["Task Info"].update({"Task ID": 5, "Finish Time": 10})
    log = spark.createDataFrame(
        [(json.dumps(e),) for e in ({"Event": "SparkListenerJobStart"}, ended, later)], "value string"
    )
    tasks = monitor.task_metrics(log)
    assert tasks.count() == 2
    last = monitor.last_task(tasks).first()
    assert (last["task_id"], last["executor_cpu_time"], last["memory_bytes_spilled"]) == (5, 11, 12)
    assert (last["result_serialization_time"], last["remote_bytes_read"], last["input_bytes"]) == (13, 14, 15)
