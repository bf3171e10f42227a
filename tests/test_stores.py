"""Stores that are read in part, written by appending, and placed by task; snapshots of an event log."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from hailstat.functions import keys
from hailstat.operators import monitor, snapshots, tracks
from hailstat.sources import lines, tables, track_store

EVENTS = "seq bigint, order_id string, driver_id string, ts bigint, lng double, lat double, is_end boolean"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def as_set(df):
    return {tuple(r) for r in df.collect()}


def random_events(spark, seed=1, rows=400):
    pick = random.Random(seed)
    out = []
    for seq in range(rows):
        order = f"o{pick.randrange(20)}"
        if pick.random() < 0.1:
            out.append((seq, order, None, None, None, None, True))
        else:
            out.append((seq, order, "d", 1704067200 + pick.randrange(0, 3 * 86400), 110 + seq / 1000, 20.0, False))
    return spark.createDataFrame(out, EVENTS)


def test_one_order_is_read_from_its_bucket(spark, tmp_path):
    events, path = random_events(spark), str(tmp_path / "tracks")
    track_store.append_events(events.where("seq < 200"), path)
    track_store.append_events(events.where("seq >= 200"), path)
    stored = track_store.read_events(spark, path)
    start, end = 1704067200 + 86400, 1704067200 + 2 * 86400 - 1
    for order in ("o3", "o7", "silent"):
        whole = [tuple(r) for r in tracks.track(events, order).collect()]
        assert [tuple(r) for r in track_store.track_of(stored, order).collect()] == whole
        part = [tuple(r) for r in tracks.track(events, order, start, end).collect()]
        assert [tuple(r) for r in track_store.track_of(stored, order, start, end).collect()] == part
        feed = [tuple(r) for r in tracks.track_feed(events.where(F.col("order_id") == order)).collect()]
        assert [tuple(r) for r in track_store.feed_of(stored, order).collect()] == feed
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        bounded = track_store.track_of(stored, "o3", start, end)
        plan = plan_of(bounded)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    bucket = spark.range(1).select(track_store.bucket_of(F.lit("o3"))).first()[0]
    scanned = re.search(r"PartitionFilters: \[([^\]]*)\]", plan)[1]
    assert "Exchange" not in plan and re.search(rf"\(bucket#\d+ = {bucket}\)", scanned) and ">= 2024-01-02" in scanned and "<= 2024-01-02" in scanned
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(order_id,o3\)", plan)


DDL = "key string, day string, ts bigint, v string"


def test_appended_changes_fold_to_the_newest(spark, tmp_path):
    path, schema = str(tmp_path / "t"), spark.createDataFrame([], DDL).schema

    def put(*data):
        tables.append_changes(spark.createDataFrame(list(data), DDL), path, ["key"], ["ts"], "day")

    def stored(*paths):
        return as_set(tables.read_newest(spark, paths or [path], schema, ["key"], ["ts"]))

    put(("a", "d1", 1, "x"), ("b", "d1", 1, "x"), ("c", "d2", 1, "x"), ("c", "d2", 0, "older"))
    first = stored()
    put(("a", "d1", 2, "y"), ("b", "d1", 0, "old"), ("e", "d3", 1, "z"))
    expected = {("a", "d1", 2, "y"), ("b", "d1", 1, "x"), ("c", "d2", 1, "x"), ("e", "d3", 1, "z")}
    assert stored() == expected and first == {("a", "d1", 1, "x"), ("b", "d1", 1, "x"), ("c", "d2", 1, "x")}
    put(("a", "d1", 2, "y"), ("e", "d3", 1, "z"))
    assert stored() == expected
    folded = str(tmp_path / "folded")
    tables.compact_changes(spark, [path], folded, schema, ["key"], ["ts"], "day")
    assert stored(folded) == expected and stored(path, folded) == expected


def test_a_killed_write_loses_nothing(spark, tmp_path):
    path, schema = str(tmp_path / "t"), spark.createDataFrame([], DDL).schema
    good = [(f"k{i}", f"d{i % 3}", 1, "x") for i in range(50)]
    tables.append_changes(spark.createDataFrame(good, DDL), path, ["key"], ["ts"], "day")
    second = spark.createDataFrame([(f"k{i}", f"d{i % 3}", 2, "y") for i in range(50)], DDL)
    broken = second.withColumn("v", F.when(F.col("key") == "k49", F.raise_error(F.lit("killed"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="killed"):
        tables.append_changes(broken, path, ["key"], ["ts"], "day")
    assert as_set(tables.read_newest(spark, [path], schema, ["key"], ["ts"])) == set(good)
    tables.append_changes(second, path, ["key"], ["ts"], "day")
    assert {r[2] for r in as_set(tables.read_newest(spark, [path], schema, ["key"], ["ts"]))} == {2}


@pytest.mark.parametrize("splits", [1, 3])
def test_no_task_holds_two_regions(spark, splits):
    df = spark.range(3000).select(F.concat(F.lit("k"), F.col("id")).alias("id"))
    placed = tables.presplit(df, F.col("id"), splits=splits)
    rows = tables.placement(placed).collect()
    assert sum(r["num_rows"] for r in rows) == 3000 and len({r["task"] for r in rows}) == len(rows) == 8 * splits
    assert all(r["task"] // splits == r["region"] for r in rows)


def jvm_hash(text):
    units = text.encode("utf-16-be")
    h = 0
    for i in range(0, len(units), 2):
        h = (31 * h + (units[i] << 8 | units[i + 1])) & 0xFFFFFFFF
    return h


def test_keys_from_a_hash_that_is_made_once(spark):
    texts = ["", "a", "1_20200120180752", "é", "漢字", "a😀b", "😀", "x" * 300, None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = keys.with_salted_key(df, F.col("t"), "key").select("t", "key", keys.salted_key(F.col("t")).alias("plain"), keys.string_hash(F.col("t")).alias("h")).collect()
    assert all(r["key"] == r["plain"] for r in rows)
    assert {r["t"]: r["h"] for r in rows} == {t: None if t is None else jvm_hash(t) for t in texts}
    assert [r["key"] for r in rows if r["t"] == "1_20200120180752"] == ["0004a97f493208b0"]
    assert plan_of(keys.with_salted_key(df, F.col("t"), "key")).count("split(") == 1


def test_hour_counts_per_city(spark):
    log = spark.createDataFrame([
        (1, "a_gps_topic", "d,o,3600,110.1,20.1"), (2, "b_gps_topic", "d,o,7200,110.1,20.1"), (3, "b_gps_topic", "d,p,7300,110.1,20.1"),
        (4, "c_gps_topic", "d,q,7300,110.1,20.1"), (5, "a_gps_topic", "end,o"),
    ], "seq bigint, topic string, value string")
    events = lines.parse_gps_events(lines.with_city(log, {"a_gps_topic": "075", "b_gps_topic": "0898"}))
    counts = tracks.hour_counts(events)
    assert as_set(counts) == {("075", "1970-01-01", 1, 1), ("0898", "1970-01-01", 2, 2), (None, "1970-01-01", 2, 1)}
    assert as_set(tracks.hour_board(counts, "1970-01-01", "0898")) == {("0898_1970-01-01_2", 2)}
    assert as_set(tracks.hour_board(counts, "1970-01-01", "075")) == {("075_1970-01-01_1", 1)}
    assert tracks.hour_board(counts, "1970-01-02", "075").collect() == []


def log_lines(seed):
    """A made-up log and, for the plain loop, when its stages, batches and block managers began and ended."""
    pick = random.Random(seed)
    out, facts = [{"Event": "SparkListenerApplicationStart", "App ID": "x", "Timestamp": 0}], []
    stage = 0
    for job in range(30):
        t = pick.randrange(0, 100_000)
        ids, last = list(range(stage, stage + 3)), t
        stage += 3
        out.append({"Event": "SparkListenerJobStart", "Job ID": job, "Submission Time": t, "Stage IDs": ids})
        ended = pick.random() < 0.8
        begun = []
        for s in ids[: pick.randrange(0, 4)]:
            a = last + pick.randrange(0, 5000)
            b = a + pick.randrange(0, 20_000)
            failed = pick.random() < 0.3
            done = pick.random() < 0.9
            info = {"Stage ID": s, "Stage Attempt ID": 0, "Submission Time": a}
            out.append({"Event": "SparkListenerStageSubmitted", "Stage Info": info})
            if done:
                more = {"Completion Time": b, **({"Failure Reason": "lost"} if failed else {})}
                out.append({"Event": "SparkListenerStageCompleted", "Stage Info": {**info, **more}})
            facts.append(("runningStages", a, b if done else None))
            if done and failed:
                facts.append(("failedStages", b, None))
            facts.append(("waitingStages", t, a))
            begun.append(s)
            last = b
        if ended:
            last += 1000
            out.append({"Event": "SparkListenerJobEnd", "Job ID": job, "Completion Time": last})
        facts += [("waitingStages", t, last if ended else None) for s in ids if s not in begun]
    for k in range(40):
        t, took = pick.randrange(0, 100_000), pick.randrange(0, 7000)
        stamp = f"1970-01-01T00:{t // 60_000:02d}:{t % 60_000 // 1000:02d}.{t % 1000:03d}Z"
        out.append({"Event": "org.apache.spark.sql.streaming.StreamingQueryListener$QueryProgressEvent",
                    "progress": {"batchId": k, "timestamp": stamp, "durationMs": {"triggerExecution": took}}})
        facts += [("runningBatches", t, t + took), ("totalCompletedBatches", t + took, None)]
        facts += [("waitingBatches", t + i * 2000, t + took) for i in range(1, took // 2000 + 1)]
    for k in range(6):
        manager = {"Executor ID": str(k), "Host": "h", "Port": k}
        a = pick.randrange(0, 50_000)
        out.append({"Event": "SparkListenerBlockManagerAdded", "Block Manager ID": manager, "Maximum Memory": 2**20 * (k + 1), "Timestamp": a})
        b = a + pick.randrange(1, 50_000) if k % 2 else None
        if b:
            out.append({"Event": "SparkListenerBlockManagerRemoved", "Block Manager ID": manager, "Timestamp": b})
        facts += [("maxMem", a, b)] * (k + 1)
    pick.shuffle(out)
    return [json.dumps(e) for e in out], facts


def test_snapshots_equal_a_plain_loop(spark):
    step, logs, expected = 5000, [], {}
    for app, seed in (("one", 4), ("two", 5)):
        text, facts = log_lines(seed)
        logs += [(app, line) for line in text] + [(app, "not json"), (app, '{"Event":"SparkListenerTaskEnd"}')]
        times = [t for _, a, b in facts for t in (a, b) if t is not None]
        for at in range(-(-min(times) // step) * step, -(-max(times) // step) * step + 1, step):
            count = {c: 0 for c in snapshots.COUNTERS}
            for counter, a, b in facts:
                count[counter] += a <= at and (b is None or at < b)
            expected[app, at] = tuple(count.values())
    found = snapshots.snapshots(spark.createDataFrame(logs, "app string, value string"), step, interval_ms=2000)
    names = [*snapshots.COUNTERS[:-1], "maxMem_MB"]
    rows = {(r["app"], int(r["ts"].timestamp() * 1000)): tuple(r[c] for c in names) for r in found.collect()}
    assert rows == expected
    board = monitor.health_board(found.where("app = 'one'")).collect()
    assert len(board) == 5 and board[0]["completed_batch_share"] == 100.0 and board[0]["used_memory_share"] is None


def test_snapshots_of_an_empty_log(spark):
    assert snapshots.snapshots(spark.createDataFrame([("nothing",)], "value string")).collect() == []


def test_a_log_is_parsed_once_for_all_counters(spark):
    found = snapshots.snapshots(spark.createDataFrame([(line,) for line in log_lines(6)[0]], "value string"))
    assert "from_json" not in plan_of(found) and "Scan ExistingRDD" not in plan_of(found)
    assert found.where("totalCompletedBatches > 0").count()
