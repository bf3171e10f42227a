"""Live state as a stateful stream: equal to the batch, across restarts, and bounded by the horizon."""

import random

import pytest
from pyspark.sql import functions as F

from hailstat.operators import tracks
from hailstat.sources import lines
from hailstat.streaming import live, topics

LINES = "seq bigint, value string"


def as_set(df):
    return {tuple(r) for r in df.collect()}


def random_lines(seed, orders=12, rows=240, start=1_700_000_000, first=0):
    pick = random.Random(seed)
    out = []
    for i in range(rows):
        order, ts = f"o{pick.randrange(orders)}", start + pick.randrange(0, 3600)
        if pick.random() < 0.1:
            out.append((first + i, f"end,{order}"))
        else:
            out.append((first + i, f"d{pick.randrange(3)},{order},{ts},{110 + pick.randrange(100) / 1000},{20 + pick.randrange(100) / 1000}"))
    return out


def deliver(spark, rows, folder):
    spark.createDataFrame(rows, LINES).coalesce(1).write.mode("append").parquet(folder)


def run(spark, source, stream):
    stream.start(topics.read_files(spark, source, LINES, max_files=1), once=True).awaitTermination()


def check(spark, stream, rows):
    gps = lines.parse_gps_events(spark.createDataFrame(rows, LINES))
    assert as_set(stream.live(spark)) == as_set(tracks.live_orders(gps))
    assert as_set(stream.spans(spark)) == as_set(tracks.order_span(gps))
    assert as_set(stream.hours(spark)) == as_set(tracks.hour_counts(gps))


@pytest.mark.parametrize("every", [2, 64])
def test_stream_equals_batch_in_any_file_order_and_after_a_restart(spark, tmp_path, every):
    data = random_lines(5)
    chunks = [data[i::6] for i in range(6)]
    random.Random(6).shuffle(chunks)
    source = str(tmp_path / "in")
    stream = live.LiveOrders(str(tmp_path / "out"), str(tmp_path / "check"), "2 hours", every)
    seen = []
    for part in (chunks[:3], chunks[3:]):
        for chunk in part:
            deliver(spark, chunk, source)
            seen += chunk
        run(spark, source, stream)
        check(spark, stream, seen)


def test_orders_past_the_horizon_leave_the_state(spark, tmp_path):
    source = str(tmp_path / "in")
    stream = live.LiveOrders(str(tmp_path / "out"), str(tmp_path / "check"), "1 hour", every=2)
    old = [(1, "d,old,1700000000,110.1,20.1"), (2, "d,old,1700000100,110.2,20.2"), (3, "d,ended,1700000000,110.3,20.3"), (4, "end,ended")]
    later = [(5, "d,new,1700010000,110.4,20.4"), (6, "d,other,1700010060,110.5,20.5")]
    last = [(7, "d,new,1700020000,110.6,20.6"), (8, "d,old,1700000050,110.9,20.9")]  # the second is past the horizon
    for chunk in (old, later, last):
        deliver(spark, chunk, source)
        run(spark, source, stream)
    gps = lines.parse_gps_events(spark.createDataFrame([*old, *later, last[0]], LINES))
    assert {r["order_id"] for r in stream.live(spark).collect()} == {"new"}
    assert as_set(stream.spans(spark)) == as_set(tracks.order_span(gps))
    assert as_set(stream.hours(spark)) == as_set(tracks.hour_counts(gps))
    held = spark.read.format("statestore").load(str(tmp_path / "check"))
    assert held.count() == 1  # the state store itself holds the one running order
    assert {r["order_id"] for r in spark.read.parquet(f"{stream.root}/closed").collect()} >= {"old", "ended"}


def test_readers_open_one_generation_and_finished_batches_only(spark, tmp_path):
    source = str(tmp_path / "in")
    stream = live.LiveOrders(str(tmp_path / "out"), str(tmp_path / "check"), "2 hours", every=3)
    data = random_lines(8, rows=100)
    for i in range(5):
        deliver(spark, data[20 * i : 20 * i + 20], source)
    run(spark, source, stream)
    last = stream.last_batch(spark)
    assert last >= 4
    files = {f for f in stream.states(spark).inputFiles()}
    assert files and all(f"generation={last // 3}/" in f for f in files)
    # A batch that was written and not finished is not read.
    half = spark.read.parquet(*files).limit(0).drop("batch")
    row = half.sparkSession.createDataFrame([("ghost", None, None, None, None, False)], half.schema)
    row.write.parquet(f"{stream.root}/live/generation={last // 3}/batch={last + 1}")
    check(spark, stream, data)


def test_nothing_yet(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([], LINES).write.parquet(source)
    stream = live.LiveOrders(str(tmp_path / "out"), str(tmp_path / "check"))
    deliver(spark, [(1, "junk"), (2, "end,o")], source)
    run(spark, source, stream)
    assert stream.live(spark).count() == 0 and stream.spans(spark).count() == 0 and stream.hours(spark).count() == 0


def test_arrival_orders_beyond_a_long(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = [("1700000000000000010000000000000000001", "d,o,1700000000,110.1,20.1"), ("1700000000000000000000000000000000009", "d,o,1700000000,110.2,20.2")]
    spark.createDataFrame(rows, "seq string, value string").select(F.col("seq").cast("decimal(38,0)"), "value").write.parquet(source)
    stream = live.LiveOrders(str(tmp_path / "out"), str(tmp_path / "check"))
    stream.start(topics.read_files(spark, source, "seq decimal(38,0), value string"), once=True).awaitTermination()
    assert [(r["getOnLng"], r["getOfLng"]) for r in stream.spans(spark).collect()] == [(110.2, 110.2)]


def test_states_are_folded_by_spark_and_not_order_by_order_in_python(spark, tmp_path):
    source = str(tmp_path / "in")
    deliver(spark, random_lines(9), source)
    events = lines.parse_gps_events(topics.read_files(spark, source, LINES))
    plan = live.live_states(events, "2 hours")._jdf.queryExecution().analyzed().toString()
    assert "Pandas" not in plan and "PYTHON" not in plan.upper()


def test_an_end_mark_that_comes_first_holds_until_the_horizon(spark, tmp_path):
    source = str(tmp_path / "in")
    stream = live.LiveOrders(str(tmp_path / "out"), str(tmp_path / "check"), "1 hour", every=2)
    chunks = [
        [(1, "d,new,1700000000,110.1,20.1"), (9, "end,early"), (10, "end,only")],
        [(11, "d,new,1700000100,110.2,20.2")],
        [(12, "d,new,1700000200,110.3,20.3"), (8, "d,early,1700000150,110.4,20.4")],
        [(13, "d,new,1700009000,110.3,20.3")],
        [(14, "d,new,1700009100,110.3,20.3")],
    ]
    told = []
    for n, chunk in enumerate(chunks):
        deliver(spark, chunk, source)
        run(spark, source, stream)
        told += chunk
        if n < 3:
            assert {r["order_id"] for r in stream.states(spark).collect()} >= {"early", "only"}
        assert {r["order_id"] for r in stream.live(spark).collect()} == {"new"}
    gps = lines.parse_gps_events(spark.createDataFrame(told, LINES))
    assert as_set(stream.spans(spark)) == as_set(tracks.order_span(gps))
    assert as_set(stream.hours(spark)) == as_set(tracks.hour_counts(gps))
    assert {r["order_id"] for r in stream.states(spark).collect()} == {"new"}
