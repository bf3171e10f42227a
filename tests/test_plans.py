"""Physical plans: what no query of the catalogue may contain."""

import pytest
from pyspark.sql import functions as F

from hailstat.operators import completion, hotareas, tracks
from hailstat.periods import GRAINS
from hailstat.plans import catalog
from hailstat.plans.catalog import QUERIES
from hailstat.sources import sample

SF_DIR = "/root/testdata/sf0.001"
# These run jobs of their own to write tables before they return one.
WRITERS = {
    "src_stream_topics", "src_sql_on_source", "c_cdc_merge", "c_cdc_stream", "g_stream", "g_stream_points", "g_live_stream",
    "g_span_stream", "g_hour_stream", "v_geojson_join", "v_district_tiles", "g_track_one", "g_feed_one",
}
# These sum the few folded rows of an application in order.
RUNNING_SUMS = {"m_snapshots", "m_health_log"}
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "Window ", "EvalPython", "Expand ", "MapInPandas")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(q for q in QUERIES if q not in WRITERS and not q.startswith("sink_")))
def test_plan(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert not [word for word in FORBIDDEN if word in plan and not (word == "Window " and name in RUNNING_SUMS)]


def test_hot_cells_fold_before_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1).selectExpr(
        "'1' id", "timestamp '1998-07-15' create_time", "110.2D open_lng", "19.9D open_lat", "'a' begin_address_code",
        "'unused' driver_id",
    ).write.parquet(path)
    plan = plan_of(hotareas.hot_order_report(spark.read.parquet(path), ("1998-07-15", "1998-07-16"), ("1998-07-14", "1998-07-15")))
    assert plan.count("FileScan") == 1 and "partial_min" in plan and "Join" not in plan and "driver_id" not in plan


HASHED = ["h_hot_day", "h_hot_prev_day", "h_hot_delta", "h_hot_order", "h_hot_detail", "h_heat_since", "g_order_span", "m_view_hot_area_result"]


@pytest.mark.parametrize("name", HASHED)
def test_rows_are_hashed_and_not_sorted_before_the_shuffle(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_feed_is_range_partitioned(spark):
    gps = spark.createDataFrame(
        [(1, "o", "d", 1, 1.0, 2.0, False)],
        "seq bigint, order_id string, driver_id string, ts bigint, lng double, lat double, is_end boolean",
    )
    assert "rangepartitioning(order_id" in plan_of(tracks.track_feed(gps))
    assert "partial_min" in plan_of(tracks.order_span(gps))


@pytest.mark.parametrize("grain", [*GRAINS, None])
def test_stored_days_are_pruned(spark, tmp_path, grain):
    path = str(tmp_path / "orders")
    rows = sample.trips(spark, "/root/testdata/sf0.001", "id", "create_time", "city_name", "cancel").where("create_time >= '1998-05-01'")
    rows.withColumn("create_day", F.to_date("create_time")).repartition(1).write.partitionBy("create_day").parquet(path)
    stored, period = spark.read.parquet(path), catalog.TRIP_PERIOD
    build = (lambda df: completion.city_summary(df, period)) if grain is None else (
        lambda df: completion.total_trips(df, completion.CITY, period, grain))
    pruned = build(stored)
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert {tuple(r) for r in pruned.collect()} == {tuple(r) for r in build(stored.drop("create_day")).collect()}
