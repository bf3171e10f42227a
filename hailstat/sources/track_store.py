"""GPS events stored by day and order bucket, so that one order's track or feed is read without the others'."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hailstat.operators import tracks

# Readers and writers of a store must agree on it.
BUCKETS = 64
COLUMNS = "seq {seq}, order_id string, driver_id string, ts bigint, lng double, lat double, is_end boolean, day date, bucket int"


def bucket_of(order_id: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(order_id), F.lit(buckets)).cast("int")


def append_events(events: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Adds GPS events (``lines.parse_gps_events``); within a file they are sorted by order and time.

    End marks have no time and lie in a day of their own. A bucket of a day that is very large is cut by the
    rebalance into several files, each sorted.
    """
    placed = events.select(
        "seq", "order_id", "driver_id", "ts", "lng", "lat", "is_end",
        F.to_date(F.timestamp_seconds("ts")).alias("day"), bucket_of(F.col("order_id"), buckets).alias("bucket"),
    )
    dealt = placed.hint("rebalance", F.col("day"), F.col("bucket")).sortWithinPartitions("day", "bucket", "order_id", "ts", "seq")
    dealt.write.mode("append").partitionBy("day", "bucket").parquet(path)


def read_events(spark: SparkSession, path: str, seq: str = "bigint") -> DataFrame:
    return spark.read.schema(COLUMNS.format(seq=seq)).parquet(path)


def _of_order(stored: DataFrame, order_id: str, buckets: int) -> DataFrame:
    """The rows of one order; the bucket is a constant, so that no other one is listed or opened."""
    return stored.where((F.col("bucket") == bucket_of(F.lit(order_id), buckets)) & (F.col("order_id") == order_id))


def track_of(stored: DataFrame, order_id: str, start: int | None = None, end: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """``tracks.track`` of one order from the store, sorted in the one task that reads it.

    Bounds are seconds, both included; they also name the days to be read.
    """
    rows = _of_order(stored, order_id, buckets).where("not is_end")
    for bound, holds in ((start, "__ge__"), (end, "__le__")):
        if bound is not None:
            day = dt.datetime.fromtimestamp(bound, dt.timezone.utc).date()
            rows = rows.where(getattr(F.col("ts"), holds)(bound) & getattr(F.col("day"), holds)(F.lit(day)))
    return rows.select("order_id", "ts", "lng", "lat").coalesce(1).sortWithinPartitions("ts")


def feed_of(stored: DataFrame, order_id: str, buckets: int = BUCKETS) -> DataFrame:
    """``tracks.track_feed`` of one order from the store, in arrival order."""
    rows = _of_order(stored, order_id, buckets)
    return rows.select("order_id", "seq", tracks.message()).coalesce(1).sortWithinPartitions("seq")
