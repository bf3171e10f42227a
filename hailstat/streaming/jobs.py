"""Streaming jobs: change log into tables, GPS lines into a point store and live state.

Each micro-batch writes folders of its own and touches nothing that is there already. A replay after a
failure replaces the folders of its batch; readers fold all folders, and a fold is the same however often
a row is in it. So a crash at any moment loses nothing, and the work of a batch depends on the batch alone.
Folders are merged by ``compact`` on a schedule of its own. No job keeps state in memory between batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from hailstat.operators import monitor, tracks
from hailstat.operators.changes import NEWEST, keyed_changes, unkeyed_changes
from hailstat.sources import lines as parse
from hailstat.sources.tables import latest_per_key

# Fixed value: seconds between micro-batches.
INTERVAL = "1 second"


def start(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, once: bool = False,
    name: str | None = None, mode: str = "append",
) -> StreamingQuery:
    """Run ``handle`` per micro-batch, every second or once over all there is."""
    writer = stream.writeStream.foreachBatch(handle).outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(availableNow=True).start() if once else writer.trigger(processingTime=INTERVAL).start()


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """The rows of a micro-batch in its folder; writing it again replaces it."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/batch={batch_id}")


def change_stream(lines: DataFrame, root: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Change-log lines (seq, value) into one table per route below ``root``; ``read_changes`` reads them.

    Lines of no table, and rows that have no key, go to ``rejects`` under their reason and batch.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        routed = parse.with_route(batch).persist()
        try:
            # At most one value per route of the change log.
            present = {r["route"] for r in routed.select("route").distinct().collect()}
            for route in present & set(parse.CHANGE_FIELDS):
                parsed = parse.parse_changes(routed, route)
                write_batch(keyed_changes(parsed), f"{root}/{route}", batch_id)
                write_batch(unkeyed_changes(parsed).select(_line()), f"{root}/rejects/reason={route}", batch_id)
            if None in present:
                unknown = routed.where(F.col("route").isNull()).drop("route")
                write_batch(unknown.select(_line()), f"{root}/rejects/reason=no-route", batch_id)
        finally:
            routed.unpersist()

    return start(lines, handle, checkpoint, once, "changes")


def _line():
    return F.to_json(F.struct("*")).alias("value")


def read_changes(spark: SparkSession, root: str, route: str) -> DataFrame:
    """The newest row per key of one route."""
    return latest_per_key(spark.read.parquet(f"{root}/{route}").drop("batch"), ["row_key"], NEWEST)


def point_stream(lines: DataFrame, path: str, checkpoint: str, once: bool = False, rejects: str | None = None) -> StreamingQuery:
    """GPS lines into the point store; ``tracks.point_store`` of ``read_points`` is one row per (order, second).

    Lines that are neither a point nor an end mark go to ``rejects``.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        write_batch(_dated_points(batch), path, batch_id)
        if rejects:
            write_batch(parse.rejected_gps(batch), rejects, batch_id)

    return start(lines, handle, checkpoint, once, "points")


def _dated_points(lines: DataFrame) -> DataFrame:
    return parse.parse_gps_points(lines).withColumn("day", F.to_date(F.timestamp_seconds("ts")))


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """All points that were stored, as they arrived."""
    return spark.read.parquet(path).drop("batch")


def state_stream(lines: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """GPS lines into partial order states, which fold by minimum and maximum (``read_states``)."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        write_batch(tracks.order_state(parse.parse_gps_events(batch)), path, batch_id)

    return start(lines, handle, checkpoint, once, "states")


def gps_stream(lines: DataFrame, root: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """One consumer for all that the GPS topics carry, each batch read once.

    Points, order states and city order lines go below ``root`` into ``points``, ``states`` and ``orders``,
    lines that are none of these into ``rejects``. All advance together, in one checkpoint.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        told = batch.withColumn("tabbed", F.col("value").contains("\t")).persist()
        try:
            gps, city = told.where("not tabbed").drop("tabbed"), told.where("tabbed").drop("tabbed")
            write_batch(_dated_points(gps), f"{root}/points", batch_id)
            write_batch(tracks.order_state(parse.parse_gps_events(gps)), f"{root}/states", batch_id)
            write_batch(parse.parse_order_lines(city), f"{root}/orders", batch_id)
            write_batch(parse.rejected_gps(gps).unionByName(parse.rejected_order_lines(city)), f"{root}/rejects", batch_id)
        finally:
            told.unpersist()

    return start(lines, handle, checkpoint, once, "gps")


def read_order_lines(spark: SparkSession, path: str) -> DataFrame:
    """City order lines, the last arrival per row key."""
    rows = spark.read.parquet(path).drop("batch")
    keyed = rows.withColumn("row_key", parse.order_line_key(F.col("order_id"), F.col("departure_time")))
    return latest_per_key(keyed, ["row_key"], ["seq"])


STATE_SCHEMA = (
    "order_id string, "
    "start struct<ts: bigint, seq: decimal(38,0), lng: double, lat: double>, "
    "finish struct<ts: bigint, back: decimal(38,0), lng: double, lat: double>, "
    "first_seen struct<seq: decimal(38,0), ts: bigint>, "
    "last_seen struct<seq: decimal(38,0), is_end: boolean, lng: double, lat: double>"
)


def read_states(spark: SparkSession, path: str) -> DataFrame:
    """The state of every order."""
    return tracks.merge_states(spark.read.schema(STATE_SCHEMA).parquet(path).drop("batch"))


def compact(spark: SparkSession, path: str, folders: list[str], fold: Callable[[DataFrame], DataFrame], name: str) -> None:
    """Fold some folders of ``path`` into one more, ``batch=name``; folders that were folded may be folded again.

    The sources stay, so readers at work go on, and reading a row twice changes no fold. Drop them
    afterwards (``drop_folders``), when no reader that listed them is left.
    """
    rows = spark.read.parquet(*[f"{path}/batch={f}" for f in folders])
    fold(rows).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/batch={name}")


def compact_states(spark: SparkSession, path: str, folders: list[str], name: str) -> None:
    compact(spark, path, folders, tracks.merge_states, name)


def drop_folders(spark: SparkSession, path: str, folders: list[str]) -> None:
    """Remove folders whose rows are in another one."""
    jvm = spark.sparkContext._jvm
    for folder in folders:
        target = jvm.org.apache.hadoop.fs.Path(f"{path}/batch={folder}")
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


class ProgressLog(StreamingQueryListener):
    """Keeps every progress report of all queries of a session below ``path``, one small file each.

    Add it with ``spark.streams.addListener``; unlike ``recentProgress`` nothing is dropped.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.spark.createDataFrame([(event.progress.json,)], "value string").coalesce(1).write.mode("append").parquet(self.path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """All reports that a ``ProgressLog`` kept, as lines."""
    return spark.read.schema("value string").parquet(path)


def progress_lines(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """The recent progress reports that a query keeps (a hundred by default), as lines; see ``ProgressLog`` for all."""
    return spark.createDataFrame([(p.json,) for p in query.recentProgress], "value string")


def batch_report(spark: SparkSession, query: StreamingQuery, interval_ms: int = 1000) -> DataFrame:
    return monitor.batch_metrics(progress_lines(spark, query), interval_ms)
