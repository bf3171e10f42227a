"""Live state and tracks of running trips, from GPS events.

Events carry ``seq``, their arrival order. End marks carry an order only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hailstat.functions.order import seconds_and_arrival
from hailstat.functions.times import SECOND_FORMAT, day_of, format_seconds, hour_of
from hailstat.sources.lines import END_MARK, GPS_CITY

NO_POINT = "none"


def _points(gps: DataFrame) -> DataFrame:
    return gps.where(~F.col("is_end")) if "is_end" in gps.columns else gps


def point_store(points: DataFrame) -> DataFrame:
    """Stored points: one per (order, second), the last arrival wins."""
    newest = F.max_by(F.struct("driver_id", "lng", "lat"), "seq").alias("p")
    return points.groupBy("order_id", "ts").agg(newest).select(
        F.concat_ws("_", "order_id", "ts").alias("rowkey"),
        F.lit(GPS_CITY).alias("city_code"),
        "p.driver_id",
        "order_id",
        F.col("ts").alias("timestamp"),
        format_seconds(F.col("ts")).alias("time"),
        "p.lng",
        "p.lat",
    )


def live_orders(gps: DataFrame) -> DataFrame:
    """Orders whose last arrival is a point: an end mark ends, a later point revives."""
    last = gps.groupBy("order_id").agg(F.max_by("is_end", "seq").alias("ended"))
    return last.where(~F.col("ended")).select(F.concat_ws("_", F.lit(GPS_CITY), "order_id").alias("order_key"), "order_id")


def order_state(gps: DataFrame) -> DataFrame:
    """What is known of each order: its first and last point by time, and by arrival.

    Every column is a minimum or maximum, so states of parts of the data fold into the state of
    the whole (``merge_states``), in any order and any number of times.
    """
    is_point = ~F.col("is_end")
    position = (F.col("lng"), F.col("lat"))
    gps = gps.withColumn("seq", F.col("seq").cast("decimal(38,0)"))  # any arrival order, of files or of topics
    return gps.groupBy("order_id").agg(
        F.min(F.when(is_point, F.struct("ts", "seq", *position))).alias("start"),
        F.max(F.when(is_point, F.struct("ts", (-F.col("seq")).alias("back"), *position))).alias("finish"),
        F.min(F.when(is_point, F.struct("seq", "ts"))).alias("first_seen"),
        F.max(F.struct("seq", "is_end", *position)).alias("last_seen"),
    )


def merge_states(states: DataFrame) -> DataFrame:
    """One state per order from any number of partial ones."""
    return states.groupBy("order_id").agg(
        F.min("start").alias("start"),
        F.max("finish").alias("finish"),
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
    )


def span_of(state: DataFrame) -> DataFrame:
    """Start and end of each order with at least one point; times in milliseconds."""
    return state.where(F.col("start").isNotNull()).select(
        F.lit(GPS_CITY).alias("cityCode"),
        F.col("order_id").alias("orderId"),
        (F.col("start.ts") * 1000).alias("startTime"),
        (F.col("finish.ts") * 1000).alias("endTime"),
        F.col("start.lat").alias("getOnLat"),
        F.col("start.lng").alias("getOnLng"),
        F.col("finish.lat").alias("getOfLat"),
        F.col("finish.lng").alias("getOfLng"),
    )


def order_span(gps: DataFrame) -> DataFrame:
    """First and last time and position per order; of points at the same time the first arrival.

    The points of an order mostly arrive together, so folding them before the shuffle leaves a few
    rows per order, however long it is. An arrival order that is a long makes one number with the time, and
    the fold hashes; a wider one (``topics.ARRIVAL``) needs the states of ``order_state``.
    """
    if not isinstance(gps.schema["seq"].dataType, T.IntegralType):
        return span_of(order_state(gps))
    early = seconds_and_arrival(F.col("ts"), F.col("seq"))
    late = seconds_and_arrival(F.col("ts"), -F.col("seq").cast("decimal(20,0)"))
    named = {"Lat": "lat", "Lng": "lng"}
    ends = _points(gps).groupBy("order_id").agg(
        F.min("ts").alias("first"), F.max("ts").alias("last"),
        *(F.min_by(c, early).alias(f"getOn{n}") for n, c in named.items()),
        *(F.max_by(c, late).alias(f"getOf{n}") for n, c in named.items()),
    )
    return ends.select(
        F.lit(GPS_CITY).alias("cityCode"), F.col("order_id").alias("orderId"), (F.col("first") * 1000).alias("startTime"),
        (F.col("last") * 1000).alias("endTime"), "getOnLat", "getOnLng", "getOfLat", "getOfLng",
    )


def live_of(state: DataFrame) -> DataFrame:
    return state.where(~F.col("last_seen.is_end")).select(
        F.concat_ws("_", F.lit(GPS_CITY), "order_id").alias("order_key"), "order_id"
    )


def _city_columns(df: DataFrame) -> list[str]:
    return ["city_code"] if "city_code" in df.columns else []


def hours_of(first_times: DataFrame) -> DataFrame:
    """Orders per day and hour, and per city where there is one, from their first time (``ts``)."""
    ts = F.col("ts")
    return first_times.groupBy(*_city_columns(first_times), day_of(ts).alias("day"), hour_of(ts).alias("hour")).agg(
        F.count("*").alias("order_count")
    )


def hour_counts(gps: DataFrame) -> DataFrame:
    """Orders per day and hour; an order counts once, in the hour of its first arriving point.

    With a ``city_code`` (``lines.with_city``) the counts are per city, and an order counts once in each.
    """
    return hours_of(_points(gps).groupBy(*_city_columns(gps), "order_id").agg(F.min_by("ts", "seq").alias("ts")))


def hour_counts_of(state: DataFrame) -> DataFrame:
    return hours_of(state.where(F.col("first_seen").isNotNull()).select(F.col("first_seen.ts").alias("ts")))


def hour_board(counts: DataFrame, day: str, city: str | None = None) -> DataFrame:
    """Hourly counts of one day under the names of the live board, of one city or of all.

    Counts without a city are those of the feed's only one.
    """
    code = F.col("city_code") if _city_columns(counts) else F.lit(GPS_CITY)
    name = F.concat_ws("_", code, "day", F.col("hour").cast("string"))
    shown = counts.where(F.col("day") == day)
    return (shown.where(code == city) if city else shown).select(name.alias("field"), "order_count")


def overview(counts: DataFrame, stored: DataFrame) -> DataFrame:
    """Orders and passengers per day: the hourly counts, or the stored count where they are none."""
    daily = counts.groupBy("day").agg(F.sum("order_count").alias("from_hours"))
    joined = stored.join(daily, "day", "full_outer")
    hours = F.when(F.col("from_hours") > 0, F.col("from_hours"))
    return joined.select("day", F.coalesce(hours, "order_count").alias("order_count"), "passenger_count")


def latest_point(gps: DataFrame) -> DataFrame:
    """Current position of each order: its last arriving point."""
    return _points(gps).groupBy("order_id").agg(
        F.max_by("lng", "seq").alias("lng"), F.max_by("lat", "seq").alias("lat")
    )


def message() -> Column:
    """What an order's listeners get for an event: ``lng,lat`` of a point, the end mark as it came."""
    return F.when(F.col("is_end"), END_MARK).otherwise(F.concat_ws(",", "lng", "lat")).alias("message")


def track_feed(gps: DataFrame) -> DataFrame:
    """Messages of every order in arrival order: ``lng,lat`` per point, the end mark as it came.

    Rows, not lists: sorting by (order, arrival) spreads one very long order over several tasks.
    """
    return gps.select("order_id", "seq", message()).orderBy("order_id", "seq")


def feed_for(requests: DataFrame, gps: DataFrame) -> DataFrame:
    """The feed of the requested orders; ``none`` for an order without any message."""
    wanted = requests.select("order_id").distinct()
    feed = gps.join(wanted, "order_id", "left_semi")
    silent = wanted.join(gps.select("order_id"), "order_id", "left_anti")
    return track_feed(feed).unionByName(
        silent.select("order_id", F.lit(None).cast(gps.schema["seq"].dataType).alias("seq"), F.lit(NO_POINT).alias("message"))
    )


def track(points: DataFrame, order_id: str | None = None, start: int | None = None, end: int | None = None) -> DataFrame:
    """Points of an order (or of all) from ``start`` to ``end`` seconds, both included, by time."""
    kept = _points(points)
    if order_id is not None:
        kept = kept.where(F.col("order_id") == order_id)
    if start is not None:
        kept = kept.where(F.col("ts") >= start)
    if end is not None:
        kept = kept.where(F.col("ts") <= end)
    return kept.select("order_id", "ts", "lng", "lat").orderBy("order_id", "ts")


def span_track(points: DataFrame, spans: DataFrame) -> DataFrame:
    """Points of each order between its own start and end."""
    s = spans.select(F.col("orderId").alias("order_id"), "startTime", "endTime")
    millis = F.col("ts") * 1000
    inside = (millis >= F.col("startTime")) & (millis <= F.col("endTime"))
    return _points(points).join(s, "order_id").where(inside).select("order_id", "ts", "lng", "lat")


def query_points(
    stored: DataFrame,
    start: str | None = None,
    end: str | None = None,
    city: str | None = None,
    brief: bool = False,
) -> DataFrame:
    """Stored points by optional time bounds (``yyyy-MM-dd HH:mm:ss``, included) and city.

    Bounds are compared on the numeric time, so they reach the scan.
    """
    def seconds(text: str) -> Column:
        return F.unix_timestamp(F.lit(text), SECOND_FORMAT)

    if start:
        stored = stored.where(F.col("timestamp") >= seconds(start))
    if end:
        stored = stored.where(F.col("timestamp") <= seconds(end))
    if city:
        stored = stored.where(F.col("city_code") == city)
    wanted = ("time", "lng", "lat") if brief else ("rowkey", "driver_id", "order_id", "timestamp", "time", "lng", "lat")
    return stored.select(*wanted)
