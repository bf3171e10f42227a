"""Ride-hailing tables derived from the generic test tables of a scale-factor folder.

Each function takes the columns it is asked for into account: a table that no wanted column comes
from is not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hailstat.functions.text import city_code
from hailstat.sources.lines import ORDER_LINE_FIELDS

SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp, o_orderpriority string"
    ),
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_quantity double",
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string",
    "pages": "page_id bigint, url string, html string",
}

TRIP_COLUMNS = (
    "id create_time pay_all open_lng open_lat begin_address_code charge_mileage city_name "
    "vehicle_license driver_id driver_name cancel"
).split()
FROM_CUSTOMER = {"city_name", "begin_address_code"}
FROM_ITEMS = {"charge_mileage", "vehicle_license", "driver_id", "driver_name"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def trips(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Trips from orders: city from the customer's nation, vehicle and driver from the line items."""
    wanted = set(columns or TRIP_COLUMNS)
    df = table(spark, sf_dir, "orders")
    if wanted & FROM_CUSTOMER:
        city = table(spark, sf_dir, "customer").join(
            table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
        )
        df = df.join(city, F.col("o_custkey") == F.col("c_custkey"))
    if wanted & FROM_ITEMS:
        items = (
            table(spark, sf_dir, "lineitem")
            .groupBy("l_orderkey")
            .agg(
                F.min("l_suppkey").alias("suppkey"),
                F.min("l_partkey").alias("partkey"),
                F.sum("l_quantity").alias("quantity"),
            )
        )
        df = df.join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    if "driver_name" in wanted:
        df = df.join(table(spark, sf_dir, "supplier"), F.col("suppkey") == F.col("s_suppkey"), "left")
    defined = {
        "id": lambda: F.col("o_orderkey").cast("string"),
        "create_time": lambda: F.col("o_orderdate"),
        "pay_all": lambda: F.col("o_totalprice"),
        "open_lng": lambda: (F.lit(1101000) + (F.col("o_orderkey") * 104729) % 6000) / 10000,
        "open_lat": lambda: (F.lit(198500) + (F.col("o_orderkey") * 7919) % 2000) / 10000,
        "begin_address_code": lambda: F.concat(
            _two_digits(F.col("n_nationkey") + 10),
            _two_digits(F.col("n_regionkey") + 1),
            _two_digits(F.col("o_custkey") % 7),
        ),
        "charge_mileage": lambda: F.col("quantity"),
        "city_name": lambda: F.col("n_name"),
        "vehicle_license": lambda: F.concat(F.lit("V"), F.col("partkey").cast("string")),
        "driver_id": lambda: F.col("suppkey").cast("string"),
        "driver_name": lambda: F.col("s_name"),
        "cancel": lambda: F.when(F.col("o_orderstatus") == "F", 0)
        .when(F.col("o_orderstatus") == "O", 1)
        .when(F.col("o_orderstatus") == "P", 2),
    }
    return df.select(*[defined[c]().alias(c) for c in TRIP_COLUMNS if c in wanted])


def _two_digits(number):
    return F.lpad(number.cast("string"), 2, "0")


def riders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rider per user: registered at the first event, last seen at the last one."""
    per_user = (
        table(spark, sf_dir, "events")
        .groupBy("user_id")
        .agg(F.min("ts").alias("create_time"), F.max("ts").alias("last_logon_time"))
    )
    user = F.col("user_id")
    return per_user.select(
        user.cast("string").alias("id"),
        "create_time",
        city_code(F.concat(_two_digits(user % 25 + 10), _two_digits(user % 5 + 1))).alias("last_login_city"),
        "last_logon_time",
    )


def drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers with a trip, registered at the first one."""
    first = (
        trips(spark, sf_dir, "driver_id", "create_time")
        .groupBy("driver_id")
        .agg(F.min("create_time").alias("create_time"))
    )
    supplier = table(spark, sf_dir, "supplier")
    return supplier.join(first, supplier.s_suppkey.cast("string") == first.driver_id).select(
        F.col("driver_id").alias("id"),
        "create_time",
        city_code(F.concat(_two_digits(F.col("s_nationkey") + 10), F.lit("01"))).alias("register_city"),
        F.col("s_name").alias("driver_name"),
    )


def as_gps(events: DataFrame) -> DataFrame:
    """Events as GPS points; works on a stream as well."""
    n = F.col("event_id")
    return events.select(
        n.alias("seq"),
        F.concat(F.col("user_id").cast("string"), F.lit("_"), F.date_format("ts", "yyyyMMdd")).alias("order_id"),
        F.col("user_id").cast("string").alias("driver_id"),
        F.unix_timestamp("ts").alias("ts"),
        ((F.lit(1101000) + (n * 31) % 6000) / 10000).alias("lng"),
        ((F.lit(198500) + (n * 17) % 2000) / 10000).alias("lat"),
        (F.col("event_type") == "error").alias("is_end"),
    )


def as_gps_lines(events: DataFrame) -> DataFrame:
    """The same as text lines, ``driver,order,seconds,lng,lat`` or ``end,order``."""
    point = F.concat_ws(",", "driver_id", "order_id", "ts", "lng", "lat")
    end = F.concat_ws(",", F.lit("end"), "order_id")
    return as_gps(events).select("seq", F.when(F.col("is_end"), end).otherwise(point).alias("value"))


def gps_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_gps_lines(table(spark, sf_dir, "events"))


# Two topics and the codes of their cities, as a configuration would name them.
TOPIC_CITIES = {"east_gps_topic": "075", "west_gps_topic": "0898"}


def city_gps_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GPS lines of two topics: orders of odd users come through the second one."""
    events = table(spark, sf_dir, "events")
    east, west = TOPIC_CITIES
    topic = F.when(F.col("user_id") % 2 == 0, F.lit(east)).otherwise(F.lit(west))
    return as_gps_lines(events).join(events.select(F.col("event_id").alias("seq"), topic.alias("topic")), "seq")


def gps_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State events as the line parser would give them."""
    gps = as_gps(table(spark, sf_dir, "events"))
    return gps.select(
        "seq",
        "order_id",
        *[F.when(~F.col("is_end"), F.col(c)).alias(c) for c in ("driver_id", "ts", "lng", "lat")],
        "is_end",
    )


def gps_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gps_events(spark, sf_dir).where(~F.col("is_end")).drop("is_end")


def as_change_lines(events: DataFrame) -> DataFrame:
    """Events as change-log lines of trip tables sharded by month."""
    kind = (
        F.when(F.col("event_type") == "error", "delete")
        .when(F.col("event_type") == "view", "update")
        .otherwise("insert")
    )
    data = F.struct(
        F.col("user_id").alias("id_"),
        F.date_format(F.date_trunc("day", "ts"), "yyyy-MM-dd HH:mm:ss").alias("create_time"),
        F.col("value").alias("pay_all"),
    )
    envelope = F.struct(
        F.lit("rides").alias("database"),
        F.concat(F.lit("order_info_"), F.date_format("ts", "yyyyMM")).alias("table"),
        kind.alias("type"),
        F.unix_timestamp("ts").alias("ts"),
        data.alias("data"),
    )
    return events.select(F.col("event_id").alias("seq"), F.to_json(envelope).alias("value"))


def change_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip changes, and one insert line per customer, supplier and part for the other tables.

    Parts stand for alliances; nations are a table that no route takes. Riders have a last login and
    alliances an update in place of a creation; every tenth rider has no time at all.
    """
    def insert(name: str, table_name: str, seq: str, **fields: str) -> DataFrame:
        data = F.struct(*[F.expr(e).alias(c) for c, e in fields.items()])
        envelope = F.struct(F.lit("rides").alias("database"), F.lit(table_name).alias("table"), data.alias("data"))
        return table(spark, sf_dir, name).select(F.col(seq).cast("bigint").alias("seq"), F.to_json(envelope).alias("value"))

    return (
        as_change_lines(table(spark, sf_dir, "events"))
        .unionByName(insert("customer", "renter_info", "c_custkey", id_="c_custkey", city_name="c_name",
                            last_login_city="''", last_logon_time="if(c_custkey % 10 = 0, null, '2024-01-02 03:04:05')"))
        .unionByName(insert("supplier", "driver_info", "s_suppkey", id_="s_suppkey", driver_name="s_name", cancel_count="s_nationkey",
                            create_time="'2024-02-03 04:05:06'"))
        .unionByName(insert("part", "opt_alliance_business", "p_partkey", id_="p_partkey", alliance_name="p_name", state="p_size",
                            update_time="'2024-03-04 05:06:07'"))
        .unionByName(insert("nation", "nation", "n_nationkey", id_="n_nationkey"))
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips as lines of 24 tab-separated fields; unknown ones are ``NULL`` or zero."""
    given = {
        "order_id": F.col("id"),
        "city_id": F.substring("begin_address_code", 1, 4),
        "county": F.col("begin_address_code"),
        "departure_time": F.date_format("create_time", "yyyy-MM-dd HH:mm:ss"),
        "pre_total_fee": F.floor("pay_all").cast("string"),
        "arrive_time": F.lit("0000-00-00 00:00:00"),
        "bubble_trace_id": F.md5("id"),
        "dest_lng": F.col("open_lng").cast("string"),
        "dest_lat": F.col("open_lat").cast("string"),
        "starting_lng": F.col("open_lng").cast("string"),
        "starting_lat": F.col("open_lat").cast("string"),
        "year": F.date_format("create_time", "yyyy"),
        "month": F.date_format("create_time", "MM"),
        "day": F.date_format("create_time", "dd"),
    }
    source = trips(spark, sf_dir, "id", "create_time", "pay_all", "open_lng", "open_lat", "begin_address_code")
    fields = [given.get(c, F.lit("NULL")) for c in ORDER_LINE_FIELDS]
    return source.select(F.concat_ws("\t", *fields).alias("value"))


def station_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pick-up points, moved off every district border by a fixed small step."""
    source = trips(spark, sf_dir, "id", "open_lng", "open_lat", "begin_address_code")
    return source.select(
        F.col("id").alias("order_id"),
        F.substring("begin_address_code", 1, 4).alias("city_id"),
        (F.col("open_lng") + 0.00003).alias("starting_lng"),
        (F.col("open_lat") + 0.00003).alias("starting_lat"),
    )


# Two districts: a rectangle and a triangle that meet at lng 110.40.
DISTRICTS = (
    ("0898", "A", "110.10,19.85;110.40,19.85;110.40,20.05;110.10,20.05"),
    ("0898", "B", "110.40,19.85;110.7003,19.85;110.55,20.05"),
)


def districts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(DISTRICTS), "citycode string, name string, polygon string")


def area_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A polygon text per address code: the bounding box of its pick-up points."""
    source = trips(spark, sf_dir, "open_lng", "open_lat", "begin_address_code")
    box = source.groupBy("begin_address_code").agg(
        F.min("open_lng").alias("x0"),
        F.max("open_lng").alias("x1"),
        F.min("open_lat").alias("y0"),
        F.max("open_lat").alias("y1"),
    )
    corners = (("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1"))
    polygon = F.concat_ws(";", *[F.concat_ws(",", *corner) for corner in corners])
    return box.select(
        F.substring("begin_address_code", 1, 4).alias("citycode"),
        F.col("begin_address_code").alias("name"),
        polygon.alias("polygon"),
        "x0", "x1", "y0", "y1",
    )


def district_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested JSON document per city: a city entry that holds its districts."""
    entry = F.struct(
        F.col("name"), F.col("citycode"), F.col("polygon").alias("polyline"), F.lit("district").alias("level")
    )
    per_city = area_boxes(spark, sf_dir).groupBy("citycode").agg(F.collect_list(entry).alias("districts"))
    city = F.struct(
        F.col("citycode").alias("name"), F.col("citycode"), F.lit("city").alias("level"), F.col("districts")
    )
    return per_city.select(F.to_json(F.struct(F.array(city).alias("districts"))).alias("value"))


def geojson_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feature collection per city, one multi-polygon of one closed ring per district."""
    def corner(x, y):
        return F.array(F.col(x), F.col(y))

    ring = F.array(corner("x0", "y0"), corner("x1", "y0"), corner("x1", "y1"), corner("x0", "y1"), corner("x0", "y0"))
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.col("name")).alias("properties"),
        F.struct(F.lit("MultiPolygon").alias("type"), F.array(F.array(ring)).alias("coordinates")).alias("geometry"),
    )
    per_city = area_boxes(spark, sf_dir).groupBy("citycode").agg(F.collect_list(feature).alias("features"))
    return per_city.select(
        F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.col("features"))).alias("value")
    )


def day_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored counts per city and day: orders and passengers."""
    gps = as_gps(table(spark, sf_dir, "events"))
    per_order = gps.groupBy(F.date_format(F.timestamp_seconds("ts"), "yyyy-MM-dd").alias("day"), "order_id").agg(
        F.max("driver_id").alias("rider")
    )
    return per_order.groupBy("day").agg(
        F.count("*").alias("order_count"), F.count_distinct("rider").alias("passenger_count")
    )


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One monitoring snapshot per hour of events."""
    def count(kind: str):
        return F.count_if(F.col("event_type") == kind).cast("int")

    hourly = table(spark, sf_dir, "events").groupBy(F.unix_timestamp(F.date_trunc("hour", "ts")).alias("ts"))
    return hourly.agg(
        count("error").alias("failedStages"),
        count("view").alias("runningStages"),
        count("click").alias("waitingStages"),
        count("signup").alias("runningBatches"),
        count("purchase").alias("waitingBatches"),
        F.count("*").cast("int").alias("totalCompletedBatches"),
        (F.count("*") * 100).cast("int").alias("maxMem_MB"),
        (count("view") * 10).alias("memUsed_MB"),
        (count("click") * 10).alias("remainingMem_MB"),
    )


def task_end_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as task-end lines of a Spark event log."""
    n = F.col("event_id")
    info = F.struct(
        n.alias("Task ID"),
        F.concat(F.lit("host"), n % 7).alias("Host"),
        F.lit(False).alias("Speculative"),
        (F.col("event_type") == "error").alias("Failed"),
        F.lit(False).alias("Killed"),
        (F.unix_timestamp("ts") * 1000).alias("Finish Time"),
    )
    read = F.struct(
        (n % 11).alias("Remote Blocks Fetched"),
        (n % 13).alias("Local Blocks Fetched"),
        (n * 7 % 1000).alias("Remote Bytes Read"),
        (n * 3 % 1000).alias("Local Bytes Read"),
        (n % 17).alias("Fetch Wait Time"),
        (n % 100).alias("Total Records Read"),
    )
    write = F.struct(
        (n * 5 % 1000).alias("Shuffle Bytes Written"),
        (n % 101).alias("Shuffle Records Written"),
        (n % 19).alias("Shuffle Write Time"),
    )
    metrics = F.struct(
        (n * 31 % 5000).alias("Executor CPU Time"),
        (n % 23).alias("JVM GC Time"),
        (n % 29).alias("Executor Deserialize CPU Time"),
        (n % 31).alias("Executor Deserialize Time"),
        (n % 37).alias("Result Size"),
        (n % 41).alias("Result Serialization Time"),
        (n % 43 * 1024).alias("Memory Bytes Spilled"),
        (n % 47 * 1024).alias("Disk Bytes Spilled"),
        read.alias("Shuffle Read Metrics"),
        write.alias("Shuffle Write Metrics"),
        F.struct((n % 53).alias("Bytes Read"), (n % 59).alias("Records Read")).alias("Input Metrics"),
        F.struct((n % 61).alias("Bytes Written"), (n % 67).alias("Records Written")).alias("Output Metrics"),
    )
    line = F.struct(F.lit("SparkListenerTaskEnd").alias("Event"), info.alias("Task Info"), metrics.alias("Task Metrics"))
    return table(spark, sf_dir, "events").select(F.to_json(line).alias("value"))


def job_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as jobs of an event log, each of two stages: the first runs, and fails for some, the second is skipped.

    Every seventh event is also a block manager that stays, every third a streaming batch.
    """
    n, t = F.col("event_id"), F.unix_millis("ts")
    begin, took = t + n % 7 * 1000, n % 50 * 60_000
    failure = F.when(F.col("event_type") == "error", F.lit("lost"))
    stage = F.struct((n * 2).alias("Stage ID"), F.lit(0).alias("Stage Attempt ID"), begin.alias("Submission Time"))
    ended = F.struct((n * 2).alias("Stage ID"), begin.alias("Submission Time"), (begin + took).alias("Completion Time"), failure.alias("Failure Reason"))
    manager = F.struct(n.cast("string").alias("Executor ID"), F.lit("host").alias("Host"), F.lit(1).alias("Port"))
    report = F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("timestamp"), F.struct((n % 90 * 1000).alias("triggerExecution")).alias("durationMs")
    )

    def line(kind: str, **parts: Column) -> Column:
        return F.to_json(F.struct(F.lit(kind).alias("Event"), *(v.alias(c.replace("_", " ")) for c, v in parts.items())))

    listener = "org.apache.spark.sql.streaming.StreamingQueryListener$QueryProgressEvent"
    made = F.array(
        line("SparkListenerJobStart", Job_ID=n, Submission_Time=t, Stage_IDs=F.array(n * 2, n * 2 + 1)),
        line("SparkListenerStageSubmitted", Stage_Info=stage),
        line("SparkListenerStageCompleted", Stage_Info=ended),
        line("SparkListenerJobEnd", Job_ID=n, Completion_Time=t + 5_400_000),
        F.when(n % 7 == 0, line("SparkListenerBlockManagerAdded", Block_Manager_ID=manager, Maximum_Memory=F.lit(1 << 30), Timestamp=t)),
        F.when(n % 3 == 0, line(listener, progress=report)),
    )
    return table(spark, sf_dir, "events").select(F.explode(made).alias("value")).where("value IS NOT NULL")


def progress_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as progress reports of streaming batches, one second apart by event id."""
    n = F.col("event_id")
    line = F.struct(
        F.lit("gps").alias("name"),
        n.alias("batchId"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("timestamp"),
        (n % 500).alias("numInputRows"),
        F.struct((n * 37 % 9000).alias("triggerExecution"), (n * 11 % 700).alias("addBatch")).alias("durationMs"),
    )
    return table(spark, sf_dir, "events").select(F.to_json(line).alias("value"))
