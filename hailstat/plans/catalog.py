"""Every operator as a query over the test tables of a scale-factor folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hailstat.functions import grid, keys, text, times
from hailstat.operators import (
    changes,
    completion,
    drivers,
    hotareas,
    monitor,
    quadtiles,
    riders,
    snapshots,
    stations,
    tracks,
    trips,
)
from hailstat.periods import GRAINS, Period, since
from hailstat.plans import reports
from hailstat.session import pin_time_zone, shared_folder
from hailstat.sources import lines, sample, tables, track_store
from hailstat.streaming import jobs, live, topics

Query = Callable[[SparkSession, str], DataFrame]

# Periods with data in the test tables.
TRIP_PERIOD = Period.of("1998-07-15")
RIDER_PERIOD = Period.of("2024-01-01")
ACTIVE_PERIOD = Period.of("2024-01-29")
DRIVER_PERIOD = Period.of("1995-01-02")
HOT_NOW = ("1998-07-01", "1998-08-01")
HOT_BEFORE = ("1998-06-01", "1998-07-01")
HEAT_SINCE = "1998-07-15"
RETENTION_DAY = ("2024-01-02", "2024-01-30")
RETENTION_WEEK = ("2024-01-01", "2024-01-29")
RETENTION_MONTH = ("2024-01-01", "2024-01-30")
BOARD_DAY = "2024-01-15"
BOARD_CITY = "0898"
TRACK_BOUNDS = (1704412800, 1705708800)
POINT_BOUNDS = ("2024-01-05 00:00:00", "2024-01-20 00:00:00")
STATION_CITY = "1203"
DISTRICT = "A"
BATCH_INTERVAL_MS = 1000


def inputs(spark: SparkSession, sf_dir: str) -> reports.Inputs:
    return reports.Inputs(
        trips=lambda *columns: sample.trips(spark, sf_dir, *columns),
        riders=lambda: sample.riders(spark, sf_dir),
        drivers=lambda: sample.drivers(spark, sf_dir),
        trip_period=TRIP_PERIOD,
        rider_period=RIDER_PERIOD,
        driver_period=DRIVER_PERIOD,
        hot_now=HOT_NOW,
        hot_before=HOT_BEFORE,
        heat_since=HEAT_SINCE,
        retention_day=RETENTION_DAY,
        retention_week=RETENTION_WEEK,
        retention_month=RETENTION_MONTH,
    )


QUERIES: dict[str, Query] = {}


def query(name: str):
    """Register a query; the session time zone is pinned before it is built."""
    def add(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            pin_time_zone(spark)
            return build(spark, sf_dir)

        QUERIES[name] = run
        return build

    return add


def _second(column: str):
    return F.date_format(column, times.SECOND_FORMAT).alias(column)


# --- sources and sinks -----------------------------------------------------------------------


@query("src_table")
def _src_table(spark, sf_dir):
    wanted = ["o_orderkey", "o_custkey", "o_totalprice"]
    return tables.read_table(spark, f"{sf_dir}/orders.parquet", sample.SCHEMAS["orders"], wanted)


@query("src_orders_for_stations")
def _src_orders_for_stations(spark, sf_dir):
    return lines.read_station_input(lines.parse_order_lines(sample.order_lines(spark, sf_dir)))


@query("src_cdc_json")
def _src_cdc_json(spark, sf_dir):
    rows = lines.parse_changes(sample.change_lines(spark, sf_dir), lines.ORDER_TABLE)
    return rows.select("seq", "table", "type", "ts", "id", _second("create_time"), "pay_all", "city_name")


@query("src_cdc_riders")
def _src_cdc_riders(spark, sf_dir):
    rows = lines.parse_changes(sample.change_lines(spark, sf_dir), lines.RIDER_TABLE)
    return rows.select("seq", "type", "id", "city_name", "last_login_city")


@query("src_cdc_drivers")
def _src_cdc_drivers(spark, sf_dir):
    rows = lines.parse_changes(sample.change_lines(spark, sf_dir), lines.DRIVER_TABLE)
    return rows.select("seq", "type", "id", "driver_name", "cancel_count")


@query("src_cdc_alliances")
def _src_cdc_alliances(spark, sf_dir):
    rows = lines.parse_changes(sample.change_lines(spark, sf_dir), lines.ALLIANCE_TABLE)
    return rows.select("seq", "type", "id_", "alliance_name", "state")


@query("src_cdc_routes")
def _src_cdc_routes(spark, sf_dir):
    return lines.route_counts(sample.change_lines(spark, sf_dir))


@query("src_gps_line")
def _src_gps_line(spark, sf_dir):
    return lines.parse_gps_events(sample.gps_lines(spark, sf_dir))


@query("src_gps_points")
def _src_gps_points(spark, sf_dir):
    return lines.parse_gps_points(sample.gps_lines(spark, sf_dir))


@query("src_order_line")
def _src_order_line(spark, sf_dir):
    rows = lines.parse_order_lines(sample.order_lines(spark, sf_dir))
    key = lines.order_line_key(F.col("order_id"), F.col("departure_time"))
    return rows.select(
        key.alias("row_key"), "order_id", "city_id", "county", "departure_time", "pre_total_fee",
        "starting_lng", "starting_lat", "year", "month", "day",
    )


def _event_stream(spark, sf_dir):
    # A pattern, since the path of a file stream has to name a folder or match files.
    return topics.read_files(spark, f"{sf_dir}/events.parque[t]", sample.SCHEMAS["events"])


@query("src_stream_topics")
def _src_stream_topics(spark, sf_dir):
    """GPS lines read as a stream and written as they come."""
    folder = shared_folder(spark, "topics")
    stream = sample.as_gps_lines(_event_stream(spark, sf_dir))

    def handle(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{folder}/lines/batch={batch_id}")

    jobs.start(stream, handle, f"{folder}/checkpoint", once=True).awaitTermination()
    return spark.read.schema("seq bigint, value string").parquet(f"{folder}/lines").select("seq", "value")


@query("sink_upsert")
def _sink_upsert(spark, sf_dir):
    """Trip changes added in two halves; the rows of the second stand in for those of the first when they are read."""
    folder = shared_folder(spark, "upsert")
    rows = changes.keyed_changes(_order_changes(spark, sf_dir))
    for half in (rows.where("seq % 2 = 0"), rows.where("seq % 2 = 1")):
        tables.append_changes(half, folder, ["row_key"], changes.NEWEST, "create_day")
    stored = tables.read_newest(spark, [folder], rows.schema, ["row_key"], changes.NEWEST)
    return stored.select("row_key", "id", _second("create_time"), "ts", "seq", "type", "pay_all")


@query("sink_table")
def _sink_table(spark, sf_dir):
    folder = shared_folder(spark, "result")
    result = completion.city_summary(sample.trips(spark, sf_dir, "create_time", "city_name", "cancel"), TRIP_PERIOD)
    fields = ["city_name", "_year_comple_rate", "_month_comple_rate"]
    tables.save_result(result, folder, "city_name", fields)
    return spark.read.parquet(folder)


@query("sink_stations")
def _sink_stations(spark, sf_dir):
    folder = shared_folder(spark, "stations")
    tables.save_stations(_placed(spark, sf_dir), folder)
    stored = (
        "order_id string, city_id string, starting_lng double, starting_lat double, "
        "trip_count bigint, district_name string"
    )
    return spark.read.schema(stored).parquet(folder).select(
        "order_id", "city_id", _six("starting_lng"), _six("starting_lat"), "trip_count", "district_name"
    )


@query("src_sql_on_source")
def _src_sql_on_source(spark, sf_dir):
    """A stored table filtered by a value and written as a result table of its own."""
    folder = shared_folder(spark, "filtered")
    source = tables.read_table(
        spark, f"{sf_dir}/orders.parquet", sample.SCHEMAS["orders"], ["o_orderkey", "o_custkey", "o_orderstatus"]
    )
    tables.filter_and_save(source, F.col("o_custkey") > 60, folder, "o_orderkey")
    return spark.read.parquet(folder)


# --- keys, placement, scalar functions -------------------------------------------------------


def _business_rows(spark, sf_dir):
    rows = sample.trips(spark, sf_dir, "id", "create_time")
    return rows.select("id", _second("create_time"))


@query("key_business")
def _key_business(spark, sf_dir):
    key = keys.business_key(F.col("id"), F.col("create_time"))
    return _business_rows(spark, sf_dir).select("id", key.alias("row_key"))


@query("key_salted")
def _key_salted(spark, sf_dir):
    key = keys.business_key(F.col("id"), F.col("create_time"))
    return keys.with_salted_key(_business_rows(spark, sf_dir), key, "row_key").select("id", "row_key")


@query("key_hash_prefix")
def _key_hash_prefix(spark, sf_dir):
    joined = keys.plain_key(F.col("id"), F.col("create_time"))
    return keys.with_hash(
        _business_rows(spark, sf_dir),
        joined,
        lambda text, number: keys.prefix_of(number).alias("prefix"),
        lambda text, number: F.hex(keys.prefixed(text, keys.prefix_of(number))).alias("row_key_hex"),
    ).select("id", "prefix", "row_key_hex")


@query("key_md5_prefix")
def _key_md5_prefix(spark, sf_dir):
    key = keys.md5_prefixed_key("_", 12, F.col("id"), F.col("create_time"))
    return _business_rows(spark, sf_dir).select("id", key.alias("row_key"))


@query("key_plain")
def _key_plain(spark, sf_dir):
    return _business_rows(spark, sf_dir).select("id", keys.plain_key(F.col("id"), F.col("create_time")).alias("row_key"))


@query("part_presplit")
def _part_presplit(spark, sf_dir):
    rows = _business_rows(spark, sf_dir)
    return tables.region_load(rows, keys.business_key(F.col("id"), F.col("create_time")))


@query("part_placed")
def _part_placed(spark, sf_dir):
    """Rows per region after the physical placement."""
    return _split_in_four(spark, sf_dir).groupBy("region").agg(F.count("*").alias("num_rows"))


def _split_in_four(spark, sf_dir):
    key = keys.business_key(F.col("id"), F.col("create_time"))
    return tables.presplit(_business_rows(spark, sf_dir), key, splits=4)


query("part_tasks")(lambda s, d: tables.placement(_split_in_four(s, d)))


@query("fn_date_bucket")
def _fn_date_bucket(spark, sf_dir):
    rows = sample.trips(spark, sf_dir, "create_time")
    time = F.col("create_time")
    return rows.agg(*[F.count_if(TRIP_PERIOD.within(g, time)).alias(f"in_{g}") for g in GRAINS])


@query("fn_date_ge")
def _fn_date_ge(spark, sf_dir):
    rows = sample.trips(spark, sf_dir, "id", "create_time")
    return rows.where(since(F.col("create_time"), HEAT_SINCE)).select("id")


@query("fn_datediff")
def _fn_datediff(spark, sf_dir):
    rows = sample.trips(spark, sf_dir, "city_name", "create_time")
    return rows.groupBy("city_name").agg(times.day_span(F.col("create_time")).alias("day_num"))


@query("fn_now_sub")
def _fn_now_sub(spark, sf_dir):
    rows = sample.riders(spark, sf_dir)
    today = F.lit("2024-01-30").cast("date")
    on = F.to_date("last_logon_time")
    return rows.agg(*[F.count_if(on == times.days_before(today, k)).alias(f"back_{k}") for k in (0, 1, 6, 29)])


@query("fn_epoch_format")
def _fn_epoch_format(spark, sf_dir):
    rows = sample.gps_events(spark, sf_dir).where(~F.col("is_end"))
    return rows.select(
        "seq",
        times.format_seconds(F.col("ts")).alias("from_seconds"),
        times.format_millis(F.col("ts") * 1000 + 176).alias("from_millis"),
        times.hour_of(F.col("ts")).alias("hour"),
    )


@query("fn_compact_date")
def _fn_compact_date(spark, sf_dir):
    rows = sample.trips(spark, sf_dir, "id", "create_time")
    day = F.when(F.col("id").cast("bigint") % 10 == 0, " ").otherwise(F.date_format("create_time", times.DAY_FORMAT))
    return rows.select("id", times.compact_date(day).alias("compact"))


@query("fn_half_month_back")
def _fn_half_month_back(spark, sf_dir):
    events = sample.table(spark, sf_dir, "events")
    stamp = F.date_format("ts", times.MINUTE_STAMP)
    return events.select("event_id", times.half_month_back(stamp).alias("earlier"))


@query("fn_table_suffix")
def _fn_table_suffix(spark, sf_dir):
    rows = sample.trips(spark, sf_dir, "create_time")
    return rows.groupBy(times.table_suffix(F.col("create_time")).alias("suffix")).agg(F.count("*").alias("num_rows"))


@query("fn_city_prefix")
def _fn_city_prefix(spark, sf_dir):
    rows = sample.trips(spark, sf_dir, "begin_address_code")
    per_city = rows.groupBy(text.city_prefix(F.col("begin_address_code")).alias("prefix")).agg(F.count("*").alias("n"))
    return per_city.select("prefix", text.city_code(F.col("prefix")).alias("code"), "n")


@query("fn_rate_text")
def _fn_rate_text(spark, sf_dir):
    rows = sample.trips(spark, sf_dir, "begin_address_code", "cancel")
    counts = rows.groupBy("begin_address_code").agg(
        F.count_if(F.col("cancel") == 0).alias("part"), F.count("*").alias("whole")
    )
    return counts.select("begin_address_code", text.rate_text(F.col("part"), F.col("whole")).alias("rate"))


@query("fn_null_default")
def _fn_null_default(spark, sf_dir):
    rows = sample.trips(spark, sf_dir, "id", "vehicle_license", "charge_mileage")
    return rows.select(
        "id",
        text.null_default(F.col("vehicle_license"), "none").alias("vehicle"),
        text.null_default(F.col("charge_mileage"), 0.0).alias("mileage"),
    )


@query("fn_json_build")
def _fn_json_build(spark, sf_dir):
    rows = sample.trips(spark, sf_dir, "id", "cancel", "vehicle_license")
    return rows.select("id", text.json_object(["id", "cancel", "vehicle_license"]).alias("json"))


@query("fn_bean_to_map")
def _fn_bean_to_map(spark, sf_dir):
    rows = sample.drivers(spark, sf_dir).withColumn("create_time", F.date_format("create_time", times.SECOND_FORMAT))
    record = text.record_map(["id", "create_time", "register_city", "driver_name"])
    return rows.select("id", F.explode(record).alias("name", "value"))


@query("fn_html_filter")
def _fn_html_filter(spark, sf_dir):
    pages = sample.table(spark, sf_dir, "pages")
    return pages.select("page_id", text.strip_unsafe_markup(F.col("html")).alias("html"))


# --- completion, trips, drivers --------------------------------------------------------------

CITY_INPUT = ("create_time", "city_name", "cancel")
DRIVER_INPUT = ("create_time", "driver_id", "driver_name", "cancel")


def _completion_queries(prefix: str, keys_, columns) -> None:
    for grain in GRAINS:
        for kind, build in (
            ("eff", completion.effective_trips),
            ("tot", completion.total_trips),
            ("rate", completion.completion),
        ):
            # Totals per driver need no cancel column and so on; unused columns are pruned.
            query(f"{prefix}_{kind}_{grain}")(
                lambda s, d, build=build, grain=grain: build(sample.trips(s, d, *columns), keys_, TRIP_PERIOD, grain)
            )


_completion_queries("p", completion.CITY, CITY_INPUT)
_completion_queries("d", completion.DRIVER, DRIVER_INPUT)
query("p_rate_summary")(lambda s, d: completion.city_summary(sample.trips(s, d, *CITY_INPUT), TRIP_PERIOD))
query("d_rate_summary")(lambda s, d: completion.driver_summary(sample.trips(s, d, *DRIVER_INPUT), TRIP_PERIOD))

for _grain in GRAINS:
    query(f"d_reg_{_grain}")(
        lambda s, d, g=_grain: drivers.registrations(sample.drivers(s, d), DRIVER_PERIOD, g)
    )
query("d_reg_summary")(lambda s, d: drivers.registration_summary(sample.drivers(s, d), DRIVER_PERIOD))

AREA_INPUT = ("create_time", "begin_address_code")
VEHICLE_INPUT = (*AREA_INPUT, "vehicle_license")
for _grain in ("day", "month"):
    query(f"t_vehicle_{_grain}")(
        lambda s, d, g=_grain: trips.vehicles(sample.trips(s, d, *VEHICLE_INPUT), TRIP_PERIOD, g)
    )
for _grain in ("day", "week", "month"):
    query(f"t_order_{_grain}")(
        lambda s, d, g=_grain: trips.trip_count(sample.trips(s, d, *AREA_INPUT), TRIP_PERIOD, g)
    )
query("t_vehicle_counts")(lambda s, d: trips.vehicle_counts(sample.trips(s, d, *VEHICLE_INPUT), TRIP_PERIOD))
query("t_order_counts")(lambda s, d: trips.trip_counts(sample.trips(s, d, *AREA_INPUT), TRIP_PERIOD))
query("t_city_board")(lambda s, d: trips.city_board(sample.trips(s, d, *VEHICLE_INPUT), TRIP_PERIOD))
query("t_total")(lambda s, d: trips.total(sample.trips(s, d, "id")))
query("t_month_total")(lambda s, d: trips.month_total(sample.trips(s, d, "create_time"), TRIP_PERIOD))
query("t_mileage")(lambda s, d: trips.mileage(sample.trips(s, d, "charge_mileage")))
query("t_avg_per_day")(lambda s, d: trips.average_per_day(sample.trips(s, d, "create_time")))
query("t_platform_summary")(
    lambda s, d: trips.platform_summary(sample.trips(s, d, "create_time", "charge_mileage"), TRIP_PERIOD)
)
query("t_pay_total")(lambda s, d: trips.pay_total(sample.trips(s, d, "pay_all")))
query("t_order_rider_pay")(lambda s, d: trips.order_rider_pay(sample.trips(s, d, "pay_all"), sample.riders(s, d)))

# --- riders ----------------------------------------------------------------------------------

query("r_total")(lambda s, d: riders.total(sample.riders(s, d)))
query("r_new_city_day")(lambda s, d: riders.new_by_city(sample.riders(s, d), RIDER_PERIOD))
query("r_active_city_day")(lambda s, d: riders.active_by_city(sample.riders(s, d), ACTIVE_PERIOD))
query("r_new_active")(lambda s, d: riders.new_active_by_city(sample.riders(s, d), RIDER_PERIOD))
for _grain in ("day", "week", "month"):
    query(f"r_new_{_grain}")(lambda s, d, g=_grain: riders.new_riders(sample.riders(s, d), RIDER_PERIOD, g))
query("r_new_summary")(lambda s, d: riders.new_summary(sample.riders(s, d), RIDER_PERIOD))
for _grain, _pair in (("day", RETENTION_DAY), ("week", RETENTION_WEEK), ("month", RETENTION_MONTH)):
    query(f"r_retention_{_grain}")(
        lambda s, d, g=_grain, pair=_pair: riders.retention(sample.riders(s, d), *pair, name=f"{g}StateRate")
    )
query("r_retention_summary")(
    lambda s, d: riders.retention_summary(sample.riders(s, d), RETENTION_DAY, RETENTION_WEEK, RETENTION_MONTH)
)
for _name, _grain in (("r_dau", "day"), ("r_wau", "week"), ("r_mau", "month")):
    query(_name)(lambda s, d, g=_grain: riders.active(sample.riders(s, d), ACTIVE_PERIOD, g))
query("r_active_summary")(lambda s, d: riders.active_summary(sample.riders(s, d), ACTIVE_PERIOD))

# --- grid, hot areas, stations ---------------------------------------------------------------

HOT_INPUT = reports.HOT_COLUMNS


def _six(name: str):
    return F.round(name, 6).alias(name)


def _cells(spark, sf_dir, res=hotareas.HOT_RESOLUTION):
    return hotareas.with_cell(sample.trips(spark, sf_dir, "id", "open_lng", "open_lat"), res)


@query("h_cell")
def _h_cell(spark, sf_dir):
    coarse = _cells(spark, sf_dir)
    return coarse.select("id", "cell", grid.cell_of(F.col("open_lat"), F.col("open_lng"), 12).alias("fine_cell"))


@query("h_cell_center")
def _h_cell_center(spark, sf_dir):
    center = grid.cell_center(F.col("cell"))
    return _cells(spark, sf_dir).select("cell").distinct().select("cell", grid.lat_lng_text(center).alias("coordinate"))


@query("h_cell_boundary")
def _h_cell_boundary(spark, sf_dir):
    cells = _cells(spark, sf_dir).select("cell").distinct()
    corners = cells.select("cell", F.posexplode(grid.cell_boundary(F.col("cell"))).alias("corner", "p"))
    return corners.select("cell", "corner", F.round("p.lng", 6).alias("lng"), F.round("p.lat", 6).alias("lat"))


@query("h_centroid")
def _h_centroid(spark, sf_dir):
    rows = sample.trips(spark, sf_dir, "begin_address_code", "open_lng", "open_lat")
    middle = rows.groupBy("begin_address_code").agg(grid.centroid(F.col("open_lat"), F.col("open_lng")).alias("p"))
    return middle.select("begin_address_code", F.round("p.lng", 6).alias("lng"), F.round("p.lat", 6).alias("lat"))


def _hot(spark, sf_dir, bounds):
    return hotareas.hot_cells(sample.trips(spark, sf_dir, *HOT_INPUT), *bounds)


query("h_hot_day")(lambda s, d: _hot(s, d, HOT_NOW))
query("h_hot_prev_day")(lambda s, d: _hot(s, d, HOT_BEFORE))
query("h_hot_delta")(lambda s, d: hotareas.hot_change(sample.trips(s, d, *HOT_INPUT), HOT_NOW, HOT_BEFORE))
query("h_hot_delta_stored")(lambda s, d: hotareas.hot_delta(_hot(s, d, HOT_NOW), _hot(s, d, HOT_BEFORE)))


@query("h_hot_detail")
def _h_hot_detail(spark, sf_dir):
    return hotareas.hot_detail(hotareas.as_detail(_hot(spark, sf_dir, HOT_NOW)))


query("h_hot_order")(
    lambda s, d: hotareas.hot_order_report(sample.trips(s, d, *HOT_INPUT), HOT_NOW, HOT_BEFORE)
)
query("h_heat_since")(lambda s, d: hotareas.heat_map(sample.trips(s, d, *HOT_INPUT), HEAT_SINCE))


@query("v_grid")
def _v_grid(spark, sf_dir):
    return stations.station_grid(sample.station_input(spark, sf_dir)).select("order_id", "cell")


def _stations(spark, sf_dir, **options):
    return stations.stations(sample.station_input(spark, sf_dir), **options)


def _placed(spark, sf_dir):
    edges = stations.district_edges(sample.districts(spark))
    return stations.with_district(_stations(spark, sf_dir), edges)


def _station_columns(df, *more):
    return df.select("order_id", "city_id", _six("starting_lng"), _six("starting_lat"), *more)


query("v_station")(lambda s, d: _station_columns(_stations(s, d), "rn", "trip_count"))
query("v_min_trips")(lambda s, d: _station_columns(_stations(s, d, res=8, min_trips=3), "rn", "trip_count"))


@query("v_polygon_parse")
def _v_polygon_parse(spark, sf_dir):
    boxes = sample.area_boxes(spark, sf_dir)
    points = boxes.select("name", F.posexplode(stations.parse_ring(F.col("polygon"))).alias("position", "p"))
    return points.select("name", "position", "p.lng", "p.lat")


query("v_district_join")(lambda s, d: _station_columns(_placed(s, d), "district_name"))


@query("v_broadcast_districts")
def _v_broadcast_districts(spark, sf_dir):
    """The district join with the districts sent to all executors."""
    edges = stations.district_edges(sample.districts(spark))
    return _station_columns(stations.with_broadcast_districts(_stations(spark, sf_dir), edges), "district_name")


query("v_district_parse")(lambda s, d: stations.parse_districts(sample.district_documents(s, d)))
query("v_station_lookup")(lambda s, d: _rounded_lookup(stations.find_stations(_placed(s, d), STATION_CITY, DISTRICT)))
query("v_station_count")(lambda s, d: stations.station_count(_placed(s, d), STATION_CITY))


def _rounded_lookup(df):
    return df.select("city_id", "district_name", _six("starting_lng"), _six("starting_lat"))


@query("v_geojson_districts")
def _v_geojson_districts(spark, sf_dir):
    rings = stations.parse_geojson(sample.geojson_documents(spark, sf_dir))
    points = rings.select("district_name", "part", "ring_no", F.posexplode("ring").alias("position", "p"))
    return points.select("district_name", "part", "ring_no", "position", "p.lng", "p.lat")


@query("v_geojson_join")
def _v_geojson_join(spark, sf_dir):
    """Stations in the districts of GeoJSON documents, through quadtree tiles."""
    rings = stations.parse_geojson(sample.geojson_documents(spark, sf_dir))
    tiles = quadtiles.quad_tiles(quadtiles.edge_rows(rings))
    return _station_columns(quadtiles.in_districts(_stations(spark, sf_dir), tiles), "district_name")


@query("v_district_tiles")
def _v_district_tiles(spark, sf_dir):
    """The district join through quadtree tiles."""
    tiles = quadtiles.quad_tiles(quadtiles.edge_rows(stations.district_rings(sample.districts(spark))))
    return _station_columns(quadtiles.in_districts(_stations(spark, sf_dir), tiles), "district_name")


# --- change log and GPS ----------------------------------------------------------------------


def _order_changes(spark, sf_dir):
    trip_lines = sample.as_change_lines(sample.table(spark, sf_dir, "events"))
    return lines.parse_changes(trip_lines, lines.ORDER_TABLE)


def _change_columns(df):
    return df.select("row_key", "id", _second("create_time"), "ts", "seq", "type", "pay_all")


@query("c_cdc_apply")
def _c_cdc_apply(spark, sf_dir):
    return _change_columns(changes.apply_changes(None, _order_changes(spark, sf_dir)))


def _applied(spark, sf_dir, route):
    return changes.apply_changes(None, lines.parse_changes(sample.change_lines(spark, sf_dir), route))


query("c_cdc_apply_riders")(lambda s, d: _applied(s, d, lines.RIDER_TABLE).select("row_key", "id", "city_name"))
query("c_cdc_apply_drivers")(lambda s, d: _applied(s, d, lines.DRIVER_TABLE).select("row_key", "id", "driver_name", "cancel_count"))
query("c_cdc_apply_alliances")(lambda s, d: _applied(s, d, lines.ALLIANCE_TABLE).select("row_key", "id_", "alliance_name", "state"))


@query("c_cdc_unkeyed")
def _c_cdc_unkeyed(spark, sf_dir):
    """Rider changes that no key can be made for."""
    rows = lines.parse_changes(sample.change_lines(spark, sf_dir), lines.RIDER_TABLE)
    return changes.unkeyed_changes(rows).select("seq", "type", "id")


@query("c_cdc_merge")
def _c_cdc_merge(spark, sf_dir):
    """Inserts stored as a table, then all changes merged into it."""
    folder = shared_folder(spark, "stored")
    rows = _order_changes(spark, sf_dir)
    stored = changes.apply_changes(None, rows.where("type = 'insert'"))
    stored.write.parquet(folder)
    current = spark.read.schema(stored.schema).parquet(folder)
    return _change_columns(changes.apply_changes(current, rows))


@query("c_cdc_stream")
def _c_cdc_stream(spark, sf_dir):
    folder = shared_folder(spark, "changes")
    stream = sample.as_change_lines(_event_stream(spark, sf_dir))
    jobs.change_stream(stream, f"{folder}/tables", f"{folder}/checkpoint", once=True).awaitTermination()
    return _change_columns(jobs.read_changes(spark, f"{folder}/tables", lines.ORDER_TABLE))


def _gps(spark, sf_dir):
    return sample.gps_events(spark, sf_dir)


def _point_store(spark, sf_dir):
    return tracks.point_store(sample.gps_points(spark, sf_dir))


query("g_point_store")(_point_store)


@query("g_stream")
def _g_stream(spark, sf_dir):
    """Order spans from the states that the one GPS consumer wrote beside points, orders and rejects."""
    folder = shared_folder(spark, "gps")
    stream = sample.as_gps_lines(_event_stream(spark, sf_dir))
    jobs.gps_stream(stream, folder, f"{folder}/checkpoint", once=True).awaitTermination()
    return tracks.span_of(jobs.read_states(spark, f"{folder}/states"))


@query("g_stream_points")
def _g_stream_points(spark, sf_dir):
    """The point store that the GPS stream wrote."""
    folder = shared_folder(spark, "points")
    stream = sample.as_gps_lines(_event_stream(spark, sf_dir))
    jobs.point_stream(stream, f"{folder}/points", f"{folder}/point-checkpoint", once=True).awaitTermination()
    return tracks.point_store(jobs.read_points(spark, f"{folder}/points"))


LIVE_HORIZON_DAYS = 7


def _live_stream(spark, sf_dir):
    """The stateful stream over all events, run to its end."""
    folder = shared_folder(spark, "live")
    stream = live.LiveOrders(f"{folder}/orders", f"{folder}/checkpoint", f"{LIVE_HORIZON_DAYS} days")
    stream.start(sample.as_gps_lines(_event_stream(spark, sf_dir)), once=True).awaitTermination()
    return stream


query("g_live_stream")(lambda s, d: _live_stream(s, d).live(s))
query("g_span_stream")(lambda s, d: _live_stream(s, d).spans(s))
query("g_hour_stream")(lambda s, d: _live_stream(s, d).hours(s))
query("g_live_orders")(lambda s, d: tracks.live_orders(_gps(s, d)))
query("g_order_span")(lambda s, d: tracks.order_span(_gps(s, d)))
query("g_hour_count")(lambda s, d: tracks.hour_counts(_gps(s, d)))
query("g_track_push")(lambda s, d: tracks.track_feed(_gps(s, d)))
query("g_latest_point")(lambda s, d: tracks.latest_point(_gps(s, d)))
query("g_track_history")(
    lambda s, d: tracks.track(sample.gps_points(s, d), start=TRACK_BOUNDS[0], end=TRACK_BOUNDS[1])
)
query("g_order_history")(lambda s, d: tracks.span_track(sample.gps_points(s, d), tracks.order_span(_gps(s, d))))


@query("g_feed_requests")
def _g_feed_requests(spark, sf_dir):
    """The feed of one order per rider key and of one that never sent anything."""
    asked = sample.riders(spark, sf_dir).select(F.concat("id", F.lit("_20240115")).alias("order_id"))
    return tracks.feed_for(asked, _gps(spark, sf_dir))


def _stored_events(spark, sf_dir):
    """The stored events, and the order that has most of them."""
    folder = shared_folder(spark, "tracks")
    track_store.append_events(_gps(spark, sf_dir), folder)
    stored = track_store.read_events(spark, folder)
    most = stored.groupBy("order_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "order_id")
    return stored, (most.first() or [""])[0]


query("g_track_one")(lambda s, d: track_store.track_of(*_stored_events(s, d), start=TRACK_BOUNDS[0], end=TRACK_BOUNDS[1]))
query("g_feed_one")(lambda s, d: track_store.feed_of(*_stored_events(s, d)))
query("g_points_query")(lambda s, d: tracks.query_points(_point_store(s, d), *POINT_BOUNDS, city=lines.GPS_CITY))
query("g_points_brief")(
    lambda s, d: tracks.query_points(_point_store(s, d), *POINT_BOUNDS, city=lines.GPS_CITY, brief=True)
)
query("g_overview")(lambda s, d: tracks.overview(tracks.hour_counts(_gps(s, d)), sample.day_counts(s, d)))
query("g_hour_board")(lambda s, d: tracks.hour_board(tracks.hour_counts(_gps(s, d)), BOARD_DAY))


def _city_hours(spark, sf_dir):
    told = lines.with_city(sample.city_gps_lines(spark, sf_dir), sample.TOPIC_CITIES)
    return tracks.hour_counts(lines.parse_gps_events(told))


query("g_hour_city")(_city_hours)
query("g_hour_board_city")(lambda s, d: tracks.hour_board(_city_hours(s, d), BOARD_DAY, BOARD_CITY))

# --- published views and job metrics ---------------------------------------------------------


def _view_query(name: str) -> Query:
    def build(spark, sf_dir):
        reports.register_view(spark, inputs(spark, sf_dir), name)
        return reports.read_view(spark, name)

    return build


for _name in reports.REPORTS:
    query(f"m_view_{_name}")(_view_query(_name))


@query("m_views")
def _m_views(spark, sf_dir):
    """Rows per published view."""
    reports.register_views(spark, inputs(spark, sf_dir))
    counts = [
        reports.read_view(spark, name).agg(F.count("*").alias("num_rows")).select(F.lit(name).alias("view"), "num_rows")
        for name in reports.REPORTS
    ]
    result = counts[0]
    for more in counts[1:]:
        result = result.unionByName(more)
    return result


query("m_task_metrics")(lambda s, d: monitor.task_metrics(sample.task_end_lines(s, d)))
query("m_task_totals")(lambda s, d: monitor.task_totals(monitor.task_metrics(sample.task_end_lines(s, d))))
query("m_last_task")(lambda s, d: monitor.last_task(monitor.task_metrics(sample.task_end_lines(s, d))))
query("m_batch_metrics")(lambda s, d: monitor.batch_metrics(sample.progress_lines(s, d), BATCH_INTERVAL_MS))
query("m_health_ratios")(lambda s, d: monitor.health_board(sample.snapshots(s, d)))
SNAPSHOT_STEP_MS = 3_600_000


def _log_snapshots(spark, sf_dir):
    return snapshots.snapshots(sample.job_log_lines(spark, sf_dir), SNAPSHOT_STEP_MS, interval_ms=20_000)


query("m_snapshots")(lambda s, d: _log_snapshots(s, d).drop("app", "memUsed_MB", "remainingMem_MB"))
query("m_health_log")(
    lambda s, d: monitor.health_board(_log_snapshots(s, d)).select("ts", "error_rate", "operating_rate", "waiting_rate", "completed_batch_share")
)
query("m_health_all")(lambda s, d: monitor.health_ratios(sample.snapshots(s, d)))
