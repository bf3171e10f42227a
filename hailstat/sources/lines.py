"""Parsers of the incoming text lines: change log, GPS points, city orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hailstat.sources.tables import column_types, finite, to_type

# Source tables of the change log. Trip tables are sharded by month, so their
# names only start with the given text.
ORDER_TABLE = "order_info"
RIDER_TABLE = "renter_info"
DRIVER_TABLE = "driver_info"
ALLIANCE_TABLE = "opt_alliance_business"

# Typed fields of the ``data`` object per table. The key field arrives as ``id_``.
CHANGE_FIELDS = {
    ORDER_TABLE: (
        "id string, pay_all double, pay_normal double, create_time timestamp, open_lng double, "
        "open_lat double, begin_address_code string, charge_mileage double, city_name string, "
        "vehicle_license string, driver_id string, driver_name string, cancel int, state int, "
        "order_type int, work_flow int, close_gps_time timestamp, cancel_time timestamp, pay_time timestamp"
    ),
    RIDER_TABLE: (
        "id string, create_time timestamp, last_login_city string, last_logon_time timestamp, city_name string"
    ),
    DRIVER_TABLE: (
        "id string, create_time timestamp, register_city string, driver_name string, mobile string, "
        "driver_type string, cancel_count int, driver_management_id string"
    ),
    ALLIANCE_TABLE: (
        "id_ string, alliance_name string, organization_code string, alliance_role string, linkman string, "
        "contact_number string, create_user string, create_time timestamp, update_user string, "
        "update_time timestamp, state int, del_state int"
    ),
}

# Fields of a city order line, in their order, and the mark of its header line.
ORDER_LINE_FIELDS = (
    "order_id product_id city_id district county type combo_type traffic_type passenger_count "
    "driver_product_id start_dest_distance arrive_time departure_time pre_total_fee normal_time "
    "bubble_trace_id product_1level dest_lng dest_lat starting_lng starting_lat year month day"
).split()
ORDER_LINE_HEADER = "dwv_order_make_haikou"

# City of the GPS feed and the mark of a finished trip.
GPS_CITY = "075"
END_MARK = "end"
# The last second of the year 9999; later ones are no times.
LAST_SECOND = 253402300799


def route_of(table: Column) -> Column:
    """The change-log table that a source table name belongs to; null for any other."""
    return F.when(table.startswith(ORDER_TABLE), ORDER_TABLE).otherwise(
        F.when(table.isin(RIDER_TABLE, DRIVER_TABLE, ALLIANCE_TABLE), table)
    )


def _where_valid(rows: DataFrame, valid: Column, *columns: Column) -> DataFrame:
    """Each row as zero or one row of ``columns``, with ``seq`` carried along if there is one.

    A filter on parsed columns would be moved below the parse and repeat it; a generator is not.
    """
    carried = ["seq"] if "seq" in rows.columns else []
    return rows.select(*carried, F.inline(F.when(valid, F.array(F.struct(*columns)))))


def _parsed(lines: DataFrame, data_fields: str = "") -> DataFrame:
    """The parsed line in a column ``e``; one parse serves all fields."""
    schema = "table string, type string, ts bigint" + (f", data struct<{data_fields}>" if data_fields else "")
    return lines.withColumn("e", F.from_json("value", schema))


def _route() -> Column:
    return route_of(F.coalesce("e.table", F.lit("")))


def _type() -> Column:
    """The change type; a missing one is an insert."""
    return F.coalesce("e.type", F.lit("insert")).alias("type")


def with_route(lines: DataFrame) -> DataFrame:
    """Lines with their route, to be kept when several routes are read from the same lines."""
    return _parsed(lines).select(*lines.columns, _route().alias("route"))


def parse_changes(lines: DataFrame, route: str) -> DataFrame:
    """Typed rows of one change-log table: table, type, ts, its fields, and ``seq`` if given.

    Null, blank and malformed fields become null.
    """
    types = column_types(CHANGE_FIELDS[route])
    sent = {c: ("id_" if c == "id" else c) for c in types}
    routed = "route" in lines.columns
    if routed:
        lines = lines.where(F.col("route") == route)
    return _where_valid(
        _parsed(lines, ", ".join(f"{s}: string" for s in sent.values())),
        F.lit(True) if routed else _route() == route,
        F.col("e.table"),
        _type(),
        F.col("e.ts"),
        *[to_type(F.col("e.data")[sent[c]], t).alias(c) for c, t in types.items()],
    )


def rejected_changes(lines: DataFrame) -> DataFrame:
    """Lines of no known table, as they came."""
    return with_route(lines).where(F.col("route").isNull()).select(*lines.columns)


def parse_change_log(lines: DataFrame) -> dict[str, DataFrame]:
    """One typed DataFrame per table, and the rejected lines."""
    return {**{r: parse_changes(lines, r) for r in CHANGE_FIELDS}, "rejects": rejected_changes(lines)}


def route_counts(lines: DataFrame) -> DataFrame:
    """Lines per route and change type; rejects under ``#A``."""
    return (
        _parsed(lines)
        .groupBy(F.coalesce(_route(), F.lit("#A")).alias("route"), _type())
        .agg(F.count("*").alias("num_lines"))
    )


def _gps_fields(lines: DataFrame) -> DataFrame:
    return lines.withColumn("p", F.split("value", ","))


def _part(position: int) -> Column:
    return F.get("p", F.lit(position))


def _numbers() -> dict[str, Column]:
    return {
        "ts": F.when(_part(2).try_cast("bigint").between(0, LAST_SECOND), _part(2).try_cast("bigint")),
        "lng": _degrees(_part(3), 180),
        "lat": _degrees(_part(4), 90),
    }


def _degrees(text: Column, most: int) -> Column:
    """A coordinate; null beyond ``most`` degrees, where not finite or malformed."""
    return F.when(F.abs(finite(text)) <= most, finite(text))


def _is_position() -> Column:
    ts, lng, lat = _numbers().values()
    return ts.isNotNull() & lng.isNotNull() & lat.isNotNull()


def _has_mark() -> Column:
    return F.col("value").contains(END_MARK)


def _is_end() -> Column:
    return F.col("value").startswith(END_MARK) & F.col("value").contains(",")


def parse_gps_points(lines: DataFrame) -> DataFrame:
    """Points to store: lines of five or more fields without the end mark."""
    return _where_valid(
        _gps_fields(lines),
        (F.size("p") > 4) & ~_has_mark() & _is_position(),
        _part(0).alias("driver_id"),
        _part(1).alias("order_id"),
        *[value.alias(name) for name, value in _numbers().items()],
    )


def with_city(lines: DataFrame, cities: dict[str, str]) -> DataFrame:
    """Lines with the ``city_code`` of their topic; that of a topic without one is null."""
    code = F.lit(None).cast("string")
    for topic, city in cities.items():
        code = F.when(F.col("topic") == topic, F.lit(city)).otherwise(code)
    return lines.withColumn("city_code", code)


def parse_gps_events(lines: DataFrame) -> DataFrame:
    """Events for the live state: points of exactly five fields, and end marks of any length.

    An end mark carries its order only; driver, time and position are null. A ``city_code`` is kept.
    """
    city = ["city_code"] if "city_code" in lines.columns else []
    counted = (F.size("p") == 5) | (_has_mark() & (F.size("p") > 4))
    fields = {"driver_id": _part(0), **_numbers()}
    return _where_valid(
        _gps_fields(lines),
        _is_end() | (counted & _is_position()),
        _part(1).alias("order_id"),
        *[F.when(~_is_end(), value).alias(name) for name, value in fields.items()],
        _is_end().alias("is_end"),
        *city,
    )


def rejected_gps(lines: DataFrame) -> DataFrame:
    """Lines that are neither a point nor an end mark."""
    rows = _gps_fields(lines)
    return rows.where(~_is_end() & ((F.size("p") <= 4) | ~_is_position())).select(*lines.columns)


def parse_order_lines(lines: DataFrame) -> DataFrame:
    """City order lines as named text columns; other lengths and header lines are left out."""
    valid = (F.size("p") == len(ORDER_LINE_FIELDS)) & ~F.col("value").contains(ORDER_LINE_HEADER)
    fields = [_part(i).alias(c) for i, c in enumerate(ORDER_LINE_FIELDS)]
    return _where_valid(lines.withColumn("p", F.split("value", "\t")), valid, *fields)


def rejected_order_lines(lines: DataFrame) -> DataFrame:
    """Lines that are neither a city order nor a header."""
    return lines.where((F.size(F.split("value", "\t")) != len(ORDER_LINE_FIELDS)) & ~F.col("value").contains(ORDER_LINE_HEADER))


def order_line_key(order_id: Column, departure_time: Column) -> Column:
    """Order id and compact departure time."""
    return F.concat(order_id, F.lit("_"), F.regexp_replace(departure_time, "[-: ]", ""))


def read_station_input(orders: DataFrame) -> DataFrame:
    """The four columns that stations are made from, coordinates as numbers."""
    return orders.select(
        "order_id",
        "city_id",
        _degrees(F.col("starting_lng"), 180).alias("starting_lng"),
        _degrees(F.col("starting_lat"), 90).alias("starting_lat"),
    )
