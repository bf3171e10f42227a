"""The queries of the catalogue as DuckDB SQL over the same tables.

Reports are written here as chains of joins over one table per period, independent of the one-pass
forms in the operators.
"""

from __future__ import annotations

import math

from hailstat.functions import grid
from hailstat.functions.text import UNSAFE_MARKUP
from hailstat.operators.hotareas import HOT_RADIUS
from hailstat.periods import GRAINS, Period
from hailstat.plans import catalog, reports
from hailstat.sources.sample import DISTRICTS

# --- derived tables --------------------------------------------------------------------------

_DERIVED = {
    "trips": """
        SELECT o.o_orderkey::VARCHAR AS id, o.o_orderdate AS create_time, o.o_totalprice AS pay_all,
               (1101000 + (o.o_orderkey * 104729) % 6000) / 10000 AS open_lng,
               (198500 + (o.o_orderkey * 7919) % 2000) / 10000 AS open_lat,
               lpad((n.n_nationkey + 10)::VARCHAR, 2, '0') || lpad((n.n_regionkey + 1)::VARCHAR, 2, '0')
                   || lpad((o.o_custkey % 7)::VARCHAR, 2, '0') AS begin_address_code,
               i.quantity AS charge_mileage, n.n_name AS city_name, 'V' || i.partkey AS vehicle_license,
               i.suppkey::VARCHAR AS driver_id, s.s_name AS driver_name,
               CASE o.o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 WHEN 'P' THEN 2 END AS cancel
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey
        LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS suppkey, min(l_partkey) AS partkey,
                          sum(l_quantity) AS quantity FROM lineitem GROUP BY 1) i
             ON i.l_orderkey = o.o_orderkey
        LEFT JOIN supplier s ON s.s_suppkey = i.suppkey""",
    "riders": """
        SELECT user_id::VARCHAR AS id, min(ts) AS create_time, max(ts) AS last_logon_time,
               lpad((10 + user_id % 25)::VARCHAR, 2, '0') || lpad((1 + user_id % 5)::VARCHAR, 2, '0') || '00'
                   AS last_login_city
        FROM events GROUP BY user_id""",
    "drivers": """
        SELECT s.s_suppkey::VARCHAR AS id, t.create_time, s.s_name AS driver_name,
               lpad((s.s_nationkey + 10)::VARCHAR, 2, '0') || '0100' AS register_city
        FROM supplier s JOIN (SELECT driver_id, min(create_time) AS create_time FROM trips GROUP BY 1) t
             ON t.driver_id = s.s_suppkey::VARCHAR""",
    "gps": """
        SELECT event_id AS seq, user_id || '_' || strftime(ts, '%Y%m%d') AS order_id,
               event_type = 'error' AS is_end,
               CASE WHEN event_type <> 'error' THEN user_id::VARCHAR END AS driver_id,
               CASE WHEN event_type <> 'error' THEN floor(epoch(ts))::BIGINT END AS ts,
               CASE WHEN event_type <> 'error' THEN (1101000 + (event_id * 31) % 6000) / 10000 END AS lng,
               CASE WHEN event_type <> 'error' THEN (198500 + (event_id * 17) % 2000) / 10000 END AS lat
        FROM events""",
    "changes": """
        SELECT event_id AS seq, 'order_info_' || strftime(ts, '%Y%m') AS "table",
               CASE event_type WHEN 'error' THEN 'delete' WHEN 'view' THEN 'update' ELSE 'insert' END AS type,
               floor(epoch(ts))::BIGINT AS ts, user_id::VARCHAR AS id,
               strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS create_time, value AS pay_all
        FROM events""",
}


def _cells(edge: float, lng: str, lat: str, res: int) -> str:
    """Cell id of a point, as nested selects over a table ``p``."""
    return f"""
        SELECT * EXCLUDE (x, y, q, r, nq, nr, ns, dq, dr, ds),
               {res * 2 ** (2 * grid.COORDINATE_BITS)} + ((CASE WHEN dq > dr AND dq > ds THEN -nr - ns ELSE nq END)::BIGINT + {grid.OFFSET}) * {2**grid.COORDINATE_BITS}
               + (CASE WHEN dq > dr AND dq > ds THEN nr WHEN dr > ds THEN -nq - ns ELSE nr END)::BIGINT + {grid.OFFSET}
               AS cell
        FROM (SELECT *, floor(q + 0.5::DOUBLE) AS nq, floor(r + 0.5::DOUBLE) AS nr, floor(-q - r + 0.5::DOUBLE) AS ns,
                     abs(nq - q) AS dq, abs(nr - r) AS dr, abs(ns - (-q - r)) AS ds
              FROM (SELECT *, ({math.sqrt(3.0) / 3.0!r}::DOUBLE * x - y / 3.0::DOUBLE) / {edge!r}::DOUBLE AS q,
                           ({2.0 / 3.0!r}::DOUBLE * y) / {edge!r}::DOUBLE AS r
                    FROM (SELECT *, ({lng} - {grid.ORIGIN_LNG}::DOUBLE) * {grid.LNG_METRES!r}::DOUBLE AS x,
                                 ({lat} - {grid.ORIGIN_LAT}::DOUBLE) * {grid.METRES_PER_DEGREE}::DOUBLE AS y FROM p)))"""


def _cell_table(source: str, res: int, lng: str = "open_lng", lat: str = "open_lat") -> str:
    return f"(WITH p AS ({source}) {_cells(grid.edge_length(res), lng, lat, res)})"


def _metres(axis: str, cell: str = "cell", edge: float = grid.EDGE_AT_7) -> str:
    q = f"(({cell} >> {grid.COORDINATE_BITS}) & {2**grid.COORDINATE_BITS - 1}) - {grid.OFFSET}"
    r = f"({cell} & {2**grid.COORDINATE_BITS - 1}) - {grid.OFFSET}"
    if axis == "x":
        return f"({edge!r}::DOUBLE * {math.sqrt(3.0)!r}::DOUBLE * (({q}) + ({r}) / 2.0::DOUBLE))"
    return f"({edge * 1.5!r}::DOUBLE * ({r}))"


def _lng(x: str) -> str:
    return f"(({x}) / {grid.LNG_METRES!r}::DOUBLE + {grid.ORIGIN_LNG}::DOUBLE)"


def _lat(y: str) -> str:
    return f"(({y}) / {grid.METRES_PER_DEGREE!r}::DOUBLE + {grid.ORIGIN_LAT}::DOUBLE)"


def _text(degrees: str) -> str:
    return f"round({degrees}, 6)::DECIMAL(9,6)::VARCHAR"


_CENTER_TEXT = f"{_text(_lat(_metres('y')))} || ',' || {_text(_lng(_metres('x')))}"
_CENTER_LNG_LAT = f"{_text(_lng(_metres('x')))} || ',' || {_text(_lat(_metres('y')))}"


def _with(sql: str, *names: str) -> str:
    """``sql`` with the derived tables it names."""
    needed = list(names)
    if "drivers" in needed and "trips" not in needed:
        needed.insert(0, "trips")
    needed.sort(key=list(_DERIVED).index)
    return "WITH " + ",\n".join(f"{n} AS ({_DERIVED[n]})" for n in needed) + "\n" + sql


def _inside(period: Period, grain: str, column: str = "create_time") -> str:
    if grain == "week":
        return f"weekofyear({column}) = {period.week}"
    start, end = period.bounds(grain)
    return f"({column} >= TIMESTAMP '{start} 00:00:00' AND {column} < TIMESTAMP '{end} 00:00:00')"


def _range(bounds: tuple[str, str], column: str = "create_time") -> str:
    return f"({column} >= TIMESTAMP '{bounds[0]} 00:00:00' AND {column} < TIMESTAMP '{bounds[1]} 00:00:00')"


def _day(day: str, column: str) -> str:
    return f"{column}::DATE = DATE '{day}'"


def _rate(part: str, whole: str) -> str:
    return f"CASE WHEN {part} = 0 THEN '0.0%' ELSE round({part} * 100 / {whole}, 2)::VARCHAR || '%' END"


ORACLE: dict[str, str] = {}

# --- sources and sinks -----------------------------------------------------------------------

ORACLE["src_table"] = "SELECT o_orderkey, o_custkey, o_totalprice FROM orders"
ORACLE["src_orders_for_stations"] = _with(
    "SELECT id AS order_id, begin_address_code[1:4] AS city_id, open_lng AS starting_lng, open_lat AS starting_lat"
    " FROM trips",
    "trips",
)
ORACLE["src_cdc_json"] = _with(
    'SELECT seq, "table", type, ts, id, create_time, pay_all, NULL::VARCHAR AS city_name FROM changes', "changes"
)
ORACLE["src_cdc_riders"] = (
    "SELECT c_custkey AS seq, 'insert' AS type, c_custkey::VARCHAR AS id, c_name AS city_name,"
    " NULL::VARCHAR AS last_login_city FROM customer"
)
ORACLE["src_cdc_drivers"] = (
    "SELECT s_suppkey AS seq, 'insert' AS type, s_suppkey::VARCHAR AS id, s_name AS driver_name,"
    " s_nationkey AS cancel_count FROM supplier"
)
ORACLE["src_cdc_alliances"] = (
    "SELECT p_partkey AS seq, 'insert' AS type, p_partkey::VARCHAR AS id_, p_name AS alliance_name,"
    " p_size AS state FROM part"
)
ORACLE["src_cdc_routes"] = _with(
    """SELECT 'order_info' AS route, type, count(*) AS num_lines FROM changes GROUP BY type
       UNION ALL SELECT 'renter_info', 'insert', count(*) FROM customer
       UNION ALL SELECT 'driver_info', 'insert', count(*) FROM supplier
       UNION ALL SELECT 'opt_alliance_business', 'insert', count(*) FROM part
       UNION ALL SELECT '#A', 'insert', count(*) FROM nation""",
    "changes",
)
ORACLE["src_gps_line"] = _with("SELECT seq, order_id, driver_id, ts, lng, lat, is_end FROM gps", "gps")
ORACLE["src_gps_points"] = _with(
    "SELECT seq, driver_id, order_id, ts, lng, lat FROM gps WHERE NOT is_end", "gps"
)
ORACLE["src_order_line"] = _with(
    """SELECT id || '_' || strftime(create_time, '%Y%m%d%H%M%S') AS row_key, id AS order_id,
              begin_address_code[1:4] AS city_id, begin_address_code AS county,
              strftime(create_time, '%Y-%m-%d %H:%M:%S') AS departure_time,
              floor(pay_all)::BIGINT::VARCHAR AS pre_total_fee, open_lng::VARCHAR AS starting_lng,
              open_lat::VARCHAR AS starting_lat, strftime(create_time, '%Y') AS year,
              strftime(create_time, '%m') AS month, strftime(create_time, '%d') AS day FROM trips""",
    "trips",
)
ORACLE["src_stream_topics"] = _with(
    """SELECT seq, CASE WHEN is_end THEN 'end,' || order_id
                        ELSE concat_ws(',', driver_id, order_id, ts, lng, lat) END AS value FROM gps""",
    "gps",
)

_BUSINESS = "id || '_' || strftime(create_time, '%Y%m%d%H%M%S')"


def _hash(text: str) -> str:
    chars = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::HUGEINT)"
    return f"list_reduce({chars}, lambda a, c: (a * 31 + c) % 4294967296, 0::HUGEINT)::BIGINT"


def _salted(text: str) -> str:
    return f"lpad((({_hash(text)} & 2147483647) % 8)::VARCHAR, 4, '0') || md5({text})[1:12]"


_CHANGE_KEY = _salted("id || '_' || regexp_replace(create_time, '[-: ]', '', 'g')")
_NEWEST_CHANGES = _with(
    f"""SELECT {_CHANGE_KEY} AS row_key, id, create_time, ts, seq, type, pay_all FROM changes
        WHERE type IN ('insert', 'update')
        QUALIFY row_number() OVER (PARTITION BY id, create_time ORDER BY ts DESC, seq DESC) = 1""",
    "changes",
)
ORACLE["sink_upsert"] = _NEWEST_CHANGES
ORACLE["src_sql_on_source"] = (
    "SELECT o_orderkey::VARCHAR AS o_orderkey, o_custkey::VARCHAR AS o_custkey, o_orderstatus FROM orders"
    " WHERE o_custkey > 60"
)

# --- keys, placement, scalar functions -------------------------------------------------------

_JOINED = "id || strftime(create_time, '%Y-%m-%d %H:%M:%S')"
_SEPARATED = "id || '_' || strftime(create_time, '%Y-%m-%d %H:%M:%S')"
ORACLE["key_business"] = _with(f"SELECT id, {_BUSINESS} AS row_key FROM trips", "trips")
ORACLE["key_salted"] = _with(f"SELECT id, {_salted(_BUSINESS)} AS row_key FROM trips", "trips")
ORACLE["key_hash_prefix"] = _with(
    f"""SELECT id, ({_hash(_JOINED)} & 32767)::INTEGER AS prefix,
               lpad(hex(({_hash(_JOINED)} & 32767)), 4, '0') || hex({_JOINED}) AS row_key_hex FROM trips""",
    "trips",
)
ORACLE["key_md5_prefix"] = _with(
    f"SELECT id, md5({_SEPARATED})[1:12] || '_' || {_SEPARATED} AS row_key FROM trips", "trips"
)
ORACLE["key_plain"] = _with(f"SELECT id, {_JOINED} AS row_key FROM trips", "trips")
_REGION = f"(({_hash(_BUSINESS)} & 2147483647) % 8)::INTEGER"
ORACLE["part_presplit"] = _with(
    f"""SELECT {_REGION} AS region, count(*) AS num_rows, count(DISTINCT {_BUSINESS}) AS num_keys
        FROM trips GROUP BY 1""",
    "trips",
)
ORACLE["part_placed"] = _with(f"SELECT {_REGION} AS region, count(*) AS num_rows FROM trips GROUP BY 1", "trips")

_NUMBER = f"({_hash(_BUSINESS)} & 2147483647)"
ORACLE["part_tasks"] = _with(
    f"""SELECT ({_NUMBER} % 8 * 4 + {_NUMBER} // 8 % 4)::INTEGER AS task, ({_NUMBER} % 8)::INTEGER AS region, count(*) AS num_rows
        FROM trips GROUP BY 1, 2""",
    "trips",
)

_P, _R, _A, _D = catalog.TRIP_PERIOD, catalog.RIDER_PERIOD, catalog.ACTIVE_PERIOD, catalog.DRIVER_PERIOD

ORACLE["fn_date_bucket"] = _with(
    "SELECT " + ", ".join(f"count(*) FILTER (WHERE {_inside(_P, g)}) AS in_{g}" for g in GRAINS) + " FROM trips",
    "trips",
)
ORACLE["fn_date_ge"] = _with(
    f"SELECT id FROM trips WHERE strftime(create_time, '%Y%m%d')::INT >= {catalog.HEAT_SINCE.replace('-', '')}", "trips"
)
ORACLE["fn_datediff"] = _with(
    """SELECT city_name, datediff('day', min(create_time)::DATE, max(create_time)::DATE)::INTEGER AS day_num
       FROM trips GROUP BY 1""",
    "trips",
)
ORACLE["fn_now_sub"] = _with(
    "SELECT "
    + ", ".join(
        f"count(*) FILTER (WHERE last_logon_time::DATE = DATE '2024-01-30' - {k}) AS back_{k}" for k in (0, 1, 6, 29)
    )
    + " FROM riders",
    "riders",
)
ORACLE["fn_epoch_format"] = _with(
    """SELECT seq, strftime(make_timestamp(ts * 1000000), '%Y-%m-%d %H:%M:%S') AS from_seconds,
              strftime(make_timestamp(ts * 1000000), '%Y-%m-%d %H:%M:%S') AS from_millis,
              hour(make_timestamp(ts * 1000000))::INTEGER AS hour
       FROM gps WHERE NOT is_end""",
    "gps",
)
ORACLE["fn_compact_date"] = _with(
    "SELECT id, CASE WHEN id::BIGINT % 10 <> 0 THEN strftime(create_time, '%Y%m%d') END AS compact FROM trips", "trips"
)
ORACLE["fn_half_month_back"] = (
    "SELECT event_id, strftime(date_trunc('minute', ts) - INTERVAL 15 DAY, '%Y%m%d%H%M') AS earlier FROM events"
)
ORACLE["fn_table_suffix"] = _with(
    "SELECT strftime(create_time, '%Y%m') AS suffix, count(*) AS num_rows FROM trips GROUP BY 1", "trips"
)
ORACLE["fn_city_prefix"] = _with(
    """SELECT begin_address_code[1:4] AS prefix, begin_address_code[1:4] || '00' AS code, count(*) AS n
       FROM trips GROUP BY 1, 2""",
    "trips",
)
ORACLE["fn_rate_text"] = _with(
    f"""SELECT begin_address_code, {_rate('n', 'd')} AS rate
        FROM (SELECT begin_address_code, count(*) FILTER (WHERE cancel = 0) AS n, count(*) AS d FROM trips GROUP BY 1)""",
    "trips",
)
ORACLE["fn_null_default"] = _with(
    """SELECT id, coalesce(vehicle_license, 'none') AS vehicle, coalesce(charge_mileage, 0.0::DOUBLE) AS mileage
       FROM trips""",
    "trips",
)
ORACLE["fn_json_build"] = _with(
    """SELECT id, '{"id":"' || id || '","cancel":"' || cancel || '"'
                  || coalesce(',"vehicle_license":"' || vehicle_license || '"', '') || '}' AS json FROM trips""",
    "trips",
)
ORACLE["fn_bean_to_map"] = _with(
    """SELECT id, 'id' AS name, id AS value FROM drivers
       UNION ALL SELECT id, 'create_time', strftime(create_time, '%Y-%m-%d %H:%M:%S') FROM drivers
       UNION ALL SELECT id, 'register_city', register_city FROM drivers
       UNION ALL SELECT id, 'driver_name', driver_name FROM drivers""",
    "drivers",
)


def _markup() -> str:
    expression = "html"
    for pattern in UNSAFE_MARKUP:
        expression = f"regexp_replace({expression}, '{pattern}', '', 'gi')"
    return expression


ORACLE["fn_html_filter"] = f"SELECT page_id, {_markup()} AS html FROM pages"

# --- completion ------------------------------------------------------------------------------


def _counts(keys: str, condition: str, name: str) -> str:
    return f"SELECT {keys}, count(*) AS {name} FROM trips WHERE {condition} GROUP BY {keys}"


def _rate_table(keys: tuple[str, ...], grain: str) -> str:
    """Effective trips left-joined with all trips."""
    names = ", ".join(keys)
    inside = _inside(_P, grain)
    match = " AND ".join(
        [f"e.{keys[0]} = t.{keys[0]}", *[f"e.{k} IS NOT DISTINCT FROM t.{k}" for k in keys[1:]]]
    )
    chosen = ", ".join(f"e.{k}" for k in keys)
    return f"""SELECT {chosen}, effective_num, total_num, {_rate('effective_num', 'total_num')} AS comple_rate
               FROM ({_counts(names, inside + ' AND cancel = 0', 'effective_num')}) e
               LEFT JOIN ({_counts(names, inside, 'total_num')}) t ON {match}"""


def _rate_summary(keys: tuple[str, ...], rk: str) -> str:
    def match(grain: str) -> str:
        return " AND ".join(
            [f"y.{keys[0]} = {grain}_t.{keys[0]}", *[f"y.{k} IS NOT DISTINCT FROM {grain}_t.{k}" for k in keys[1:]]]
        )

    others = ("quarter", "month", "week", "day")
    joins = " ".join(f"LEFT JOIN ({_rate_table(keys, g)}) {g}_t ON {match(g)}" for g in others)
    rates = ", ".join(f"coalesce({g}_t.comple_rate, '0.0%') AS _{g}_comple_rate" for g in others)
    chosen = ", ".join(f"y.{k}" for k in keys)
    return f"""SELECT {rk} AS rk, {chosen}, y.comple_rate AS _year_comple_rate, {rates}
               FROM ({_rate_table(keys, 'year')}) y {joins}"""


_CITY, _DRIVER = ("city_name",), ("driver_id", "driver_name")
for _prefix, _keys in (("p", _CITY), ("d", _DRIVER)):
    _names = ", ".join(_keys)
    for _g in GRAINS:
        _in = _inside(_P, _g)
        ORACLE[f"{_prefix}_eff_{_g}"] = _with(_counts(_names, _in + " AND cancel = 0", "effective_num"), "trips")
        ORACLE[f"{_prefix}_tot_{_g}"] = _with(_counts(_names, _in, "total_num"), "trips")
        ORACLE[f"{_prefix}_rate_{_g}"] = _with(_rate_table(_keys, _g), "trips")
_CITY_SUMMARY = _rate_summary(_CITY, "'1'")
_DRIVER_SUMMARY = _rate_summary(_DRIVER, "y.driver_id")
ORACLE["p_rate_summary"] = _with(_CITY_SUMMARY, "trips")
ORACLE["d_rate_summary"] = _with(_DRIVER_SUMMARY, "trips")
ORACLE["sink_table"] = _with(
    f"SELECT city_name, _year_comple_rate, _month_comple_rate FROM ({_CITY_SUMMARY})", "trips"
)


def _registered(grain: str) -> str:
    return f"""SELECT register_city, count(DISTINCT id) AS _register_{grain}_num FROM drivers
               WHERE {_inside(_D, grain)} GROUP BY 1"""


for _g in GRAINS:
    ORACLE[f"d_reg_{_g}"] = _with(_registered(_g), "drivers")
_REGISTERED_SUMMARY = (
    "SELECT y.register_city AS rk, y.register_city, _register_year_num::VARCHAR AS _register_year_num, "
    + ", ".join(
        f"coalesce(_register_{g}_num, 0)::VARCHAR AS _register_{g}_num" for g in ("quarter", "month", "week", "day")
    )
    + f" FROM ({_registered('year')}) y "
    + " ".join(
        f"LEFT JOIN ({_registered(g)}) {g}_t ON y.register_city = {g}_t.register_city"
        for g in ("quarter", "month", "week", "day")
    )
)
ORACLE["d_reg_summary"] = _with(_REGISTERED_SUMMARY, "drivers")

# --- trips -----------------------------------------------------------------------------------


def _vehicles(grain: str) -> str:
    return f"""SELECT begin_address_code[1:4] AS begin_address_code,
                      count(DISTINCT vehicle_license) AS {grain}VehicleCount
               FROM trips WHERE {_inside(_P, grain)} GROUP BY 1"""


def _orders(grain: str) -> str:
    return f"""SELECT begin_address_code[1:4] AS begin_address_code, count(*) AS {grain}OrderCount
               FROM trips WHERE {_inside(_P, grain)} GROUP BY 1"""


for _g in ("day", "month"):
    ORACLE[f"t_vehicle_{_g}"] = _with(_vehicles(_g), "trips")
for _g in ("day", "week", "month"):
    ORACLE[f"t_order_{_g}"] = _with(_orders(_g), "trips")
_VEHICLE_COUNTS = f"""SELECT m.begin_address_code, monthVehicleCount, coalesce(dayVehicleCount, 0) AS dayVehicleCount
    FROM ({_vehicles('month')}) m LEFT JOIN ({_vehicles('day')}) d ON m.begin_address_code = d.begin_address_code"""
_ORDER_COUNTS = f"""SELECT m.begin_address_code, monthOrderCount, weekOrderCount, dayOrderCount
    FROM ({_orders('month')}) m LEFT JOIN ({_orders('week')}) w ON m.begin_address_code = w.begin_address_code
    LEFT JOIN ({_orders('day')}) d ON m.begin_address_code = d.begin_address_code"""
ORACLE["t_vehicle_counts"] = _with(_VEHICLE_COUNTS, "trips")
ORACLE["t_order_counts"] = _with(_ORDER_COUNTS, "trips")
_BOARD = (
    "SELECT coalesce(v.begin_address_code, o.begin_address_code) || '00' AS rk, "
    "coalesce(o.begin_address_code, v.begin_address_code) || '00' AS o_begin_address_code, "
    + ", ".join(
        f"coalesce({c}, 0)::VARCHAR AS {c}"
        for c in ("monthVehicleCount", "dayVehicleCount", "monthOrderCount", "weekOrderCount", "dayOrderCount")
    )
    + f" FROM ({_VEHICLE_COUNTS}) v FULL OUTER JOIN ({_ORDER_COUNTS}) o"
    " ON v.begin_address_code = o.begin_address_code"
)
ORACLE["t_city_board"] = _with(_BOARD, "trips")
ORACLE["t_total"] = _with("SELECT count(*) AS totalOrderNum FROM trips", "trips")
ORACLE["t_month_total"] = _with(
    f"SELECT count(*) AS monthOrderNum FROM trips WHERE {_inside(_P, 'month')}", "trips"
)
_MILEAGE = "round(sum(charge_mileage), 2)"
_PAY = "round(sum(pay_all), 2)"
_AVERAGE = "round(count(*) / datediff('day', min(create_time)::DATE, max(create_time)::DATE), 2)"
ORACLE["t_mileage"] = _with(f"SELECT {_MILEAGE}::DOUBLE AS charge_mileage FROM trips", "trips")
ORACLE["t_pay_total"] = _with(f"SELECT {_PAY}::DOUBLE AS pay_all FROM trips", "trips")
ORACLE["t_avg_per_day"] = _with(f"SELECT {_AVERAGE} AS avgOrderNum FROM trips", "trips")
_PLATFORM = f"""SELECT '1' AS rk, count(*)::VARCHAR AS totalOrderNum,
    (count(*) FILTER (WHERE {_inside(_P, 'month')}))::VARCHAR AS monthOrderNum, {_AVERAGE}::VARCHAR AS avgOrderNum,
    {_MILEAGE}::DECIMAL(38,2)::VARCHAR AS charge_mileage FROM trips"""
ORACLE["t_platform_summary"] = _with(_PLATFORM, "trips")
_RIDER_PAY = f"""SELECT 1 AS myid, (SELECT count(*) FROM trips)::VARCHAR AS totalCount,
    (SELECT count(*) FROM riders)::VARCHAR AS registerTotalCount,
    (SELECT {_PAY} FROM trips)::DECIMAL(38,2)::VARCHAR AS pay_all"""
ORACLE["t_order_rider_pay"] = _with(_RIDER_PAY, "trips", "riders")

# --- riders ----------------------------------------------------------------------------------


def _new_city(period: Period) -> str:
    return f"""SELECT last_login_city[1:4] AS last_login_city, count(*) AS _day_new_user FROM riders
               WHERE {_inside(period, 'day')} AND last_login_city <> '' GROUP BY 1"""


def _active_city(period: Period) -> str:
    return f"""SELECT last_login_city[1:4] AS last_login_city, count(DISTINCT id) AS DAU FROM riders
               WHERE {_inside(period, 'day', 'last_logon_time')} AND last_login_city <> '' GROUP BY 1"""


ORACLE["r_total"] = _with("SELECT count(*) AS registerTotalCount FROM riders", "riders")
ORACLE["r_new_city_day"] = _with(_new_city(_R), "riders")
ORACLE["r_active_city_day"] = _with(_active_city(_A), "riders")
_NEW_ACTIVE = f"""SELECT coalesce(n.last_login_city, a.last_login_city) || '00' AS rk,
    coalesce(n.last_login_city, a.last_login_city) || '00' AS _city_code,
    coalesce(_day_new_user, 0)::VARCHAR AS _day_new_user, coalesce(DAU, 0)::VARCHAR AS DAU
    FROM ({_new_city(_R)}) n FULL OUTER JOIN ({_active_city(_R)}) a ON n.last_login_city = a.last_login_city"""
ORACLE["r_new_active"] = _with(_NEW_ACTIVE, "riders")
for _g in ("day", "week", "month"):
    ORACLE[f"r_new_{_g}"] = _with(
        f"SELECT count(*) AS {_g}NewUserCount FROM riders WHERE {_inside(_R, _g)}", "riders"
    )
_NEW_SUMMARY = "SELECT '1' AS myid, " + ", ".join(
    f"(SELECT count(*) FROM riders WHERE {_inside(_R, g)})::VARCHAR AS {g}NewUserCount" for g in ("month", "week", "day")
)
ORACLE["r_new_summary"] = _with(_NEW_SUMMARY, "riders")


def _retention(pair: tuple[str, str]) -> str:
    return f"""SELECT CASE WHEN count(c.id) > 0 THEN (count(l.id) * 100 / count(c.id))::VARCHAR || '%' END
               FROM (SELECT id FROM riders WHERE {_day(pair[0], 'create_time')}) c
               LEFT JOIN (SELECT id FROM riders WHERE {_day(pair[1], 'last_logon_time')}) l ON c.id = l.id"""


_PAIRS = {"month": catalog.RETENTION_MONTH, "week": catalog.RETENTION_WEEK, "day": catalog.RETENTION_DAY}
for _g, _pair in _PAIRS.items():
    ORACLE[f"r_retention_{_g}"] = _with(f"SELECT 1 AS myid, ({_retention(_pair)}) AS {_g}StateRate", "riders")
_RETENTION_SUMMARY = "SELECT '1' AS myid, " + ", ".join(
    f"coalesce(({_retention(p)}), '0.0%') AS {g}StateRate" for g, p in _PAIRS.items()
)
ORACLE["r_retention_summary"] = _with(_RETENTION_SUMMARY, "riders")


def _active(grain: str, name: str) -> str:
    return f"SELECT count(DISTINCT id) AS {name} FROM riders WHERE {_inside(_A, grain, 'last_logon_time')}"


_ACTIVE_NAMES = {"day": "DAU", "week": "WAU", "month": "MAU"}
for _g, _n in _ACTIVE_NAMES.items():
    ORACLE[f"r_{_n.lower()}"] = _with(_active(_g, _n), "riders")
_ACTIVE_SUMMARY = "SELECT '1' AS rk, " + ", ".join(
    f"({_active(g, n)})::VARCHAR AS {n}" for g, n in _ACTIVE_NAMES.items()
)
ORACLE["r_active_summary"] = _with(_ACTIVE_SUMMARY, "riders")

# --- grid, hot areas, stations ---------------------------------------------------------------

_ALL_CELLS = _cell_table("SELECT id, open_lng, open_lat FROM trips", 7)
ORACLE["h_cell"] = _with(
    f"""SELECT a.id, a.cell, b.cell AS fine_cell FROM {_ALL_CELLS} a
        JOIN {_cell_table('SELECT id, open_lng, open_lat FROM trips', 12)} b ON a.id = b.id""",
    "trips",
)
ORACLE["h_cell_center"] = _with(f"SELECT DISTINCT cell, {_CENTER_TEXT} AS coordinate FROM {_ALL_CELLS}", "trips")
_EDGE = f"{grid.EDGE_AT_7!r}::DOUBLE"
_CORNER_X = f"{_metres('x')} + {_EDGE} * cos(radians(60 * corner - 30))"
_CORNER_Y = f"{_metres('y')} + {_EDGE} * sin(radians(60 * corner - 30))"
ORACLE["h_cell_boundary"] = _with(
    f"""SELECT cell, corner::INTEGER AS corner, round({_lng(_CORNER_X)}, 6) AS lng, round({_lat(_CORNER_Y)}, 6) AS lat
        FROM (SELECT DISTINCT cell FROM {_ALL_CELLS}), range(6) k(corner)""",
    "trips",
)
_UNIT = {
    "x": "avg(cos(radians(open_lat)) * cos(radians(open_lng)))",
    "y": "avg(cos(radians(open_lat)) * sin(radians(open_lng)))",
    "z": "avg(sin(radians(open_lat)))",
}
ORACLE["h_centroid"] = _with(
    f"""SELECT begin_address_code, round(degrees(atan2(y, x)), 6) AS lng,
               round(degrees(atan2(z, sqrt(x * x + y * y))), 6) AS lat
        FROM (SELECT begin_address_code, {', '.join(f'{e} AS {n}' for n, e in _UNIT.items())} FROM trips GROUP BY 1)""",
    "trips",
)


def _hot(condition: str) -> str:
    """The two-window form: newest trips numbered from one, the highest number is the count."""
    cells = _cell_table(f"SELECT * FROM trips WHERE {condition}", 7)
    return f"""SELECT begin_address_code, {_CENTER_TEXT} AS coordinate, cell, {HOT_RADIUS} AS radius, rank AS count
        FROM (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY rank DESC) AS num
              FROM (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY create_time DESC, id DESC) AS rank
                    FROM {cells})) WHERE num = 1"""


_HOT_NOW, _HOT_BEFORE = _hot(_range(catalog.HOT_NOW)), _hot(_range(catalog.HOT_BEFORE))
_HOT_DELTA = f"""SELECT coalesce(t.begin_address_code, y.begin_address_code) AS city_code,
    coalesce(t.coordinate, y.coordinate) AS coordinate, coalesce(t.radius, y.radius) AS radius,
    coalesce(t.count, 0) - coalesce(y.count, 0) AS count
    FROM ({_HOT_NOW}) t FULL OUTER JOIN ({_HOT_BEFORE}) y ON t.cell = y.cell"""
ORACLE["h_hot_day"] = _with(_HOT_NOW, "trips")
ORACLE["h_hot_prev_day"] = _with(_HOT_BEFORE, "trips")
ORACLE["h_hot_delta"] = _with(_HOT_DELTA, "trips")
ORACLE["h_hot_delta_stored"] = ORACLE["h_hot_delta"]
ORACLE["h_hot_detail"] = _with(
    f"""SELECT begin_address_code AS city_code, NULL::BIGINT AS city_num, coordinate, radius, count FROM ({_HOT_NOW})
        UNION ALL SELECT begin_address_code, sum(count)::BIGINT, NULL, NULL, NULL FROM ({_HOT_NOW}) GROUP BY 1""",
    "trips",
)
_HOT_ORDER = f"""SELECT t.city_code AS rk, t.city_code AS _city_code, t.n::VARCHAR AS _day_order_num,
    d.n::VARCHAR AS _new_orders_num
    FROM (SELECT begin_address_code AS city_code, sum(count)::BIGINT AS n FROM ({_HOT_NOW}) GROUP BY 1) t
    LEFT JOIN (SELECT city_code, sum(count)::BIGINT AS n FROM ({_HOT_DELTA}) GROUP BY 1) d
         ON t.city_code = d.city_code"""
ORACLE["h_hot_order"] = _with(_HOT_ORDER, "trips")
_SINCE_CELLS = _cell_table(f"SELECT * FROM trips WHERE create_time >= TIMESTAMP '{catalog.HEAT_SINCE} 00:00:00'", 7)
# The centroid of the six corners of a regular cell is its centre to well below the sixth decimal
# only in the plane; on the sphere it is computed from the corners.
_HEAT = f"""SELECT cell::VARCHAR AS rk, code AS begin_address_code,
    {_text('degrees(atan2(sy, sx))')} || ',' || {_text('degrees(atan2(sz, sqrt(sx * sx + sy * sy)))')} AS centerPoint, n AS count
    FROM (SELECT cell, any_value(code) AS code, any_value(n) AS n, sum(cos(radians(lat)) * cos(radians(lng))) AS sx,
                 sum(cos(radians(lat)) * sin(radians(lng))) AS sy, sum(sin(radians(lat))) AS sz
          FROM (SELECT cell, code, n, {_lng(_CORNER_X)} AS lng, {_lat(_CORNER_Y)} AS lat
                FROM (SELECT cell, arg_max(begin_address_code, (create_time, id)) AS code, count(*) AS n
                      FROM {_SINCE_CELLS} GROUP BY 1), range(6) k(corner)) GROUP BY cell)"""
ORACLE["h_heat_since"] = _with(_HEAT, "trips")

_STATION_INPUT = """SELECT id AS order_id, begin_address_code[1:4] AS city_id, open_lng + 0.00003::DOUBLE AS starting_lng,
    open_lat + 0.00003::DOUBLE AS starting_lat FROM trips"""


def _stations(res: int = 12, min_trips: int = 1) -> str:
    return f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cell
                   ORDER BY starting_lng, starting_lat, order_id)::INTEGER AS rn, count(*) OVER (PARTITION BY cell) AS trip_count
               FROM {_cell_table(_STATION_INPUT, res, 'starting_lng', 'starting_lat')})
               WHERE rn = 1 AND trip_count >= {min_trips}"""


_STATION_COLUMNS = "order_id, city_id, round(starting_lng, 6) AS starting_lng, round(starting_lat, 6) AS starting_lat"


def _edges() -> str:
    rows = []
    for _, name, polygon in DISTRICTS:
        ring = [point.split(",") for point in polygon.split(";")]
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            rows.append(f"('{name}', {x1}::DOUBLE, {y1}::DOUBLE, {x2}::DOUBLE, {y2}::DOUBLE)")
    return f"(VALUES {', '.join(rows)}) e(district_name, x1, y1, x2, y2)"


_PLACED = f"""SELECT s.order_id, s.city_id, s.starting_lng, s.starting_lat, s.trip_count, e.district_name
    FROM ({_stations()}) s JOIN {_edges()}
         ON (y1 > starting_lat) <> (y2 > starting_lat)
        AND starting_lng < (x2 - x1) * ((starting_lat - y1) / (y2 - y1)) + x1
    GROUP BY ALL HAVING count(*) % 2 = 1"""
ORACLE["v_grid"] = _with(
    f"SELECT order_id, cell FROM {_cell_table(_STATION_INPUT, 12, 'starting_lng', 'starting_lat')}", "trips"
)
ORACLE["v_station"] = _with(f"SELECT {_STATION_COLUMNS}, rn, trip_count FROM ({_stations()})", "trips")
ORACLE["v_min_trips"] = _with(f"SELECT {_STATION_COLUMNS}, rn, trip_count FROM ({_stations(8, 3)})", "trips")
ORACLE["v_district_join"] = _with(f"SELECT {_STATION_COLUMNS}, district_name FROM ({_PLACED})", "trips")
ORACLE["v_broadcast_districts"] = ORACLE["v_district_join"]
ORACLE["v_district_tiles"] = ORACLE["v_district_join"]
ORACLE["sink_stations"] = _with(f"SELECT {_STATION_COLUMNS}, trip_count, district_name FROM ({_PLACED})", "trips")
ORACLE["v_station_lookup"] = _with(
    f"""SELECT city_id, district_name, round(starting_lng, 6) AS starting_lng, round(starting_lat, 6) AS starting_lat
        FROM ({_PLACED}) WHERE city_id = '{catalog.STATION_CITY}' AND district_name = '{catalog.DISTRICT}'""",
    "trips",
)
ORACLE["v_station_count"] = _with(
    f"""SELECT district_name, count(*) AS count FROM ({_PLACED})
        WHERE city_id = '{catalog.STATION_CITY}' GROUP BY 1""",
    "trips",
)
_BOXES = """SELECT begin_address_code AS name, min(open_lng) AS x0, max(open_lng) AS x1, min(open_lat) AS y0,
    max(open_lat) AS y1 FROM trips GROUP BY 1"""
_CORNERS = "(VALUES (0, 0, 0), (1, 1, 0), (2, 1, 1), (3, 0, 1)) k(position, kx, ky)"
_CLOSED = "(VALUES (0, 0, 0), (1, 1, 0), (2, 1, 1), (3, 0, 1), (4, 0, 0)) k(position, kx, ky)"
_AT = "CASE kx WHEN 0 THEN x0 ELSE x1 END AS lng, CASE ky WHEN 0 THEN y0 ELSE y1 END AS lat"
ORACLE["v_polygon_parse"] = _with(f"SELECT name, position, {_AT} FROM ({_BOXES}), {_CORNERS}", "trips")
ORACLE["v_geojson_districts"] = _with(
    f"SELECT name AS district_name, 0 AS part, 0 AS ring_no, position, {_AT} FROM ({_BOXES}), {_CLOSED}", "trips"
)
ORACLE["v_geojson_join"] = _with(
    f"""SELECT {_STATION_COLUMNS}, name AS district_name FROM ({_stations()}) JOIN ({_BOXES})
        ON x0 <= starting_lng AND starting_lng < x1 AND y0 <= starting_lat AND starting_lat < y1""",
    "trips",
)
ORACLE["v_district_parse"] = _with(
    f"""SELECT name[1:4] AS citycode, name, concat_ws(';', concat_ws(',', x0, y0), concat_ws(',', x1, y0),
               concat_ws(',', x1, y1), concat_ws(',', x0, y1)) AS polygon FROM ({_BOXES})""",
    "trips",
)

# --- change log and GPS ----------------------------------------------------------------------

ORACLE["c_cdc_apply"] = _NEWEST_CHANGES
ORACLE["c_cdc_merge"] = _NEWEST_CHANGES
_RIDER_KEY = _salted("c_custkey || '_20240102030405'")
ORACLE["c_cdc_apply_riders"] = (
    f"SELECT {_RIDER_KEY} AS row_key, c_custkey::VARCHAR AS id, c_name AS city_name FROM customer WHERE c_custkey % 10 <> 0"
)
_DRIVER_KEY = _salted("s_suppkey || '_20240203040506'")
ORACLE["c_cdc_apply_drivers"] = f"""SELECT {_DRIVER_KEY} AS row_key, s_suppkey::VARCHAR AS id, s_name AS driver_name,
    s_nationkey::INTEGER AS cancel_count FROM supplier"""
_ALLIANCE_KEY = _salted("p_partkey || '_20240304050607'")
ORACLE["c_cdc_apply_alliances"] = f"""SELECT {_ALLIANCE_KEY} AS row_key, p_partkey::VARCHAR AS id_, p_name AS alliance_name,
    p_size::INTEGER AS state FROM part"""
ORACLE["c_cdc_unkeyed"] = """SELECT c_custkey::BIGINT AS seq, 'insert' AS type, c_custkey::VARCHAR AS id FROM customer
    WHERE c_custkey % 10 = 0"""
ORACLE["c_cdc_stream"] = _NEWEST_CHANGES

_STORE = """SELECT order_id || '_' || ts AS rowkey, '075' AS city_code, driver_id, order_id, ts AS "timestamp",
    strftime(make_timestamp(ts * 1000000), '%Y-%m-%d %H:%M:%S') AS time, lng, lat FROM gps WHERE NOT is_end
    QUALIFY row_number() OVER (PARTITION BY order_id, ts ORDER BY seq DESC) = 1"""
ORACLE["g_point_store"] = _with(_STORE, "gps")
ORACLE["g_stream_points"] = ORACLE["g_point_store"]
ORACLE["g_live_orders"] = _with(
    """SELECT '075_' || order_id AS order_key, order_id FROM (SELECT * FROM gps
       QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY seq DESC) = 1) WHERE NOT is_end""",
    "gps",
)
_SPAN = """SELECT '075' AS cityCode, s.order_id AS orderId, s.ts * 1000 AS startTime, e.ts * 1000 AS endTime,
    s.lat AS getOnLat, s.lng AS getOnLng, e.lat AS getOfLat, e.lng AS getOfLng
    FROM (SELECT * FROM gps WHERE NOT is_end QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY ts, seq) = 1) s
    JOIN (SELECT * FROM gps WHERE NOT is_end QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY ts DESC, seq) = 1) e
         ON s.order_id = e.order_id"""
ORACLE["g_order_span"] = _with(_SPAN, "gps")
ORACLE["g_stream"] = ORACLE["g_order_span"]
ORACLE["g_span_stream"] = ORACLE["g_order_span"]
ORACLE["g_live_stream"] = _with(
    f"""SELECT '075_' || order_id AS order_key, order_id FROM (SELECT order_id, arg_max(is_end, seq) AS ended, max(ts) AS last
        FROM gps GROUP BY 1) WHERE NOT ended AND last >= (SELECT max(ts) FROM gps) - {catalog.LIVE_HORIZON_DAYS} * 86400""",
    "gps",
)
_HOURS = """SELECT strftime(make_timestamp(ts * 1000000), '%Y-%m-%d') AS day,
    hour(make_timestamp(ts * 1000000))::INTEGER AS hour, count(*) AS order_count
    FROM (SELECT * FROM gps WHERE NOT is_end QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY seq) = 1)
    GROUP BY 1, 2"""
ORACLE["g_hour_count"] = _with(_HOURS, "gps")
ORACLE["g_hour_stream"] = ORACLE["g_hour_count"]
ORACLE["g_hour_board"] = _with(
    f"""SELECT '075_' || day || '_' || hour AS field, order_count FROM ({_HOURS})
        WHERE day = '{catalog.BOARD_DAY}'""",
    "gps",
)
_CITY = "CASE WHEN split_part(order_id, '_', 1)::BIGINT % 2 = 0 THEN '075' ELSE '0898' END"
_CITY_HOURS = f"""SELECT {_CITY} AS city_code, strftime(make_timestamp(ts * 1000000), '%Y-%m-%d') AS day,
    hour(make_timestamp(ts * 1000000))::INTEGER AS hour, count(*) AS order_count
    FROM (SELECT * FROM gps WHERE NOT is_end QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY seq) = 1)
    GROUP BY 1, 2, 3"""
ORACLE["g_hour_city"] = _with(_CITY_HOURS, "gps")
ORACLE["g_hour_board_city"] = _with(
    f"""SELECT city_code || '_' || day || '_' || hour AS field, order_count FROM ({_CITY_HOURS})
        WHERE day = '{catalog.BOARD_DAY}' AND city_code = '{catalog.BOARD_CITY}'""",
    "gps",
)
_MOST = "(SELECT order_id FROM gps GROUP BY 1 ORDER BY count(*) DESC, order_id LIMIT 1)"
ORACLE["g_track_one"] = _with(
    f"""SELECT order_id, ts, lng, lat FROM gps WHERE NOT is_end AND order_id = {_MOST}
        AND ts BETWEEN {catalog.TRACK_BOUNDS[0]} AND {catalog.TRACK_BOUNDS[1]}""",
    "gps",
)
ORACLE["g_feed_one"] = _with(
    f"""SELECT order_id, seq, CASE WHEN is_end THEN 'end' ELSE lng || ',' || lat END AS message FROM gps
        WHERE order_id = {_MOST}""",
    "gps",
)
ORACLE["g_track_push"] = _with(
    "SELECT order_id, seq, CASE WHEN is_end THEN 'end' ELSE lng || ',' || lat END AS message FROM gps", "gps"
)
ORACLE["g_latest_point"] = _with(
    """SELECT order_id, lng, lat FROM gps WHERE NOT is_end
       QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY seq DESC) = 1""",
    "gps",
)
ORACLE["g_track_history"] = _with(
    f"""SELECT order_id, ts, lng, lat FROM gps WHERE NOT is_end
        AND ts BETWEEN {catalog.TRACK_BOUNDS[0]} AND {catalog.TRACK_BOUNDS[1]}""",
    "gps",
)
ORACLE["g_order_history"] = _with(
    """SELECT p.order_id, p.ts, p.lng, p.lat FROM gps p JOIN (
           SELECT order_id, min(ts) AS first, max(ts) AS last FROM gps WHERE NOT is_end GROUP BY 1
       ) s USING (order_id) WHERE NOT p.is_end AND p.ts BETWEEN s.first AND s.last""",
    "gps",
)
ORACLE["g_feed_requests"] = _with(
    """SELECT r.id || '_20240115' AS order_id, g.seq, CASE WHEN g.seq IS NULL THEN 'none' WHEN g.is_end THEN 'end'
              ELSE g.lng || ',' || g.lat END AS message
       FROM riders r LEFT JOIN gps g ON g.order_id = r.id || '_20240115'""",
    "riders", "gps",
)
_IN_BOUNDS = f"time >= '{catalog.POINT_BOUNDS[0]}' AND time <= '{catalog.POINT_BOUNDS[1]}' AND city_code = '075'"
ORACLE["g_points_query"] = _with(f"SELECT * EXCLUDE (city_code) FROM ({_STORE}) WHERE {_IN_BOUNDS}", "gps")
ORACLE["g_points_brief"] = _with(f"SELECT time, lng, lat FROM ({_STORE}) WHERE {_IN_BOUNDS}", "gps")
ORACLE["g_overview"] = _with(
    f"""SELECT coalesce(s.day, h.day) AS day, coalesce(nullif(h.n, 0), s.order_count)::BIGINT AS order_count,
               s.passenger_count
        FROM (SELECT strftime(ts, '%Y-%m-%d') AS day, count(DISTINCT user_id || '_' || strftime(ts, '%Y%m%d')) AS order_count,
                     count(DISTINCT user_id) AS passenger_count FROM events GROUP BY 1) s
        FULL OUTER JOIN (SELECT day, sum(order_count) AS n FROM ({_HOURS}) GROUP BY 1) h ON s.day = h.day""",
    "gps",
)

# --- published views and job metrics ---------------------------------------------------------

_REPORT_SQL = {
    "final_summary_order": (_BOARD, ("trips",)),
    "summary_plat": (_PLATFORM, ("trips",)),
    "summary_order_register_pay": (_RIDER_PAY, ("trips", "riders")),
    "summary_register_active": (_NEW_ACTIVE, ("riders",)),
    "register_status": (_NEW_SUMMARY, ("riders",)),
    "state_rate": (_RETENTION_SUMMARY, ("riders",)),
    "active": (_ACTIVE_SUMMARY.replace(_inside(_A, "day", "last_logon_time"), _inside(_R, "day", "last_logon_time"))
               .replace(_inside(_A, "week", "last_logon_time"), _inside(_R, "week", "last_logon_time")), ("riders",)),
    "driver_order_summary": (_DRIVER_SUMMARY, ("trips",)),
    "final_summary_pat_order": (_CITY_SUMMARY, ("trips",)),
    "register_driver": (_REGISTERED_SUMMARY, ("drivers",)),
    "hot_area_result": (_HEAT, ("trips",)),
    "hot_order": (_HOT_ORDER, ("trips",)),
}
for _name, (_sql, _tables) in _REPORT_SQL.items():
    ORACLE[f"m_view_{_name}"] = _with(
        f"SELECT {', '.join(reports.VIEW_COLUMNS[_name])} FROM ({_sql})", *_tables
    )
ORACLE["m_views"] = _with(
    " UNION ALL ".join(
        f"SELECT '{name}' AS \"view\", count(*) AS num_rows FROM ({sql})" for name, (sql, _) in _REPORT_SQL.items()
    ),
    "trips", "riders", "drivers",
)

_TASKS = """SELECT event_id AS task_id, 'host' || (event_id % 7) AS host, false AS speculative,
    event_type = 'error' AS failed, false AS killed, floor(epoch(ts))::BIGINT * 1000 AS finish_time,
    event_id * 31 % 5000 AS executor_cpu_time, event_id % 23 AS jvm_gc_time, event_id % 29 AS deserialize_cpu_time,
    event_id % 31 AS deserialize_time, event_id % 37 AS result_size, event_id % 41 AS result_serialization_time,
    event_id % 43 * 1024 AS memory_bytes_spilled, event_id % 47 * 1024 AS disk_bytes_spilled,
    event_id % 11 AS remote_blocks_fetched, event_id % 13 AS local_blocks_fetched,
    event_id * 7 % 1000 AS remote_bytes_read, event_id * 3 % 1000 AS local_bytes_read,
    event_id % 17 AS fetch_wait_time, event_id % 100 AS shuffle_records_read,
    event_id * 5 % 1000 AS shuffle_bytes_written, event_id % 101 AS shuffle_records_written,
    event_id % 19 AS shuffle_write_time, event_id % 53 AS input_bytes, event_id % 59 AS input_records,
    event_id % 61 AS output_bytes, event_id % 67 AS output_records FROM events"""
ORACLE["m_task_metrics"] = _TASKS
_SUMMED = (
    "executor_cpu_time jvm_gc_time memory_bytes_spilled disk_bytes_spilled remote_bytes_read local_bytes_read "
    "shuffle_bytes_written input_records output_records"
).split()
ORACLE["m_task_totals"] = f"""SELECT host, count(*) AS tasks, count(*) FILTER (WHERE failed) AS failed_tasks,
    {', '.join(f'sum({c})::BIGINT AS {c}' for c in _SUMMED)} FROM ({_TASKS}) GROUP BY 1"""
ORACLE["m_last_task"] = f"SELECT * FROM ({_TASKS}) ORDER BY finish_time DESC, task_id DESC LIMIT 1"
ORACLE["m_batch_metrics"] = f"""SELECT 'gps' AS query, event_id AS batch_id, event_id % 500 AS records,
    event_id * 37 % 9000 - event_id * 11 % 700 AS schedule_delay, event_id * 37 % 9000 AS total_delay,
    epoch_us(ts) // 1000 AS processing_start, epoch_us(ts) // 1000 + event_id * 37 % 9000 AS processing_end,
    event_id + 1 AS finished_batches, event_id * 37 % 9000 > {6 * catalog.BATCH_INTERVAL_MS} AS blocked FROM events"""


def _kind(kind: str) -> str:
    return f"count(*) FILTER (WHERE event_type = '{kind}')"


def _percent(part: str, *parts: str) -> str:
    return f"CASE WHEN {part} = 0 THEN 0.0::DOUBLE ELSE round({part} * 100 / nullif({' + '.join(parts)}, 0), 2) END"


_STAGES = ("failed", "running", "waiting")
_BATCHES = ("running_b", "waiting_b", "done_b")
_MEMORY = ("used", "free")
_HEALTH = f"""SELECT ts, {_percent('failed', *_STAGES)} AS error_rate, {_percent('running', *_STAGES)} AS operating_rate,
    {_percent('waiting', *_STAGES)} AS waiting_rate, {_percent('running_b', *_BATCHES)} AS running_batch_share,
    {_percent('waiting_b', *_BATCHES)} AS waiting_batch_share, {_percent('done_b', *_BATCHES)} AS completed_batch_share,
    {_percent('used', *_MEMORY)} AS used_memory_share, {_percent('free', *_MEMORY)} AS free_memory_share,
    {_percent('most', *_MEMORY)} AS max_memory_share
    FROM (SELECT epoch(date_trunc('hour', ts))::BIGINT AS ts, {_kind('error')} AS failed, {_kind('view')} AS running,
                 {_kind('click')} AS waiting, {_kind('signup')} AS running_b, {_kind('purchase')} AS waiting_b,
                 count(*) AS done_b, count(*) * 100 AS most, {_kind('view')} * 10 AS used, {_kind('click')} * 10 AS free
          FROM events GROUP BY 1)"""
ORACLE["m_health_all"] = _HEALTH
ORACLE["m_health_ratios"] = f"{_HEALTH} ORDER BY ts DESC LIMIT 5"
_STEP = catalog.SNAPSHOT_STEP_MS
_JOB_LOG = """SELECT event_id AS n, epoch_ms(ts) AS t, epoch_ms(ts) + event_id % 7 * 1000 AS begin,
    epoch_ms(ts) + event_id % 7 * 1000 + event_id % 50 * 60000 AS done, event_type = 'error' AS failed,
    epoch_ms(ts) + 5400000 AS job_end, epoch_ms(ts) + event_id % 90 * 1000 AS batch_end FROM events"""
# What happened up to each hour: every term is a count of starts less a count of ends.
_CHANGES_OF_LOG = f"""
    SELECT 'runningStages' AS counter, begin AS time, 1 AS delta FROM log UNION ALL SELECT 'runningStages', done, -1 FROM log
    UNION ALL SELECT 'failedStages', done, 1 FROM log WHERE failed
    UNION ALL SELECT 'waitingStages', t, 2 FROM log UNION ALL SELECT 'waitingStages', begin, -1 FROM log
    UNION ALL SELECT 'waitingStages', job_end, -1 FROM log
    UNION ALL SELECT 'runningBatches', t, 1 FROM log WHERE n % 3 = 0 UNION ALL SELECT 'runningBatches', batch_end, -1 FROM log WHERE n % 3 = 0
    UNION ALL SELECT 'totalCompletedBatches', batch_end, 1 FROM log WHERE n % 3 = 0
    UNION ALL SELECT 'waitingBatches', t + k * 20000, 1 FROM log, range(1, 5) r(k) WHERE n % 3 = 0 AND t + k * 20000 <= batch_end
    UNION ALL SELECT 'waitingBatches', batch_end, -1 FROM log, range(1, 5) r(k) WHERE n % 3 = 0 AND t + k * 20000 <= batch_end
    UNION ALL SELECT 'maxMem', t, 1024 FROM log WHERE n % 7 = 0"""
_COUNTERS = ("failedStages", "runningStages", "waitingStages", "runningBatches", "waitingBatches", "totalCompletedBatches")
_LOG_SNAPSHOTS = f"""SELECT make_timestamp(step * {_STEP} * 1000) AS ts,
    {", ".join(f"sum(coalesce({c}, 0)) OVER (ORDER BY step)::BIGINT AS {c}" for c in _COUNTERS)},
    sum(coalesce(maxMem, 0)) OVER (ORDER BY step)::DOUBLE AS maxMem_MB
    FROM (SELECT unnest(range(first, last + 1)) AS step FROM (SELECT min(step) AS first, max(step) AS last FROM steps)) LEFT JOIN steps USING (step)"""
_LOG_WITH = f"""WITH log AS ({_JOB_LOG}), changes AS ({_CHANGES_OF_LOG}), steps AS (
    SELECT ceil(time / {_STEP})::BIGINT AS step,
           {", ".join(f"sum(delta) FILTER (WHERE counter = '{c}') AS {c}" for c in (*_COUNTERS, "maxMem"))} FROM changes GROUP BY 1)"""
ORACLE["m_snapshots"] = f"{_LOG_WITH} {_LOG_SNAPSHOTS}"


def _share(part: str, *parts: str) -> str:
    return f"CASE WHEN {part} = 0 THEN 0.0::DOUBLE ELSE round({part} * 100.0::DOUBLE / ({' + '.join(parts)}), 2) END"


_STAGES, _BATCHES = _COUNTERS[:3], _COUNTERS[3:]
ORACLE["m_health_log"] = f"""{_LOG_WITH} SELECT ts, {_share("failedStages", *_STAGES)} AS error_rate,
    {_share("runningStages", *_STAGES)} AS operating_rate, {_share("waitingStages", *_STAGES)} AS waiting_rate,
    {_share("totalCompletedBatches", *_BATCHES)} AS completed_batch_share FROM ({_LOG_SNAPSHOTS}) ORDER BY ts DESC LIMIT 5"""
