"""Line parsers, change log, upserts and stations."""

import json

import pytest
from pyspark.sql import functions as F

from hailstat.operators import changes, stations
from hailstat.sources import lines, tables


def line_rows(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "seq bigint, value string")


def change(table="order_info_201907", type_="insert", ts=1, **data):
    record = {"database": "rides", "ts": ts, "data": data}
    if table is not None:
        record["table"] = table
    if type_ is not None:
        record["type"] = type_
    return json.dumps(record)


def test_change_log_routes(spark):
    log = line_rows(spark, [
        change(id_="1", create_time="2019-07-15 10:00:00", pay_all=12.5, cancel="0", open_lng="x", city_name=""),
        change(table=None, id_="2"),
        change(type_=None, id_="3"),
        change(table="renter_info", id_="4", last_login_city="120300"),
        change(table="driver_info", id_=5, cancel_count=3),
        change(table="opt_alliance_business", id_="6", state="1", update_time="no time"),
        change(table="driver_info_old", id_="7"),
        "not json",
    ])
    parsed = lines.parse_change_log(log)
    orders = {r["id"]: r for r in parsed["order_info"].collect()}
    assert set(orders) == {"1", "3"}
    first = orders["1"]
    assert (first["pay_all"], first["cancel"], first["open_lng"], first["city_name"]) == (12.5, 0, None, None)
    assert first["table"] == "order_info_201907" and orders["3"]["type"] == "insert"
    assert [r["last_login_city"] for r in parsed["renter_info"].collect()] == ["120300"]
    assert [(r["id"], r["cancel_count"]) for r in parsed["driver_info"].collect()] == [("5", 3)]
    alliance = parsed["opt_alliance_business"].first()
    assert (alliance["id_"], alliance["state"], alliance["update_time"]) == ("6", 1, None)
    assert sorted(r["seq"] for r in parsed["rejects"].collect()) == [1, 6, 7]


CREATED = "2019-07-15 10:00:00"


def test_changes_are_applied_newest_first(spark):
    log = line_rows(spark, [
        change(id_="1", ts=2, create_time=CREATED, pay_all=2, type_="update"),
        change(id_="1", ts=1, create_time=CREATED, pay_all=1),
        change(id_="1", ts=3, create_time=CREATED, pay_all=3, type_="delete"),
        change(id_=None, ts=1, create_time=CREATED, pay_all=9),
        change(id_="2", ts=1, create_time=CREATED, pay_all=5),
        change(id_="2", ts=1, create_time=CREATED, pay_all=6, type_="update"),
    ])
    rows = lines.parse_changes(log, "order_info")
    applied = changes.apply_changes(None, rows)
    assert {(r["id"], r["pay_all"]) for r in applied.collect()} == {("1", 2.0), ("2", 6.0)}
    # A later batch with an older change does not win; a new key is added; others stay.
    late = lines.parse_changes(line_rows(spark, [
        change(id_="1", ts=1, create_time=CREATED, pay_all=7), change(id_="3", ts=1, create_time=CREATED, pay_all=8),
    ]), "order_info")
    again = changes.apply_changes(applied, late)
    assert {(r["id"], r["pay_all"]) for r in again.collect()} == {("1", 2.0), ("2", 6.0), ("3", 8.0)}


def test_upsert_replaces_only_touched_days(spark, tmp_path):
    path = str(tmp_path / "t")
    ddl = "key string, day string, ts bigint, v string"

    def put(*data):
        tables.upsert(spark, spark.createDataFrame(list(data), ddl), path, ["key"], ["ts"], "day")

    def stored():
        return {tuple(r) for r in spark.read.schema(ddl).parquet(path).select("key", "day", "ts", "v").collect()}

    put(("a", "d1", 1, "x"), ("b", "d1", 1, "x"), ("c", "d2", 1, "x"))
    put(("a", "d1", 2, "y"), ("b", "d1", 0, "old"), ("e", "d3", 1, "z"))
    expected = {("a", "d1", 2, "y"), ("b", "d1", 1, "x"), ("c", "d2", 1, "x"), ("e", "d3", 1, "z")}
    assert stored() == expected
    put(("a", "d1", 2, "y"), ("b", "d1", 0, "old"), ("e", "d3", 1, "z"))
    assert stored() == expected


def test_typed_never_fails(spark):
    df = spark.createDataFrame([("", "x", "2019-07-15 10:00:00"), ("1", "2.5", "")], "a string, b string, c string")
    out = tables.typed(df, "a int, b double, c timestamp").collect()
    assert [(r["a"], r["b"], r["c"] is None) for r in out] == [(None, None, False), (1, 2.5, True)]


def test_gps_lines(spark):
    log = line_rows(spark, [
        "d,o,100,110.1,19.9", "d,o,100,110.1", "d,o,100,east,19.9", "end,o", "d,o,100,110.1,19.9,extra",
        "friend,o,100,110.1,19.9", "end", "",
    ])
    points = {r["seq"] for r in lines.parse_gps_points(log).collect()}
    assert points == {0, 4}
    events = {r["seq"]: r["is_end"] for r in lines.parse_gps_events(log).collect()}
    assert events == {0: False, 3: True, 5: False}
    end = lines.parse_gps_events(log).where("is_end").first()
    assert (end["order_id"], end["ts"], end["driver_id"]) == ("o", None, None)
    assert {r["seq"] for r in lines.rejected_gps(log).collect()} == {1, 2, 6, 7}


def order_line(n=24, first="4200000000017"):
    return "\t".join([first] + [str(i) for i in range(1, n)])


def test_order_lines(spark):
    log = line_rows(spark, [order_line(), order_line(23), order_line(first="dwv_order_make_haikou.order_id")])
    parsed = lines.parse_order_lines(log).collect()
    assert [(r["order_id"], r["starting_lng"], r["day"]) for r in parsed] == [("4200000000017", "19", "23")]
    assert lines.read_station_input(lines.parse_order_lines(log)).dtypes == [
        ("order_id", "string"), ("city_id", "string"), ("starting_lng", "double"), ("starting_lat", "double"),
    ]


def test_result_table(spark, tmp_path):
    path = str(tmp_path / "r")
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "k string, n int")
    for _ in range(2):
        tables.save_result(df, path, "k", ["k", "n"])
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [("a", "1"), ("b", "2")]


def test_presplit_uses_all_regions(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("id"))
    placed = tables.presplit(df, F.col("id"), splits=3)
    assert placed.rdd.getNumPartitions() == 24 and placed.count() == 2000
    assert placed.select("region").distinct().count() == 8
    load = tables.region_load(df, F.col("id"))
    assert load.agg(F.sum("num_rows")).first()[0] == 2000


ORDERS = "order_id string, city_id string, starting_lng double, starting_lat double"


def test_station_is_the_lowest_point_by_number(spark):
    orders = spark.createDataFrame(
        [("b", "1", 110.20001, 19.9), ("a", "1", 110.20001, 19.9), ("c", "1", 110.20002, 19.9), ("d", "1", 110.5, 19.9)],
        ORDERS,
    )
    found = {(r["order_id"], r["trip_count"]) for r in stations.stations(orders).collect()}
    assert found == {("a", 3), ("d", 1)}
    assert [r["order_id"] for r in stations.stations(orders, min_trips=2).collect()] == ["a"]
    below = spark.createDataFrame([("n", "1", 9.00001, 5.0), ("m", "1", 10.0, 5.0)], ORDERS)
    assert {r["order_id"] for r in stations.stations(below, res=1).collect()} <= {"n", "m"}


def in_polygon(point, ring):
    """Plain even-odd test."""
    x, y = point
    inside = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            inside = not inside
    return inside


@pytest.mark.parametrize("join", [stations.with_district, stations.with_broadcast_districts])
@pytest.mark.parametrize("tile", [0.1, 0.03])
def test_district_join_against_brute_force(spark, join, tile):
    shapes = {
        "box": [(110.1, 19.9), (110.3, 19.9), (110.3, 20.1), (110.1, 20.1)],
        "arrow": [(110.25, 19.95), (110.65, 19.85), (110.4, 20.0), (110.6, 20.15)],
    }
    polygons = [("1", n, ";".join(f"{x},{y}" for x, y in ring)) for n, ring in shapes.items()] + [("1", "none", "")]
    points = [(str(i), "1", 110.0 + (i * 7919 % 7000) / 10000 + 3e-5, 19.8 + (i * 104729 % 4000) / 10000 + 3e-5)
              for i in range(500)]
    expected = {(p[0], n) for p in points for n, ring in shapes.items() if in_polygon(p[2:], ring)}
    edges = stations.district_edges(spark.createDataFrame(polygons, "citycode string, name string, polygon string"))
    joined = join(spark.createDataFrame(points, ORDERS), edges, tile)
    assert {(r["order_id"], r["district_name"]) for r in joined.collect()} == expected and expected


def test_holes_and_parts_of_a_geojson(spark):
    def square(x, y, a):
        return [[x, y], [x + a, y], [x + a, y + a], [x, y + a], [x, y]]

    document = {"type": "FeatureCollection", "features": [{
        "type": "Feature", "properties": {"name": "D", "citycode": "7"},
        "geometry": {"type": "MultiPolygon",
                     "coordinates": [[square(0, 0, 4), square(1, 1, 2)], [square(10, 0, 1)]]},
    }]}
    rings = stations.parse_geojson(spark.createDataFrame([(json.dumps(document),)], "value string"))
    assert rings.count() == 3
    assert {r["citycode"] for r in rings.collect()} == {"7"}
    edges = stations.rings_to_edges(rings)
    points = spark.createDataFrame(
        [("ring", "1", 0.5, 0.5), ("hole", "1", 2.1, 2.1), ("part", "1", 10.5, 0.5), ("out", "1", 6.1, 0.5)], ORDERS
    )
    assert {r["order_id"] for r in stations.with_district(points, edges, tile=1.0).collect()} == {"ring", "part"}


def test_polygon_feature_and_bad_vertex(spark):
    document = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"name": "P"}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1]]]}},
        {"type": "Feature", "properties": {"name": "X"}, "geometry": {"type": "Point", "coordinates": [0, 0]}},
    ]}
    rings = stations.parse_geojson(spark.createDataFrame([(json.dumps(document),)], "value string")).collect()
    assert [(r["district_name"], r["citycode"], len(r["ring"])) for r in rings] == [("P", None, 3)]
    shapes = spark.createDataFrame(
        [("1", "bad", "0,0;4,0;bad;4,4"), ("1", "nan", "0,0;4,0;NaN,1"), ("1", "good", "0,0;4,0;4,4"), ("1", "blank", "")],
        "citycode string, name string, polygon string",
    )
    assert {r["district_name"] for r in stations.district_edges(shapes).collect()} == {"good"}
    assert {r["name"] for r in stations.rejected_districts(shapes).collect()} == {"bad", "nan"}


def test_broadcast_is_refused_beyond_its_bound(spark):
    edges = stations.district_edges(spark.createDataFrame([("1", "a", "0,0;4,0;4,4")], "citycode string, name string, polygon string"))
    with pytest.raises(ValueError):
        stations.with_broadcast_districts(spark.createDataFrame([("x", "1", 1.0, 1.0)], ORDERS), edges, limit=2)


def test_numbers_beyond_any_place_or_time_are_rejected(spark):
    bad = ["d,o,9000000000000000000,110.1,19.9", "d,o,-5,110.1,19.9", "d,o,1,NaN,19.9", "d,o,1,110.1,Infinity", "d,o,1,181,19.9", "d,o,1,110,1e400"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate([*bad, "d,o,1,110.1,19.9"])], "seq bigint, value string")
    assert [r["seq"] for r in lines.parse_gps_points(df).collect()] == [len(bad)]
    assert {r["seq"] for r in lines.rejected_gps(df).collect()} == set(range(len(bad)))


def test_changes_without_a_creation_time(spark):
    from hailstat.operators import changes

    rows = spark.createDataFrame(
        [("insert", "1", "2024-01-01 00:00:00", None), ("update", "2", None, "2024-01-02 00:00:00"), ("insert", "3", None, None),
         ("insert", None, "2024-01-01 00:00:00", None), ("delete", "5", None, None)],
        "type string, id string, create_time string, last_logon_time string",
    ).selectExpr("type", "id", "timestamp(create_time) create_time", "timestamp(last_logon_time) last_logon_time")
    assert {r["id"]: str(r["create_day"]) for r in changes.keyed_changes(rows).collect()} == {"1": "2024-01-01", "2": "2024-01-02"}
    assert {r["id"] for r in changes.unkeyed_changes(rows).collect()} == {"3", None}


def test_nested_district_documents(spark):
    document = {"districts": [{"name": "C", "citycode": "1", "level": "city", "districts": [
        {"name": "a", "citycode": "1", "polyline": "1,1;2,2", "level": "district"},
        {"name": "b", "citycode": "1", "level": "district"},
        {"name": "s", "citycode": "1", "polyline": "1,1", "level": "street"},
    ]}, {"name": "d", "citycode": "2", "polyline": "3,3", "level": "district"}]}
    parsed = stations.parse_districts(spark.createDataFrame([(json.dumps(document),)], "value string"))
    assert {tuple(r) for r in parsed.collect()} == {("1", "a", "1,1;2,2"), ("2", "d", "3,3")}


def test_station_lookup_filters(spark):
    placed = spark.createDataFrame(
        [("1", "a", 1.0, 2.0), ("1", "b", 1.0, 2.0), ("2", "a", 1.0, 2.0)],
        "city_id string, district_name string, starting_lng double, starting_lat double",
    )
    assert stations.find_stations(placed).count() == 3
    assert stations.find_stations(placed, city="1").count() == 2
    assert stations.find_stations(placed, city="1", district="b").count() == 1
    assert stations.find_stations(placed, city="", district="a").count() == 2
    assert {tuple(r) for r in stations.station_count(placed, "1").collect()} == {("a", 1), ("b", 1)}
