"""Hand-made cases of the reports."""

from pyspark.sql import functions as F

from hailstat.operators import completion, drivers, hotareas, riders, trips
from hailstat.periods import Period
from hailstat.plans import catalog, reports
from hailstat.sources import sample

P = Period.of("1998-07-15")
TRIPS = (
    "id string, create_time timestamp, city_name string, driver_id string, driver_name string, cancel int, "
    "begin_address_code string, vehicle_license string"
)


def as_set(df):
    return {tuple(r) for r in df.collect()}


def as_list(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def trip(id_, day, city="A", driver="1", name="N", cancel=0, area="120301", vehicle="V1"):
    return (id_, day, city, driver, name, cancel, area, vehicle)


def test_city_with_only_cancelled_trips_is_absent(rows):
    df = rows([trip("1", "1998-07-15"), trip("2", "1998-07-15", city="B", cancel=1)], TRIPS)
    assert [r["city_name"] for r in completion.city_summary(df, P).collect()] == ["A"]


def test_city_without_trips_in_the_year_is_absent(rows):
    df = rows([trip("1", "1997-07-15")], TRIPS)
    assert completion.city_summary(df, P).count() == 0


def test_missing_rates_are_zero_text(rows):
    df = rows([trip("1", "1998-01-02"), trip("2", "1998-01-03", cancel=2), trip("3", "1998-01-03")], TRIPS)
    assert as_set(completion.city_summary(df, P)) == {("1", "A", "66.67%", "0.0%", "0.0%", "0.0%", "0.0%")}


def test_null_city_has_no_total(rows):
    df = rows([trip("1", "1998-07-15", city=None), trip("2", "1998-07-15", city="A")], TRIPS)
    assert as_set(completion.completion(df, completion.CITY, P, "day")) == {(None, 1, None, None), ("A", 1, 1, "100.0%")}
    summary = {r["city_name"]: tuple(r)[2:] for r in completion.city_summary(df, P).collect()}
    assert summary[None] == (None, "0.0%", "0.0%", "0.0%", "0.0%")


def test_renamed_driver_gives_two_rows(rows):
    df = rows([trip("1", "1998-07-15", name="old"), trip("2", "1998-07-15", name="new"),
               trip("3", "1998-07-15", name="new", cancel=1)], TRIPS)
    assert as_set(completion.completion(df, completion.DRIVER, P, "day")) == {
        ("1", "old", 1, 1, "100.0%"), ("1", "new", 1, 2, "50.0%"),
    }
    assert completion.driver_summary(df, P).count() == 2


def test_one_pass_equals_join_chain(spark):
    df = sample.trips(spark, "/root/testdata/sf0.01", "create_time", "city_name", "cancel")
    by_joins = completion.completion_summary_by_joins(df, completion.CITY, P, F.lit("1"))
    assert as_set(completion.city_summary(df, P)) == as_set(by_joins)


def test_summary_scans_once_and_shuffles_once(spark, rows, tmp_path):
    path = str(tmp_path / "trips")
    rows([trip("1", "1998-07-15")], TRIPS).write.parquet(path)
    df = completion.city_summary(spark.read.parquet(path), P)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    assert "driver_id" not in plan


def test_board_equals_its_joined_form(rows):
    df = rows([
        trip("1", "1998-07-15"), trip("2", "1998-07-02", vehicle="V2"), trip("3", "1998-07-02", vehicle=None),
        trip("4", "1998-07-03", area="999901", vehicle="V1"), trip("5", "1998-07-16", area=None, vehicle="V9"),
        trip("6", "1997-07-15", area="120302"), trip("7", "1998-06-30", area="888801"),
    ], TRIPS)
    joined = trips.merge_board(trips.vehicle_counts(df, P), trips.trip_counts(df, P))
    board = trips.city_board(df, P)
    assert board.columns == joined.columns
    assert as_list(board) == as_list(joined)
    assert as_list(board) == sorted([
        ("120300", "2", "1", "120300", "3", "2", "1"),
        ("999900", "1", "0", "999900", "1", "0", "0"),
        (None, "1", "0", None, "0", "0", "0"),
        (None, "0", "0", None, "1", "0", "0"),
    ], key=str)


def test_board_with_an_area_on_one_side(rows):
    vehicles = rows([("1203", 5, 1)], "begin_address_code string, monthVehicleCount bigint, dayVehicleCount bigint")
    orders = rows([("1304", 7, None, 2)],
                  "begin_address_code string, monthOrderCount bigint, weekOrderCount bigint, dayOrderCount bigint")
    assert as_set(trips.merge_board(vehicles, orders)) == {
        ("120300", "5", "1", "120300", "0", "0", "0"), ("130400", "0", "0", "130400", "7", "0", "2"),
    }


def test_average_of_a_single_day_is_null(rows):
    one_day = rows([("1998-07-15 01:00:00",), ("1998-07-15 23:00:00",)], "create_time timestamp")
    assert as_set(trips.average_per_day(one_day)) == {(None,)}
    two = rows([("1998-07-15",), ("1998-07-16",), ("1998-07-17",)], "create_time timestamp")
    assert as_set(trips.average_per_day(two)) == {(1.5,)}


def test_order_rider_pay_of_nothing(rows):
    paid = rows([], "pay_all double")
    assert as_set(trips.order_rider_pay(paid, rows([], "id string"))) == {(1, "0", "0", None)}


def test_registrations(rows):
    df = rows([("1", "1998-07-15", "120300"), ("1", "1998-07-16", "120300"), ("2", "1998-02-01", "120300"),
               ("3", "1997-07-15", "130400")], "id string, create_time timestamp, register_city string")
    assert as_set(drivers.registration_summary(df, P)) == {("120300", "120300", "2", "1", "1", "1", "1")}


RIDERS = "id string, create_time timestamp, last_login_city string, last_logon_time timestamp"


def test_retention_uses_the_last_login_only(rows):
    df = rows([
        ("1", "2024-01-01 08:00:00", "120300", "2024-01-02 09:00:00"),
        ("2", "2024-01-01 08:00:00", "120300", "2024-01-03 09:00:00"),
        ("3", "2024-01-01 08:00:00", "120300", "2024-01-01 09:00:00"),
        ("4", "2024-01-02 08:00:00", "120300", "2024-01-02 09:00:00"),
        (None, "2024-01-01 08:00:00", "120300", "2024-01-02 09:00:00"),
    ], RIDERS)
    assert as_set(riders.retention(df, "2024-01-01", "2024-01-02")) == {(1, "25.0%")}


def test_retention_of_an_empty_cohort(rows):
    df = rows([("1", "2024-01-01", "120300", "2024-01-02")], RIDERS)
    assert as_set(riders.retention(df, "2023-01-01", "2024-01-02")) == {(1, None)}
    summary = riders.retention_summary(
        df, day=("2024-01-01", "2024-01-02"), week=("2023-01-01", "2023-01-08"), month=("2024-01-01", "2024-01-31")
    )
    assert as_set(summary) == {("1", "0.0%", "0.0%", "100.0%")}
    assert summary.columns == ["myid", "monthStateRate", "weekStateRate", "dayStateRate"]


def test_retention_counts_repeated_ids_like_a_join(rows):
    df = rows([("1", "2024-01-01", "1", "2024-01-02"), ("1", "2024-01-01", "1", "2024-01-02")], RIDERS)
    joined = df.alias("c").join(df.alias("l"), "id").count()
    assert joined == 4
    row = riders._retained(df, {"r": ("2024-01-01", "2024-01-02")}).first()
    assert (row["r_matched"], row["r_cohort"]) == (4, 4)


def test_new_and_active_on_either_side(rows):
    df = rows([
        ("1", "2024-01-01", "110101", "2024-01-05"), ("2", "2023-01-01", "120201", "2024-01-01"),
        ("3", "2024-01-01", "", "2024-01-01"), ("4", "2024-01-01", None, "2024-01-01"),
    ], RIDERS)
    assert as_set(riders.new_active_by_city(df, Period.of("2024-01-01"))) == {
        ("110100", "110100", "1", "0"), ("120200", "120200", "0", "1"),
    }


HOT = "id string, create_time timestamp, open_lng double, open_lat double, begin_address_code string"
NOW, BEFORE = ("1998-07-15", "1998-07-16"), ("1998-07-14", "1998-07-15")


def hot_rows(rows):
    here, there, far = (110.2, 19.9), (110.5, 20.0), (110.6, 20.1)
    return rows([
        ("2", "1998-07-15 10:00:00", *here, "A"), ("1", "1998-07-15 10:00:00", *here, "B"),
        ("3", "1998-07-15 11:00:00", *here, "C"),
        ("4", "1998-07-14 10:00:00", *there, "B"), ("5", "1998-07-14 10:00:00", *there, "B"),
        ("6", "1998-07-14 11:00:00", *there, "B"), ("7", "1998-07-14 11:00:00", *far, "Z"),
        ("8", "1998-07-15 12:00:00", *far, None),
    ], HOT)


def test_hot_cell_takes_the_earliest_area_and_lower_id(rows):
    cells = hotareas.hot_cells(hot_rows(rows), *NOW)
    assert {(r["begin_address_code"], r["count"]) for r in cells.collect()} == {("B", 3), (None, 1)}
    assert as_set(cells) == as_set(hotareas.hot_cells_by_window(hot_rows(rows), *NOW))


def test_hot_cells_forms_agree_on_the_test_tables(spark):
    df = sample.trips(spark, "/root/testdata/sf0.01", *reports.HOT_COLUMNS)
    assert as_set(hotareas.hot_cells(df, *catalog.HOT_NOW)) == as_set(hotareas.hot_cells_by_window(df, *catalog.HOT_NOW))


def test_hot_delta_forms_agree(rows):
    df = hot_rows(rows)
    stored = hotareas.hot_delta(hotareas.hot_cells(df, *NOW), hotareas.hot_cells(df, *BEFORE))
    change = hotareas.hot_change(df, NOW, BEFORE)
    assert as_list(stored) == as_list(change)
    assert {(r["city_code"], r["count"]) for r in change.collect()} == {("B", 3), ("B", -3), ("Z", 0)}


def test_hot_order_forms_agree(rows):
    df = hot_rows(rows)
    now, before = hotareas.hot_cells(df, *NOW), hotareas.hot_cells(df, *BEFORE)
    joined = hotareas.hot_order(
        hotareas.area_totals(hotareas.as_detail(now)), hotareas.area_totals(hotareas.hot_delta(now, before))
    )
    assert as_list(hotareas.hot_order_report(df, NOW, BEFORE)) == as_list(joined)


def test_hot_detail_of_a_crowded_area(rows):
    cells = rows([("A", f"c{i}", 1200, 1) for i in range(5000)] + [("B", "c0", 1200, 4), (None, "n", 1200, 2)],
                 "city_code string, coordinate string, radius int, count bigint")
    found = hotareas.hot_detail(cells).collect()
    assert {(r["city_code"], r["city_num"]) for r in found if r["coordinate"] is None} == {("A", 5000), ("B", 4), (None, 2)}
    assert len(found) == 5002 + 3 and sum(r["count"] or 0 for r in found) == 5006
    assert all(r["city_num"] is None for r in found if r["coordinate"])


def test_heat_map_takes_the_latest_area(rows):
    heat = hotareas.heat_map(hot_rows(rows), "1998-07-15").collect()
    assert {(r["begin_address_code"], r["count"]) for r in heat} == {("C", 3), (None, 1)}
    lng, lat = (float(x) for x in [r for r in heat if r["count"] == 3][0]["centerPoint"].split(","))
    assert abs(lng - 110.2) < 0.02 and abs(lat - 19.9) < 0.02


def test_views(spark):
    reports.register_views(spark, catalog.inputs(spark, "/root/testdata/sf0.001"))
    assert spark.sql("select _year_comple_rate from final_summary_pat_order").count() == 24
    assert len(reports.REPORTS) == 12 and set(reports.REPORTS) == set(reports.VIEW_COLUMNS)
