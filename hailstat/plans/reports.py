"""The twelve published reports and the views they are read through."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from hailstat.operators import completion, drivers, hotareas, riders, trips
from hailstat.periods import Period


@dataclass(frozen=True)
class Inputs:
    """Where the reports take their tables from, and the periods they are made for.

    Tables are functions so that a report only reads what it needs; ``trips`` is told the columns.
    """

    trips: Callable[..., DataFrame]
    riders: Callable[[], DataFrame]
    drivers: Callable[[], DataFrame]
    trip_period: Period
    rider_period: Period
    driver_period: Period
    hot_now: tuple[str, str]
    hot_before: tuple[str, str]
    heat_since: str
    retention_day: tuple[str, str]
    retention_week: tuple[str, str]
    retention_month: tuple[str, str]


HOT_COLUMNS = ("id", "create_time", "open_lng", "open_lat", "begin_address_code")

# Report name to its builder. Inputs are read lazily.
REPORTS: dict[str, Callable[[Inputs], DataFrame]] = {
    "final_summary_order": lambda i: trips.city_board(
        i.trips("create_time", "begin_address_code", "vehicle_license"), i.trip_period
    ),
    "summary_plat": lambda i: trips.platform_summary(i.trips("create_time", "charge_mileage"), i.trip_period),
    "summary_order_register_pay": lambda i: trips.order_rider_pay(i.trips("pay_all"), i.riders()),
    "summary_register_active": lambda i: riders.new_active_by_city(i.riders(), i.rider_period),
    "register_status": lambda i: riders.new_summary(i.riders(), i.rider_period),
    "state_rate": lambda i: riders.retention_summary(
        i.riders(), i.retention_day, i.retention_week, i.retention_month
    ),
    "active": lambda i: riders.active_summary(i.riders(), i.rider_period),
    "driver_order_summary": lambda i: completion.driver_summary(
        i.trips("create_time", "driver_id", "driver_name", "cancel"), i.trip_period
    ),
    "final_summary_pat_order": lambda i: completion.city_summary(
        i.trips("create_time", "city_name", "cancel"), i.trip_period
    ),
    "register_driver": lambda i: drivers.registration_summary(i.drivers(), i.driver_period),
    "hot_area_result": lambda i: hotareas.heat_map(i.trips(*HOT_COLUMNS), i.heat_since),
    "hot_order": lambda i: hotareas.hot_order_report(i.trips(*HOT_COLUMNS), i.hot_now, i.hot_before),
}

# The columns that are read from each report.
VIEW_COLUMNS = {
    "final_summary_order": (
        "o_begin_address_code", "monthVehicleCount", "dayVehicleCount",
        "monthOrderCount", "weekOrderCount", "dayOrderCount",
    ),
    "summary_plat": ("totalOrderNum", "monthOrderNum", "avgOrderNum", "charge_mileage"),
    "summary_order_register_pay": ("totalCount", "registerTotalCount", "pay_all"),
    "summary_register_active": ("_city_code", "_day_new_user", "DAU"),
    "register_status": ("dayNewUserCount", "weekNewUserCount", "monthNewUserCount"),
    "state_rate": ("monthStateRate", "weekStateRate", "dayStateRate"),
    "active": ("DAU", "WAU", "MAU"),
    "driver_order_summary": (
        "driver_id", "driver_name", "_year_comple_rate", "_quarter_comple_rate",
        "_month_comple_rate", "_week_comple_rate", "_day_comple_rate",
    ),
    "final_summary_pat_order": (
        "city_name", "_year_comple_rate", "_quarter_comple_rate",
        "_month_comple_rate", "_week_comple_rate", "_day_comple_rate",
    ),
    "register_driver": (
        "register_city", "_register_year_num", "_register_quarter_num",
        "_register_month_num", "_register_week_num", "_register_day_num",
    ),
    "hot_area_result": ("begin_address_code", "centerPoint", "count"),
    "hot_order": ("_city_code", "_day_order_num", "_new_orders_num"),
}


def register_view(spark: SparkSession, inputs: Inputs, name: str) -> None:
    REPORTS[name](inputs).createOrReplaceTempView(name)


def register_views(spark: SparkSession, inputs: Inputs) -> None:
    """All reports as temporary views; none is computed before it is read."""
    for name in REPORTS:
        register_view(spark, inputs, name)


def read_view(spark: SparkSession, name: str) -> DataFrame:
    """The published columns of a registered report."""
    return spark.table(name).select(*VIEW_COLUMNS[name])
