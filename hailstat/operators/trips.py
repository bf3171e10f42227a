"""Vehicle and trip distribution per city, and platform totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hailstat.functions.text import (
    amount_sum,
    amount_text,
    city_code,
    city_prefix,
    count_text,
)
from hailstat.functions.times import day_span
from hailstat.periods import Period, in_period

AREA = "begin_address_code"


def _per_vehicle(trips: DataFrame, period: Period, grains: tuple[str, ...]) -> DataFrame:
    """One row per (area, vehicle) with its trips in each period.

    Counting vehicles from these rows needs no second copy of the trips per distinct count, and a
    city with a large share of all trips is spread over its vehicles.
    """
    time = F.col("create_time")
    kept = in_period(trips, period, grains)
    return kept.groupBy(city_prefix(F.col(AREA)).alias(AREA), "vehicle_license").agg(
        *[F.count_if(period.within(grain, time)).alias(f"in_{grain}") for grain in grains]
    )


def vehicles(trips: DataFrame, period: Period, grain: str) -> DataFrame:
    """Distinct vehicles per city prefix."""
    kept = in_period(trips, period, grain)
    return kept.groupBy(city_prefix(F.col(AREA)).alias(AREA)).agg(
        F.count_distinct("vehicle_license").alias(f"{grain}VehicleCount")
    )


def vehicle_counts(trips: DataFrame, period: Period) -> DataFrame:
    """Distinct vehicles of the month and of the day, for areas with a trip in the month."""
    grouped = _per_vehicle(trips, period, ("month", "day")).groupBy(AREA).agg(
        F.sum("in_month").alias("month_trips"),
        F.count_if((F.col("in_month") > 0) & F.col("vehicle_license").isNotNull()).alias("monthVehicleCount"),
        F.count_if((F.col("in_day") > 0) & F.col("vehicle_license").isNotNull()).alias("day_vehicles"),
    )
    return grouped.where(F.col("month_trips") > 0).select(
        AREA,
        "monthVehicleCount",
        F.when(F.col(AREA).isNull(), 0).otherwise(F.col("day_vehicles")).alias("dayVehicleCount"),
    )


def trip_count(trips: DataFrame, period: Period, grain: str) -> DataFrame:
    """Trips per city prefix."""
    kept = in_period(trips, period, grain)
    return kept.groupBy(city_prefix(F.col(AREA)).alias(AREA)).agg(F.count("*").alias(f"{grain}OrderCount"))


def trip_counts(trips: DataFrame, period: Period) -> DataFrame:
    """Trips of the month, week and day, for areas with a trip in the month; null for none."""
    time = F.col("create_time")
    grains = ("month", "week", "day")
    grouped = (
        in_period(trips, period, grains)
        .groupBy(city_prefix(F.col(AREA)).alias(AREA))
        .agg(*[F.count_if(period.within(g, time)).alias(f"{g}OrderCount") for g in grains])
    )
    known = F.col(AREA).isNotNull()
    return grouped.where(F.col("monthOrderCount") > 0).select(
        AREA,
        "monthOrderCount",
        *[
            F.when(known & (F.col(f"{g}OrderCount") > 0), F.col(f"{g}OrderCount")).alias(f"{g}OrderCount")
            for g in ("week", "day")
        ],
    )


def merge_board(vehicle_table: DataFrame, trip_table: DataFrame) -> DataFrame:
    """City board from a vehicle table and a trip table: an area may be missing on either side."""
    v = vehicle_table.withColumnRenamed(AREA, "v_area")
    o = trip_table.withColumnRenamed(AREA, "o_area")
    joined = v.join(o, F.col("v_area") == F.col("o_area"), "full_outer")
    return joined.select(
        city_code(F.coalesce("v_area", "o_area")).alias("rk"),
        count_text(F.col("monthVehicleCount")).alias("monthVehicleCount"),
        count_text(F.col("dayVehicleCount")).alias("dayVehicleCount"),
        city_code(F.coalesce("o_area", "v_area")).alias("o_begin_address_code"),
        count_text(F.col("monthOrderCount")).alias("monthOrderCount"),
        count_text(F.col("weekOrderCount")).alias("weekOrderCount"),
        count_text(F.col("dayOrderCount")).alias("dayOrderCount"),
    )


def city_board(trips: DataFrame, period: Period) -> DataFrame:
    """Vehicles and trips per city, in one scan.

    Both halves are grouped from the same (area, vehicle) rows, so no join is needed. Trips
    without an area give two rows, one per half, because null areas never match each other.
    """
    rows = _per_vehicle(trips, period, ("month", "week", "day"))
    has_vehicle = F.col("vehicle_license").isNotNull()
    board = rows.groupBy(AREA).agg(
        F.count_if((F.col("in_month") > 0) & has_vehicle).alias("monthVehicleCount"),
        F.count_if((F.col("in_day") > 0) & has_vehicle).alias("dayVehicleCount"),
        F.sum("in_month").alias("monthOrderCount"),
        F.sum("in_week").alias("weekOrderCount"),
        F.sum("in_day").alias("dayOrderCount"),
    )
    halves = F.when(F.col(AREA).isNull(), F.array(F.lit("vehicles"), F.lit("trips"))).otherwise(
        F.array(F.lit("both"))
    )
    split = board.where(F.col("monthOrderCount") > 0).withColumn("half", F.explode(halves))

    def cell(name: str, *shown_in: str):
        return F.when(F.col("half").isin(*shown_in), F.col(name)).otherwise(0).cast("string").alias(name)

    return split.select(
        city_code(F.col(AREA)).alias("rk"),
        cell("monthVehicleCount", "both", "vehicles"),
        cell("dayVehicleCount", "both"),
        city_code(F.col(AREA)).alias("o_begin_address_code"),
        cell("monthOrderCount", "both", "trips"),
        cell("weekOrderCount", "both"),
        cell("dayOrderCount", "both"),
    )


def total(trips: DataFrame) -> DataFrame:
    return trips.agg(F.count("*").alias("totalOrderNum"))


def month_total(trips: DataFrame, period: Period) -> DataFrame:
    return in_period(trips, period, "month").agg(F.count("*").alias("monthOrderNum"))


def mileage(trips: DataFrame) -> DataFrame:
    return trips.agg(F.round(amount_sum(F.col("charge_mileage")), 2).cast("double").alias("charge_mileage"))


def pay_total(trips: DataFrame) -> DataFrame:
    return trips.agg(F.round(amount_sum(F.col("pay_all")), 2).cast("double").alias("pay_all"))


def average_per_day(trips: DataFrame) -> DataFrame:
    """Trips per day between the first and the last day; null when they are the same day."""
    return trips.agg(
        F.round(F.try_divide(F.count("*"), day_span(F.col("create_time"))), 2).alias("avgOrderNum")
    )


def platform_summary(trips: DataFrame, period: Period) -> DataFrame:
    """Totals of the platform in one row and one scan."""
    time = F.col("create_time")
    row = trips.agg(
        F.count("*").alias("total"),
        F.count_if(period.within("month", time)).alias("month"),
        day_span(time).alias("days"),
        amount_sum(F.col("charge_mileage")).alias("mileage"),
    )
    return row.select(
        F.lit("1").alias("rk"),
        F.col("total").cast("string").alias("totalOrderNum"),
        F.col("month").cast("string").alias("monthOrderNum"),
        F.round(F.try_divide("total", "days"), 2).cast("string").alias("avgOrderNum"),
        amount_text(F.col("mileage")).alias("charge_mileage"),
    )


def order_rider_pay(trips: DataFrame, riders: DataFrame) -> DataFrame:
    """All trips, all riders and the income in one row: two one-row totals, stacked and folded."""
    from_trips = trips.agg(F.count("*").alias("orders"), amount_sum(F.col("pay_all")).alias("pay"))
    from_riders = riders.agg(F.count("*").alias("riders"))
    stacked = from_trips.unionByName(from_riders, allowMissingColumns=True)
    row = stacked.agg(F.max("orders").alias("orders"), F.max("riders").alias("riders"), F.max("pay").alias("pay"))
    return row.select(
        F.lit(1).alias("myid"),
        F.col("orders").cast("string").alias("totalCount"),
        F.col("riders").cast("string").alias("registerTotalCount"),
        amount_text(F.col("pay")).alias("pay_all"),
    )
