"""Completion rates per city or per driver."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hailstat.functions.text import NO_RATE, rate_text
from hailstat.periods import GRAINS, Period, in_period

CITY = ("city_name",)
DRIVER = ("driver_id", "driver_name")


def is_effective() -> Column:
    return F.col("cancel") == 0


def effective_trips(trips: DataFrame, keys: Sequence[str], period: Period, grain: str) -> DataFrame:
    """Trips of the period that were not cancelled, per key."""
    kept = in_period(trips, period, grain).where(is_effective())
    return kept.groupBy(*keys).agg(F.count("*").alias("effective_num"))


def total_trips(trips: DataFrame, keys: Sequence[str], period: Period, grain: str) -> DataFrame:
    """All trips of the period, per key."""
    kept = in_period(trips, period, grain)
    return kept.groupBy(*keys).agg(F.count("*").alias("total_num"))


def completion(trips: DataFrame, keys: Sequence[str], period: Period, grain: str) -> DataFrame:
    """Effective and total trips with their rate, for keys with an effective trip.

    One pass over the trips. A null key has effective trips of its own but no total to compare
    them with, so its total and rate are null.
    """
    kept = in_period(trips, period, grain)
    counts = kept.groupBy(*keys).agg(
        F.count_if(is_effective()).alias("effective_num"), F.count("*").alias("total_num")
    )
    known = F.col(keys[0]).isNotNull()
    return counts.where(F.col("effective_num") > 0).select(
        *keys,
        "effective_num",
        F.when(known, F.col("total_num")).alias("total_num"),
        F.when(known, rate_text(F.col("effective_num"), F.col("total_num"))).alias("comple_rate"),
    )


def completion_summary(trips: DataFrame, keys: Sequence[str], period: Period, row_key: Column) -> DataFrame:
    """The five rates side by side, for keys with an effective trip in the year.

    All ten counts come from one scan and one shuffle; the scan is limited to rows that fall into
    at least one of the periods.
    """
    time = F.col("create_time")
    counts = []
    for grain in GRAINS:
        inside = period.within(grain, time)
        counts.append(F.count_if(inside & is_effective()).alias(f"eff_{grain}"))
        counts.append(F.count_if(inside).alias(f"tot_{grain}"))
    grouped = in_period(trips, period).groupBy(*keys).agg(*counts)
    known = F.col(keys[0]).isNotNull()
    return grouped.where(F.col("eff_year") > 0).select(
        row_key.cast("string").alias("rk"),
        *[F.col(k).cast("string").alias(k) for k in keys],
        F.when(known, _rate("year")).alias("_year_comple_rate"),
        *[
            F.when(known, _rate(grain)).otherwise(NO_RATE).alias(f"_{grain}_comple_rate")
            for grain in ("quarter", "month", "week", "day")
        ],
    )


def _rate(grain: str) -> Column:
    return rate_text(F.col(f"eff_{grain}"), F.col(f"tot_{grain}"))


def completion_summary_by_joins(trips: DataFrame, keys: Sequence[str], period: Period, row_key: Column) -> DataFrame:
    """The same summary from five separately computed rate tables.

    For rates that already lie in stored tables, and as a check of the one-pass form.
    """
    tables = {
        grain: completion(trips, keys, period, grain).select(
            *keys, F.col("comple_rate").alias(f"_{grain}_comple_rate")
        )
        for grain in GRAINS
    }
    joined = reduce(
        lambda left, grain: left.join(tables[grain], list(keys), "left"),
        ("quarter", "month", "week", "day"),
        tables["year"],
    )
    return joined.select(
        row_key.cast("string").alias("rk"),
        *[F.col(k).cast("string").alias(k) for k in keys],
        "_year_comple_rate",
        *[
            F.coalesce(f"_{grain}_comple_rate", F.lit(NO_RATE)).alias(f"_{grain}_comple_rate")
            for grain in ("quarter", "month", "week", "day")
        ],
    )


def city_summary(trips: DataFrame, period: Period) -> DataFrame:
    return completion_summary(trips, CITY, period, F.lit("1"))


def driver_summary(trips: DataFrame, period: Period) -> DataFrame:
    return completion_summary(trips, DRIVER, period, F.col("driver_id"))
