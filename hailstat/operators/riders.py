"""New, active and retained riders."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hailstat.functions.text import NO_RATE, city_code, city_prefix, share_text
from hailstat.periods import Period, between, in_period

CITY = "last_login_city"


def _on_day(time: Column, day: str | dt.date) -> Column:
    day = dt.date.fromisoformat(day) if isinstance(day, str) else day
    return between(time, day, day + dt.timedelta(days=1))


def total(riders: DataFrame) -> DataFrame:
    return riders.agg(F.count("*").alias("registerTotalCount"))


def new_by_city(riders: DataFrame, period: Period) -> DataFrame:
    """Riders registered on the day, per city of the last login."""
    kept = in_period(riders, period, "day").where(F.col(CITY) != "")
    return kept.groupBy(city_prefix(F.col(CITY)).alias(CITY)).agg(F.count("*").alias("_day_new_user"))


def active_by_city(riders: DataFrame, period: Period) -> DataFrame:
    """Distinct riders whose last login is on the day, per city."""
    kept = riders.where(period.within("day", F.col("last_logon_time")) & (F.col(CITY) != ""))
    return kept.groupBy(city_prefix(F.col(CITY)).alias(CITY)).agg(F.count_distinct("id").alias("DAU"))


def new_active_by_city(riders: DataFrame, period: Period) -> DataFrame:
    """New and active riders per city, in one scan; a city with either one has a row."""
    new = period.within("day", F.col("create_time"))
    active = period.within("day", F.col("last_logon_time"))
    per_rider = (
        riders.where((F.col(CITY) != "") & (new | active))
        .groupBy(city_prefix(F.col(CITY)).alias("city"), "id")
        .agg(F.count_if(new).alias("new"), F.count_if(active).alias("active"))
    )
    per_city = per_rider.groupBy("city").agg(
        F.sum("new").alias("new"),
        F.count_if((F.col("active") > 0) & F.col("id").isNotNull()).alias("active"),
    )
    return per_city.select(
        city_code(F.col("city")).alias("rk"),
        city_code(F.col("city")).alias("_city_code"),
        F.col("new").cast("string").alias("_day_new_user"),
        F.col("active").cast("string").alias("DAU"),
    )


def new_riders(riders: DataFrame, period: Period, grain: str) -> DataFrame:
    kept = in_period(riders, period, grain)
    return kept.agg(F.count("*").alias(f"{grain}NewUserCount"))


def new_summary(riders: DataFrame, period: Period) -> DataFrame:
    time = F.col("create_time")
    grains = ("month", "week", "day")
    row = in_period(riders, period, grains).agg(
        *[F.count_if(period.within(g, time)).alias(g) for g in grains]
    )
    return row.select(
        F.lit("1").alias("myid"), *[F.col(g).cast("string").alias(f"{g}NewUserCount") for g in grains]
    )


def _retained(riders: DataFrame, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Per name, cohort size and matches of (cohort day, login day), in one row.

    A rider of the cohort is matched with the login rows of the same id. Counting both kinds per
    id gives the size of that join without joining.
    """
    created, logged_on = F.col("create_time"), F.col("last_logon_time")
    counters, wanted = [], F.lit(False)
    for name, (cohort_day, login_day) in pairs.items():
        in_cohort, in_login = _on_day(created, cohort_day), _on_day(logged_on, login_day)
        counters += [F.count_if(in_cohort).alias(f"{name}_c"), F.count_if(in_login).alias(f"{name}_l")]
        wanted = wanted | in_cohort | in_login
    per_id = riders.where(wanted).groupBy("id").agg(*counters)
    known = F.col("id").isNotNull()
    totals = []
    for name in pairs:
        cohort, login = F.col(f"{name}_c"), F.col(f"{name}_l")
        totals.append(F.sum(F.when(known, cohort * login)).alias(f"{name}_matched"))
        totals.append(
            F.sum(F.when(known, cohort * F.greatest(login, F.lit(1))).otherwise(cohort)).alias(f"{name}_cohort")
        )
    return per_id.agg(*totals)


def _share(name: str) -> Column:
    matched = F.coalesce(f"{name}_matched", F.lit(0))
    return share_text(matched, F.coalesce(f"{name}_cohort", F.lit(0)))


def retention(riders: DataFrame, cohort_day: str, login_day: str, name: str = "StateRate") -> DataFrame:
    """Share of the riders registered on ``cohort_day`` whose *last* login is on ``login_day``."""
    row = _retained(riders, {"r": (cohort_day, login_day)})
    return row.select(F.lit(1).alias("myid"), _share("r").alias(name))


def retention_summary(
    riders: DataFrame, day: tuple[str, str], week: tuple[str, str], month: tuple[str, str]
) -> DataFrame:
    """The three retention rates, each from its (cohort day, login day) pair, in one scan."""
    row = _retained(riders, {"day": day, "week": week, "month": month})
    return row.select(
        F.lit("1").alias("myid"),
        *[F.coalesce(_share(g), F.lit(NO_RATE)).alias(f"{g}StateRate") for g in ("month", "week", "day")],
    )


# The names of the active-rider counts.
ACTIVE_NAMES = {"day": "DAU", "week": "WAU", "month": "MAU"}


def active(riders: DataFrame, period: Period, grain: str) -> DataFrame:
    """Distinct riders whose last login is in the period."""
    kept = riders.where(period.within(grain, F.col("last_logon_time")))
    return kept.agg(F.count_distinct("id").alias(ACTIVE_NAMES[grain]))


def active_summary(riders: DataFrame, period: Period) -> DataFrame:
    time = F.col("last_logon_time")
    per_rider = (
        riders.where(period.within_any(time, tuple(ACTIVE_NAMES)) & F.col("id").isNotNull())
        .groupBy("id")
        .agg(*[F.bool_or(period.within(g, time)).alias(g) for g in ACTIVE_NAMES])
    )
    row = per_rider.agg(*[F.count_if(F.col(g)).cast("string").alias(n) for g, n in ACTIVE_NAMES.items()])
    return row.select(F.lit("1").alias("rk"), *ACTIVE_NAMES.values())
