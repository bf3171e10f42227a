"""New drivers per city."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hailstat.periods import GRAINS, Period, in_period


def registrations(drivers: DataFrame, period: Period, grain: str) -> DataFrame:
    """Distinct drivers registered in the period, per city."""
    kept = in_period(drivers, period, grain)
    return kept.groupBy("register_city").agg(F.count_distinct("id").alias(f"_register_{grain}_num"))


def registration_summary(drivers: DataFrame, period: Period) -> DataFrame:
    """The five counts side by side, for cities with a registration in the year.

    Rows are first folded to one per (city, driver) with a flag per period. Five distinct counts
    in one aggregate would instead multiply every row by five before the shuffle.
    """
    time = F.col("create_time")
    per_driver = (
        in_period(drivers, period)
        .groupBy("register_city", "id")
        .agg(*[F.bool_or(period.within(g, time)).alias(f"in_{g}") for g in GRAINS])
    )
    has_id = F.col("id").isNotNull()
    per_city = per_driver.groupBy("register_city").agg(
        F.bool_or("in_year").alias("kept"),
        *[F.count_if(F.col(f"in_{g}") & has_id).alias(f"num_{g}") for g in GRAINS],
    )
    known = F.col("register_city").isNotNull()
    return per_city.where("kept").select(
        F.col("register_city").cast("string").alias("rk"),
        F.col("register_city").cast("string").alias("register_city"),
        F.col("num_year").cast("string").alias("_register_year_num"),
        *[
            F.when(known, F.col(f"num_{g}")).otherwise(0).cast("string").alias(f"_register_{g}_num")
            for g in ("quarter", "month", "week", "day")
        ],
    )
