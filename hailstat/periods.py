"""Report periods and their filters."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAINS = ("day", "week", "month", "quarter", "year")


@dataclass(frozen=True)
class Period:
    """The day, week, month, quarter and year that a report is made for.

    Day, month, quarter and year become half-open ranges on the raw timestamp, so they reach the
    Parquet scan. The week is an ISO week number of *any* year unless ``week_year`` is given.
    """

    day: dt.date
    week: int
    month: tuple[int, int]
    quarter: tuple[int, int]
    year: int
    week_year: int | None = None

    @classmethod
    def of(cls, day: str | dt.date) -> "Period":
        """The periods that contain ``day``."""
        day = dt.date.fromisoformat(day) if isinstance(day, str) else day
        return cls(
            day=day,
            week=day.isocalendar().week,
            month=(day.year, day.month),
            quarter=(day.year, (day.month + 2) // 3),
            year=day.year,
        )

    @property
    def previous_day(self) -> dt.date:
        return self.day - dt.timedelta(days=1)

    def bounds(self, grain: str) -> tuple[dt.date, dt.date]:
        """First day and the day after the last one."""
        if grain == "day":
            return self.day, self.day + dt.timedelta(days=1)
        if grain == "week":
            if self.week_year is None:
                raise ValueError("a week without a year has no bounds")
            monday = dt.date.fromisocalendar(self.week_year, self.week, 1)
            return monday, monday + dt.timedelta(days=7)
        if grain == "month":
            return _months(self.month[0], self.month[1], 1)
        if grain == "quarter":
            return _months(self.quarter[0], 3 * self.quarter[1] - 2, 3)
        if grain == "year":
            return _months(self.year, 1, 12)
        raise ValueError(f"unknown grain {grain!r}")

    def within(self, grain: str, time: Column) -> Column:
        if grain == "week" and self.week_year is None:
            return F.weekofyear(time) == F.lit(self.week)
        return between(time, *self.bounds(grain))

    def within_any(self, time: Column, grains=GRAINS) -> Column:
        return reduce(lambda a, b: a | b, (self.within(g, time) for g in grains))


def _months(year: int, month: int, length: int) -> tuple[dt.date, dt.date]:
    end = year * 12 + month - 1 + length
    return dt.date(year, month, 1), dt.date(end // 12, end % 12 + 1, 1)


def midnight(day: str | dt.date) -> Column:
    """A constant timestamp in the session time zone."""
    return F.lit(str(day)).cast("timestamp")


def between(time: Column, start: str | dt.date, end: str | dt.date) -> Column:
    """``start <= time < end`` on the stored column."""
    return (time >= midnight(start)) & (time < midnight(end))


def since(time: Column, day: str | dt.date) -> Column:
    """On or after ``day``."""
    return time >= midnight(day)


DAY_COLUMN = "create_day"


def in_period(rows: DataFrame, period: Period, grains: str | tuple[str, ...] = GRAINS) -> DataFrame:
    """Rows created in the period at one of the grains.

    A stored table is partitioned by the day of creation (``create_day``); the same condition on that day
    lets the scan skip the partitions of other days, also for a week of any year, which is no range.
    """
    grains = (grains,) if isinstance(grains, str) else tuple(grains)
    kept = rows.where(period.within_any(F.col("create_time"), grains))
    return kept.where(period.within_any(F.col(DAY_COLUMN), grains)) if DAY_COLUMN in rows.columns else kept
