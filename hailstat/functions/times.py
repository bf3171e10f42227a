"""Times and dates as Column expressions, in the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed text formats.
SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"
DAY_FORMAT = "yyyy-MM-dd"
MINUTE_STAMP = "yyyyMMddHHmm"
MONTH_SUFFIX = "yyyyMM"


def format_seconds(seconds: Column, pattern: str = SECOND_FORMAT) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), pattern)


def format_millis(millis: Column, pattern: str = SECOND_FORMAT) -> Column:
    return F.date_format(F.timestamp_millis(millis), pattern)


def hour_of(seconds: Column) -> Column:
    return F.hour(F.timestamp_seconds(seconds))


def day_of(seconds: Column) -> Column:
    return format_seconds(seconds, DAY_FORMAT)


def compact_date(day_text: Column) -> Column:
    """``yyyy-MM-dd`` without dashes; null when blank."""
    kept = F.when(F.trim(day_text) != "", day_text)
    return F.replace(kept, F.lit("-"), F.lit(""))


def half_month_back(minute_stamp: Column) -> Column:
    """``yyyyMMddHHmm`` fifteen days earlier."""
    time = F.try_to_timestamp(minute_stamp, F.lit(MINUTE_STAMP))
    return F.date_format(time - F.expr("INTERVAL 15 DAYS"), MINUTE_STAMP)


def table_suffix(time: Column) -> Column:
    return F.date_format(time, MONTH_SUFFIX)


def day_span(time: Column) -> Column:
    """Days between the first and the last day of a group (an aggregate)."""
    return F.datediff(F.max(F.to_date(time)), F.min(F.to_date(time)))


def days_before(day: Column, count: int) -> Column:
    return F.date_sub(day, count)
