import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hailstat.periods import Period


@given(st.dates(dt.date(1990, 1, 1), dt.date(2040, 12, 31)))
@settings(max_examples=200, deadline=None)
def test_periods_contain_their_day(day):
    period = Period.of(day)
    for grain in ("day", "month", "quarter", "year"):
        start, end = period.bounds(grain)
        assert start <= day < end
    dated = Period(day, period.week, period.month, period.quarter, period.year, week_year=day.isocalendar().year)
    start, end = dated.bounds("week")
    assert start <= day < end and (end - start).days == 7


def test_quarter_and_year_end():
    period = Period.of("1998-12-31")
    assert period.bounds("quarter") == (dt.date(1998, 10, 1), dt.date(1999, 1, 1))
    assert period.bounds("month") == (dt.date(1998, 12, 1), dt.date(1999, 1, 1))
    assert period.previous_day == dt.date(1998, 12, 30)


def test_week_without_year_counts_every_year(rows):
    trips = rows([("1997-07-15",), ("1998-07-15",), ("1998-08-15",)], "create_time timestamp")
    period = Period.of("1998-07-15")
    assert trips.where(period.within("week", F.col("create_time"))).count() == 2
    dated = Period(period.day, period.week, period.month, period.quarter, period.year, week_year=1998)
    assert trips.where(dated.within("week", F.col("create_time"))).count() == 1
    with pytest.raises(ValueError):
        period.bounds("week")


def test_ranges_reach_the_scan(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    rows([("1998-07-15", 1)], "create_time timestamp, cancel int").write.parquet(path)
    kept = spark.read.parquet(path).where(Period.of("1998-07-15").within("day", F.col("create_time")))
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(create_time" in plan and "LessThan(create_time" in plan
