"""Orders as numbers of fixed width, which a hash aggregate can keep in place."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

PREFIX_BYTES = 8
PREFIX_DIGITS = 20


def text_prefix(text: Column) -> Column:
    """The first eight bytes of a text as a number that compares like them."""
    digits = F.rpad(F.left(F.hex(text), F.lit(2 * PREFIX_BYTES)), 2 * PREFIX_BYTES, "0")
    return F.conv(digits, 16, 10).cast(f"decimal({PREFIX_DIGITS},0)")


def time_and_text(time: Column, text: Column) -> Column:
    """One number for a timestamp and, at equal times, the first eight bytes of a text; a null text counts as empty."""
    micros = F.unix_micros(time).cast("decimal(18,0)")
    return (micros * F.lit(Decimal(10**PREFIX_DIGITS)) + F.coalesce(text_prefix(text), F.lit(Decimal(0)))).cast("decimal(38,0)")


def seconds_and_arrival(seconds: Column, arrival: Column) -> Column:
    """One number for a time in seconds and, at equal times, an arrival order that is a long."""
    return (seconds.cast("decimal(18,0)") * F.lit(Decimal(10**PREFIX_DIGITS)) + arrival.cast("decimal(20,0)")).cast("decimal(38,0)")
