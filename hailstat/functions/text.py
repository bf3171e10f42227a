"""Report texts, record conversion and markup cleaning as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NO_RATE = "0.0%"

# Fixed patterns of the markup filter, applied in this order, without regard to case.
UNSAFE_MARKUP = (
    r"<[\s]*?(script|style)[^>]*?>[\s\S]*?<[\s]*?\/[\s]*?(script|style)[\s]*?>",
    r"on[^\s]+=\s*",
    r"href=javascript:",
    r"<[\s]*?(iframe|frameset)[^>]*?>[\s\S]*?<[\s]*?\/[\s]*?(iframe|frameset)[\s]*?>",
    r"<[\s]*?link[^>]*?/>",
)


def rate_text(part: Column, whole: Column) -> Column:
    """``66.67%``: part of whole in percent with two decimals, ``0.0%`` for no part."""
    percent = F.round(F.try_divide(part * 100, whole), 2).cast("string")
    return F.when(part == 0, NO_RATE).otherwise(F.concat(percent, F.lit("%")))


def share_text(part: Column, whole: Column) -> Column:
    """A percentage that is not rounded; null for an empty whole."""
    return F.concat(F.try_divide(part * 100, whole).cast("string"), F.lit("%"))


def amount_text(amount: Column) -> Column:
    """Plain decimal text of a summed amount, two decimals."""
    return F.round(amount, 2).cast("decimal(38,2)").cast("string")


def amount_sum(amount: Column) -> Column:
    """The plain sum; amounts are rounded when they are shown and not before they are added."""
    return F.sum(amount)


def city_prefix(code: Column) -> Column:
    """The first four digits of an area code stand for its city."""
    return F.substring(code, 1, 4)


def city_code(prefix: Column) -> Column:
    return F.concat(prefix, F.lit("00"))


def null_default(value: Column, default) -> Column:
    return F.coalesce(value, F.lit(default))


def count_text(count: Column) -> Column:
    """A count as text, ``0`` for none."""
    return null_default(count, 0).cast("string")


def json_object(columns: Sequence[str]) -> Column:
    """A JSON object text with one text entry per column."""
    return F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in columns]))


def record_map(columns: Sequence[str]) -> Column:
    """Column name to text, as a map; null values keep their entry."""
    entries = [x for c in columns for x in (F.lit(c), F.col(c).cast("string"))]
    return F.create_map(*entries)


def strip_unsafe_markup(html: Column) -> Column:
    for pattern in UNSAFE_MARKUP:
        html = F.regexp_replace(html, "(?i)" + pattern, "")
    return html
