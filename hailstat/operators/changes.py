"""Applying change-log rows to stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hailstat.functions.keys import timed_key, with_salted_key
from hailstat.sources.tables import latest_per_key, merge_rows

# The change types that are applied. Deletes are left out.
APPLIED = ("insert", "update")
NEWEST = ("ts", "seq")
KEY_TIMES = ("create_time", "last_logon_time", "update_time")


def _id_column(changes: DataFrame) -> str:
    return "id" if "id" in changes.columns else "id_"


def _key_time(changes: DataFrame) -> Column:
    """The time in a row's key: its creation, else its last login or update."""
    return F.coalesce(*(F.col(c) for c in KEY_TIMES if c in changes.columns))


def _has_key(changes: DataFrame) -> Column:
    return F.col(_id_column(changes)).isNotNull() & _key_time(changes).isNotNull()


def keyed_changes(changes: DataFrame) -> DataFrame:
    """Applied changes with their row key; the rest is in ``unkeyed_changes``.

    The key's time stands in for the day a row is stored under, ``create_day``.
    """
    id_, time = F.col(_id_column(changes)), _key_time(changes)
    kept = changes.where(F.col("type").isin(*APPLIED) & _has_key(changes))
    return with_salted_key(kept, timed_key(id_, time), "row_key").withColumn("create_day", F.to_date(time))


def unkeyed_changes(changes: DataFrame) -> DataFrame:
    """Inserts and updates without an id or any time, which no key can be made for."""
    return changes.where(F.col("type").isin(*APPLIED) & ~_has_key(changes))


def apply_changes(current: DataFrame | None, changes: DataFrame) -> DataFrame:
    """The stored table after the changes, newest row per key by (ts, arrival)."""
    newest = latest_per_key(keyed_changes(changes), ["row_key"], NEWEST)
    return newest if current is None else merge_rows(current, newest, ["row_key"], NEWEST)
