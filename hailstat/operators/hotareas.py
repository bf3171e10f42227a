"""Hot areas: trips per hexagon, their change, and a heat map."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hailstat.functions import grid
from hailstat.functions.order import time_and_text
from hailstat.periods import between, since

# Fixed values of the report.
HOT_RESOLUTION = 7
HOT_RADIUS = 1200

Day = str | dt.date
Span = tuple[Day, Day]


def with_cell(trips: DataFrame, res: int = HOT_RESOLUTION) -> DataFrame:
    return trips.withColumn("cell", grid.cell_of(F.col("open_lat"), F.col("open_lng"), res))


def hot_cells(trips: DataFrame, start: Day, end: Day, res: int = HOT_RESOLUTION) -> DataFrame:
    """Per cell, the trips of ``[start, end)`` and the area code of the earliest one.

    Equal to numbering the trips of a cell twice by window, but folded before the shuffle: first per cell and area
    code, by numbers alone, so that rows are hashed and not sorted; then per cell, over its few area codes.
    """
    kept = with_cell(trips.where(between(F.col("create_time"), start, end)), res)
    per_area = kept.groupBy("cell", "begin_address_code").agg(F.min(_rank()).alias("first"), F.count("*").alias("n"))
    per_cell = per_area.groupBy("cell").agg(_least("first").alias("begin_address_code"), F.sum("n").alias("count"))
    return per_cell.select(
        "begin_address_code",
        grid.lat_lng_text(grid.cell_center(F.col("cell"))).alias("coordinate"),
        "cell",
        F.lit(HOT_RADIUS).alias("radius"),
        "count",
    )


def _rank() -> Column:
    """Trips by time; at the same time by the first eight bytes of the id, and then by area code."""
    return time_and_text(F.col("create_time"), F.col("id"))


def _least(rank: str) -> Column:
    """The area code of least rank among the rows of a cell, one per area code; a null rank does not count."""
    areas = F.collect_list(F.when(F.col(rank).isNotNull(), F.struct(rank, "begin_address_code")))
    return F.array_min(areas)["begin_address_code"]


def hot_cells_by_window(trips: DataFrame, start: Day, end: Day, res: int = HOT_RESOLUTION) -> DataFrame:
    """The same by two row numbers; kept as a check of ``hot_cells``, not for large tables."""
    kept = with_cell(trips.where(between(F.col("create_time"), start, end)), res)
    newest_first = Window.partitionBy("cell").orderBy(F.desc("create_time"), F.desc("id"))
    ranked = kept.withColumn("count", F.row_number().over(newest_first).cast("bigint"))
    highest_first = Window.partitionBy("cell").orderBy(F.desc("count"))
    top = ranked.withColumn("num", F.row_number().over(highest_first)).where("num = 1")
    return top.select(
        "begin_address_code",
        grid.lat_lng_text(grid.cell_center(F.col("cell"))).alias("coordinate"),
        "cell",
        F.lit(HOT_RADIUS).alias("radius"),
        "count",
    )


def hot_delta(today: DataFrame, before: DataFrame) -> DataFrame:
    """Change of the trips per cell, from two stored tables of hot cells.

    A cell that is hot only before gives a negative count.
    """
    t, y = today.alias("t"), before.alias("y")
    joined = t.join(y, F.col("t.cell") == F.col("y.cell"), "full_outer")
    return joined.select(
        F.coalesce("t.begin_address_code", "y.begin_address_code").alias("city_code"),
        F.coalesce("t.coordinate", "y.coordinate").alias("coordinate"),
        F.coalesce("t.radius", "y.radius").alias("radius"),
        (F.coalesce("t.count", F.lit(0)) - F.coalesce("y.count", F.lit(0))).alias("count"),
    )


def hot_pair(trips: DataFrame, now: Span, before: Span, res: int = HOT_RESOLUTION) -> DataFrame:
    """Per cell, trips and area code of two periods, from one scan of the trips."""
    time = F.col("create_time")
    in_now, in_before = between(time, *now), between(time, *before)

    per_area = with_cell(trips.where(in_now | in_before), res).groupBy("cell", "begin_address_code").agg(
        F.min(F.when(in_now, _rank())).alias("first_now"),
        F.count_if(in_now).alias("now"),
        F.min(F.when(in_before, _rank())).alias("first_before"),
        F.count_if(in_before).alias("before"),
    )
    return per_area.groupBy("cell").agg(
        _least("first_now").alias("code_now"),
        F.sum("now").alias("count_now"),
        _least("first_before").alias("code_before"),
        F.sum("before").alias("count_before"),
    )


def hot_change(trips: DataFrame, now: Span, before: Span, res: int = HOT_RESOLUTION) -> DataFrame:
    """``hot_delta`` of two periods of the same trips, without a join."""
    return hot_pair(trips, now, before, res).select(
        F.coalesce("code_now", "code_before").alias("city_code"),
        grid.lat_lng_text(grid.cell_center(F.col("cell"))).alias("coordinate"),
        F.lit(HOT_RADIUS).alias("radius"),
        (F.col("count_now") - F.col("count_before")).alias("count"),
    )


def as_detail(cells: DataFrame) -> DataFrame:
    """Hot cells under the column names of ``hot_delta``."""
    return cells.select(F.col("begin_address_code").alias("city_code"), "coordinate", "radius", "count")


def hot_detail(cells: DataFrame) -> DataFrame:
    """Per area code one row with the sum of its counts, and one row for each of its cells.

    The sum's row has no cell and a cell's row no sum, so either can be added up. Rows and not lists: an
    area may have any number of cells.
    """
    sums = area_totals(cells)
    listed = cells.select("city_code", F.lit(None).cast("bigint").alias("city_num"), "coordinate", "radius", "count")
    return listed.unionByName(sums, allowMissingColumns=True)


def area_totals(cells: DataFrame) -> DataFrame:
    """The sums of ``hot_detail`` alone."""
    return cells.groupBy("city_code").agg(F.sum("count").alias("city_num"))


def hot_order(today: DataFrame, delta: DataFrame) -> DataFrame:
    """Per area code, the trips of today and the new ones; both inputs as area totals."""
    t, n = today.alias("t"), delta.alias("n")
    joined = t.join(n, F.col("t.city_code") == F.col("n.city_code"), "left")
    return joined.select(
        F.col("t.city_code").alias("rk"),
        F.col("t.city_code").alias("_city_code"),
        F.col("t.city_num").cast("string").alias("_day_order_num"),
        F.col("n.city_num").cast("string").alias("_new_orders_num"),
    )


def hot_order_report(trips: DataFrame, now: Span, before: Span) -> DataFrame:
    """``hot_order`` of two periods of the same trips: one scan, no join.

    Each cell adds its trips to the area it is in now, and its change to the area of the change,
    which is the earlier one for a cell that is no longer hot. Areas without trips now are left
    out, and a missing area has no change to match.
    """
    counts = F.array(
        F.struct(
            F.col("code_now").alias("code"),
            F.col("count_now").alias("trips"),
            F.lit(0).cast("bigint").alias("change"),
            (F.col("count_now") > 0).alias("is_now"),
        ),
        F.struct(
            F.coalesce("code_now", "code_before").alias("code"),
            F.lit(0).cast("bigint").alias("trips"),
            (F.col("count_now") - F.col("count_before")).alias("change"),
            F.lit(False).alias("is_now"),
        ),
    )
    shares = hot_pair(trips, now, before).select(F.inline(counts))
    areas = shares.groupBy("code").agg(
        F.sum("trips").alias("trips"), F.sum("change").alias("change"), F.bool_or("is_now").alias("is_now")
    )
    return areas.where("is_now").select(
        F.col("code").alias("rk"),
        F.col("code").alias("_city_code"),
        F.col("trips").cast("string").alias("_day_order_num"),
        F.when(F.col("code").isNotNull(), F.col("change").cast("string")).alias("_new_orders_num"),
    )


def heat_map(trips: DataFrame, day: Day, res: int = HOT_RESOLUTION) -> DataFrame:
    """Per cell, the trips since a day, the area code of the latest, and the centre of its outline."""
    kept = with_cell(trips.where(since(F.col("create_time"), day)), res)
    # The latest has the least negative rank.
    per_area = kept.groupBy("cell", "begin_address_code").agg((-F.max(_rank())).alias("last"), F.count("*").alias("n"))
    per_cell = per_area.groupBy("cell").agg(_least("last").alias("begin_address_code"), F.sum("n").alias("count"))
    # Columns of their own, so that the outline is made once and not once per use.
    outlined = per_cell.withColumn("outline", grid.cell_boundary(F.col("cell")))
    placed = outlined.withColumn("center", grid.array_centroid(F.col("outline")))
    return placed.select(
        F.col("cell").cast("string").alias("rk"),
        "begin_address_code",
        grid.lng_lat_text(F.col("center")).alias("centerPoint"),
        "count",
    )
