"""Points in districts by an adaptive quadtree: tiles are split until few district edges are left in each.

The world is a square of 360 degrees; a tile of level n has a side of 360 / 2^n. A tile holds, for every district
whose border runs through it, the edges that touch it. Whether a point of the tile is inside follows from the
edges that a ray to the east crosses; those that do not touch the tile cross it or not by the point's latitude
alone, and what they add up to is kept as steps: latitudes above which inside and outside change places. Steps of
equal latitude cancel, so that no more are left than the touching edges have ends. A tile without any edge of a
district lies in it as a whole or not at all: it names the district, or is no row.

Splitting works on rows of edges, never on a district as a whole: a tile passes only its own edges on to its parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hailstat.operators.stations import contains, ring_edges
from hailstat.session import shared_folder

WORLD = 360.0
FIRST_LEVEL, LAST_LEVEL, STRIDE = 8, 20, 2
# The most edges of a tile; only tiles of the last level, 38 m wide, may have more.
MAX_EDGES = 64
# Degrees around a tile that count as touching, far above the rounding of a coordinate.
MARGIN = 1e-9
# Beyond all coordinates: where steps stand, as edges that go up from their latitude.
FAR = 1e6
TILE = ["level", "tx", "ty"]
DISTRICT = ["citycode", "district_name"]
ENDS = ["x1", "y1", "x2", "y2"]


def _side(level: Column) -> Column:
    return F.lit(WORLD) / F.pow(F.lit(2.0), level)


def tile_of(degrees: Column, level: Column) -> Column:
    """The tile's number along an axis."""
    return F.floor((degrees + WORLD / 2) / _side(level)).cast("long")


def edge_rows(rings: DataFrame) -> DataFrame:
    """Rings (citycode, district_name, ring) as one row per edge; a missing city code becomes an empty one."""
    edges = rings.select(F.coalesce("citycode", F.lit("")).alias("citycode"), "district_name", F.explode(ring_edges(F.col("ring"))).alias("e"))
    return edges.select(*DISTRICT, *(F.col(f"e.{c}") for c in ENDS)).where(" AND ".join(f"{c} IS NOT NULL" for c in ENDS))


def _first_tiles(edges: DataFrame) -> DataFrame:
    """Every edge in each tile of the first level that it may touch or lie east of, within its district's box."""
    level = F.lit(FIRST_LEVEL)
    west = edges.groupBy(*DISTRICT).agg(F.min(F.least("x1", "x2")).alias("west"))
    def span(low: Column, high: Column) -> Column:
        return F.sequence(tile_of(low - MARGIN, level), tile_of(high + MARGIN, level))

    return (
        edges.join(west, DISTRICT)
        .withColumn("tx", F.explode(span(F.col("west"), F.greatest("x1", "x2"))))
        .withColumn("ty", F.explode(span(F.least("y1", "y2"), F.greatest("y1", "y2"))))
        .select(level.alias("level"), "tx", "ty", *DISTRICT, F.lit(False).alias("step"), *ENDS)
    )


def _parts(rows: DataFrame) -> DataFrame:
    """Every row in each of the smaller tiles of its tile."""
    cut = 1 << STRIDE
    each = F.sequence(F.lit(0), F.lit(cut - 1))
    split = rows.withColumn("ix", F.explode(each)).withColumn("iy", F.explode(each))
    return split.select(
        (F.col("level") + STRIDE).alias("level"), (F.col("tx") * cut + F.col("ix")).alias("tx"),
        (F.col("ty") * cut + F.col("iy")).alias("ty"), *DISTRICT, "step", *ENDS,
    )


def _settled(rows: DataFrame) -> DataFrame:
    """What the candidate rows are to their tiles: edges that touch them, and steps, of which equal pairs cancel."""
    side = _side(F.col("level"))
    low = F.col("ty") * side - WORLD / 2
    top, half = low + side, side / 2 + MARGIN
    cx, cy = F.col("tx") * side - WORLD / 2 + side / 2, low + side / 2
    x1, y1, x2, y2 = (F.col(c) for c in ENDS)
    dx, dy = x2 - x1, y2 - y1
    down, up = F.least(y1, y2), F.greatest(y1, y2)
    near = (F.greatest(x1, x2) >= cx - half) & (F.least(x1, x2) <= cx + half) & (up >= cy - half) & (down <= cy + half)
    touches = near & (F.abs(dx * (cy - y1) - dy * (cx - x1)) <= (F.abs(dx) + F.abs(dy)) * half)
    level_with = (dy != 0) & (up > low - MARGIN) & (down <= top + MARGIN)
    middle = (F.greatest(down, low - MARGIN) + F.least(up, top + MARGIN)) / 2
    east = level_with & (x1 + dx * F.try_divide(middle - y1, dy) > cx)

    def edge(step: bool, *ends: Column) -> Column:
        return F.struct(F.lit(step).alias("step"), *(e.cast("double").alias(c) for e, c in zip(ends, ENDS)))

    def step_at(y: Column) -> Column:
        return edge(True, F.lit(FAR), F.when(y <= low - MARGIN, F.lit(-FAR)).otherwise(y), F.lit(FAR), F.lit(FAR))

    told = F.when(F.col("step"), F.array(step_at(y1))).when(touches, F.array(edge(False, x1, y1, x2, y2))).when(
        east, F.array(step_at(down), step_at(up))
    )
    made = rows.select(*TILE, *DISTRICT, top.alias("top"), F.inline(told))
    steps = made.where(F.col("step") & (F.col("y1") <= F.col("top") + MARGIN)).groupBy(*TILE, *DISTRICT, "y1").agg(F.count("*").alias("n"))
    odd = steps.where("n % 2 = 1").select(
        *TILE, *DISTRICT, F.lit(True).alias("step"), F.lit(FAR).alias("x1"), "y1", F.lit(FAR).alias("x2"), F.lit(FAR).alias("y2")
    )
    return made.where("not step").drop("top").unionByName(odd)


def _kept(df: DataFrame) -> DataFrame:
    path = shared_folder(df.sparkSession, "tiles")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def quad_tiles(edges: DataFrame, max_edges: int = MAX_EDGES) -> DataFrame:
    """``level, tx, ty, citycode, district_name, inner, edges``: the tiles of each district, from ``edge_rows``.

    Tiles of one district do not overlap. ``inner`` tiles lie in the district as a whole. The others hold what
    ``contains`` needs: the touching edges, at most ``max_edges`` of all districts together, and the steps.
    """
    leaves, rows = None, _first_tiles(edges)
    for level in range(FIRST_LEVEL, LAST_LEVEL + 1, STRIDE):
        rows = _kept(_settled(rows))
        own = rows.groupBy(*TILE, *DISTRICT).agg(F.count_if(~F.col("step")).alias("own"))
        crowded = own.groupBy(*TILE).agg(F.sum("own").alias("all")).where(F.col("all") > max_edges).select(*TILE)
        if level < LAST_LEVEL:
            split = _kept(own.where("own > 0").join(crowded, TILE, "left_semi").select(*TILE, *DISTRICT))
            done, rows = rows.join(split, TILE + DISTRICT, "left_anti"), rows.join(split, TILE + DISTRICT, "left_semi")
        else:
            done, split = rows, None
        found = _kept(done.groupBy(*TILE, *DISTRICT).agg(
            ((F.count_if(~F.col("step")) == 0) & (F.count("*") == 1) & (F.min("y1") == -FAR)).alias("inner"),
            F.collect_list(F.struct(*ENDS)).alias("edges"),
        ))
        leaves = found if leaves is None else leaves.unionByName(found)
        if split is None or split.isEmpty():
            break
        rows = _parts(rows)
    return leaves


def in_districts(points: DataFrame, tiles: DataFrame, lng: str = "starting_lng", lat: str = "starting_lat") -> DataFrame:
    """Points with the name of the district that contains them; a row for each of several, none for a point in none.

    A point is looked up once for each level that has tiles, a handful of numbers that are read first.
    """
    levels = sorted(r[0] for r in tiles.select("level").distinct().collect())
    if not levels:
        return points.withColumn("district_name", F.lit("")).where(F.lit(False))
    x, y, level = F.col(lng), F.col(lat), F.col("level")
    placed = points.withColumn("level", F.explode(F.array(*(F.lit(n) for n in levels))))
    placed = placed.withColumns({"tx": tile_of(x, level), "ty": tile_of(y, level)})
    met = placed.join(tiles.drop("citycode"), TILE).where(F.col("inner") | contains(F.col("edges"), x, y))
    return met.select(*points.columns, "district_name")
