"""Pick-up stations and the districts they lie in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hailstat.functions import grid
from hailstat.sources.tables import finite

STATION_RESOLUTION = 12
# Side of the square tiles, in degrees, by which points and districts are matched.
TILE_DEGREES = 0.1
# The most edges, counted once per tile, that ``with_broadcast_districts`` sends to all executors.
BROADCAST_EDGES = 500_000


def station_grid(orders: DataFrame, res: int = STATION_RESOLUTION) -> DataFrame:
    """Orders with the fine cell of their pick-up point."""
    return orders.withColumn("cell", grid.cell_of(F.col("starting_lat"), F.col("starting_lng"), res))


def stations(orders: DataFrame, res: int = STATION_RESOLUTION, min_trips: int = 1) -> DataFrame:
    """One station per cell with enough trips: its lowest (lng, lat) point, ties by order id.

    An aggregate in place of a row number, so that a cell with very many trips (an airport) is
    folded before the shuffle.
    """
    point = F.struct("starting_lng", "starting_lat", "order_id", "city_id")
    per_cell = station_grid(orders, res).groupBy("cell").agg(F.min(point).alias("s"), F.count("*").alias("trip_count"))
    return per_cell.where(F.col("trip_count") >= min_trips).select(
        "s.order_id", "s.city_id", "s.starting_lng", "s.starting_lat", F.lit(1).alias("rn"), "cell", "trip_count"
    )


def parse_ring(text: Column) -> Column:
    """``lng,lat;lng,lat`` as ``array<struct<lng,lat>>``; null when blank."""
    def point(pair: Column) -> Column:
        xy = F.split(pair, ",")
        return F.struct(
            finite(F.get(xy, F.lit(0))).alias("lng"), finite(F.get(xy, F.lit(1))).alias("lat")
        )

    return F.transform(F.split(F.nullif(F.trim(text), F.lit("")), ";"), point)


def ring_edges(ring: Column) -> Column:
    """Edges of a ring as ``array<struct<x1,y1,x2,y2>>``; an open ring is closed."""
    following = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    edges = F.zip_with(
        ring,
        following,
        lambda a, b: F.struct(
            a["lng"].alias("x1"), a["lat"].alias("y1"), b["lng"].alias("x2"), b["lat"].alias("y2")
        ),
    )
    return F.filter(edges, lambda e: (e["x1"] != e["x2"]) | (e["y1"] != e["y2"]))


def contains(edges: Column, lng: Column, lat: Column) -> Column:
    """Even-odd test: a point is inside when a ray to the east crosses an odd number of edges.

    With the edges of all rings of a multi-polygon, holes and parts come out right.
    """
    crossed = F.filter(
        edges,
        lambda e: ((e["y1"] > lat) != (e["y2"] > lat))
        & (lng < (e["x2"] - e["x1"]) * F.try_divide(lat - e["y1"], e["y2"] - e["y1"]) + e["x1"]),
    )
    return F.size(crossed) % 2 == 1


def district_edges(districts: DataFrame) -> DataFrame:
    """Polygon texts as edges: citycode, district_name, edges.

    Blank polygons are left out, and those with a malformed vertex, which are in ``rejected_districts``.
    """
    parsed = district_rings(districts).select("citycode", "district_name", ring_edges(F.col("ring")).alias("edges"))
    return parsed.where(F.size("edges") > 0)


def district_rings(districts: DataFrame) -> DataFrame:
    """Polygon texts as rings: citycode, district_name, ring; malformed ones are left out."""
    rings = districts.withColumn("ring", parse_ring(F.col("polygon"))).where(_whole(F.col("ring")))
    return rings.select("citycode", F.col("name").alias("district_name"), "ring")


def _whole(ring: Column) -> Column:
    return F.forall(ring, lambda p: p["lng"].isNotNull() & p["lat"].isNotNull())


def rejected_districts(districts: DataFrame) -> DataFrame:
    """Districts of which a vertex is malformed, as they came."""
    return districts.where(~_whole(parse_ring(F.col("polygon"))))


def rings_to_edges(rings: DataFrame) -> DataFrame:
    """Rings of multi-polygons (citycode, district_name, ring) as one list of edges per district."""
    return (
        rings.select("citycode", "district_name", F.explode(ring_edges(F.col("ring"))).alias("edge"))
        .groupBy("citycode", "district_name")
        .agg(F.collect_list("edge").alias("edges"))
    )


def _tile(degrees: Column, tile: float) -> Column:
    return F.floor(degrees / tile)


def with_broadcast_districts(points: DataFrame, edges: DataFrame, tile: float = TILE_DEGREES, limit: int = BROADCAST_EDGES) -> DataFrame:
    """``with_district`` with the districts sent to all executors; refused beyond ``limit`` edges."""
    tiles = district_tiles(edges, tile)
    found = tiles.agg(F.sum(F.size("edges"))).first()[0] or 0
    if found > limit:
        raise ValueError(f"{found} edges are more than the {limit} that may be broadcast; use with_district")
    return _in_tiles(points, F.broadcast(tiles), tile)


def with_district(points: DataFrame, edges: DataFrame, tile: float = TILE_DEGREES) -> DataFrame:
    """Points with the name of the district that contains them; no row for a point in none.

    Districts are cut into the tiles that their bounding box covers and points are joined to them
    by tile, so a point is only tested against districts nearby. The crossing test runs inside the
    row; nothing is grouped afterwards. Spark chooses the join by the sizes it knows; in a shuffle, adaptive
    execution splits a crowded tile.
    """
    return _in_tiles(points, district_tiles(edges, tile), tile)


def district_tiles(edges: DataFrame, tile: float = TILE_DEGREES) -> DataFrame:
    """Districts cut into tiles, each with the edges that a ray to the east from one of its points can cross."""
    xs = F.flatten(F.transform("edges", lambda e: F.array(e["x1"], e["x2"])))
    ys = F.flatten(F.transform("edges", lambda e: F.array(e["y1"], e["y2"])))
    boxed = edges.select(
        "district_name",
        "edges",
        F.sequence(_tile(F.array_min(xs), tile), _tile(F.array_max(xs), tile)).alias("tiles_x"),
        F.sequence(_tile(F.array_min(ys), tile), _tile(F.array_max(ys), tile)).alias("tiles_y"),
    )
    tiles = boxed.withColumn("tile_x", F.explode("tiles_x")).withColumn("tile_y", F.explode("tiles_y"))
    left, low = F.col("tile_x") * tile, F.col("tile_y") * tile
    # A margin far below a vertex's precision keeps points on a tile's border with their edges.
    needed = F.filter(
        "edges",
        lambda e: (F.greatest(e["x1"], e["x2"]) >= left - 1e-9)
        & (F.greatest(e["y1"], e["y2"]) >= low - 1e-9)
        & (F.least(e["y1"], e["y2"]) <= low + tile + 1e-9),
    )
    return tiles.select("tile_x", "tile_y", "district_name", needed.alias("edges")).where(F.size("edges") > 0)


def _in_tiles(points: DataFrame, tiles: DataFrame, tile: float) -> DataFrame:
    placed = points.withColumn("tile_x", _tile(F.col("starting_lng"), tile)).withColumn(
        "tile_y", _tile(F.col("starting_lat"), tile)
    )
    inside = contains(F.col("edges"), F.col("starting_lng"), F.col("starting_lat"))
    return placed.join(tiles, ["tile_x", "tile_y"]).where(inside).select(*points.columns, "district_name")


# Shapes of the district documents.
DISTRICT_JSON = (
    "districts array<struct<name: string, citycode: string, polyline: string, level: string, districts: "
    "array<struct<name: string, citycode: string, polyline: string, level: string>>>>"
)
GEOJSON = (
    "features array<struct<properties: struct<name: string, citycode: string>, "
    "geometry: struct<type: string, coordinates: string>>>"
)


def parse_districts(documents: DataFrame) -> DataFrame:
    """District rows of nested documents (``value``): a city entry holds its districts."""
    top = documents.select(F.explode(F.from_json("value", DISTRICT_JSON)["districts"]).alias("entry"))
    below = top.where(F.col("entry.level") == "city").select(F.explode("entry.districts").alias("d"))
    direct = top.select(
        F.struct("entry.name", "entry.citycode", "entry.polyline", "entry.level").alias("d")
    )
    rows = below.unionByName(direct).where((F.col("d.level") == "district") & F.col("d.polyline").isNotNull())
    return rows.select("d.citycode", "d.name", F.col("d.polyline").alias("polygon"))


def parse_geojson(documents: DataFrame) -> DataFrame:
    """Rings of the polygons and multi-polygons of feature collections (``value``), numbered per part.

    A polygon is a multi-polygon of one part. The city code is a property; without one it is null.
    """
    feature = documents.select(F.explode(F.from_json("value", GEOJSON)["features"]).alias("f"))
    shape, kind = F.col("f.geometry.coordinates"), F.col("f.geometry.type")
    whole = F.when(kind == "MultiPolygon", shape).when(kind == "Polygon", F.concat(F.lit("["), shape, F.lit("]")))
    parts = feature.withColumn("parts", F.from_json(whole, "array<array<array<array<double>>>>")).select(
        F.col("f.properties.citycode").alias("citycode"),
        F.col("f.properties.name").alias("district_name"),
        F.posexplode("parts").alias("part", "rings"),
    )
    rings = parts.select("citycode", "district_name", "part", F.posexplode("rings").alias("ring_no", "points"))
    return rings.select(
        "citycode",
        "district_name",
        "part",
        "ring_no",
        F.transform("points", lambda p: F.struct(F.get(p, F.lit(0)).alias("lng"), F.get(p, F.lit(1)).alias("lat"))).alias("ring"),
    )


def find_stations(placed: DataFrame, city: str | None = None, district: str | None = None) -> DataFrame:
    """Stations of a city and a district; a blank or missing filter lets all through."""
    if city:
        placed = placed.where(F.col("city_id") == city)
    if district:
        placed = placed.where(F.col("district_name") == district)
    return placed.select("city_id", "district_name", "starting_lng", "starting_lat")


def station_count(placed: DataFrame, city: str) -> DataFrame:
    """Stations per district of one city."""
    return placed.where(F.col("city_id") == city).groupBy("district_name").agg(F.count("*").alias("count"))
