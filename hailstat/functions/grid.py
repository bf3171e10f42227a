"""A hexagonal grid and spherical centroids as Column expressions.

Points are projected to metres around a fixed origin and put into pointy-top hexagons with axial
coordinates ``q`` and ``r``. The edge is 1200 m at resolution 7 and shrinks by the square root of
seven per step, so cells cover the same area per resolution as other hierarchical hex grids do; the
ids are this grid's own. A cell id holds resolution, ``q`` and ``r`` in one 64-bit number.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the grid.
ORIGIN_LNG = 110.0
ORIGIN_LAT = 20.0
METRES_PER_DEGREE = 111320.0
EDGE_AT_7 = 1200.0
COORDINATE_BITS = 29
RESOLUTIONS = range(0, 16)  # every place on earth fits the bits of the finest
OFFSET = 2 ** (COORDINATE_BITS - 1)

LNG_METRES = math.cos(math.radians(ORIGIN_LAT)) * METRES_PER_DEGREE


def edge_length(res: int) -> float:
    """Edge of a cell in metres."""
    return EDGE_AT_7 / math.sqrt(7.0) ** (res - 7)


def cell_of(lat: Column, lng: Column, res: int) -> Column:
    """The cell that holds a point; null for a coordinate that is null, not finite or out of range.

    Three families of parallel lines through the corners cut the plane into triangles. The line
    numbers ``u``, ``v`` and ``w`` of a point name its triangle and, divided by three, the hexagon
    that the triangle is a part of. It is the nearest centre, as rounding of cube coordinates finds
    it, but short and without branches, so that it stays cheap inside generated code.
    """
    if res not in RESOLUTIONS:
        raise ValueError(f"resolution {res} is not one of {RESOLUTIONS.start} to {RESOLUTIONS.stop - 1}")
    edge = edge_length(res)
    on_earth = lat.between(-90, 90) & lng.between(-180, 180)
    x = (lng - ORIGIN_LNG) * (LNG_METRES / math.sqrt(3.0) / edge)
    y = (lat - ORIGIN_LAT) * (METRES_PER_DEGREE / edge)
    u, v, w = F.floor(x * 2.0), F.floor(x - y), F.floor(x + y)
    q, r = F.floor((u + v + 2) / 3.0), F.floor((w - v + 1) / 3.0)
    high = F.lit((res * 2**COORDINATE_BITS + OFFSET) * 2**COORDINATE_BITS + OFFSET).cast("bigint")
    return F.when(on_earth, high + q * 2**COORDINATE_BITS + r)


def _resolution(cell: Column) -> Column:
    return F.shiftright(cell, 2 * COORDINATE_BITS)


def _centre_metres(cell: Column) -> tuple[Column, Column, Column]:
    mask = F.lit(2**COORDINATE_BITS - 1)
    q = F.shiftright(cell, COORDINATE_BITS).bitwiseAND(mask) - OFFSET
    r = cell.bitwiseAND(mask) - OFFSET
    edge = F.lit(EDGE_AT_7) / F.pow(F.lit(math.sqrt(7.0)), _resolution(cell) - 7)
    return edge * math.sqrt(3.0) * (q + r / 2.0), edge * 1.5 * r, edge


def _degrees(x: Column, y: Column) -> tuple[Column, Column]:
    return x / LNG_METRES + ORIGIN_LNG, y / METRES_PER_DEGREE + ORIGIN_LAT


def cell_center(cell: Column) -> Column:
    """Centre of a cell as ``struct<lng,lat>``."""
    x, y, _ = _centre_metres(cell)
    lng, lat = _degrees(x, y)
    return F.struct(lng.alias("lng"), lat.alias("lat"))


def cell_boundary(cell: Column) -> Column:
    """The six corners of a cell as ``array<struct<lng,lat>>``."""
    x, y, edge = _centre_metres(cell)
    corners = []
    for k in range(6):
        angle = math.radians(60 * k - 30)
        lng, lat = _degrees(x + edge * math.cos(angle), y + edge * math.sin(angle))
        corners.append(F.struct(lng.alias("lng"), lat.alias("lat")))
    return F.array(*corners)


def degrees_text(degrees: Column) -> Column:
    """Six decimals, about ten centimetres."""
    return F.round(degrees, 6).cast("decimal(9,6)").cast("string")


def lat_lng_text(point: Column) -> Column:
    return F.concat_ws(",", degrees_text(point["lat"]), degrees_text(point["lng"]))


def lng_lat_text(point: Column) -> Column:
    return F.concat_ws(",", degrees_text(point["lng"]), degrees_text(point["lat"]))


def _from_unit(x: Column, y: Column, z: Column) -> Column:
    return F.struct(
        F.degrees(F.atan2(y, x)).alias("lng"), F.degrees(F.atan2(z, F.sqrt(x * x + y * y))).alias("lat")
    )


def centroid(lat: Column, lng: Column) -> Column:
    """Mean of a group's points on the sphere (an aggregate), as ``struct<lng,lat>``."""
    phi, lam = F.radians(lat), F.radians(lng)
    return _from_unit(F.avg(F.cos(phi) * F.cos(lam)), F.avg(F.cos(phi) * F.sin(lam)), F.avg(F.sin(phi)))


def array_centroid(points: Column) -> Column:
    """The same over an array of ``struct<lng,lat>``; the length of the mean vector drops out."""
    def total(part) -> Column:
        return F.aggregate(points, F.lit(0.0), lambda acc, p: acc + part(F.radians(p["lat"]), F.radians(p["lng"])))

    return _from_unit(
        total(lambda phi, lam: F.cos(phi) * F.cos(lam)),
        total(lambda phi, lam: F.cos(phi) * F.sin(lam)),
        total(lambda phi, lam: F.sin(phi)),
    )
