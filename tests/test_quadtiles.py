"""Quadtree tiles against the plain crossing test."""

import json
import random

import pytest
from pyspark.sql import functions as F

from hailstat.operators import quadtiles, stations

POINTS = "id bigint, starting_lng double, starting_lat double"
RINGS = "citycode string, district_name string, ring array<struct<lng: double, lat: double>>"


def inside(rings, x, y):
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * ((y - y1) / (y2 - y1)) + x1:
                odd = not odd
    return odd


def joined(spark, shapes, points, max_edges):
    rows = [("c", name, [(float(x), float(y)) for x, y in ring]) for name, rings in shapes.items() for ring in rings]
    edges = quadtiles.edge_rows(spark.createDataFrame(rows, RINGS))
    tiles = quadtiles.quad_tiles(edges, max_edges).cache()
    found = quadtiles.in_districts(spark.createDataFrame([(i, *(None if v is None else float(v) for v in xy)) for i, *xy in points], POINTS), tiles)
    return {(r["id"], r["district_name"]) for r in found.collect()}, tiles


def star(pick, x, y, size, corners):
    import math

    out = []
    for k in range(corners):
        r, a = size * pick.uniform(0.4, 1), 2 * math.pi * k / corners
        out.append((x + r * math.cos(a), y + r * math.sin(a)))
    return out


@pytest.mark.parametrize("max_edges", [4, 64])
def test_holes_parts_and_long_edges(spark, max_edges):
    pick = random.Random(max_edges)
    shapes = {
        "hole": [star(pick, 110, 20, 3, 40), [(109.9, 19.9), (110.1, 19.9), (110.1, 20.1), (109.9, 20.1)]],
        "parts": [star(pick, 115, 22, 0.4, 25), star(pick, 116, 22, 0.3, 9)],
        "square": [[(111, 19), (112, 19), (112, 20), (111, 20)]],
        "aligned": [[(112.5, 19.6875), (113.90625, 19.6875), (113.90625, 21.09375), (112.5, 21.09375)]],
        "thin": [[(100, 10), (120, 25), (120, 25.0001)]],
        "tiny": [[(110.5, 20.5), (110.50001, 20.5), (110.5, 20.50001)]],
        "far": [[(-75, -30), (-74, -30.5), (-74.5, -29)]],
    }
    where = [(pick.uniform(106, 117), pick.uniform(16, 24)) for _ in range(1500)]
    where += [(pick.uniform(-75.2, -73.8), pick.uniform(-30.6, -28.8)) for _ in range(200)]
    where += [(110.500003, 20.500003), (112.5, 19.6875), (113.90625, 20.0), (113.0, 21.09375), (111.0, 19.5), (111.5, 19.0)]
    where += [(x, y + d) for x, y in [(110.0, 17.5), (115.0, 21.25)] for d in (-1e-7, 0.0, 1e-5)]
    points = [(i, x, y) for i, (x, y) in enumerate(where)] + [(-1, None, 20.0), (-2, 110.0, None)]
    found, tiles = joined(spark, shapes, points, max_edges)
    expected = {(i, n) for i, x, y in points if x is not None and y is not None for n, rings in shapes.items() if inside(rings, x, y)}
    assert found == expected and len({n for _, n in expected}) == len(shapes)
    last = tiles.where(F.col("level") < quadtiles.LAST_LEVEL)
    touching = last.select("level", "tx", "ty", F.size(F.filter("edges", lambda e: e["x1"] < quadtiles.FAR)).alias("n"))
    assert touching.groupBy("level", "tx", "ty").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] <= max_edges
    assert (tiles.where("inner").count() > 0) == (max_edges == 4) and tiles.where("inner and size(edges) > 1").count() == 0


def test_ten_thousand_districts(spark):
    pick = random.Random(2)
    side = 0.05
    shapes = {f"d{i}_{j}": [[(100 + i * side, 10 + j * side), (100 + (i + 1) * side, 10 + j * side),
                             (100 + (i + 1) * side, 10 + (j + 1) * side), (100 + i * side, 10 + (j + 1) * side)]]
              for i in range(100) for j in range(100)}
    points = [(k, pick.uniform(99.9, 105.1), pick.uniform(9.9, 15.1)) for k in range(3000)]
    found, tiles = joined(spark, shapes, points, 64)
    expected = set()
    for k, x, y in points:
        i, j = int((x - 100) / side), int((y - 10) / side)
        near = [f"d{a}_{b}" for a in (i - 1, i, i + 1) for b in (j - 1, j, j + 1)]
        expected |= {(k, n) for n in near if n in shapes and inside(shapes[n], x, y)}
    assert found == expected and len(expected) > 2500


def test_from_geojson_to_the_join(spark):
    ring = [[110.0, 19.0], [111.0, 19.0], [111.0, 20.0], [110.0, 20.0], [110.0, 19.0]]
    hole = [[110.4, 19.4], [110.6, 19.4], [110.6, 19.6], [110.4, 19.6], [110.4, 19.4]]
    document = {"features": [{"properties": {"name": "A"}, "geometry": {"type": "Polygon", "coordinates": [ring, hole]}}]}
    rings = stations.parse_geojson(spark.createDataFrame([(json.dumps(document),)], "value string"))
    tiles = quadtiles.quad_tiles(quadtiles.edge_rows(rings))
    points = spark.createDataFrame([(1, 110.2, 19.2), (2, 110.5, 19.5), (3, 111.5, 19.5)], POINTS)
    assert [r["id"] for r in quadtiles.in_districts(points, tiles).collect()] == [1]


def test_no_districts(spark):
    tiles = quadtiles.quad_tiles(quadtiles.edge_rows(spark.createDataFrame([], RINGS)))
    assert quadtiles.in_districts(spark.createDataFrame([(1, 1.0, 1.0)], POINTS), tiles).collect() == []
