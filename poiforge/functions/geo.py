"""Geometry as columns: points are two doubles, polygons arrays of struct(x, y) rings; longitude and latitude in degrees."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH, MERCATOR = 6_371_000.0, 6_378_137.0
#: Metres of a degree of latitude, a little low, so that cells are never too small.
DEGREE = 111_194.0
WIDEST = math.cos(math.radians(72))


def haversine(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def mercator_x(lon: Column) -> Column:
    return F.radians(lon) * MERCATOR


def mercator_y(lat: Column) -> Column:
    return F.log(F.tan(F.radians(lat) / 2 + math.pi / 4)) * MERCATOR


def mercator_distance(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Web-Mercator metres: the ground distance times 1 / cos(latitude)."""
    return F.sqrt(F.pow(mercator_x(lon1) - mercator_x(lon2), 2) + F.pow(mercator_y(lat1) - mercator_y(lat2), 2))


def buffer(lon: Column, lat: Column, metres: float, corners: int = 32) -> Column:
    """A ring of so many corners around a point, at so many Web-Mercator metres."""
    x, y = mercator_x(lon), mercator_y(lat)
    turns = [2 * math.pi * (i % corners) / corners for i in range(corners + 1)]
    corner = lambda a: F.struct(
        F.degrees((x + metres * math.cos(a)) / MERCATOR).alias("x"),
        F.degrees(2 * F.atan(F.exp((y + metres * math.sin(a)) / MERCATOR)) - math.pi / 2).alias("y"),
    )
    return F.array(*(corner(a) for a in turns))


def cells(lon: Column, lat: Column, radius: float | Column, metric: str) -> tuple[Column, Column]:
    """Grid cells such that points within the radius lie in the same or in neighbouring cells (haversine: up to 72 degrees of latitude)."""
    if metric == "mercator":
        return F.floor(mercator_x(lon) / radius), F.floor(mercator_y(lat) / radius)
    return F.floor(lon / (radius / (DEGREE * WIDEST))), F.floor(lat / (radius / DEGREE))


def row(lat: Column, radius: float) -> Column:
    """Rows of haversine cells, as high as the radius."""
    return F.floor(lat / (radius / DEGREE))


def row_width(row: Column, radius: float) -> Column:
    """Degrees of longitude that the radius reaches at most between this row and the next ones (up to 72 degrees of latitude)."""
    edge = F.least(F.greatest(F.abs(row - 1), F.abs(row + 2)) * (radius / DEGREE), F.lit(72.0))
    reach = F.lit(math.sin(min(radius / (2 * EARTH), math.pi / 2))) / F.cos(F.radians(edge))
    return F.degrees(2 * F.asin(F.least(reach, F.lit(1.0)))) * 1.00001


def distance(metric: str):
    return mercator_distance if metric == "mercator" else haversine


def grid_id(lon: Column, lat: Column, step: float = 0.005) -> Column:
    """Our own cell index, south-west corner in steps; NULL where the point is NULL. Not an H3 id."""
    return F.when(lon.isNotNull() & lat.isNotNull(), F.concat(F.floor(lon / step), F.lit("_"), F.floor(lat / step)))


def tile(lon: Column, lat: Column, zoom: int) -> tuple[Column, Column]:
    """x and y of the Web-Mercator tile."""
    n = float(1 << zoom)
    y = (1 - F.log(F.tan(F.radians(lat)) + 1 / F.cos(F.radians(lat))) / math.pi) / 2 * n
    return F.floor((lon + 180) / 360 * n).cast("int"), F.floor(y).cast("int")


def inside_ring(x: Column, y: Column, ring: Column) -> Column:
    """Ray casting over a closed ring (the last point repeats the first)."""

    def crosses(i: Column) -> Column:
        a, b = F.element_at(ring, i), F.element_at(ring, i + 1)
        return ((a["y"] > y) != (b["y"] > y)) & (x < (b["x"] - a["x"]) * (y - a["y"]) / (b["y"] - a["y"]) + a["x"])

    return F.size(F.filter(F.sequence(F.lit(1), F.greatest(F.size(ring) - 1, F.lit(1))), crosses)) % 2 == 1


def ring_box(ring: Column) -> Column:
    """struct(xmin, ymin, xmax, ymax) as FLOAT."""
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return F.struct(F.array_min(xs).cast("float").alias("xmin"), F.array_min(ys).cast("float").alias("ymin"), F.array_max(xs).cast("float").alias("xmax"), F.array_max(ys).cast("float").alias("ymax"))


def point_box(lon: Column, lat: Column) -> Column:
    return F.struct(lon.cast("float").alias("xmin"), lat.cast("float").alias("ymin"), lon.cast("float").alias("xmax"), lat.cast("float").alias("ymax"))


def ring_centroid(ring: Column) -> Column:
    """struct(x, y): area centroid of a closed ring; the mean of its points where the area is 0."""
    n = F.size(ring)

    def total(f) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), F.lit(0.0), lambda acc, i: acc + f(F.element_at(ring, i), F.element_at(ring, i + 1)))

    cross = lambda a, b: a["x"] * b["y"] - b["x"] * a["y"]
    area = total(cross)
    mean = lambda k: F.aggregate(ring, F.lit(0.0), lambda acc, p: acc + p[k]) / n
    at = lambda k: F.when(area != 0, total(lambda a, b: (a[k] + b[k]) * cross(a, b)) / (3 * area)).otherwise(mean(k))
    return F.struct(at("x").alias("x"), at("y").alias("y"))


def clip_ring(ring: Column, xmin: float, ymin: float, xmax: float, ymax: float) -> Column:
    """Sutherland-Hodgman against a box, one side after the other; the result is closed (empty where nothing is left)."""

    none = F.array().cast("array<struct<x:double,y:double>>")
    let = lambda value, f: F.get(F.transform(F.array(value), f), F.lit(0))  # noqa: E731  names a value, so that it isn't written out again and again

    def side(points: Column, key: str, other: str, bound: float, sign: int) -> Column:
        keep = lambda p: (p[key] - bound) * sign >= 0

        def cut(a: Column, b: Column) -> Column:
            t = (F.lit(bound) - a[key]) / (b[key] - a[key])
            at = {key: F.lit(float(bound)), other: a[other] + t * (b[other] - a[other])}
            hit = F.struct(at["x"].cast("double").alias("x"), at["y"].cast("double").alias("y"))
            return F.when(keep(a) & keep(b), F.array(b)).when(keep(a), F.array(hit)).when(keep(b), F.array(hit, b)).otherwise(none)

        def clip(p: Column) -> Column:
            pairs = F.arrays_zip(F.slice(p, 1, F.size(p) - 1).alias("a"), F.slice(p, 2, F.size(p) - 1).alias("b"))
            return F.when(F.size(p) > 1, F.flatten(F.transform(pairs, lambda q: cut(q["a"], q["b"])))).otherwise(none)

        return let(let(points, clip), lambda p: F.when(F.size(p) > 0, F.concat(p, F.slice(p, 1, 1))).otherwise(p))

    out = side(ring, "x", "y", xmin, 1)
    out = side(out, "x", "y", xmax, -1)
    out = side(out, "y", "x", ymin, 1)
    return side(out, "y", "x", ymax, -1)


def in_boxes(lon: Column, lat: Column, boxes: list[tuple[float, float, float, float]]) -> Column:
    """In any of the boxes (xmin, ymin, xmax, ymax); a disjunction of ranges that reaches the Parquet scan."""
    out = F.lit(False)
    for x0, y0, x1, y1 in boxes:
        out = out | (lon.between(x0, x1) & lat.between(y0, y1))
    return out


def dms(seconds: Column, hemisphere: Column) -> Column:
    """Arc-seconds to degrees, negative for S and W; NULL unless above 0."""
    s = seconds.try_cast("double")
    return F.when(s > 0, s / 3600 * F.when(F.upper(hemisphere).isin("S", "W"), -1).otherwise(1))


URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"


def uuid5(name: Column) -> Column:
    """Name-based id in the URL namespace: SHA-1 with version and variant bits."""
    h = F.sha1(F.concat(F.unhex(F.lit(URL_NAMESPACE)), F.encode(name, "UTF-8")))
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    return F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12))
