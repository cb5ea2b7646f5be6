"""Geometries of feeds as GeoJSON text: type and coordinates in [lon, lat] order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(x: Column, f: Callable[[Column], Column]) -> Column:
    """f of x, where f may look at x several times: x is made once a row, not once for each look."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def _json(kind: str, coordinates: Column) -> Column:
    return F.to_json(F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates")))


def point(lon: Column, lat: Column) -> Column:
    """A point; null without both numbers."""
    return F.when(lon.isNotNull() & lat.isNotNull(), _json("Point", F.array(lon, lat)))


def pairs(text: Column, swapped: bool = False) -> Column:
    """The points of `a,b[,more] a,b[,more] ...`, without those of fewer than two numbers; swapped: b first."""
    numbers = F.transform(F.split(F.trim(text), r"\s+"), lambda p: F.slice(F.transform(F.split(p, ","), lambda x: x.try_cast("double")), 1, 2))
    good = F.filter(numbers, lambda p: (F.size(p) == 2) & F.forall(p, lambda x: x.isNotNull()))
    return F.transform(good, lambda p: F.reverse(p)) if swapped else good


def ring(points: Column) -> Column:
    """Points as a closed ring; null under three."""
    return once(points, lambda p: F.when(F.size(p) >= 3, F.when(F.get(p, F.lit(0)) == F.element_at(p, -1), p).otherwise(F.concat(p, F.slice(p, 1, 1)))))


def cap_polygons(texts: Column) -> Column:
    """CAP polygons (an array of `lat,lon lat,lon ...` texts): one ring is a Polygon, several are a MultiPolygon; null without any."""
    rings = F.filter(F.transform(texts, lambda t: ring(pairs(t, swapped=True))), lambda r: r.isNotNull())
    return once(rings, lambda x: F.when(F.size(x) == 1, _json("Polygon", x)).when(F.size(x) > 1, _json("MultiPolygon", F.transform(x, lambda r: F.array(r)))))


def _spaced(text: Column) -> Column:
    """Points of `lat lon lat lon ...`; a pair that isn't two numbers and an odd last number are left out."""
    numbers = F.transform(F.split(F.trim(text), r"\s+"), lambda x: x.try_cast("double"))
    at = lambda n: F.sequence(F.lit(0), F.floor(F.size(n) / 2).cast("int") - 1)
    both = once(numbers, lambda n: F.when(F.size(n) >= 2, F.transform(at(n), lambda i: F.array(F.get(n, 2 * i + 1), F.get(n, 2 * i)))))
    return F.filter(both, lambda p: F.forall(p, lambda x: x.isNotNull()))


def georss(point_text: Column, polygon_text: Column) -> Column:
    """The point of `lat lon` if there is one, else the polygon of three or more; null without either."""
    first = once(F.get(_spaced(point_text), F.lit(0)), lambda p: F.when(p.isNotNull(), _json("Point", p)))
    return F.coalesce(first, _outline(_spaced(polygon_text)))


def _outline(points: Column) -> Column:
    return once(ring(points), lambda r: F.when(r.isNotNull(), _json("Polygon", F.array(r))))


def placemark(point_text: Column, line_text: Column, polygon_text: Column) -> Column:
    """KML coordinates: the first point if there is one, else a line of two points or more, else a ring of three or more."""
    first = once(F.get(pairs(point_text), F.lit(0)), lambda p: F.when(p.isNotNull(), _json("Point", p)))
    line = once(pairs(line_text), lambda p: F.when(F.size(p) >= 2, _json("LineString", p)))
    return F.coalesce(first, line, _outline(pairs(polygon_text)))
