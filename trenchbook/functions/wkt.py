"""Polygons inside WKT text, as column expressions.

A polygon is a struct (wkt, area, low): the text of its outer ring, its planar
area, and its smallest coordinate, which stands for its depth.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trenchbook import config
from trenchbook.functions.text import number


def polygon_texts(wkt: Column) -> Column:
    """Polygon texts of a geometry collection in order; null when it is not a collection.

    Only the outer ring is read; a polygon with holes is closed after it.
    """
    found = F.regexp_extract_all(wkt, F.lit(config.OUTER_RING_PATTERN), F.lit(0))
    return F.when(
        F.startswith(wkt, F.lit(config.COLLECTION_PREFIX)),
        F.transform(found, lambda p: F.concat(p, F.lit(")"))),
    )


def ring(polygon: Column) -> Column:
    """A polygon's outer ring as a struct (numbers, axes): all coordinates in one flat
    array, a bad number as a null, and how many make a point."""
    body = F.trim(F.regexp_extract(polygon, r"\(\(([^)]*)\)", 1))
    first_point = F.trim(F.substring_index(body, ",", 1))
    return F.struct(
        F.transform(F.split(body, r"[\s,]+"), number).alias("numbers"),
        F.size(F.split(first_point, r"\s+")).alias("axes"),
    )


def ring_area(numbers: Column, axes: Column) -> Column:
    """Planar area of a ring by the shoelace rule over X and Y.

    Coordinates are taken relative to the first point, so that large grid
    coordinates do not cost digits. Null when a number is bad or points differ in length.
    """
    x0, y0 = F.get(numbers, 0), F.get(numbers, 1)

    def term(x: Column, i: Column) -> Column:
        following = (i + axes) % F.size(numbers)
        cross = (x - x0) * (F.get(numbers, following + 1) - y0) - (
            F.get(numbers, following) - x0
        ) * (F.get(numbers, i + 1) - y0)
        return F.when(i % axes == 0, cross).otherwise(0.0)

    total = F.aggregate(F.transform(numbers, term), F.lit(0.0), lambda acc, t: acc + t)
    return F.when(F.size(numbers) % axes == 0, F.abs(total) / 2)


def measured_polygons(wkt: Column) -> Column:
    """Polygons of the collection as an array of (wkt, area, low, pos)."""

    def measure(text: Column, pos: Column) -> Column:
        # The ring is parsed once and handed to both measures.
        return F.get(
            F.transform(
                F.array(ring(text)),
                lambda r: F.struct(
                    text.alias("wkt"),
                    ring_area(r.numbers, r.axes).alias("area"),
                    F.array_min(r.numbers).alias("low"),
                    pos.alias("pos"),
                ),
            ),
            0,
        )

    return F.transform(polygon_texts(wkt), measure)


def largest_two(polygons: Column) -> Column:
    """The two polygons of largest distinct area, largest first; of equal areas the first stays.

    One ordered pass keeps the two leaders, so the cost is linear in the
    number of polygons.
    """
    measured = F.filter(polygons, lambda p: p.area.isNotNull())
    none = F.array().cast("array<struct<wkt:string,area:double,low:double,pos:int>>")

    def keep(best: Column, p: Column) -> Column:
        first, second = F.get(best, 0).area, F.get(best, 1).area
        return (
            F.when(first.isNull() | (p.area > first),
                   F.slice(F.concat(F.array(p), best), 1, 2))
            .when((p.area < first) & (second.isNull() | (p.area > second)),
                  F.array(F.get(best, 0), p))
            .otherwise(best)
        )

    return F.aggregate(measured, none, keep)


def opening_closing(polygons: Column) -> Column:
    """Struct (opening, closing): of two polygons the one with the lower low is the opening."""
    a, b = F.get(polygons, 0), F.get(polygons, 1)
    ordered = b.isNull() | (a.low <= b.low)
    return F.struct(
        F.when(ordered, a.wkt).otherwise(b.wkt).alias("opening"),
        F.when(ordered, b.wkt).otherwise(a.wkt).alias("closing"),
    )


def is_well_formed(polygon: Column) -> Column:
    """True for a single-ring polygon of at least four points, all of two or all of three numbers,
    the last equal to the first.

    Whatever passes has an area: ``ring`` reads the same numbers by the same rule.
    """
    body = F.regexp_extract(polygon, r"\(\(([^)]*)\)", 1)
    points = F.transform(
        F.split(body, ","), lambda p: F.transform(F.split(F.trim(p), r"\s+"), number)
    )

    def closed(parsed: Column) -> Column:
        axes = F.size(F.get(parsed, 0))
        return (
            (F.size(parsed) >= 4)
            & axes.isin(2, 3)
            & F.forall(parsed, lambda p: (F.size(p) == axes) & F.forall(p, lambda n: n.isNotNull()))
            & (F.element_at(parsed, -1) == F.get(parsed, 0))
        )

    # The points are parsed once and handed over, not once for every point.
    return polygon.rlike("^" + config.POLYGON_PATTERN + "$") & F.get(
        F.transform(F.array(points), closed), 0
    )
