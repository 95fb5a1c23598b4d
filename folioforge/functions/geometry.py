"""Plane geometry as expressions, the gap of two polygons and points in polygons as arrays of whole Arrow batches. Points are structs (x, y), polygons arrays of them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from folioforge.operators import box_batches as shape


def point(x, y) -> Column:
    as_double = lambda v: (v if isinstance(v, Column) else F.lit(v)).cast("double")
    return F.struct(as_double(x).alias("x"), as_double(y).alias("y"))


def edge_normals(polygon: Column) -> Column:
    """Unit normals of the edges that have a length."""
    n = F.size(polygon)

    def normal(i):
        a, b = F.get(polygon, i), F.get(polygon, (i + 1) % n)
        ex, ey = b["x"] - a["x"], b["y"] - a["y"]
        length = F.sqrt(ex * ex + ey * ey)
        return F.struct(F.try_divide(-ey, length).alias("x"), F.try_divide(ex, length).alias("y"))

    return F.filter(F.transform(F.sequence(F.lit(0), n - 1), normal), lambda v: v["x"].isNotNull())


def overlap_gap(a: Column, b: Column) -> Column:
    """How far two convex polygons can move apart at least before some edge normal parts them; negative if one does.

    Edges without a length, or with a null, have no normal, and points with a
    null are passed over; null if either polygon is null or no normal is left.
    """

    @F.arrow_udf("double")
    def run(pairs: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for p, q in pairs:
            yield shape.gaps(p, q)

    return run(a, b)


def polygons_overlap(a: Column, b: Column, threshold: float = 0.0) -> Column:
    """Touching counts at threshold 0."""
    return overlap_gap(a, b) >= -threshold


def orientation(a: Column, b: Column, c: Column) -> Column:
    """Twice the signed area of the triangle."""
    return (b["x"] - a["x"]) * (c["y"] - a["y"]) - (b["y"] - a["y"]) * (c["x"] - a["x"])


def on_segment(a: Column, b: Column, p: Column) -> Column:
    """Whether p is in the bounding box of a and b."""
    inside = lambda k: p[k].between(F.least(a[k], b[k]), F.greatest(a[k], b[k]))
    return inside("x") & inside("y")


def segments_intersect(a: Column, b: Column, c: Column, d: Column) -> Column:
    o1, o2, o3, o4 = orientation(a, b, c), orientation(a, b, d), orientation(c, d, a), orientation(c, d, b)
    crossing = (F.signum(o1) * F.signum(o2) < 0) & (F.signum(o3) * F.signum(o4) < 0)
    touching = (
        ((o1 == 0) & on_segment(a, b, c)) | ((o2 == 0) & on_segment(a, b, d)) | ((o3 == 0) & on_segment(c, d, a)) | ((o4 == 0) & on_segment(c, d, b))
    )
    return crossing | touching


def point_in_polygon(polygon: Column, p: Column) -> Column:
    """Whether p is in or on a convex polygon, whichever way it turns; null if nulls leave it open."""

    @F.arrow_udf("boolean")
    def run(pairs: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for polygons, points in pairs:
            yield shape.inside(polygons, points)

    return run(polygon, p)


def _inside(polygon: Column, p: Column) -> Column:
    """point_in_polygon as an expression, for use in others."""
    n = F.size(polygon)
    turns = F.transform(F.sequence(F.lit(0), n - 1), lambda i: orientation(F.get(polygon, i), F.get(polygon, (i + 1) % n), p))
    return F.forall(turns, lambda t: t >= 0) | F.forall(turns, lambda t: t <= 0)


def segment_distance(a: Column, b: Column, p: Column) -> Column:
    """Distance of p from the segment a-b; from a if the segment has no length."""
    ex, ey = b["x"] - a["x"], b["y"] - a["y"]
    px, py = p["x"] - a["x"], p["y"] - a["y"]
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.try_divide(px * ex + py * ey, ex * ex + ey * ey), F.lit(0.0))))
    dx, dy = px - t * ex, py - t * ey
    return F.sqrt(dx * dx + dy * dy)


def line_intersection(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Where the lines a-b and c-d meet; null if they are parallel."""
    ux, uy = b["x"] - a["x"], b["y"] - a["y"]
    vx, vy = d["x"] - c["x"], d["y"] - c["y"]
    t = F.try_divide((c["x"] - a["x"]) * vy - (c["y"] - a["y"]) * vx, ux * vy - uy * vx)
    return F.when(t.isNotNull(), point(a["x"] + t * ux, a["y"] + t * uy))


def point_distance(a: Column, b: Column) -> Column:
    dx, dy = a["x"] - b["x"], a["y"] - b["y"]
    return F.sqrt(dx * dx + dy * dy)


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _put(items: Column, at: Column, value: Column) -> Column:
    return F.transform(items, lambda v, k: F.when(k == at, value).otherwise(v))


def _first_corners(points: Column, canvas: Column) -> Column:
    """For each corner of the canvas the point nearest to it; of two neighbouring corners with the same point, the one
    whose second choice is nearer to its own canvas corner takes that."""
    ranked = F.transform(canvas, lambda c: F.slice(F.sort_array(F.transform(points, lambda p, k: F.struct(point_distance(c, p).alias("d"), k.alias("k"), p.alias("p")))), 1, 2))

    def settle(near):
        def step(quad, i):
            j = (i + 1) % 4
            a, b = F.get(F.get(near, i), 1), F.get(F.get(near, j), 1)
            first = a["d"] < b["d"]
            moved = _put(quad, F.when(first, i).otherwise(j), F.when(first, a["p"]).otherwise(b["p"]))
            return F.when((F.size(points) > 1) & (F.get(quad, i) == F.get(quad, j)), moved).otherwise(quad)

        return F.aggregate(F.sequence(F.lit(0), F.lit(3)), F.transform(near, lambda n: F.get(n, 0)["p"]), step)

    return _let(ranked, settle)


def merged_quad(points: Column, width: Column, height: Column) -> Column:
    """One quadrilateral around the points of some polygons, corners in order from the canvas's upper left.

    Each corner starts at a point near a canvas corner. Then every point that lies
    outside, the furthest first, moves the nearer end of the edge that was next to
    it to where that end's other edge meets the line through the point; parallel
    lines move nothing.
    """
    canvas = F.array(point(0, 0), point(width, 0), point(width, height), point(0, height))

    def widen(start):
        def edge(p):
            return F.array_min(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.struct(segment_distance(F.get(start, i), F.get(start, (i + 1) % 4), p).alias("d"), i.alias("i"))))

        near = lambda p, k: _let(edge(p), lambda e: F.struct((-e["d"]).alias("d"), k.alias("k"), e["i"].alias("i"), p.alias("p")))
        far = F.sort_array(F.transform(points, near))

        def step(quad, row):
            p, i, j = row["p"], row["i"], (row["i"] + 1) % 4
            a, b = F.get(quad, i), F.get(quad, j)
            nearer = point_distance(a, p) < point_distance(b, p)
            moved = F.when(nearer, line_intersection(a, F.get(quad, (i + 3) % 4), p, b)).otherwise(line_intersection(b, F.get(quad, (i + 2) % 4), p, a))
            wider = _let(moved, lambda m: F.when(m.isNull(), quad).otherwise(_put(quad, F.when(nearer, i).otherwise(j), m)))
            return F.when(_inside(quad, p), quad).otherwise(wider)

        return F.aggregate(far, start, step)

    return _let(_first_corners(points, canvas), widen)
