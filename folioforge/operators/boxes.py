"""Text boxes of a page: those that overlap are grouped, each group becomes one quadrilateral.

Overlaps on a page of more than a few boxes are found on grids: a box lies in the cells of the grid whose edge is the
power of four next to its own size, four at most, and looks for boxes of its size
or larger in the cells of every grid that is in use. A pair is settled in one
cell, that of the lower corner of what its bounds share. Work thus goes by cells
and not by pages, and grows with the boxes and those that come near each other.

Boxes without points, or with one that is null, NaN or infinite, overlap nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions.geometry import edge_normals, point
from folioforge.operators import box_batches as shape
from folioforge.operators.components import connected_groups
from folioforge.sources.files import stored

QUAD = "array<struct<x:double,y:double>>"
#: A coordinate's bits before its unit that cells tell apart; smaller boxes than that are taken for as large.
CELL_BITS = 40
#: Boxes up to which a page is one cell.
SMALL_PAGE = 64
#: Pages of a batch that are held as arrays at once.
PAGES_AT_ONCE = 5_000
#: Overlaps up to which a page's groups are found by one task; beyond it by rounds over all tasks.
LOCAL_PAIRS = 100_000


def _reach(polygon: Column, threshold: float) -> Column:
    """How far another convex polygon can be that no edge normal parts by more than the threshold; null without a bound.

    The direction to the other one is within half the angle of two neighbouring
    normals of one of them.
    """
    n = edge_normals(polygon)
    turn = lambda i: F.get(n, i)["x"] * F.get(n, (i + 1) % F.size(n))["x"] + F.get(n, i)["y"] * F.get(n, (i + 1) % F.size(n))["y"]
    least = F.array_min(F.transform(F.sequence(F.lit(0), F.size(n) - 1), turn))
    return F.when((F.size(n) > 2) & (least > -0.999), threshold / F.sqrt((1 + least) / 2))


def _sound_point(p: Column) -> Column:
    sound = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    return sound(p["x"]) & sound(p["y"])


def _bounded(boxes: DataFrame, page: str, box: str, polygon: str, threshold: float) -> DataFrame:
    """Sound boxes with bounds, half their reach added, and the level of their grid; without a level if no bound is known."""
    bound = lambda f, k: f(F.transform("poly", lambda p: p[k]))
    cut = boxes.select(F.col(page).alias("page"), F.col(box).alias("box"), F.col(polygon).alias("poly"))
    cut = cut.filter((F.size("poly") > 0) & F.forall("poly", _sound_point))
    half = _reach(F.col("poly"), threshold) / 2 if threshold > 0 else F.lit(0.0)
    sized = cut.withColumn("half", half).select(
        "*", *((bound(f, k) + (F.col("half") if f is F.array_max else -F.col("half"))).alias(k + str(int(f is F.array_max))) for k in "xy" for f in (F.array_min, F.array_max))
    )
    edge = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    far = F.greatest(*(F.abs(c) for c in ("x0", "x1", "y0", "y1")))
    log = lambda v: F.when(v > 0, F.ceil(F.log2(v))).otherwise(F.lit(-1000)).cast("int")
    # every other power of two: fewer grids in use, and fewer cells to a box
    return sized.withColumn("level", (2 * F.ceil(F.greatest(log(edge), log(far) - CELL_BITS) / 2)).cast("int"))


def _cells(df: DataFrame) -> DataFrame:
    """Each row in every cell of its level's grid that its bounds touch."""
    size = F.pow(F.lit(2.0), F.col("level"))
    at = {c: F.floor(F.col(c) / size).cast("long").alias("c" + c) for c in ("x0", "x1", "y0", "y1")}
    placed = df.select("*", *at.values())
    across = placed.withColumn("cx", F.explode(F.sequence("cx0", "cx1")))
    return across.withColumn("cy", F.explode(F.sequence("cy0", "cy1"))).drop("cx1", "cy1")


def candidate_pairs(boxes: DataFrame, page: str, box: str, polygon: str, threshold: float = 0.0, small_page: int = SMALL_PAGE) -> DataFrame:
    """(page, a, b, apoly, bpoly) with a < b: boxes of one page whose bounds meet, or are as near as the threshold allows."""
    known = _bounded(boxes, page, box, polygon, threshold)
    pairs = None
    if small_page:
        sizes = known.groupBy("page").agg(F.count("*").alias("n"))
        large = sizes.filter(F.col("n") > small_page).select("page")
        some = bool(large.head(1))
        few = known.join(large, "page", "left_anti") if some else known
        known = known.join(large, "page", "left_semi")
        one = lambda n: few.select("page", *(F.col(c).alias(n + c) for c in ("box", "poly", "x0", "x1", "y0", "y1", "level")))
        apart = F.col("alevel").isNotNull() & F.col("blevel").isNotNull() & ~F.expr("ax0 <= bx1 AND bx0 <= ax1 AND ay0 <= by1 AND by0 <= ay1")
        pairs = one("a").join(one("b"), "page").filter((F.col("abox") < F.col("bbox")) & ~apart).select("page", "abox", "bbox", "apoly", "bpoly")
    if not small_page or some:
        tiled = _tiled(known, threshold)
        pairs = tiled if pairs is None else pairs.unionByName(tiled)
    first = F.col("abox") < F.col("bbox")
    side = lambda c, d: F.when(first, F.col(c)).otherwise(F.col(d))
    return pairs.select(F.col("page").alias(page), F.least("abox", "bbox").alias("a"), F.greatest("abox", "bbox").alias("b"), side("apoly", "bpoly").alias("apoly"), side("bpoly", "apoly").alias("bpoly"))


def _tiled(known: DataFrame, threshold: float) -> DataFrame:
    """(page, abox, bbox, apoly, bpoly) by the cells of the grids, in either order."""
    levels = sorted(r.level for r in known.select("level").distinct().collect() if r.level is not None)  # a double has 2,100 powers of two
    grid = known.filter("level IS NOT NULL").drop("half")
    own = ("page", "box", "poly", "x0", "x1", "y0", "y1", "cx0", "cy0")
    held = _cells(grid).select("level", "cx", "cy", *(F.col(c).alias("b" + c) for c in own))
    upward = F.filter(F.array(*(F.lit(v) for v in levels)).cast("array<int>"), lambda v: v >= F.col("rank"))
    asked = _cells(grid.withColumnRenamed("level", "rank").withColumn("level", F.explode(upward)))
    asked = asked.select("level", "cx", "cy", "rank", *(F.col(c).alias("a" + c) for c in own))
    met = asked.join(held, (F.col("apage") == F.col("bpage")) & (asked["level"] == held["level"]) & (asked["cx"] == held["cx"]) & (asked["cy"] == held["cy"]))
    settled = (asked["cx"] == F.greatest("acx0", "bcx0")) & (asked["cy"] == F.greatest("acy0", "bcy0"))
    once = F.when(F.col("rank") == asked["level"], F.col("abox") < F.col("bbox")).otherwise(F.col("abox") != F.col("bbox"))
    near = met.filter(settled & once & F.expr("ax0 <= bx1 AND bx0 <= ax1 AND ay0 <= by1 AND by0 <= ay1"))
    pairs = near.select(F.col("apage").alias("page"), "abox", "bbox", "apoly", "bpoly")
    if threshold > 0:  # polygons without a reach meet all others of their page
        rest = known.select("page", F.col("box").alias("abox"), F.col("poly").alias("apoly"), F.col("level").isNull().alias("aopen"))
        other = known.select("page", F.col("box").alias("bbox"), F.col("poly").alias("bpoly"), F.col("level").isNull().alias("bopen"))
        pairs = pairs.unionByName(rest.filter("aopen").join(other, "page").filter("abox <> bbox AND (NOT bopen OR abox < bbox)").drop("aopen", "bopen"))
    return pairs


def overlapping_pairs(boxes: DataFrame, page: str, box: str, polygon: str, threshold: float = 0.0, small_page: int = SMALL_PAGE) -> DataFrame:
    """(page, a, b): numbers of boxes of one page that overlap, a < b; numbers tell a page's boxes apart."""
    kind = {c: boxes.schema[c].dataType.simpleString() for c in (page, box)}
    near = candidate_pairs(boxes.withColumn(polygon, F.col(polygon).cast(QUAD)), page, box, polygon, threshold, small_page)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = np.arange(batch.num_rows)
            hit = shape.overlapping(shape.polygons(batch.column(3)), k, shape.polygons(batch.column(4)), k, threshold)
            yield batch.select([0, 1, 2]).filter(pa.array(hit))

    return near.mapInArrow(run, f"`{page}` {kind[page]}, a {kind[box]}, b {kind[box]}")


def box_groups(boxes: DataFrame, page: str, box: str, polygon: str, threshold: float = 0.0, keep: dict[str, Column] | None = None) -> DataFrame:
    """(page, box, polygon, group, what keep names): each box with the smallest one of its connected group.

    Boxes with the same polygon stand for each other until the end. Those that
    overlap nothing, or have no page, are alone.
    """
    cut = boxes.select(F.col(page).alias("page"), F.col(box).alias("box"), F.col(polygon).alias("poly"), *(c.alias(n) for n, c in (keep or {}).items()))
    kinds = stored(cut.groupBy("page", "poly").agg(F.min("box").alias("first")))
    # a page has fewer polygons than boxes if there are copies: with few of them it is one cell, and each is shuffled once and
    # not for every cell of every grid in use
    pairs = overlapping_pairs(kinds, "page", "first", "poly", threshold)
    found = connected_groups(pairs, "page", "a", "b", LOCAL_PAIRS).withColumnRenamed("node", "first")
    # a sound polygon with an edge overlaps its copies
    alike = F.exists("poly", lambda p: p != F.get("poly", F.lit(0))) & F.forall("poly", _sound_point)
    whole = kinds.join(found, ["page", "first"], "left").withColumn("own", F.when(alike, F.col("first")))
    grouped = cut.join(whole, ["page", "poly"], "left").withColumn("group", F.coalesce("group", "own", "box"))
    return grouped.select(F.col("page").alias(page), F.col("box").alias(box), F.col("poly").alias(polygon), "group", *(keep or {}))


Point = tuple[float, float]


def overlap(p: list[Point], q: list[Point], threshold: float = 0.0) -> bool:
    for poly in (p, q):
        for (ax, ay), (bx, by) in zip(poly, [*poly[1:], poly[0]]):
            nx, ny = ay - by, bx - ax
            norm = _distance((nx, ny), (0.0, 0.0))
            if norm:
                a, b = [x * nx + y * ny for x, y in p], [x * nx + y * ny for x, y in q]
                if min(max(a) - min(b), max(b) - min(a)) < -threshold * norm:
                    return False
    return True


def groups_of(polygons: list[list[Point]], threshold: float = 0.0) -> list[list[int]]:
    """Connected groups of overlapping polygons, by smallest member."""
    parent = list(range(len(polygons)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    # boxes sorted by their left edge: only those that begin before this one ends can meet it
    left, right = [min(x for x, _ in p) for p in polygons], [max(x for x, _ in p) for p in polygons]
    order = sorted(range(len(polygons)), key=left.__getitem__)
    for k, i in enumerate(order):
        for j in order[k + 1 :]:
            if left[j] > right[i] + threshold:
                break
            if root(i) != root(j) and overlap(polygons[i], polygons[j], threshold):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    out: dict[int, list[int]] = {}
    for i in range(len(polygons)):
        out.setdefault(root(i), []).append(i)
    return list(out.values())


def _distance(a: Point, b: Point) -> float:
    """As the expressions of `functions.geometry` have it, so that both ways give the same corners."""
    dx, dy = a[0] - b[0], a[1] - b[1]
    return math.sqrt(dx * dx + dy * dy)


def _inside(quad: list[Point], p: Point) -> bool:
    x, y = p
    turns = [(bx - ax) * (y - ay) - (by - ay) * (x - ax) for (ax, ay), (bx, by) in zip(quad, [*quad[1:], quad[0]])]
    return min(turns) >= 0 or max(turns) <= 0


def _segment_distance(a: Point, b: Point, p: Point) -> float:
    ex, ey, px, py = b[0] - a[0], b[1] - a[1], p[0] - a[0], p[1] - a[1]
    length = ex * ex + ey * ey
    t = min(1.0, max(0.0, (px * ex + py * ey) / length)) if length else 0.0
    return _distance((px, py), (t * ex, t * ey))


def _meet(a: Point, b: Point, c: Point, d: Point) -> Point | None:
    ux, uy, vx, vy = b[0] - a[0], b[1] - a[1], d[0] - c[0], d[1] - c[1]
    cross = ux * vy - uy * vx
    if cross == 0:
        return None
    t = ((c[0] - a[0]) * vy - (c[1] - a[1]) * vx) / cross
    return a[0] + t * ux, a[1] + t * uy


def merged_quad(polygons: list[list[Point]], width: float, height: float) -> list[Point]:
    """One quadrilateral around the polygons, corners in order from the canvas's upper left.

    Each corner starts at the point nearest to a canvas corner. Where two
    neighbouring corners took the same point, the one whose second choice is
    nearer to its own canvas corner gives way. Then every point that lies
    outside, the furthest first, moves the nearer end of its edge to where that
    end's other edge meets the line through the point; parallel lines move
    nothing.
    """
    points = [p for poly in polygons for p in poly]
    canvas = [(0.0, 0.0), (width, 0.0), (width, height), (0.0, height)]
    near = [sorted(points, key=lambda p, c=c: _distance(p, c)) for c in canvas]
    quad = [n[0] for n in near]
    for i in range(4):
        j = (i + 1) % 4
        if len(points) > 1 and quad[i] == quad[j]:
            a, b = near[i][1], near[j][1]
            first = _distance(canvas[i], a) < _distance(canvas[j], b)
            quad[i if first else j] = a if first else b
    edges = [min((_segment_distance(quad[i], quad[(i + 1) % 4], p), i) for i in range(4)) for p in points]
    for k in sorted(range(len(points)), key=lambda k: -edges[k][0]):
        p, i = points[k], edges[k][1]
        if _inside(quad, p):
            continue
        j = (i + 1) % 4
        if _distance(quad[i], p) < _distance(quad[j], p):
            moved, at = _meet(quad[i], quad[i - 1], p, quad[j]), i
        else:
            moved, at = _meet(quad[j], quad[(j + 1) % 4], p, quad[i]), j
        if moved is not None:
            quad[at] = moved
    return quad


def _merge_local(boxes: DataFrame, page: str, box: str, polygon: str, size: tuple[str, str], threshold: float) -> DataFrame:
    """merge_boxes with a page to a row; boxes without a page are alone."""
    kind = {c: boxes.schema[c].dataType.simpleString() for c in (page, box)}
    rows = F.array_sort(F.collect_list(F.struct(F.col(box).alias("box"), F.col(polygon).cast(QUAD).alias("polygon"))))
    pages = boxes.groupBy(page).agg(rows.alias("boxes"), F.first(size[0]).cast("double").alias("w"), F.first(size[1]).cast("double").alias("h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, PAGES_AT_ONCE):
                yield merged(batch.slice(k, PAGES_AT_ONCE))

    def merged(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, w, h = batch.column(0), *(c.to_numpy(zero_copy_only=False) for c in batch.columns[2:])
        own = batch.column(1).flatten()
        numbers, polygons = own.flatten()
        shapes, of = shape.polygons(polygons), np.repeat(np.arange(batch.num_rows), batch.column(1).value_lengths().to_numpy(zero_copy_only=False))
        alone = batch.num_rows + np.arange(len(of))
        low = shape.labels(len(of), *shape.page_pairs(np.where(keys.is_null().to_numpy(zero_copy_only=False)[of], alone, of), shapes, threshold))
        first, n = np.unique(low, return_counts=True)
        many, order = n > 1, np.argsort(low, kind="stable")
        order = order[np.repeat(many, n)]
        quad = pa.concat_arrays([polygons.take(pa.array(first[~many])), shape.quads(shape.gathered(shapes, order, n[many]), w[of[first[many]]], h[of[first[many]]]).cast(polygons.type)])
        first, n = np.concatenate([first[~many], first[many]]), np.concatenate([n[~many], n[many]])
        return pa.RecordBatch.from_arrays([keys.take(pa.array(of[first])), numbers.take(pa.array(first)), pa.array(n, pa.int32()), quad], names=[page, "group", "n_boxes", "quad"])

    return pages.mapInArrow(run, f"`{page}` {kind[page]}, group {kind[box]}, n_boxes int, quad {QUAD}")


def _merge_spread(boxes: DataFrame, page: str, box: str, polygon: str, size: tuple[str, str], threshold: float) -> DataFrame:
    """merge_boxes with a group's points to a row."""
    kind = {c: boxes.schema[c].dataType.simpleString() for c in (page, box)}
    width, height = (F.col(c).cast("double") for c in size)
    rows = F.sort_array(F.collect_list(F.struct(F.col(box).alias("box"), F.col(polygon).cast(QUAD).alias("poly"))))
    grouped = box_groups(boxes, page, box, polygon, threshold, {"__w": width, "__h": height}).groupBy(page, "group")
    gathered = grouped.agg(F.count("*").cast("int").alias("n_boxes"), F.flatten(F.transform(rows, lambda r: r["poly"])).alias("points"), F.first("__w").alias("w"), F.first("__h").alias("h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points, w, h = batch.column(3), *(c.to_numpy(zero_copy_only=False) for c in batch.columns[4:])
            many = batch.column(2).to_numpy() > 1
            own, other = np.flatnonzero(~many), np.flatnonzero(many)
            around = shape.quads(shape.polygons(points.take(pa.array(other))), w[other], h[other])
            quad = pa.concat_arrays([points.take(pa.array(own)), around.cast(points.type)])
            keys = [c.take(pa.array(np.concatenate([own, other]))) for c in batch.columns[:3]]
            yield pa.RecordBatch.from_arrays([*keys, quad], names=[page, "group", "n_boxes", "quad"])

    return gathered.select(page, "group", "n_boxes", "points", "w", "h").mapInArrow(run, f"`{page}` {kind[page]}, group {kind[box]}, n_boxes int, quad {QUAD}")


def merge_boxes(
    boxes: DataFrame, page: str, box: str, polygon: str, score: str | None = None, least: float = 0.8, size: tuple[str, str] = ("width", "height"), threshold: float = 0.0, small_page: int = SMALL_PAGE
) -> DataFrame:
    """(page, group, n_boxes, quad): groups of overlapping boxes scored `least` or more; a box alone keeps its polygon.

    The group's number is its smallest box. Pages of small_page boxes at most are
    settled as a row each; larger ones by overlaps, on grids if copies leave them
    many polygons, rounds over all tasks and rows of groups. Both ways give the same rows.
    """
    kept = boxes if score is None else boxes.filter(F.col(score) >= least)
    if not small_page:
        return _merge_spread(kept, page, box, polygon, size, threshold)
    large = kept.groupBy(page).agg(F.count("*").alias("n")).filter(F.col("n") > small_page).select(page)
    if not large.head(1):
        return _merge_local(kept, page, box, polygon, size, threshold)
    local = _merge_local(kept.join(large, page, "left_anti"), page, box, polygon, size, threshold)
    return local.unionByName(_merge_spread(kept.join(large, page, "left_semi"), page, box, polygon, size, threshold))


def quad_column(x: Column, y: Column, w: Column, h: Column) -> Column:
    """An axis-aligned quadrilateral as a polygon."""
    return F.array(point(x, y), point(x + w, y), point(x + w, y + h), point(x, y + h))
