"""Overlaps, groups and merged quadrilaterals of whole Arrow batches, as array operations.

The rules are those of `boxes.overlap`, `boxes.groups_of` and `boxes.merged_quad`,
which state them one polygon at a time. Polygons with as many points each are
worked on together, so the number of numpy calls goes by the kinds of sizes and
not by pages.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Pairs of polygons, and points of groups, that are held as arrays at once.
AT_ONCE = 250_000


class Polygons(NamedTuple):
    """Points of many polygons one after another; polygon i has those from at[i] to at[i + 1]."""

    at: np.ndarray
    x: np.ndarray
    y: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.at)

    def sound(self) -> np.ndarray:
        """Whether a polygon has points, all of them finite."""
        bad = np.concatenate([[0], np.cumsum(~(np.isfinite(self.x) & np.isfinite(self.y)))])
        return (self.sizes > 0) & (bad[self.at[1:]] == bad[self.at[:-1]])

    def points(self, which: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Those of polygons of n points, a row each."""
        k = self.at[which][:, None] + np.arange(n)
        return self.x[k], self.y[k]


def polygons(column: pa.Array) -> Polygons:
    """From lists of points (x, y); nulls of any depth are no points or NaN."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    points, sizes = column.flatten(), column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    x, y = (c.cast(pa.float64()).to_numpy(zero_copy_only=False) for c in points.flatten())
    return Polygons(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), x, y)


def _parted(px: np.ndarray, py: np.ndarray, qx: np.ndarray, qy: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(whether an edge normal of p parts a pair by more than the threshold, whether there is such a normal)."""
    parted, any_ = np.zeros(len(px), bool), np.zeros(len(px), bool)
    for e in range(px.shape[1]):
        f = (e + 1) % px.shape[1]
        nx, ny = py[:, e] - py[:, f], px[:, f] - px[:, e]
        norm = np.sqrt(nx * nx + ny * ny)
        a, b = px * nx[:, None] + py * ny[:, None], qx * nx[:, None] + qy * ny[:, None]
        gap = np.minimum(a.max(1) - b.min(1), b.max(1) - a.min(1))
        parted |= (norm > 0) & (gap < -threshold * norm)
        any_ |= norm > 0
    return parted, any_


def overlapping(p: Polygons, i: np.ndarray, q: Polygons, j: np.ndarray, threshold: float = 0.0) -> np.ndarray:
    """Whether polygons i of p overlap polygons j of q, pair by pair, all of them sound; two without edges don't."""
    out = np.zeros(len(i), bool)
    kinds = p.sizes[i] * (int(q.sizes.max(initial=0)) + 1) + q.sizes[j]
    for kind in np.unique(kinds):
        own = np.flatnonzero(kinds == kind)
        n, m = p.sizes[i[own[0]]], q.sizes[j[own[0]]]
        step = max(1, AT_ONCE // int(n + m))
        for k in range(0, len(own), step):
            part = own[k : k + step]
            (px, py), (qx, qy) = p.points(i[part], n), q.points(j[part], m)
            (one, a), (other, b) = _parted(px, py, qx, qy, threshold), _parted(qx, qy, px, py, threshold)
            out[part] = ~one & ~other & (a | b)
    return out


def _spans(x: np.ndarray, y: np.ndarray, known: np.ndarray | None, nx: np.ndarray, ny: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest coordinate along an axis of polygons of a column each; NaN is larger than any other."""
    v = x * nx + y * ny
    if known is None:
        return np.fmin.reduce(v), v.max(0)
    return np.fmin.reduce(np.where(known, v, np.nan)), np.where(known, v, -np.inf).max(0)


def _known(points: pa.StructArray) -> np.ndarray | None:
    """Whether a point has both coordinates; None if all have."""
    x, y = points.flatten()
    known = x.is_valid().to_numpy(zero_copy_only=False) & y.is_valid().to_numpy(zero_copy_only=False)
    return None if known.all() else known


def gaps(a: pa.Array, b: pa.Array) -> pa.Array:
    """`geometry.overlap_gap`, pair by pair."""
    (p, pknown), (q, qknown) = ((polygons(c), _known(c.flatten())) for c in (a, b))
    out, some = np.full(len(a), np.nan), np.zeros(len(a), bool)
    kinds = p.sizes * (int(q.sizes.max(initial=0)) + 1) + q.sizes
    for kind in np.unique(kinds[(p.sizes > 0) & (q.sizes > 0)]):
        own = np.flatnonzero(kinds == kind)
        sizes = p.sizes[own[0]], q.sizes[own[0]]
        step = max(1, AT_ONCE // int(sum(sizes)))
        for k in range(0, len(own), step):
            part = own[k : k + step]
            # a point to a row: short columns would be reduced one pair at a time
            at = [of.at[part] + np.arange(n)[:, None] for of, n in zip((p, q), sizes)]
            pair = [(of.x[i], of.y[i], None if known is None else known[i]) for of, known, i in zip((p, q), (pknown, qknown), at)]
            with np.errstate(all="ignore"):
                for (x, y, known), n in zip(pair, sizes):
                    for e in range(n):
                        f = (e + 1) % n
                        ex, ey = x[f] - x[e], y[f] - y[e]
                        length = np.sqrt(ex * ex + ey * ey)
                        normal = length != 0 if known is None else (length != 0) & known[e] & known[f]
                        (low, high), (other_low, other_high) = (_spans(*one, -ey / length, ex / length) for one in pair)
                        gap = np.where(normal, np.fmin(high - other_low, other_high - low), np.nan)
                        out[part], some[part] = np.fmin(out[part], gap), some[part] | normal
            for _, _, known in pair:
                if known is not None:
                    some[part] &= known.any(0)
    return pa.array(out, mask=~some)


def inside(column: pa.Array, points: pa.StructArray) -> pa.Array:
    """`geometry.point_in_polygon`, pair by pair."""
    shapes, known, own_known = polygons(column), _known(column.flatten()), _known(points)
    x, y = (c.cast(pa.float64()).to_numpy(zero_copy_only=False) for c in points.flatten())
    out, open_ = np.zeros(len(column), bool), column.is_null().to_numpy(zero_copy_only=False).copy()
    for n in np.unique(shapes.sizes[shapes.sizes > 0]):
        own = np.flatnonzero(shapes.sizes == n)
        step = max(1, AT_ONCE // int(n))
        for k in range(0, len(own), step):
            part = own[k : k + step]
            at = shapes.at[part] + np.arange(n)[:, None]
            ax, ay = shapes.x[at], shapes.y[at]
            bx, by = np.roll(ax, -1, 0), np.roll(ay, -1, 0)
            with np.errstate(all="ignore"):
                turns = (bx - ax) * (y[part] - ay) - (by - ay) * (x[part] - ax)
                left, right = ~(turns < 0), turns <= 0  # NaN is larger than any other number, as in Spark
            if known is None and own_known is None:
                out[part] = left.all(0) | right.all(0)
                continue
            sure = np.ones(at.shape, bool)
            if known is not None:
                sure &= known[at] & np.roll(known[at], -1, 0)
            if own_known is not None:
                sure &= own_known[part]
            may = (left | ~sure).all(0) | (right | ~sure).all(0)
            out[part] = may & sure.all(0)
            open_[part] = may & ~sure.all(0)
    return pa.array(out, mask=open_)


def page_pairs(page: np.ndarray, shapes: Polygons, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of polygons of one page that overlap; those of a page stand together."""
    fit, n = shapes.sound(), len(page)
    some = np.flatnonzero(shapes.sizes)
    lo, hi = (np.zeros((2, n)) for _ in range(2))
    for k, c in enumerate((shapes.x, shapes.y)):
        if len(some):
            lo[k, some], hi[k, some] = np.minimum.reduceat(c, shapes.at[some]), np.maximum.reduceat(c, shapes.at[some])
    found_i, found_j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    near = np.arange(n - 1)
    for d in range(1, n):
        near = near[: np.searchsorted(near, n - d)]
        near = near[page[near] == page[near + d]]  # a page without a pair this far apart has none farther
        if not len(near):
            break
        i = near[fit[near] & fit[near + d]]
        if threshold <= 0:  # else how far polygons reach is left to their normals
            i = i[((lo[:, i] <= hi[:, i + d]) & (lo[:, i + d] <= hi[:, i])).all(0)]
        i = i[overlapping(shapes, i, shapes, i + d, threshold)]
        found_i.append(i)
        found_j.append(i + d)
    return np.concatenate(found_i), np.concatenate(found_j)


def labels(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest number that each of n nodes reaches by the links i-j."""
    low = np.arange(n)
    while len(open_ := np.flatnonzero(low[i] != low[j])):
        i, j = i[open_], j[open_]
        a, b = low[i], low[j]
        least = np.minimum(a, b)
        np.minimum.at(low, a, least)
        np.minimum.at(low, b, least)
        while (low[low] != low).any():
            low = low[low]
    return low


def _distance(dx: np.ndarray, dy: np.ndarray) -> np.ndarray:
    return np.sqrt(dx * dx + dy * dy)


def _meet(ax, ay, bx, by, cx, cy, dx, dy):
    """Where lines meet, and whether they do."""
    ux, uy, vx, vy = bx - ax, by - ay, dx - cx, dy - cy
    cross = ux * vy - uy * vx
    with np.errstate(divide="ignore", invalid="ignore"):
        t = ((cx - ax) * vy - (cy - ay) * vx) / cross
        return ax + t * ux, ay + t * uy, cross != 0


def merged_quads(x: np.ndarray, y: np.ndarray, w: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """`boxes.merged_quad` for rows of as many points each: x and y of the four corners."""
    k, m = x.shape
    rows, zero = np.arange(k), np.zeros(k)
    qx, qy, second, away = np.empty((k, 4)), np.empty((k, 4)), [], []
    for c, (cx, cy) in enumerate(((zero, zero), (w, zero), (w, h), (zero, h))):
        d = _distance(x - cx[:, None], y - cy[:, None])
        first = d.argmin(1)
        qx[:, c], qy[:, c] = x[rows, first], y[rows, first]
        d[rows, first] = np.inf
        second.append(d.argmin(1))
        away.append(d[rows, second[-1]])
    if m > 1:
        for i in range(4):
            j = (i + 1) % 4
            same = (qx[:, i] == qx[:, j]) & (qy[:, i] == qy[:, j])
            first = away[i] < away[j]
            for c, who in ((i, same & first), (j, same & ~first)):
                qx[who, c], qy[who, c] = x[who, second[c][who]], y[who, second[c][who]]
    far, edge = np.full((k, m), np.inf), np.zeros((k, m), np.int64)
    for i in range(4):
        j = (i + 1) % 4
        ex, ey = (qx[:, j] - qx[:, i])[:, None], (qy[:, j] - qy[:, i])[:, None]
        ox, oy = x - qx[:, i][:, None], y - qy[:, i][:, None]
        length = ex * ex + ey * ey
        t = np.divide(ox * ex + oy * ey, length, out=np.zeros((k, m)), where=length != 0)
        t = np.minimum(1.0, np.maximum(0.0, t))
        d = _distance(ox - t * ex, oy - t * ey)
        nearer = d < far
        far[nearer], edge[nearer] = d[nearer], i
    order = np.argsort(-far, axis=1, kind="stable")
    for s in range(m):
        at = order[:, s]
        px, py, i = x[rows, at], y[rows, at], edge[rows, at]
        nx, ny = np.roll(qx, -1, 1), np.roll(qy, -1, 1)
        turns = (nx - qx) * (py[:, None] - qy) - (ny - qy) * (px[:, None] - qx)
        out = np.flatnonzero(~((turns.min(1) >= 0) | (turns.max(1) <= 0)))
        if not len(out):
            continue
        px, py, i = px[out], py[out], i[out]
        j = (i + 1) % 4
        corner = lambda c: (qx[out, c], qy[out, c])  # noqa: E731, B023
        (ix, iy), (jx, jy) = corner(i), corner(j)
        first = _distance(ix - px, iy - py) < _distance(jx - px, jy - py)
        (ax, ay), (bx, by) = corner(np.where(first, i, j)), corner(np.where(first, (i + 3) % 4, (i + 2) % 4))
        mx, my, meets = _meet(ax, ay, bx, by, px, py, np.where(first, jx, ix), np.where(first, jy, iy))
        moved = out[meets]
        qx[moved, np.where(first, i, j)[meets]], qy[moved, np.where(first, i, j)[meets]] = mx[meets], my[meets]
    return qx, qy


def quads(groups: Polygons, w: np.ndarray, h: np.ndarray) -> pa.Array:
    """The quadrilateral around each group's points, as lists of points (x, y)."""
    x, y = np.empty((len(w), 4)), np.empty((len(w), 4))
    for n in np.unique(groups.sizes):
        own = np.flatnonzero(groups.sizes == n)
        step = max(1, AT_ONCE // int(n))
        for k in range(0, len(own), step):
            part = own[k : k + step]
            x[part], y[part] = merged_quads(*groups.points(part, n), w[part], h[part])
    points = pa.StructArray.from_arrays([pa.array(x.ravel()), pa.array(y.ravel())], ["x", "y"])
    return pa.ListArray.from_arrays(pa.array(np.arange(0, 4 * len(w) + 1, 4), pa.int32()), points)


def gathered(shapes: Polygons, order: np.ndarray, counts: np.ndarray) -> Polygons:
    """Points of the polygons in an order, counts of them at a time taken as one."""
    sizes = shapes.sizes[order]
    ends = np.cumsum(sizes)
    k = np.repeat(shapes.at[order] - (ends - sizes), sizes) + np.arange(int(sizes.sum()))
    ends = np.concatenate([[0], ends])
    return Polygons(ends[np.concatenate([[0], np.cumsum(counts)])], shapes.x[k], shapes.y[k])
