"""Histogram gradient boosting in numpy.

Boosted trees need nothing of the rows but sums by node, feature and bin, taken
level by level: from arrays here, from a table on the executors in `spread`. The
additive model's training tables are bounded samples on the driver. Scoring is
vectorised and runs wherever rows are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Bins of a feature, at most.
BINS = 32
#: Gradients are rounded to this part of one and summed as whole numbers, so that trees are the same however rows are dealt out and ordered.
#: A batch's sums are doubles, exact up to 2**29 rows; those of all rows have 63 bits, enough for 2**39.
UNITS = 2.0**24


def quantile_bins(column: np.ndarray, most: int) -> np.ndarray:
    """Ascending cut points; value v is in bin searchsorted(cuts, v, 'right')."""
    return np.unique(np.quantile(column, np.linspace(0, 1, most + 1)[1:-1])) if len(column) else np.zeros(0)


def binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(cuts)], axis=1) if len(cuts) else np.zeros((len(x), 0), int)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def log_odds(y: np.ndarray) -> float:
    p = (y.sum() + 1) / (len(y) + 2)
    return float(np.log(p / (1 - p)))


def rounded(column: np.ndarray) -> np.ndarray:
    """Values to sixteen significant bits, so that there is a bounded number of them."""
    return (column.astype(np.float32).view(np.int32) & np.int32(-256)).view(np.float32).astype(float)


def counted_bins(values: np.ndarray, counts: np.ndarray, most: int = BINS) -> np.ndarray:
    """quantile_bins, given the distinct values in order and how many rows have each."""
    ends = counts.cumsum()
    if not len(values) or not ends[-1]:
        return np.zeros(0)
    at = np.linspace(0, 1, most + 1)[1:-1] * (ends[-1] - 1)
    low, high = (values[np.searchsorted(ends, rank(at), side="right")] for rank in (np.floor, np.ceil))
    return np.unique(low + (high - low) * (at % 1))


def model_cuts(columns: list[tuple[np.ndarray, np.ndarray]]) -> list[list[np.ndarray]]:
    """Cut points of each model and feature, given each feature's distinct values and their counts by fold."""
    folds = columns[0][1].shape[1]
    return [[counted_bins(v, n.sum(axis=1) - (n[:, m - 1] if m else 0)) for v, n in columns] for m in range(folds + 1)]


def model_bins(x: np.ndarray, cuts: list[list[np.ndarray]]) -> np.ndarray:
    """Bins by row, model and feature."""
    return np.stack([binned(x, c) for c in cuts], axis=1).astype(np.uint8)


def tree_nodes(b: np.ndarray, features: np.ndarray, places: np.ndarray, levels: int) -> np.ndarray:
    """The nodes that rows of bins reach some levels down; a row goes right if its bin is the node's place or above."""
    node, rows = np.zeros(len(b), int), np.arange(len(b))
    for d in range(levels):
        at = 2**d - 1 + node
        node = 2 * node + (b[rows, features[at]] >= places[at])
    return node


def add_trees(z: np.ndarray, b: np.ndarray, trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
    """Adds to the scores, a column for each model, what trees (features, places, leaves; by model) give."""
    for features, places, leaves in trees:
        levels = leaves.shape[1].bit_length() - 1
        for m in range(z.shape[1]):
            z[:, m] += leaves[m][tree_nodes(b[:, m], features[m], places[m], levels)]


def level_sums(b: np.ndarray, y: np.ndarray, fold: np.ndarray, z: np.ndarray, features: np.ndarray, places: np.ndarray, level: int, seen: np.ndarray, width: int) -> np.ndarray:
    """Gradients and curvatures in UNITS by model, node of the level, feature of `seen` and bin; model m has no rows of fold m - 1."""
    n = 2**level
    out = np.zeros((z.shape[1], n, len(seen), width, 2), np.int64)
    for m in range(z.shape[1]):
        p, own = sigmoid(z[:, m]), fold != m - 1
        g, h = np.rint((y - p) * own * UNITS), np.rint(p * (1 - p) * own * UNITS)
        node = tree_nodes(b[:, m], features[m], places[m], level) * width
        for i, j in enumerate(seen):
            at = node + b[:, m, j]
            out[m, :, i, :, 0] = np.bincount(at, g, n * width).reshape(n, width)
            out[m, :, i, :, 1] = np.bincount(at, h, n * width).reshape(n, width)
    return out


class HeldRows:
    """Training rows in arrays: features, labels, folds from 0 on; counts are rows and positive ones, of all and of each fold."""

    def __init__(self, x: np.ndarray, y: np.ndarray, fold: np.ndarray | None = None):
        self.x, self.y, self.folds = x, y.astype(float), 0 if fold is None else int(fold.max(initial=-1)) + 1
        self.fold = np.zeros(len(y), int) if fold is None else fold
        parts = [self.y[self.fold == f] for f in range(self.folds)]
        self.counts = np.array([(len(part), int(part.sum())) for part in (self.y, *parts)])

    def cuts(self) -> list[list[np.ndarray]]:
        columns = []
        for j in range(self.x.shape[1]):
            values, place = np.unique(rounded(self.x[:, j]), return_inverse=True)
            counts = np.zeros((len(values), max(1, self.folds)), int)
            np.add.at(counts, (place, self.fold), 1)
            columns.append((values, counts))
        return model_cuts(columns)[: self.folds + 1]

    def start(self, cuts: list[list[np.ndarray]], bias: np.ndarray) -> None:
        self.b, self.z = model_bins(self.x, cuts), np.tile(bias, (len(self.y), 1))

    def sums(self, *level) -> np.ndarray:
        return level_sums(self.b, self.y, self.fold, self.z, *level)

    def add(self, tree: tuple[np.ndarray, np.ndarray, np.ndarray]) -> None:
        add_trees(self.z, self.b, [tree])

    def score_counts(self, steps: int) -> np.ndarray:
        return score_counts(self.z, self.y, self.fold, steps)


def score_counts(z: np.ndarray, y: np.ndarray, fold: np.ndarray, steps: int) -> np.ndarray:
    """How many rows and how many positive ones have each score, rounded down to steps, by the model without the row's fold."""
    at = (sigmoid(z[np.arange(len(z)), fold + 1]) * steps).astype(int)
    return np.stack([np.bincount(at, minlength=steps + 1), np.bincount(at, y, steps + 1).astype(int)], axis=1)


def best_splits(sums: np.ndarray, cuts: list[list[np.ndarray]], seen: np.ndarray, ridge: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, place, sums to its left and right) by model and node, given level_sums; nodes that gain nothing send all to the left."""
    models, nodes, _, width, _ = sums.shape
    left = sums.cumsum(axis=3)[:, :, :, :-1]
    all_ = sums[:, :, :1].sum(axis=3, keepdims=True)
    score = lambda s: s[..., 0] ** 2 / (s[..., 1] + ridge)
    gain = score(left) + score(all_ - left) - score(all_)
    known = np.array([[len(c[j]) for j in seen] for c in cuts])
    gain = np.where(np.arange(width - 1) < known[:, None, :, None], gain, -1)
    gain = gain.reshape(models, nodes, -1)
    at = gain.argmax(axis=2)
    ok = np.take_along_axis(gain, at[..., None], 2)[..., 0] > 1e-9
    sides = np.take_along_axis(left.reshape(models, nodes, -1, 2), at[..., None, None], 2)[:, :, 0]
    all_ = all_[:, :, 0, 0]
    sides = np.where(ok[..., None], sides, all_)
    feature, place = np.where(ok, seen[at // (width - 1)], 0), np.where(ok, at % (width - 1) + 1, width)
    return feature, place, np.stack([sides, all_ - sides], axis=2)


def grow(rows, rounds: int = 60, depth: int = 3, rate: float = 0.2, ridge: float = 1.0, columns: float = 0.5) -> list[BoostedTrees]:
    """Trees on all rows, then those without the rows of each fold; rows are HeldRows or a class like it.

    Each round's trees see a seeded choice of that share of the columns, so that equally good ones all have a say.
    """
    draw, cuts = np.random.default_rng(0), rows.cuts()
    n, positive = np.r_[rows.counts[:1], rows.counts[0] - rows.counts[1:]].T
    bias = np.log((positive + 1) / (n - positive + 1))
    models, width = len(n), BINS
    rows.start(cuts, bias)
    trees = [[] for _ in n]
    for _ in range(rounds if n[0] else 0):
        seen = draw.permutation(len(cuts[0]))[: max(1, round(columns * len(cuts[0])))]
        features, places = np.zeros((models, 2**depth - 1), int), np.full((models, 2**depth - 1), width)
        for d in range(depth):
            at = slice(2**d - 1, 2 ** (d + 1) - 1)
            features[:, at], places[:, at], sides = best_splits(rows.sums(features, places, d, seen, width) / UNITS, cuts, seen, ridge)
        leaves = rate * (sides[..., 0] / (sides[..., 1] + ridge)).reshape(models, -1)
        rows.add((features, places, leaves))
        for m in range(models):
            values = [cuts[m][j][k - 1] if k < width else np.inf for j, k in zip(features[m], places[m])]
            trees[m].append((features[m], np.array(values), leaves[m]))
    return [BoostedTrees(depth, float(b), t) for b, t in zip(bias, trees)]


@dataclass
class BoostedTrees:
    """Boosted trees of fixed depth on the logistic loss; each tree is (features, cuts, leaves) of a full tree."""

    depth: int
    bias: float
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]]

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, **how) -> BoostedTrees:
        return grow(HeldRows(x, y), **how)[0]

    def predict(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for features, values, leaves in self.trees:
            node = np.zeros(len(x), int)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, features[node]] >= values[node])
            z += leaves[node - (2**self.depth - 1)]
        return sigmoid(z)


@dataclass
class AdditiveModel:
    """A generalised additive model with pairwise interactions.

    Each feature has a table of one number per bin, each chosen pair a table of
    one number per pair of coarse bins. They grow in turn: every round visits
    each table with a shallow tree on the residual.
    """

    bias: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_cuts: list[np.ndarray]
    pair_tables: list[np.ndarray]

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, rounds: int = 150, rate: float = 0.1, bins: int = 32, coarse: int = 6, pairs: int = 6, ridge: float = 2.0, least: int = 5) -> AdditiveModel:
        n, f = x.shape
        cuts = [quantile_bins(x[:, j], bins) for j in range(f)]
        b = binned(x, cuts)
        tables = [np.zeros(len(c) + 1) for c in cuts]
        bias = log_odds(y)
        z = np.full(n, bias)
        model = cls(bias, cuts, tables, [], [quantile_bins(x[:, j], coarse) for j in range(f)], [])
        if not n:
            return model
        for _ in range(rounds):
            for j in range(f):
                step = rate * _stump_steps(b[:, j], y - sigmoid(z), sigmoid(z), len(tables[j]), ridge, least)
                tables[j] += step
                z += step[b[:, j]]
        c = binned(x, model.pair_cuts)
        width = [len(k) + 1 for k in model.pair_cuts]
        p = sigmoid(z)
        gains = []
        for i in range(f):
            for j in range(i):
                at, size = c[:, i] * width[j] + c[:, j], width[i] * width[j]
                gs, hs = np.bincount(at, y - p, size), np.bincount(at, p * (1 - p), size)
                gains.append(((gs**2 / (hs + ridge)).sum(), i, j))
        model.pairs = [(i, j) for _, i, j in sorted(gains, reverse=True)[:pairs]]
        model.pair_tables = [np.zeros((width[i], width[j])) for i, j in model.pairs]
        for _ in range(rounds // 3):
            for (i, j), t in zip(model.pairs, model.pair_tables):
                p = sigmoid(z)
                step = rate * _quadrant_steps(c[:, i], c[:, j], y - p, p * (1 - p), t.shape, ridge)
                t += step
                z += step[c[:, i], c[:, j]]
        return model

    def predict(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.bias)
        b = binned(x, self.cuts)
        for j, t in enumerate(self.tables):
            z += t[b[:, j]]
        if self.pairs:
            c = binned(x, self.pair_cuts)
            for (i, j), t in zip(self.pairs, self.pair_tables):
                z += t[c[:, i], c[:, j]]
        return sigmoid(z)


def _stump_steps(b: np.ndarray, g: np.ndarray, p: np.ndarray, width: int, ridge: float, least: int) -> np.ndarray:
    """A tree of up to three leaves over the bins: the best cut, then the best cut of either side."""
    gs, hs, ns = np.bincount(b, g, width), np.bincount(b, p * (1 - p), width), np.bincount(b, minlength=width)
    spans = [(0, width)]
    for _ in range(2):
        options = []
        for s, (lo, hi) in enumerate(spans):
            if hi - lo > 1:
                gl, hl, nl = gs[lo:hi].cumsum(), hs[lo:hi].cumsum(), ns[lo:hi].cumsum()
                gain = gl[:-1] ** 2 / (hl[:-1] + ridge) + (gl[-1] - gl[:-1]) ** 2 / (hl[-1] - hl[:-1] + ridge) - gl[-1] ** 2 / (hl[-1] + ridge)
                gain[(nl[:-1] < least) | (nl[-1] - nl[:-1] < least)] = -1
                k = int(gain.argmax())
                options.append((gain[k], s, lo + k + 1))
        if not options or max(options)[0] <= 0:
            break
        _, s, cut = max(options)
        lo, hi = spans.pop(s)
        spans += [(lo, cut), (cut, hi)]
    step = np.zeros(width)
    for lo, hi in spans:
        step[lo:hi] = gs[lo:hi].sum() / (hs[lo:hi].sum() + ridge)
    return step


def _quadrant_steps(a: np.ndarray, b: np.ndarray, g: np.ndarray, h: np.ndarray, shape: tuple[int, int], ridge: float) -> np.ndarray:
    """The best tree that cuts one feature of a pair and then each side by the other at one place."""
    at = a * shape[1] + b
    gs = np.bincount(at, g, shape[0] * shape[1]).reshape(shape).cumsum(0).cumsum(1)
    hs = np.bincount(at, h, shape[0] * shape[1]).reshape(shape).cumsum(0).cumsum(1)
    step = np.zeros(shape)
    if min(shape) < 2:
        return step

    def quads(s):
        tl, top, left, all_ = s[:-1, :-1], s[:-1, -1:], s[-1:, :-1], s[-1, -1]
        return np.stack([tl, top - tl, left - tl, all_ - top - left + tl])

    q, r = quads(gs), quads(hs)
    gain = (q**2 / (r + ridge)).sum(0)
    i, j = np.unravel_index(gain.argmax(), gain.shape)
    v = q[:, i, j] / (r[:, i, j] + ridge)
    step[: i + 1, : j + 1], step[: i + 1, j + 1 :], step[i + 1 :, : j + 1], step[i + 1 :, j + 1 :] = v
    return step
