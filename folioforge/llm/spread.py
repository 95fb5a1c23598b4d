"""Training rows of boosted trees that lie on the executors: whole tables are fitted, and only sums come to the driver.

Each level of each tree is a pass over the rows' bins. Scores are written with
the bins every few rounds; in between a pass works them out from the trees since.
Results equal those of `boosting.HeldRows`, as sums are exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.boosting import add_trees, level_sums, model_bins, model_cuts, rounded, score_counts
from folioforge.llm.common import discard, map_rows, stage

#: Rounds after which scores are written anew.
ROUNDS = 10
#: Rows for each file of bins, and tasks of a pass at most; the latter bounds the sums that are on their way.
ROWS, TASKS = 65_536, 256


def _matrix(column: pa.Array, kind, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width)


def _blobs(rows: np.ndarray) -> list[bytes]:
    data, n = rows.tobytes(), rows.shape[1] * rows.itemsize
    return [data[i : i + n] for i in range(0, len(data), n)]


class SpreadRows:
    """Training rows in a table (x, y, fold): features as the bytes of doubles, a label, a fold from 0 on below `folds`."""

    def __init__(self, df: DataFrame, features: int, folds: int):
        self.df, self.features = df, features
        got = {r.fold: (r.n, r.positive) for r in df.groupBy("fold").agg(F.count("*").alias("n"), F.sum(F.col("y").cast("long")).alias("positive")).collect()}
        parts = np.array([got.get(f, (0, 0)) for f in range(folds)])
        self.counts = np.r_[parts.sum(axis=0)[None], parts]

    def cuts(self) -> list[list[np.ndarray]]:
        width, folds = self.features, len(self.counts) - 1

        def run(batches):
            for batch in batches:
                x, fold = _matrix(batch.column(0), float, width), batch.column(1).to_numpy()
                for f in np.unique(fold):
                    for j in range(width):
                        values, counts = np.unique(rounded(x[fold == f, j]), return_counts=True)
                        yield {"feature": np.full(len(values), j, np.int32), "fold": np.full(len(values), f, np.int32), "value": values, "n": counts}

        counted = map_rows(self.df.select("x", "fold"), run, "feature int, fold int, value double, n long")
        got = counted.groupBy("feature", "fold", "value").agg(F.sum("n").alias("n")).toPandas()
        columns = []
        for j in range(width):
            own = got[got["feature"] == j]
            values, place = np.unique(own["value"].to_numpy(), return_inverse=True)
            counts = np.zeros((len(values), folds), int)
            counts[place, own["fold"].to_numpy()] = own["n"].to_numpy()
            columns.append((values, counts))
        return model_cuts(columns)

    def start(self, cuts: list[list[np.ndarray]], bias: np.ndarray) -> None:
        width = self.features

        def run(batches):
            for batch in batches:
                b = model_bins(_matrix(batch.column(0), float, width), cuts)
                yield {"y": batch.column(1), "fold": batch.column(2), "b": _blobs(b.reshape(len(b), -1)), "z": _blobs(np.tile(bias, (len(b), 1)))}

        self.since, self.models, self.staged = [], len(bias), None
        files = max(1, -(-int(self.counts[0][0]) // ROWS))
        self._keep(map_rows(self.df.select("x", "y", "fold").coalesce(files), run, "y boolean, fold int, b binary, z binary"))

    def _keep(self, rows: DataFrame) -> None:
        old, self.staged, self.since = self.staged, stage(rows, "boosting-rows"), []
        discard(old)

    def _each(self, rows, schema: str) -> DataFrame:
        """What rows(batches of (y, fold, b, z)) yields, scores being those after all trees so far."""
        since, width, models = self.since, self.features, self.models

        def read(batches):
            for batch in batches:
                b, z = _matrix(batch.column(2), np.uint8, models * width).reshape(-1, models, width), _matrix(batch.column(3), float, models).copy()
                add_trees(z, b, since)
                yield batch.column(0).to_numpy(zero_copy_only=False).astype(float), batch.column(1).to_numpy(), b, z

        return map_rows(self.staged.coalesce(TASKS), lambda batches: rows(read(batches)), schema)

    def sums(self, *level) -> np.ndarray:
        def run(batches):
            parts = [0]
            for y, fold, b, z in batches:
                parts[0] = parts[0] + level_sums(b, y, fold, z, *level)
            if isinstance(parts[0], np.ndarray):
                yield {"shape": [list(parts[0].shape)], "sums": [parts[0].tobytes()]}

        return sum(np.frombuffer(r.sums, np.int64).reshape(r.shape) for r in self._each(run, "shape array<int>, sums binary").collect())

    def add(self, tree: tuple[np.ndarray, np.ndarray, np.ndarray]) -> None:
        self.since = [*self.since, tree]
        if len(self.since) == ROUNDS:

            def run(batches):
                for y, fold, b, z in batches:
                    yield {"y": y.astype(bool), "fold": fold, "b": _blobs(b.reshape(len(b), -1)), "z": _blobs(z)}

            self._keep(self._each(run, "y boolean, fold int, b binary, z binary"))

    def score_counts(self, steps: int) -> np.ndarray:
        def run(batches):
            for y, fold, _, z in batches:
                counts = score_counts(z, y, fold, steps)
                at = np.flatnonzero(counts[:, 0])
                yield {"step": at, "n": counts[at, 0], "positive": counts[at, 1]}

        out = np.zeros((steps + 1, 2), int)
        summed = self._each(run, "step long, n long, positive long").groupBy("step").agg(F.sum("n").alias("n"), F.sum("positive").alias("positive"))
        for r in summed.collect():
            out[r.step] = r.n, r.positive
        return out

    def close(self) -> None:
        discard(self.staged)
