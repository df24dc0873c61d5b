"""Linear support vector machine with an L1 penalty and squared hinge loss.

Minimises sum |w| + c * sum max(0, 1 - y w.x)^2, the intercept being the
weight of a constant feature and penalised with the others. Spark's own
linear SVM has no L1 penalty.

The method is proximal Newton without a curvature matrix. A pass over the rows
sums the gradient; the quadratic model is minimised by accelerated proximal
steps whose products of curvature and direction are one pass each; a last pass
compares step lengths. All that moves is vectors as long as the features.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weakspot.models.boosting import width_of
from weakspot.session import written_once

STEPS = 0.5 ** np.arange(12)
INNER = 60  # proximal steps on one quadratic model at most
PART_CELLS = 1 << 23


@dataclass
class SparseSvmModel:
    coefficients: np.ndarray
    intercept: float
    features: str = "features"
    steps: int = 0
    gap: float = 0.0  # largest violation of the optimality conditions

    @property
    def converged(self) -> bool:
        return self.gap <= 1e-4

    def transform(self, df: DataFrame) -> DataFrame:
        """``margin`` and ``prediction``."""
        weights = F.array(*[F.lit(float(w)) for w in self.coefficients])
        x = vector_to_array(self.features) if df.schema[self.features].dataType.typeName() != "array" else F.col(self.features)
        margin = F.aggregate(F.zip_with(x, weights, lambda a, w: a * w), F.lit(float(self.intercept)), lambda s, v: s + v)
        return df.withColumn("margin", margin).withColumn("prediction", (F.col("margin") > 0).cast("double"))


def _shrunk(x: np.ndarray, by: float) -> np.ndarray:
    return np.sign(x) * np.maximum(np.abs(x) - by, 0.0)


def violation(w: np.ndarray, grad: np.ndarray) -> float:
    """How far a point is from a minimum of smooth loss plus sum |w|."""
    return float(np.where(w == 0, np.maximum(np.abs(grad) - 1.0, 0.0), np.abs(grad + np.sign(w))).max())


@dataclass
class SparseSvm:
    c: float = 0.01
    features: str = "features"
    label: str = "label"
    max_steps: int = 50
    tolerance: float = 1e-6

    def fit(self, df: DataFrame) -> SparseSvmModel:
        c = self.c
        kind = df.schema[self.features].dataType.typeName()
        x = vector_to_array(self.features) if kind != "array" else F.col(self.features).cast("array<double>")
        rows = df.select(x.alias("x"), F.col(self.label).cast("double").alias("y")).filter("y IS NOT NULL")
        size = width_of(df, self.features) + 1
        blocks = written_once(rows.mapInArrow(_pack(size), "n int, x binary, y binary"), "rows")
        parts = max(1, -(-(blocks.agg(F.sum("n")).first()[0] or 0) * size // PART_CELLS))
        held = blocks.rdd.map(lambda r: (np.frombuffer(r["x"]).reshape(r["n"], size), np.frombuffer(r["y"]))).coalesce(parts).persist(
            StorageLevel.MEMORY_AND_DISK)

        def total(one) -> np.ndarray:
            """The sum over blocks of ``one(x, y)``."""
            def run(part: Iterator) -> Iterator[np.ndarray]:
                out = None
                for x, y in part:
                    out = one(x, y) if out is None else out + one(x, y)
                if out is not None:
                    yield out

            return held.mapPartitions(run).treeReduce(np.add)

        def slope(at: np.ndarray) -> np.ndarray:
            return total(lambda x, y: -2.0 * c * ((y * np.maximum(1.0 - y * (x @ at), 0.0)) @ x))

        def curved(at: np.ndarray, v: np.ndarray) -> np.ndarray:
            return total(lambda x, y: 2.0 * c * (((1.0 - y * (x @ at) > 0) * (x @ v)) @ x))

        def losses(points: np.ndarray) -> np.ndarray:
            return total(lambda x, y: c * (np.maximum(1.0 - y[:, None] * (x @ points.T), 0.0) ** 2).sum(axis=0))

        w, gap, steps = np.zeros(size), 0.0, 0
        try:
            if held.isEmpty():
                return SparseSvmModel(w[:-1], 0.0, self.features)
            # largest curvature, by a few products with a direction
            v, top = np.ones(size) / np.sqrt(size), 1e-12
            for _ in range(8):
                v = curved(w, v)
                top = float(np.linalg.norm(v))
                if top == 0:
                    break
                v /= top
            for steps in range(1, self.max_steps + 1):
                grad = slope(w)
                gap = violation(w, grad)
                if gap <= self.tolerance:
                    break
                step = self._model_step(w, grad, lambda v, at=w: curved(at, v), 1.5 * top + 1e-12, gap)
                if not np.abs(step).max() > 0:
                    break
                points = np.array([w + t * step for t in (0.0, *STEPS)])
                goal = losses(points) + np.abs(points).sum(axis=1)
                best = int(goal[1:].argmin())
                if goal[1 + best] >= goal[0]:
                    break
                w = points[1 + best]
        finally:
            held.unpersist()
        return SparseSvmModel(w[:-1], float(w[-1]), self.features, steps, gap)

    @staticmethod
    def _model_step(w: np.ndarray, grad: np.ndarray, product, bound: float, gap: float) -> np.ndarray:
        """Accelerated proximal steps on the quadratic model plus sum |w|,
        until ten times nearer to its minimum than the point is to the whole's."""
        s, ahead, t = np.zeros_like(w), np.zeros_like(w), 1.0
        for _ in range(INNER):
            down = grad + product(ahead)
            new = _shrunk(w + ahead - down / bound, 1.0 / bound) - w
            grown = (1.0 + np.sqrt(1.0 + 4.0 * t * t)) / 2.0
            moved = np.abs(new - ahead).max() * bound
            if (ahead - new) @ (new - s) > 0:  # overshot: start the momentum anew
                grown, t = 1.0, 1.0
            ahead, s, t = new + (t - 1.0) / grown * (new - s), new, grown
            if moved <= 0.1 * gap:
                break
        return s


def _pack(size: int):
    most = max(1, (1 << 19) // size)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, most):
                part = batch.slice(start, most)
                n = part.num_rows
                x = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, size - 1)
                y = np.where(part.column("y").to_numpy() == 1, 1.0, -1.0)
                yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int32()),
                                                  "x": [np.hstack([x, np.ones((n, 1))]).tobytes()], "y": [y.tobytes()]})

    return pack
