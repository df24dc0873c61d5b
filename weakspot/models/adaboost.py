"""Adaptive boosting of one-split trees (SAMME)."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Stump:
    feature: int
    threshold: float
    below: int
    above: int
    weight: float

    def vote(self, values: Column) -> Column:
        """Predicted class of a feature array."""
        return F.when(F.get(values, F.lit(self.feature)) <= self.threshold, self.below).otherwise(self.above)


@dataclass
class AdaBoostModel:
    stumps: list[Stump]
    size: int
    features: str

    @property
    def featureImportances(self) -> np.ndarray:
        """Share of the total stump weight on each feature."""
        total = np.zeros(self.size)
        for s in self.stumps:
            total[s.feature] += s.weight
        return total / total.sum() if total.sum() > 0 else total

    def transform(self, df: DataFrame) -> DataFrame:
        x = vector_to_array(self.features)
        margin = sum(((s.vote(x) * 2 - 1) * s.weight for s in self.stumps), F.lit(0.0))
        return df.withColumn("prediction", (margin > 0).cast("double"))


@dataclass
class AdaBoostStumps:
    rounds: int = 50
    features: str = "features"
    label: str = "label"

    def fit(self, df: DataFrame) -> AdaBoostModel:
        """Row weights are one expression over the stumps so far, so the
        plan of a round does not stack on the rounds before it."""
        x = vector_to_array(self.features)
        rows = df.select(self.features, F.col(self.label).cast("int").alias("label")).persist(
            StorageLevel.MEMORY_AND_DISK)
        stumps: list[Stump] = []
        size = 0
        for _ in range(self.rounds):
            wrong = sum(((s.vote(x) != F.col("label")).cast("double") * s.weight for s in stumps), F.lit(0.0))
            tree = DecisionTreeClassifier(featuresCol=self.features, labelCol="label", weightCol="__w", maxDepth=1,
                                          minWeightFractionPerNode=0.0).fit(rows.withColumn("__w", F.exp(wrong)))
            size = tree.numFeatures
            root = tree._java_obj.rootNode()
            if tree.numNodes < 3:
                break
            left, right = root.leftChild(), root.rightChild()
            below, above = int(left.prediction()), int(right.prediction())
            held = [list(node.impurityStats().stats()) for node in (left, right)]
            right_weight = held[0][below] + held[1][above]
            error = 1.0 - right_weight / (sum(held[0]) + sum(held[1]))
            if error >= 0.5:
                break
            weight = 1.0 if error <= 0 else math.log((1 - error) / error)
            stumps.append(Stump(root.split().featureIndex(), root.split().threshold(), below, above, weight))
            if error <= 0:
                break
        rows.unpersist()
        return AdaBoostModel(stumps, size, self.features)
