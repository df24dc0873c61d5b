"""This package's classifiers as pipeline stages that can be saved and loaded.

``Classifier`` is an estimator of one kind with its settings; ``Fitted`` holds
what it learned. Both write Spark ML's metadata; a fitted stage adds one
Parquet table: coefficients, stumps or tree nodes.
"""

from __future__ import annotations

import dataclasses
import json
import math

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession

from weakspot.models.adaboost import AdaBoostModel, AdaBoostStumps, Stump
from weakspot.models.boosting import BoostedModel, Growth, HistogramBoosting, Tree
from weakspot.models.extra_trees import ExtraTrees, ExtraTreesModel
from weakspot.models.svm import SparseSvm, SparseSvmModel

_NODES = "tree int, node long, feature int, cut int, edge double, gain double, sums array<long>, value double"


def _nodes(spark: SparkSession, trees: list[Tree]) -> DataFrame:
    rows = []
    for t, tree in enumerate(trees):
        for i in sorted(tree.sums):
            rows.append((t, i, *tree.splits.get(i, (None,) * 4), [int(s) for s in tree.sums[i]], tree.values.get(i)))
    return spark.createDataFrame(rows, _NODES)


def _trees(table: DataFrame, count: int) -> list[Tree]:
    trees = [Tree() for _ in range(count)]
    for r in table.collect():  # the model itself
        tree = trees[r["tree"]]
        tree.sums[r["node"]] = tuple(r["sums"])
        if r["feature"] is not None:
            tree.splits[r["node"]] = (r["feature"], r["cut"], r["edge"], r["gain"])
        else:
            tree.values[r["node"]] = r["value"]
    return trees


def _table_of(spark: SparkSession, model) -> tuple[str, dict, DataFrame]:
    """(kind, plain values, table) of a fitted model."""
    if isinstance(model, SparseSvmModel):
        rows = [(i, float(w)) for i, w in enumerate(model.coefficients)]
        return "svm", {"intercept": float(model.intercept)}, spark.createDataFrame(rows, "pos int, weight double")
    if isinstance(model, AdaBoostModel):
        rows = [(i, *dataclasses.astuple(s)) for i, s in enumerate(model.stumps)]
        return "ada_boost", {"size": model.size}, spark.createDataFrame(
            rows, "pos int, feature int, threshold double, below int, above int, weight double")
    if isinstance(model, BoostedModel):
        return "boosting", {"size": model.size, "start": model.start, "kind": model.kind, "trees": len(model.trees)}, _nodes(spark, model.trees)
    if isinstance(model, ExtraTreesModel):
        return "extra_trees", {"size": model.size, "trees": len(model.trees)}, _nodes(spark, model.trees)
    raise TypeError(f"no table for {type(model).__name__}")


def _from_table(kind: str, plain: dict, table: DataFrame, features: str):
    if kind == "svm":
        weights = [r["weight"] for r in table.orderBy("pos").collect()]
        return SparseSvmModel(weights, plain["intercept"], features)
    if kind == "ada_boost":
        stumps = [Stump(*list(r)[1:]) for r in table.orderBy("pos").collect()]
        return AdaBoostModel(stumps, plain["size"], features)
    trees = _trees(table, plain["trees"])
    if kind == "boosting":
        return BoostedModel(trees, plain["start"], plain["size"], features, plain["kind"])
    return ExtraTreesModel(trees, plain["size"], features)


class Classifier(Estimator, HasFeaturesCol, HasLabelCol, MLWritable, MLReadable):
    """``kind``: svm, ada_boost, boosting or extra_trees; ``settings`` are the
    keyword arguments of its class (of ``Growth`` for boosting)."""

    kind = Param(Params._dummy(), "kind", "family", TypeConverters.toString)
    settings = Param(Params._dummy(), "settings", "keyword arguments as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, kind: str = "svm", settings: str = "{}", featuresCol: str = "features", labelCol: str = "label"):
        super().__init__()
        self._setDefault(kind="svm", settings="{}")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> Fitted:
        more = json.loads(self.getOrDefault("settings"))
        columns = {"features": self.getFeaturesCol(), "label": self.getLabelCol()}
        kind = self.getOrDefault("kind")
        if kind == "boosting":
            made = HistogramBoosting(Growth(**more), **columns)
        else:
            made = {"svm": SparseSvm, "ada_boost": AdaBoostStumps, "extra_trees": ExtraTrees}[kind](**more, **columns)
        return Fitted(made.fit(dataset), featuresCol=self.getFeaturesCol(), labelCol=self.getLabelCol())

    def write(self) -> MLWriter:
        return DefaultParamsWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return DefaultParamsReader(cls)


class Fitted(Model, HasFeaturesCol, HasLabelCol, MLWritable, MLReadable):
    """A fitted model of this package as a pipeline stage."""

    def __init__(self, model=None, featuresCol: str = "features", labelCol: str = "label"):
        super().__init__()
        self.model = model
        self._set(featuresCol=featuresCol, labelCol=labelCol)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.model.transform(dataset)

    def write(self) -> MLWriter:
        return _FittedWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _FittedReader(cls)


class _FittedWriter(MLWriter):
    def __init__(self, instance: Fitted):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        kind, plain, table = _table_of(self.sparkSession, self.instance.model)
        if any(isinstance(v, float) and not math.isfinite(v) for v in plain.values()):
            raise ValueError("the model holds numbers that are not finite")
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession, extraMetadata={"family": kind, "plain": plain})
        table.write.parquet(f"{path}/data")


class _FittedReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> Fitted:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        table = self.sparkSession.read.parquet(f"{path}/data")
        out = self.cls()
        out._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(out, metadata)
        out.model = _from_table(metadata["family"], metadata["plain"], table, out.getFeaturesCol())
        return out
