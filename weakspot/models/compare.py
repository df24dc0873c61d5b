"""Comparisons of balancing strategies and model families."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weakspot import constants as C
from weakspot.models.boosting import HistogramBoosting, second_order
from weakspot.models.estimators import EstimatorSpec
from weakspot.operators import balance as B
from weakspot.operators import metrics as M
from weakspot.session import ensure_checkpoints, written_once


def score(model, df: DataFrame, output: str = "prediction") -> DataFrame:
    """Predictions of a fitted model, nothing else added to the rows."""
    scored = model.transform(df)
    return scored.select(*df.columns, F.col("prediction").cast("int").alias(output))


def side_by_side(spark, run: Callable, tasks: list, parallelism: int) -> list:
    """Results of independent fits, each one a series of distributed jobs;
    together they fill the cluster where one alone would leave gaps."""
    with ThreadPool(parallelism) as pool:
        return pool.map(inheritable_thread_target(spark)(run), tasks)


def strategies(k: int = C.SMOTE_NEIGHBOURS, seed: int = C.SAMPLE_SEED) -> dict[str, Callable[[DataFrame], DataFrame] | None]:
    """Balancing of a table (row_id, embedding, label); None is by weight."""
    return {
        "weighted": None,
        "undersampled": lambda t: B.undersample(t, seed=seed),
        "oversampled": lambda t: B.oversample(t, seed=seed),
        "smote": lambda t: B.smote(t, k=k, seed=seed),
        "smote_tomek": lambda t: B.smote_tomek(t, k=k, seed=seed),
    }


def compare_balancing(train: DataFrame, test: DataFrame, rounds: int = 100, depth: int = 6, rate: float = 0.3,
                      chosen: dict | None = None, parallelism: int = 3) -> tuple[DataFrame, dict]:
    """Metrics on the test rows for each strategy, best F1 first, and the
    fitted models. Inputs are (row_id, embedding, label)."""
    held_out = test.select("embedding", "label")
    how = second_order(rounds, depth, rate)

    def fit(sampler: Callable[[DataFrame], DataFrame] | None):
        if sampler is None:
            sizes = B.class_sizes(train)
            ready = train.withColumn("weight", B.class_weight("label", sizes[0] / sizes[1]))
            return HistogramBoosting(how, "embedding", weight="weight").fit(ready)
        # the sample feeds many jobs of the fit
        ready = written_once(sampler(train).select("embedding", "label"), "balanced")
        return HistogramBoosting(how, "embedding").fit(ready)

    named = chosen or strategies()
    models = dict(zip(named, side_by_side(train.sparkSession, fit, list(named.values()), parallelism)))
    rows = [
        M.binary_metrics(score(model, held_out)).select(F.lit(name).alias("method"), "accuracy", "precision", "recall", "f1")
        for name, model in models.items()
    ]
    return M.ranked(reduce(DataFrame.unionByName, rows), "method"), models


def pick_model(results: DataFrame, models: dict, name: str = "method", force: str | None = None):
    """The model with the best F1, or the one asked for."""
    best = force or M.winner(results, name).first()[name]
    return best, models[best]


def compare_families(train: DataFrame, dev: DataFrame, specs: list[EstimatorSpec], label: str = "label",
                     parallelism: int = 4) -> tuple[DataFrame, dict]:
    """F1, precision and recall on dev for each family, best F1 first."""
    ensure_checkpoints(train.sparkSession)
    fitted = side_by_side(train.sparkSession, lambda spec: spec.make().fit(train), specs, parallelism)
    models = dict(zip([spec.name for spec in specs], fitted))
    rows = [
        M.binary_metrics(score(model, dev), label=label).select(F.lit(name).alias("model"), "f1", "precision", "recall")
        for name, model in models.items()
    ]
    return M.ranked(reduce(DataFrame.unionByName, rows)), models


def probabilities(model, df: DataFrame, name: str) -> DataFrame:
    """Class probabilities as two plain columns ``<name>_0``, ``<name>_1``."""
    p = vector_to_array("probability")
    return model.transform(df).select(*df.columns, F.get(p, F.lit(0)).alias(f"{name}_0"), F.get(p, F.lit(1)).alias(f"{name}_1"))


def soft_vote(model_a, model_b, df: DataFrame, w_a: int, w_b: int) -> DataFrame:
    """Weighted mean of two models' probabilities; both score the same row
    in one pass, so nothing is joined."""
    from weakspot.functions import numeric as N

    scored = probabilities(model_b, probabilities(model_a, df, "a"), "b")
    p0, p1 = N.weighted_mean("a_0", "b_0", w_a, w_b), N.weighted_mean("a_1", "b_1", w_a, w_b)
    return scored.withColumn("prediction", N.argmax_binary(p0, p1)).withColumn("p1", p1)


def find_weights(model_a, model_b, dev: DataFrame, label: str = "label") -> tuple[int, int]:
    scored = probabilities(model_b, probabilities(model_a, dev, "a"), "b")
    best = M.best_weights(M.weight_grid(scored, ("a_0", "a_1"), ("b_0", "b_1"), label)).first()
    return best["w_a"], best["w_b"]
