"""Flows over one feature table (row_id, features, label)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weakspot.models import attribution, compare, estimators, search, voting
from weakspot.models.boosting import HistogramBoosting, second_order
from weakspot.operators import balance, features, metrics, sampling
from weakspot.session import ensure_checkpoints, written_once
from weakspot.sources.tables import write_parquet


def select_features(
    train: DataFrame, test: DataFrame, names: list[str], min_votes: int = 0, voters: list | None = None, path: str | None = None
) -> tuple[DataFrame, DataFrame, list[str], DataFrame]:
    """Both parts cut to the features with enough votes, in vote order.

    With ``path`` the vote table, the winners and both parts are kept there.
    """
    votes = voting.feature_votes(train, names, voters=voters)
    chosen, positions = voting.selected_positions(votes, names, min_votes)
    parts = [
        features.with_names(
            features.keep_features(p, positions).drop("features").withColumnRenamed("selected", "features"), chosen)
        for p in (train, test)
    ]
    if path:
        write_parquet(votes, f"{path}/votes")
        write_parquet(voting.winners(votes, min_votes), f"{path}/winners")
        both = parts[0].withColumn("split", F.lit("train")).unionByName(parts[1].withColumn("split", F.lit("test")))
        features.write_features(features.with_names(both, chosen), f"{path}/selected")
    return parts[0], parts[1], chosen, votes


def fit_final(train: DataFrame, test: DataFrame, rounds: int = 500, features: str = "features") -> tuple[object, DataFrame]:
    """The weighted second-order model and its report on test."""
    ratio = metrics.imbalance_ratio(train).first()["ratio"]
    model = estimators.final_boosted(features, rounds=rounds).fit(train.withColumn("weight", balance.class_weight("label", ratio)))
    return model, metrics.class_report(compare.score(model, test))


def three_way(rows: DataFrame, by_group: str | None = None) -> dict[str, DataFrame]:
    """Train, dev and test parts, scaled by the train part.

    The split is by row; ``by_group`` keeps the rows of a group together
    instead, so that no group leaks into dev or test.
    """
    if by_group is None:
        split = sampling.row_split(rows, "row_id")
    else:
        held = sampling.group_split(rows, by_group, 0.3, seed=222).withColumnRenamed("split", "__outer")
        inner = sampling.group_split(held.filter("__outer = 'test'"), by_group, 0.5, seed=223)
        train = held.filter("__outer = 'train'").withColumn("split", F.lit("train"))
        dev_test = inner.withColumn("split", F.when(F.col("split") == "train", "dev").otherwise("test"))
        split = train.unionByName(dev_test).drop("__outer")
    scaler = features.fit_scaler(split.filter("split = 'train'"))
    scaled = features.scale(split, scaler).drop("features").withColumnRenamed("scaled", "features")
    ready = written_once(scaled.select("row_id", "label", "split", "features"), "split", by="split")
    return {name: ready.filter(F.col("split") == name).drop("split") for name in ("train", "dev", "test")}


def balanced(train: DataFrame) -> DataFrame:
    """The oversampled train part, written: a written table is read in
    partitions fit for its size, which a cached shuffle is not. Fits on it
    may checkpoint."""
    ensure_checkpoints(train.sparkSession)
    return written_once(balance.oversample(train).select("features", "label"), "balanced")


def best_family(
    rows: DataFrame, names: list[str], families: set[str] | None = None, spaces: dict = search.SPACES, draws: int = 10
) -> dict[str, DataFrame]:
    """Families (all seven, or those named) compared on dev, the winner tuned, reported on test and
    explained: tables ``comparison``, ``search``, ``report``, ``attribution``."""
    parts = three_way(rows)
    train = balanced(parts["train"])
    count = train.count()
    specs = [s for s in estimators.families(count) if families is None or s.name in families]
    comparison, _ = compare.compare_families(train, parts["dev"], specs)
    best = metrics.winner(comparison).first()["model"]
    kind = search.space_of(best)
    tried, model, setting = search.tune(kind, parts["train"], spaces[kind], draws, count)
    report = metrics.class_report(compare.score(model, parts["test"]))
    if kind == "logistic":
        phi = attribution.linear_attribution(parts["test"], list(model.coefficients), parts["train"])
    else:
        phi = attribution.tree_attribution(parts["test"], model)
    return {
        "comparison": comparison, "search": tried, "report": report,
        "attribution": attribution.summarise(phi, features.name_table(rows, names)),
    }


def ensemble(rows: DataFrame, spaces: dict = search.DEEP_SPACES, draws: int = 5, base_rounds: int = 1000) -> dict[str, DataFrame]:
    """Two families tuned, their change over the plain fits on dev, and the
    report of their weighted vote on test."""
    parts = three_way(rows)
    train = balanced(parts["train"])
    plain = {"boosted": HistogramBoosting(second_order(base_rounds, 6, 0.03, l2=3.0)), "forest": estimators.Forest(100, None)}
    tuned, changes = {}, []
    for kind in ("boosted", "forest"):
        base = plain[kind].fit(train)
        _, tuned[kind], _ = search.tune(kind, parts["train"], spaces[kind], draws, seed=222)
        both = compare.score(tuned[kind], compare.score(base, parts["dev"], "base"), "tuned")
        changes.append(metrics.improvement(both, "base", "tuned").select(F.lit(kind).alias("family"), "*"))
    w_a, w_b = compare.find_weights(tuned["boosted"], tuned["forest"], parts["dev"])
    voted = compare.soft_vote(tuned["boosted"], tuned["forest"], parts["test"], w_a, w_b)
    return {"changes": changes[0].unionByName(changes[1]), "report": metrics.class_report(voted)}
