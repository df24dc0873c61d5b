import itertools
import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from weakspot.models import adaboost, attribution, boosting, compare, estimators, extra_trees, search, svm, voting
from weakspot.operators import embed, features, metrics


def learnable(spark, n=300, dim=6, seed=0):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, dim))
    y = (x[:, 0] + 0.5 * x[:, 1] + 0.3 * r.normal(size=n) > 0.8).astype(int)
    rows = [(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "row_id bigint, embedding array<double>, label int")
    return x, y, df.withColumn("features", array_to_vector("embedding"))


def test_metrics_without_positives(spark):
    rows = spark.createDataFrame([(1, 0), (0, 0)], "label int, prediction int")
    got = metrics.binary_metrics(rows).first()
    assert (got.precision, got.recall, got.f1, got.accuracy) == (0.0, 0.0, 0.0, 0.5)
    report = {r["class"]: r for r in metrics.class_report(rows).collect()}
    assert report["1"].f1 == 0.0 and report["0"].support == 1 and report["accuracy"].f1 == 0.5


def test_pr_curve_in_many_buckets(spark, monkeypatch):
    r = np.random.default_rng(3)
    score, y = r.integers(0, 400, 3000) / 400 - 0.5, r.integers(0, 2, 3000)
    rows = spark.createDataFrame([(float(s), int(c)) for s, c in zip(score, y)], "score double, label int")
    points = rows.groupBy("score").agg(F.sum("label").alias("pos"), F.count(F.lit(1)).alias("n"))
    got = {p.score: (p.cum_pos, p.cum_n) for p in metrics.running_counts(points, "score", ["pos", "n"], bucket_rows=20).collect()}
    assert got == {s: (int(y[score >= s].sum()), int((score >= s).sum())) for s in set(score)}
    monkeypatch.setattr(metrics, "MOST_EDGES", 3)  # four levels of cuts
    again = metrics.running_counts(points, "score", ["pos", "n"], bucket_rows=10).collect()
    assert {p.score: (p.cum_pos, p.cum_n) for p in again} == got
    curve = metrics.pr_curve(rows)
    assert curve.count() == len(set(score))
    want, last = 0.0, 0.0
    for s in sorted(set(score), reverse=True):
        recall = y[score >= s].sum() / y.sum()
        want, last = want + (recall - last) * y[score >= s].mean(), recall
    assert metrics.average_precision(curve).first()[0] == pytest.approx(want)


def test_weight_ties_go_to_the_first_pair(spark):
    rows = spark.createDataFrame([(1, 0.5, 0.5), (0, 0.5, 0.5)], "label int, a1 double, b1 double").withColumns(
        {"a0": 1 - F.col("a1"), "b0": 1 - F.col("b1")})
    best = metrics.best_weights(metrics.weight_grid(rows, ("a0", "a1"), ("b0", "b1"))).first()
    assert (best.w_a, best.w_b, best.f1) == (1, 1, 0.0)


def test_improvement_of_nothing_is_null(spark):
    rows = spark.createDataFrame([(1, 0, 1)], "label int, a int, b int")
    assert metrics.improvement(rows, "a", "b").first().improvement is None


def test_scaling_by_population_deviation(spark):
    x, _, df = learnable(spark)
    model = features.fit_scaler(df)
    got = np.array([r.s for r in features.scale(df, model).orderBy("row_id").select(vector_to_array("scaled").alias("s")).collect()])
    assert np.allclose(got, (x - x.mean(0)) / x.std(0))


def test_assemble_fills_gaps(spark):
    emb = spark.createDataFrame([(1, [0.5, float("nan")]), (2, [1.0, 2.0])], "row_id int, embedding array<float>")
    meta = spark.createDataFrame([(2, None, 7, "x"), (1, 3.0, None, "y")], "row_id int, m double, k int, label string")
    got = {r.row_id: (r.label, r.features.toArray().tolist()) for r in features.assemble(emb, meta, ["m", "k"]).collect()}
    assert got == {1: ("y", [0.5, 0.0, 3.0, 0.0]), 2: ("x", [1.0, 2.0, 0.0, 7.0])}


def test_feature_table_on_disk(spark, tmp_path):
    _, _, df = learnable(spark, 20)
    features.write_features(df.select("row_id", "features", F.lit("train").alias("split")), str(tmp_path / "f"))
    back = spark.read.parquet(str(tmp_path / "f"))
    assert back.filter("split = 'train'").count() == 20 and back.schema["features"].dataType.simpleString() == "array<float>"


def test_one_hot_of_null(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (3, "a")], "row_id int, c string")
    wide, names = features.one_hot(df, ["c"], ["row_id"])
    assert names == ["c_a", "c_b"]
    assert {tuple(r) for r in wide.collect()} == {(1, 0, 1), (2, 0, 0), (3, 1, 0)}
    vec = features.one_hot_vector(df, ["c"])[0].collect()
    assert {(r.row_id, *r.one_hot.toArray()) for r in vec} == {(1, 0, 1), (2, 0, 0), (3, 1, 0)}


def test_one_hot_of_many_categories(spark):
    rows = spark.range(20_000).select(F.col("id").alias("row_id"), F.format_string("v%05d", F.col("id") * 7919 % 20_000).alias("c"),
                                      F.when(F.col("id") % 2 == 0, "even").alias("d"))
    made, places = features.one_hot_vector(rows.repartition(6), ["c", "d"])
    assert places.count() == 20_001 and places.agg(F.max("pos")).first()[0] == 20_000
    first = {r.row_id: r.one_hot for r in made.filter("row_id IN (0, 1, 19999)").collect()}
    for i, v in first.items():
        want = {int(i * 7919 % 20_000)} | ({20_000} if i % 2 == 0 else set())
        assert v.size == 20_001 and set(v.indices.tolist()) == want and set(v.values) == {1.0}
    none, places = features.one_hot_vector(spark.createDataFrame([(1, None)], "row_id int, c string"), ["c"])
    assert none.first().one_hot.size == 0 and places.count() == 0


def test_wide_one_hot_refuses_what_it_cannot_hold(spark, monkeypatch):
    monkeypatch.setattr(features, "MAX_WIDE_COLUMNS", 3)
    with pytest.raises(ValueError, match="one_hot_vector"):
        features.categories(spark.range(5), ["id"])


def test_hashed_embedding(spark):
    df = spark.createDataFrame([(1, "aa bb aa"), (2, ""), (3, None)], "row_id int, code string")
    rows = {r.row_id: r.embedding for r in embed.hashed_embedding(df, dim=64).collect()}
    assert sorted(x for x in rows[1] if x)[-1] == pytest.approx(2 / 3) and sum(rows[2]) == 0 and sum(rows[3]) == 0
    first = {r.row_id: r.embedding for r in embed.hashed_embedding(df, dim=64, max_tokens=1).collect()}
    assert sorted(first[1])[-1] == 1.0


def test_sparse_svm_meets_optimality(spark):
    x, y, df = learnable(spark)
    c = 0.02
    model = svm.SparseSvm(c, tolerance=1e-9).fit(df)
    w = np.append(model.coefficients, model.intercept)
    xb, s = np.hstack([x, np.ones((len(x), 1))]), np.where(y == 1, 1.0, -1.0)
    grad = -2 * c * ((s * np.maximum(1 - s * (xb @ w), 0)) @ xb)
    assert np.all(np.abs(grad[w == 0]) <= 1 + 1e-5)
    assert np.allclose(grad[w != 0], -np.sign(w[w != 0]), atol=1e-4)
    assert (w == 0).any() and w[0] > 0 and model.converged and model.steps < 30
    assert metrics.binary_metrics(compare.score(model, df)).first().accuracy > 0.8


def test_sparse_svm_of_many_features(spark):
    r = np.random.default_rng(2)
    rows = spark.createDataFrame([(r.normal(size=2_000).tolist(), i % 2) for i in range(60)], "features array<double>, label int")
    wide = rows.select(F.flatten(F.array_repeat("features", 10)).alias("features"), "label")  # 20,000, most of them alike
    model = svm.SparseSvm(0.05, tolerance=1e-3).fit(wide)
    assert len(model.coefficients) == 20_000 and model.gap < 0.05 and np.any(model.coefficients)
    assert compare.score(model, wide).filter("prediction = label").count() > 50


def test_lasso_matches_its_optimum(spark):
    x, y, df = learnable(spark)
    w = estimators.linear(1.0, 0.05).fit(df).coefficients.toArray()
    residual = (y - y.mean()) - (x - x.mean(0)) @ w
    grad = -(x - x.mean(0)).T @ residual / len(x)
    assert np.all(np.abs(grad[w == 0]) <= 0.05 + 1e-4) and np.allclose(grad[w != 0], -0.05 * np.sign(w[w != 0]), atol=1e-4)


def test_adaboost_weights(spark):
    x, y, df = learnable(spark)
    model = adaboost.AdaBoostStumps(8).fit(df)
    weight = np.ones(len(x))
    for s in model.stumps:
        wrong = np.where(x[:, s.feature] <= s.threshold, s.below, s.above) != y
        error = weight[wrong].sum() / weight.sum()
        assert s.weight == pytest.approx(math.log((1 - error) / error))
        weight *= np.exp(s.weight * wrong)
    assert model.featureImportances.sum() == pytest.approx(1) and model.featureImportances.argmax() == 0
    assert metrics.binary_metrics(compare.score(model, df)).first().accuracy > 0.85


def test_votes(spark):
    scores = spark.createDataFrame([(0, "l", "coefficients", 1e-6), (1, "l", "coefficients", -0.1),
                                    (0, "t", "importances", 0.9), (1, "t", "importances", 0.1)],
                                   "pos int, model string, kind string, score double")
    named = voting.votes_of_scores(scores).join(features.name_table(scores, ["a", "b"]), "pos").withColumnRenamed("name", "feature")
    table = voting.tally(named, ["l", "t"])
    assert [tuple(r) for r in table.collect()] == [("a", 0, 1, 1), ("b", 1, 0, 1)]
    assert voting.selected_positions(table, ["a", "b"], 1) == (["a", "b"], [0, 1])
    assert voting.winners(table, 2).count() == 0


def few_voters():
    """Families of two sorts with few rounds."""
    Spec, B = estimators.EstimatorSpec, boosting.HistogramBoosting
    return [*estimators.linear_voters(300)[:3], Spec("second_order", lambda: B(boosting.second_order(4, 3)), "importances"),
            Spec("leaf_wise", lambda: B(boosting.leaf_wise(4, 5), kind="splits"), "importances"),
            Spec("extra_trees", lambda: extra_trees.ExtraTrees(20, 5), "importances")]


def test_feature_votes_find_the_signal(spark):
    _, _, df = learnable(spark)
    names = [f"emb_{i}" for i in range(6)]
    table = voting.feature_votes(df, names, voters=few_voters()).collect()
    assert len(table) == 6 and table[0].feature == "emb_0" and len(table[0]) == 8
    assert [s.name for s in [*estimators.linear_voters(1), *estimators.tree_voters()]] == [
        "lasso", "elastic_net", "svm", "logistic", "random_forest", "extra_trees", "second_order", "leaf_wise", "ada_boost", "gradient_boosting"]
    assert all(r.votes == sum(r[1:-1]) for r in table)


def test_linear_attribution_adds_up(spark):
    x, _, df = learnable(spark)
    w = np.arange(6) / 10
    phi = np.array([r.phi for r in attribution.linear_attribution(df, w.tolist()).orderBy("row_id").collect()])
    assert np.allclose(phi.sum(1), x @ w - x.mean(0) @ w)


def expectation(nodes, node, x, known, probability):
    """Mean of a tree when only some features are known."""
    n = nodes[node]
    if n.left < 0:
        return n.stats[1] / sum(n.stats) if probability else n.prediction
    if n.feature in known:
        return expectation(nodes, n.left if x[n.feature] <= n.threshold else n.right, x, known, probability)
    return sum(nodes[c].rows / n.rows * expectation(nodes, c, x, known, probability) for c in (n.left, n.right))


@pytest.mark.parametrize("boosted", [True, False])
def test_tree_attribution_is_the_shapley_value(spark, boosted):
    x, y, df = learnable(spark, 200, 4)
    model = (estimators.boosted(3, 3, 0.3) if boosted else estimators.forest(3, 4)).fit(df)
    nodes = attribution.tree_nodes(model, spark)
    trees = [{r.id: r for r in part.itertuples(index=False)} for _, part in nodes.groupby("tree")]
    weights = list(model.treeWeights) if boosted else [1 / 3] * 3

    def value(row, known):
        return sum(w * expectation(t, 0, row, known, not boosted) for w, t in zip(weights, trees))

    phi = {r.row_id: r.phi for r in attribution.tree_attribution(df.filter("row_id < 5"), model).collect()}
    for i in range(5):
        for j in range(4):
            rest = [f for f in range(4) if f != j]
            want = sum(
                math.factorial(len(s)) * math.factorial(3 - len(s)) / 24 * (value(x[i], {*s, j}) - value(x[i], set(s)))
                for n in range(4) for s in itertools.combinations(rest, n))
            assert phi[i][j] == pytest.approx(want, abs=1e-9)
    if boosted:
        raw = {r.row_id: r.m for r in model.transform(df.filter("row_id < 5")).select(
            "row_id", F.get(vector_to_array("rawPrediction"), F.lit(1)).alias("m")).collect()}
        assert all(sum(phi[i]) + value(x[i], set()) == pytest.approx(raw[i], abs=1e-6) for i in raw)


def test_candidates():
    space = {"a": [1, 2, 3], "b": [1, 2]}
    drawn = search.draw_candidates(space, 4, 1)
    assert len(drawn) == 4 == len({tuple(d.items()) for d in drawn}) and drawn == search.draw_candidates(space, 4, 1)
    assert len(search.draw_candidates(space, 10)) == 6
    assert [search.space_of(s.name) for s in estimators.families(10)] == ["logistic", "forest", "forest"] + ["boosted"] * 4
    assert search.space_of("unheard of") == "logistic"


def test_folds_are_stratified(spark):
    _, y, df = learnable(spark)
    counts = {(r.fold, r.label): r["count"] for r in search.with_folds(df).groupBy("fold", "label").count().collect()}
    for c in (0, 1):
        sizes = [counts[(f, c)] for f in range(3)]
        assert max(sizes) - min(sizes) <= 1


def test_search_prefers_the_better_setting(spark):
    _, _, df = learnable(spark)
    table, model, best = search.random_search(df, search.maker("logistic", 300), {"c": [1e-9, 1.0]}, n=2)
    assert best == {"c": 1.0} and table.count() == 2 and table.first().f1 > 0.7
    assert metrics.binary_metrics(compare.score(model, df)).first().f1 > 0.7


def test_soft_vote_and_weights(spark):
    _, y, df = learnable(spark)
    a, b = estimators.logistic(300).fit(df), estimators.forest(5, 3).fit(df)
    w = compare.find_weights(a, b, df)
    voted = compare.soft_vote(a, b, df, *w)
    grid = metrics.weight_grid(compare.probabilities(b, compare.probabilities(a, df, "a"), "b"), ("a_0", "a_1"), ("b_0", "b_1"))
    assert metrics.binary_metrics(voted).first().f1 == pytest.approx(grid.agg(F.max("f1")).first()[0])


def test_comparisons(spark):
    _, _, df = learnable(spark)
    rows = df.select("row_id", "embedding", "label")
    results, models = compare.compare_balancing(rows, rows, rounds=2, depth=2)
    table = results.collect()
    assert {r.method for r in table} == set(compare.strategies()) and [r.f1 for r in table] == sorted((r.f1 for r in table), reverse=True)
    assert compare.pick_model(results, models)[0] == table[0].method
    assert compare.pick_model(results, models, force="oversampled")[0] == "oversampled"
    few = [s for s in estimators.families(300, slow_rounds=2) if s.name in ("logistic", "boosted_slow")]
    families, _ = compare.compare_families(df, df, few)
    assert families.first().f1 > 0.5


def test_selected_features_keep_their_names(spark, tmp_path):
    from weakspot.plans import training

    _, _, df = learnable(spark)
    train, test, chosen, _ = training.select_features(
        df.select("row_id", "features", "label"), df.select("row_id", "features", "label"),
        [f"emb_{i}" for i in range(6)], 3, few_voters(), str(tmp_path))
    assert chosen[0] == "emb_0" and len(chosen) < 6 and features.names_of(train) == chosen
    back = spark.read.parquet(str(tmp_path / "selected"))
    assert features.names_of(back) == chosen and back.count() == 600
    assert spark.read.parquet(str(tmp_path / "votes")).count() == 6
    assert training.fit_final(train, test, rounds=2)[1].filter("class = 'accuracy'").first().f1 > 0.8


def test_group_aware_split(spark):
    from weakspot.plans import training

    _, _, df = learnable(spark)
    parts = training.three_way(df.withColumn("g", F.col("row_id") % 20), by_group="g")
    groups = {n: {r.g for r in p.select((F.col("row_id") % 20).alias("g")).collect()} for n, p in parts.items()}
    assert sum(map(len, groups.values())) == 20 == len(set.union(*groups.values())) and len(groups["dev"]) == 3


def test_finite_arrays(spark):
    from weakspot.functions import numeric as N

    inf, nan = float("inf"), float("nan")
    rows = spark.createDataFrame([(1, [1.0, 2.0]), (2, [nan, 1.0]), (3, [None, 1.0]), (4, [inf, -inf]), (5, [])], "i int, v array<float>")
    got = {r.i: r.v for r in rows.select("i", N.finite_array("v").alias("v")).collect()}
    assert got == {1: [1.0, 2.0], 2: [0.0, 1.0], 3: [0.0, 1.0], 4: [N.DOUBLE_MAX, -N.DOUBLE_MAX], 5: []}


def test_scratch_is_cleared(spark):
    from weakspot import session

    path = session.scratch_path(spark, "x")
    assert session.written_once(spark.range(3), "x").count() == 3
    session.clear_scratch(spark)
    assert not __import__("os").path.exists(path.rsplit("/", 1)[0])


def test_no_feature_is_chosen(spark, tmp_path):
    """A selection that no feature wins is stored and read back, with empty vectors."""
    _, _, df = learnable(spark, 20, 3)
    cut = features.with_names(features.keep_features(df, []).drop("features").withColumnRenamed("selected", "features"), [])
    features.write_features(cut.select("row_id", "label", "features").withColumn("split", F.lit("train")), str(tmp_path / "cut"))
    back = spark.read.parquet(str(tmp_path / "cut"))
    names = features.name_table(back, features.names_of(back))
    assert back.filter(F.size("features") == 0).count() == 20 and names.count() == 0 and dict(names.dtypes)["name"] == "string"


def test_a_forest_keeps_the_nodes_of_its_rows(spark):
    """Rows know their nodes, and the trees are those of walking down every time."""
    from weakspot.models.estimators import forest

    _, _, df = learnable(spark, 200, 4)
    how = forest(4, None)
    assert how.getCacheNodeIds()
    kept, walked = how.fit(df), how.copy({how.cacheNodeIds: False}).fit(df)
    assert [t.toDebugString.split("\n")[1:] for t in kept.trees] == [t.toDebugString.split("\n")[1:] for t in walked.trees]
