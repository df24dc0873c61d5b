"""Histogram trees against plain Python and SQL."""

import itertools
import math
import pickle

import duckdb
import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from test_models import learnable

from weakspot.models import attribution, boosting, compare, extra_trees, search
from weakspot.operators import metrics
from weakspot.plans import tree_sql


def sql_nodes(x, y, ctes):
    con = duckdb.connect()
    con.execute("CREATE TABLE rows (row_id BIGINT, v DOUBLE[], y INTEGER, w DOUBLE)")
    con.executemany("INSERT INTO rows VALUES (?, ?, ?, 1.0)", [(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, y))])
    return con.execute("WITH RECURSIVE " + ",\n".join(ctes) + " SELECT * FROM nodes ORDER BY tree, node").fetchall()


@pytest.mark.parametrize("how", [boosting.second_order(4, 3), boosting.leaf_wise(3, 6), boosting.second_order(2, 2, least_rows=40, l2=0.5)])
def test_boosted_trees_equal_sql(spark, how):
    x, y, df = learnable(spark, 240, 4)
    x[:, 3] = np.round(x[:, 3])  # ties
    df = spark.createDataFrame([(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, y))], "row_id long, features array<double>, label int")
    model = boosting.HistogramBoosting(how, row_key="row_id").fit(df.repartition(5))
    got = {(r.tree, r.node): r for r in model.nodes(spark).collect()}
    want = sql_nodes(x, y, tree_sql.bins_sql("rows", "rows") + tree_sql.trees_sql(how, "rows"))
    assert len(got) == len(want) > how.rounds
    for tree, node, feature, _, edge, gain, g, h, n, value in want:
        r = got[tree, node]
        assert (r.feature, r.edge, r.rows, r.gradient, r.hessian) == (feature, edge, n, g, h)
        assert r.gain == (None if gain is None else pytest.approx(gain)) and r.value == (None if value is None else pytest.approx(value))


def test_partitions_do_not_change_a_model(spark, monkeypatch):
    _, _, df = learnable(spark, 400, 5)
    once = boosting.HistogramBoosting(boosting.leaf_wise(4, 8, subsample=0.7), row_key="row_id").fit(df)
    monkeypatch.setattr(boosting, "BLOCK_CELLS", 100)
    monkeypatch.setattr(boosting, "PART_CELLS", 300)
    monkeypatch.setattr(boosting, "REFRESH", 1)
    monkeypatch.setattr(boosting, "SAVED", 2)
    monkeypatch.setattr(boosting, "KEPT_BYTES", 0)  # both children are summed
    monkeypatch.setattr(boosting, "PASS_BYTES", 1)  # one node a pass
    again = boosting.HistogramBoosting(boosting.leaf_wise(4, 8, subsample=0.7), row_key="row_id").fit(df.repartition(7))
    assert [t.splits for t in once.trees] == [t.splits for t in again.trees] and [t.sums for t in once.trees] == [t.sums for t in again.trees]


def test_leaves_and_prior(spark):
    _, y, df = learnable(spark, 300, 5)
    model = boosting.HistogramBoosting(boosting.leaf_wise(2, 7)).fit(df)
    assert all(len(t.values) <= 7 for t in model.trees) and min(t.sums[i][2] for t in model.trees for i in t.values) >= 20
    assert model.start == pytest.approx(math.log(y.sum() / (len(y) - y.sum())))
    for kind in ("gain", "mean_gain", "splits"):
        model.kind = kind
        assert model.featureImportances.sum() == pytest.approx(1) and model.featureImportances.argmax() == 0


def test_weights_are_copies(spark):
    """A row of weight 3 counts like three rows (edges given by distinct values)."""
    rows = [(i, [float(i % 9), float(i * 7 % 11)], int(i % 9 > 4 and i % 4 > 0), 1.0 + 2 * (i % 3 == 0)) for i in range(120)]
    df = spark.createDataFrame(rows, "row_id long, features array<double>, label int, w double")
    copies = df.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("w").cast("int"))))
    how = boosting.second_order(5, 3)
    a = boosting.HistogramBoosting(how, weight="w").fit(df)
    b = boosting.HistogramBoosting(how).fit(copies)
    assert [{i: s[:3] for i, s in t.splits.items()} for t in a.trees] == [{i: s[:3] for i, s in t.splits.items()} for t in b.trees]
    assert all(t.values == pytest.approx(u.values, abs=1e-7) for t, u in zip(a.trees, b.trees))  # copies are rounded one by one


def test_odd_tables(spark):
    nothing = spark.createDataFrame([], "features array<double>, label int")
    assert boosting.HistogramBoosting(boosting.second_order(2, 2)).fit(nothing).featureImportances.sum() == 0
    one = spark.createDataFrame([([1.0, float("nan")], 1), ([2.0, 3.0], 1), ([2.0, 3.0], None)], "features array<double>, label int")
    model = boosting.HistogramBoosting(boosting.second_order(2, 2)).fit(one)
    assert [len(t.values) for t in model.trees] == [1, 1] and model.transform(one).filter("prediction = 1").count() == 3
    trees = extra_trees.ExtraTrees(3, 4).fit(one)
    assert all(t.sums == {1: (0, 2)} for t in trees.trees) and trees.transform(one).filter("prediction = 1").count() == 3
    same = spark.createDataFrame([([1.0], i % 2) for i in range(50)], "features array<double>, label int")
    assert all(not t.splits for t in extra_trees.ExtraTrees(3, 4).fit(same).trees)
    assert all(not t.splits for t in boosting.HistogramBoosting(boosting.second_order(2, 2)).fit(same).trees)


def test_extra_trees_equal_sql(spark, monkeypatch):
    x, y, df = learnable(spark, 200, 6)
    monkeypatch.setattr(extra_trees, "BLOCK_CELLS", 60)
    monkeypatch.setattr(extra_trees, "PART_CELLS", 200)
    monkeypatch.setattr(extra_trees, "PASS_NODES", 11)
    model = extra_trees.ExtraTrees(9, 5).fit(df.repartition(4))
    got = sorted(tuple(r) for r in model.nodes(spark).collect())
    want = [(t, n, f, c, n0, n1) for t, n, f, c, n0, n1 in sql_nodes(x, y, tree_sql.extra_trees_sql(9, 5, 42, "rows", "2"))]
    assert got == want and len(got) > 100
    low, high = x.min(axis=0), x.max(axis=0)
    assert all(low[f] <= c < high[f] for _, _, f, c, _, _ in got if f is not None)
    assert metrics.binary_metrics(compare.score(model, df)).first().accuracy > 0.8


def test_draws_look_even():
    d = extra_trees.draw(42, np.arange(200)[:, None], np.arange(1, 51)[None, :], 3, 1) / extra_trees.PRIME
    assert abs(d.mean() - 0.5) < 0.01 and abs(d.std() - 12 ** -0.5) < 0.01 and len(np.unique(d)) > 9_990


@pytest.mark.parametrize("make", [lambda: boosting.HistogramBoosting(boosting.second_order(4, 4)), lambda: extra_trees.ExtraTrees(4, 4)])
def test_shapley_values_of_own_trees(spark, make):
    x, _, df = learnable(spark, 200, 4)
    model = make().fit(df)
    tables = attribution.node_tables(model, spark)
    start = getattr(model, "start", 0.0)

    def mean(t, at, row, known):
        if t.feature[at] < 0:
            return t.value[at]
        f = t.feature[at]
        if f in known:
            return mean(t, t.left[at] if row[f] <= t.edge[at] else t.right[at], row, known)
        return sum(t.share[c] * mean(t, c, row, known) for c in (t.left[at], t.right[at]))

    def value(row, known):
        return start + sum(mean(t, 0, row, known) for t in tables)

    found = {r.row_id: r for r in attribution.tree_attribution(df.filter("row_id < 6"), model).collect()}
    column = F.col("margin") if hasattr(model, "start") else F.get(vector_to_array("probability"), F.lit(1))
    out = {r.row_id: r.m for r in model.transform(df.filter("row_id < 6")).select("row_id", column.alias("m")).collect()}
    for i in range(6):
        assert found[i].base + sum(found[i].phi) == pytest.approx(out[i]) and found[i].base == pytest.approx(value(x[i], set()))
        for j in range(4):
            rest = [f for f in range(4) if f != j]
            want = sum(math.factorial(len(s)) * math.factorial(3 - len(s)) / 24 * (value(x[i], {*s, j}) - value(x[i], set(s)))
                       for n in range(4) for s in itertools.combinations(rest, n))
            assert found[i].phi[j] == pytest.approx(want, abs=1e-9)


def test_fits_in_one_scan_equal_separate_fits(spark):
    _, _, df = learnable(spark, 240, 4)
    rows = df.withColumn("w0", (F.col("row_id") % 3 != 0).cast("double")).withColumn("w1", F.lit(1.0) + F.col("row_id") % 2)
    jobs = [(boosting.second_order(6, 3, 0.2), "w0"), (boosting.second_order(3, 4, 0.1, subsample=0.8), "w1"), (boosting.leaf_wise(4, 5), "w0")]
    together = boosting.fit_many(rows, jobs, row_key="row_id")
    for job, model in zip(jobs, together):
        alone = boosting.fit_many(rows, [job], row_key="row_id")[0]
        assert [t.splits for t in alone.trees] == [t.splits for t in model.trees] and [t.values for t in alone.trees] == [t.values for t in model.trees]


def test_boosted_search(spark):
    _, _, df = learnable(spark, 240, 4)
    space = {"rounds": [2, 6], "depth": [1, 3], "rate": [0.001, 0.3]}
    table, model, best = search.boosted_search(df.select("row_id", "features", "label"), space, n=4)
    rows = table.collect()
    assert len(rows) == 4 and [r.f1 for r in rows] == sorted((r.f1 for r in rows), reverse=True) and str(best) == rows[0].setting
    assert len(model.trees) == best["rounds"]
    # the best setting's score, fold by fold with separate fits on real copies
    folded = search.with_folds(df.select("row_id", "features", "label"))
    scores = []
    for fold in range(3):
        own = folded.filter(F.col("fold") != fold)
        weights = search.copies(own, "row_id", "label", 42, "copies")
        fitted = boosting.HistogramBoosting(boosting.second_order(**best), weight="copies", row_key="row_id")
        whole = folded.join(weights, "row_id", "left").na.fill(0.0, ["copies"])  # the edges see all rows
        scores.append(metrics.binary_metrics(compare.score(fitted.fit(whole), folded.filter(F.col("fold") == fold))).first().f1)
    assert sum(scores) / 3 == pytest.approx(rows[0].f1)


def test_only_splits_reach_the_driver(spark, monkeypatch):
    """No pass collects sums by bin, in one part or in several."""
    _, _, df = learnable(spark, 300, 6)
    found = []
    measure = boosting.Fits.measure
    monkeypatch.setattr(boosting.Fits, "measure", lambda self, *a: found.append(measure(self, *a)) or found[-1])
    one = boosting.HistogramBoosting(boosting.second_order(3, 4), row_key="row_id").fit(df)
    monkeypatch.setattr(boosting, "BLOCK_CELLS", 100)
    monkeypatch.setattr(boosting, "PART_CELLS", 400)
    many = boosting.HistogramBoosting(boosting.second_order(3, 4), row_key="row_id").fit(df.repartition(6))
    assert [t.sums for t in one.trees] == [t.sums for t in many.trees] and [t.splits for t in one.trees] == [t.splits for t in many.trees]
    assert found and all(len(pickle.dumps(r)) < 1000 for pass_ in found for r in pass_)
