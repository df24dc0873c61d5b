import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from weakspot.operators import balance as B
from weakspot.operators import neighbours, order, sampling, spread


def key(seed, *parts):
    return hashlib.md5("|".join(map(str, (seed, *parts))).encode()).hexdigest()


def test_sample_is_exact_and_repeatable(spark):
    df = spark.range(5000)
    want = sorted(range(5000), key=lambda i: key(7, i))[:137]
    assert {r.id for r in sampling.sample_n(df, "id", 137, 7).collect()} == set(want)
    assert {r.id for r in sampling.sample_n(df.repartition(5), "id", 137, 7).collect()} == set(want)
    assert sampling.sample_n(df, "id", 5000, 7).count() == 5000
    assert sampling.sample_n(df.limit(0), "id", 3, 7).count() == 0


def test_ranks_are_dense_within_classes(spark):
    df = spark.range(1000).withColumn("c", (F.col("id") % 3).cast("int")).withColumn("k", order.order_key(1, "id"))
    rows = order.with_rank(df, "k", ["c"], digits=2).collect()
    for c in range(3):
        ours = sorted((r.rank, r.id) for r in rows if r.c == c)
        assert [r for r, _ in ours] == list(range(len(ours)))
        assert [i for _, i in ours] == sorted((i for i in range(1000) if i % 3 == c), key=lambda i: key(1, i))


def test_groups_stay_whole(spark):
    df = spark.range(2000).select(F.col("id").alias("row_id"), F.when(F.col("id") < 700, "CVE-UNKNOWN").otherwise(
        F.concat(F.lit("g"), (F.col("id") % 50).cast("string"))).alias("cve_id"))
    rows = sampling.group_split(df).collect()
    sides = {}
    for r in rows:
        sides.setdefault(r.cve_id, set()).add(r.split)
    assert all(len(s) == 1 for s in sides.values())
    assert sum(s == {"test"} for s in sides.values()) == math.ceil(0.2 * 51)
    apart = sampling.group_split(df, unknown="CVE-UNKNOWN").filter("cve_id = 'CVE-UNKNOWN'")
    assert 0 < apart.filter("split = 'test'").count() < 700


@pytest.mark.parametrize("n", [0, 1, 3, 7, 1000])
def test_row_split_sizes(spark, n):
    found = Counter(r.split for r in sampling.row_split(spark.range(n), "id").collect())
    held = math.ceil(0.3 * n)
    test = math.ceil(0.5 * held)
    assert (found["train"], found["dev"], found["test"]) == (n - held, held - test, test)


def labelled(spark, n=500, minority=40):
    return spark.range(n).select(F.col("id").alias("row_id"), (F.col("id") < minority).cast("int").alias("label"))


def test_undersample(spark):
    rows = B.undersample(labelled(spark)).collect()
    assert Counter(r.label for r in rows) == {0: 40, 1: 40}
    assert {r.row_id for r in rows if r.label == 0} == set(sorted(range(40, 500), key=lambda i: key(42, i))[:40])


def test_oversample(spark):
    rows = B.oversample(labelled(spark)).collect()
    assert Counter(r.label for r in rows) == {0: 460, 1: 460}
    drawn = [r for r in rows if r.draw is not None]
    assert sorted(r.draw for r in drawn) == list(range(420)) and all(r.row_id < 40 for r in drawn)
    assert len({r.row_id for r in drawn}) > 30


def test_oversample_from_one_row(spark, monkeypatch):
    monkeypatch.setattr(B, "DRAWS_PER_KEY", 50)
    rows = B.oversample(labelled(spark, 500, 1)).collect()
    assert Counter(r.label for r in rows) == {0: 499, 1: 499}


def brute(points, k):
    """{id: [(distance, id)]} over all pairs."""
    ids = sorted(points)
    found = {}
    for i in ids:
        near = sorted((float(np.sqrt(((points[i] - points[j]) ** 2).sum())), j) for j in ids if j != i)
        found[i] = near[:k]
    return found


def cloud(seed=0, n=300, dim=5, copies=100):
    """Clusters, plus one group of copies that is a third of the rows."""
    r = np.random.default_rng(seed)
    x = r.normal(size=(n - copies, dim)) + r.integers(0, 4, size=(n - copies, 1)) * 6.0
    return {i: v for i, v in enumerate(np.vstack([x, np.repeat(x[:1], copies, axis=0)]))}


@pytest.mark.parametrize("block_rows,k", [(16, 5), (40, 1), (512, 3)])
def test_neighbours_equal_brute_force(spark, block_rows, k):
    points = cloud()
    df = spark.createDataFrame([(i, v.tolist()) for i, v in points.items()], "row_id bigint, embedding array<double>").repartition(4)
    found = {}
    for r in neighbours.exact_neighbours(df, k, block_rows=block_rows).orderBy("position").collect():
        found.setdefault(r.row_id, []).append((r.distance, r.neighbour))
    want = brute(points, k)
    assert set(found) == set(want)
    for i in want:
        assert [j for _, j in found[i]] == [j for _, j in want[i]], i
        assert np.allclose([d for d, _ in found[i]], [d for d, _ in want[i]])


def test_neighbours_with_text_keys_and_few_rows(spark):
    df = spark.createDataFrame([("a", [0.0]), ("b", [1.0]), ("c", [5.0])], "row_id string, embedding array<double>")
    rows = {(r.row_id, r.position): r.neighbour for r in neighbours.exact_neighbours(df, 5).collect()}
    assert rows == {("a", 0): "b", ("a", 1): "c", ("b", 0): "a", ("b", 1): "c", ("c", 0): "b", ("c", 1): "a"}
    assert neighbours.exact_neighbours(df.limit(1), 2).count() == 0


def test_pairs_of_tiles_shuffle_no_vectors(spark):
    points = cloud(3, 600, 6, 0)
    df = spark.createDataFrame([(f"k{i:03d}", v.tolist()) for i, v in points.items()], "pid string, vector array<double>")
    made = neighbours._nearest_points(df, 4, 8, 42)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and not any("Exchange" in line and "data" in line for line in plan.splitlines())
    found = {}
    for r in made.collect():
        found.setdefault(r.pid, []).append((r.distance, r.other))
    want = brute(points, 4)
    assert {i: [j for _, j in sorted(own)] for i, own in found.items()} == {f"k{i:03d}": [f"k{j:03d}" for _, j in own] for i, own in want.items()}


def with_labels(spark, points, minority):
    rows = [(i, v.tolist(), int(i < minority)) for i, v in points.items()]
    return spark.createDataFrame(rows, "row_id bigint, embedding array<double>, label int")


def test_smote_points_lie_between_neighbours(spark):
    points = cloud(1, 200, 4, 0)
    df = with_labels(spark, points, 60)
    near = brute({i: points[i] for i in range(60)}, 5)
    made = B.smote_draws(df, block_rows=16).collect()
    assert len(made) == 80
    for r in made:
        assert r.neighbour in [j for _, j in near[r.base]] and 0 <= r.step < 1
        assert np.allclose(r.embedding, points[r.base] + r.step * (points[r.neighbour] - points[r.base]))
    assert Counter(r.label for r in B.smote(df).collect()) == {0: 140, 1: 140}
    with pytest.raises(ValueError):
        B.smote_draws(with_labels(spark, points, 5))


def test_tomek_links_are_mutual_and_mixed(spark):
    points = {i: v for i, v in cloud(2, 200, 2, 0).items()}
    df = with_labels(spark, points, 100)
    near = {i: n[0][1] for i, n in brute(points, 1).items()}
    want = {(i, j) for i, j in near.items() if i < j and near[j] == i and (i < 100) != (j < 100)}
    assert {(r.a, r.b) for r in B.tomek_links(df, block_rows=32).collect()} == want
    gone = {i for pair in want for i in pair}
    assert {r.row_id for r in B.remove_tomek(df).collect()} == set(points) - gone


def test_hot_groups_are_joined_whole(spark):
    rows = spark.range(3000).select(F.col("id").alias("row_id"), F.when(F.col("id") < 1000, 7).otherwise(
        F.col("id")).cast("bigint").alias("k"))
    groups = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    joined = spread.join_group_values(rows, groups, ["k"], ["n"], "n", "row_id", max_hot=2, hot_rows=100)
    assert Counter(r.n for r in joined.collect()) == {1000: 1000, 1: 2000}


def test_large_dimension_is_salted(spark, monkeypatch):
    rows = spark.range(1000).select(F.col("id").alias("row_id"), F.when(F.col("id") % 3 > 0, F.col("id") % 5).alias("k"))
    dim = spark.range(3).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    want = Counter((r.k, r.v) for r in rows.join(dim, "k", "left").collect())
    monkeypatch.setattr(spread, "is_small", lambda df: False)
    assert Counter((r.k, r.v) for r in spread.lookup_join(rows, dim, "k", "row_id", salts=8).collect()) == want
    assert Counter((r.k, r.v) for r in spread.lookup_join(rows, dim, "k", "row_id", salts=8, max_hot=2).collect()) == want
    monkeypatch.undo()
    assert spread.is_small(dim) and not spread.is_small(dim, max_rows=2) and not spread.is_small(dim, max_bytes=10)
