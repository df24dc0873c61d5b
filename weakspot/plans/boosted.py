"""Registered queries: boosted trees at the reference's settings, with SQL
that grows the same trees on its own."""

from __future__ import annotations

from pyspark.sql import functions as F

from weakspot.models import attribution, boosting, search, voting
from weakspot.models.extra_trees import ExtraTrees
from weakspot.operators import features, sampling
from weakspot.plans import training, tree_sql
from weakspot.plans.code_view import NUMBER_SQL
from weakspot.plans.features import points
from weakspot.plans.registry import query
from weakspot.session import written_once

_ALL = "p AS (SELECT vec_id AS row_id, embedding::DOUBLE[] AS v, cast(label = 0 AS INTEGER) AS y, 1.0::DOUBLE AS w FROM embeddings)"
_NODES = """SELECT cast(tree AS INTEGER) AS tree, node, cast(feature AS INTEGER) AS feature, round(edge, 6) AS edge, round(gain, 4) AS gain, round(gradient, 5) AS gradient,
  round(hessian, 5) AS hessian, rows, round(value, 5) AS value FROM nodes"""


def _sql(*parts: str) -> str:
    return "WITH RECURSIVE " + ",\n  ".join(parts) + "\n"


def _node_table(model, spark):
    rounded = {"edge": 6, "gain": 4, "gradient": 5, "hessian": 5, "value": 5}
    return model.nodes(spark).withColumns({c: F.round(c, d) for c, d in rounded.items()})


SECOND_ORDER = boosting.second_order()
LEAF_WISE = boosting.leaf_wise()
FINAL = boosting.second_order(500, 6, 0.05)


@query(_sql(_ALL, *tree_sql.bins_sql("p", "p"), *tree_sql.trees_sql(SECOND_ORDER, "p")) + _NODES)
def second_order_trees(spark, sf):
    """Every node of 100 second-order trees of depth 6."""
    model = boosting.HistogramBoosting(SECOND_ORDER, "embedding", row_key="row_id").fit(points(spark, sf))
    return _node_table(model, spark)


@query(_sql(_ALL, *tree_sql.bins_sql("p", "p"), *tree_sql.trees_sql(LEAF_WISE, "p")) + _NODES)
def leaf_wise_trees(spark, sf):
    """Every node of 100 best-first trees of 31 leaves."""
    model = boosting.HistogramBoosting(LEAF_WISE, "embedding", row_key="row_id").fit(points(spark, sf))
    return _node_table(model, spark)


_SPLIT = """placed AS (SELECT vec_id AS row_id, embedding::DOUBLE[] AS v, cast(label = 0 AS INTEGER) AS y,
    row_number() OVER (ORDER BY md5('222|' || vec_id)) AS place, count(*) OVER () AS n FROM embeddings),
  split AS (SELECT *, CASE WHEN place <= n - ceil(0.3 * n) THEN 'train' WHEN place <= n - ceil(0.5 * ceil(0.3 * n)) THEN 'dev' ELSE 'test' END AS part FROM placed),
  train AS (SELECT * FROM split WHERE part = 'train')"""
_WEIGHTED = """p AS (SELECT row_id, v, y, CASE WHEN part <> 'train' THEN 0.0 WHEN y = 1 THEN ratio ELSE 1.0 END::DOUBLE AS w
    FROM split, (SELECT count(*) FILTER (y = 0) / count(*) FILTER (y = 1) AS ratio FROM train))"""
_REPORT = """s AS (SELECT y AS label, cast(margin > 0 AS INTEGER) AS prediction FROM split JOIN margins USING (row_id) WHERE part = 'test'),
  k AS (SELECT unnest([0, 1]) AS c),
  c1 AS (SELECT c, count(*) FILTER (label = c AND prediction = c) AS tp, count(*) FILTER (prediction = c) AS pp, count(*) FILTER (label = c) AS support FROM k, s GROUP BY c),
  c2 AS (SELECT c, support, coalesce(tp / nullif(pp, 0), 0) AS p, coalesce(tp / nullif(support, 0), 0) AS r, tp FROM c1),
  c3 AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f FROM c2 WHERE p + r + support > 0),
  report AS (SELECT cast(c AS VARCHAR) AS class, p, r, f, support FROM c3
    UNION ALL SELECT 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support), sum(support) FROM c3
    UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(support) FROM c3
    UNION ALL SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support), sum(f * support) / sum(support), sum(support) FROM c3)"""


def split_points(spark, sf):
    """The points with their part, written once."""
    return written_once(sampling.row_split(points(spark, sf), "row_id"), "points", by="split")


@query(_sql(_SPLIT, _WEIGHTED, *tree_sql.bins_sql("split", "train"), *tree_sql.trees_sql(FINAL, "p"), _REPORT)
       + "SELECT class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, cast(support AS BIGINT) AS support FROM report")
def final_model(spark, sf):
    """Report on test of the final model: 500 rounds, rate 0.05, depth 6,
    weighted classes, on all features (a vote threshold of 0 keeps all)."""
    rows = split_points(spark, sf)
    _, report = training.fit_final(rows.filter("split = 'train'").drop("split"), rows.filter("split = 'test'").drop("split"), features="embedding")
    return report.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query(_sql(_ALL, *tree_sql.extra_trees_sql(100, 10, 42, "p", "8"))
       + "SELECT cast(tree AS INTEGER) AS tree, node, cast(feature AS INTEGER) AS feature, round(cut, 6) AS cut, n0, n1 FROM nodes")
def extra_trees(spark, sf):
    """Every node of 100 extremely randomised trees of depth 10."""
    return ExtraTrees(features="embedding").fit(points(spark, sf)).nodes(spark).withColumn("cut", F.round("cut", 6))


_COPIES = f"""ranked AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY md5('42|' || row_id)) - 1 AS rank FROM train),
  sizes AS (SELECT count(*) FILTER (y = 1) AS n_min, count(*) FILTER (y = 0) AS n_max FROM train),
  drawn AS (SELECT rank, count(*) AS n FROM (SELECT {NUMBER_SQL.format("'42|copy-1|' || draw")} % n_min AS rank
    FROM (SELECT unnest(range(n_max - n_min)) AS draw, n_min FROM sizes)) GROUP BY rank),
  p AS (SELECT row_id, v, y, (1 + CASE WHEN y = 1 THEN coalesce(drawn.n, 0) ELSE 0 END)::DOUBLE AS w FROM ranked LEFT JOIN drawn USING (rank))"""


@query(_sql(_SPLIT, _COPIES, *tree_sql.bins_sql("p", "p"), *tree_sql.trees_sql(SECOND_ORDER, "p"),
            "means AS (SELECT feature, avg(gain) AS gain FROM nodes WHERE feature IS NOT NULL GROUP BY feature)")
       + """SELECT 'emb_' || f AS feature, round(coalesce(gain, 0) / (SELECT sum(gain) FROM means), 6) AS importance
FROM (SELECT unnest(range((SELECT len(v) FROM p LIMIT 1))) AS f) LEFT JOIN means ON feature = f""")
def importance(spark, sf):
    """Features by mean gain in 100 rounds on oversampled rows; a row that is
    drawn more than once weighs so much more, no copies are made."""
    train = split_points(spark, sf).filter("split = 'train'").drop("split")
    weighted = train.join(search.copies(train, "row_id", "label", 42, "copies"), "row_id")
    model = boosting.HistogramBoosting(SECOND_ORDER, "embedding", weight="copies", row_key="row_id").fit(weighted)
    table = voting.importance_table(model, train, features.feature_names(model.size, []))
    return table.withColumn("importance", F.round("importance", 6))


EXPLAINED = boosting.second_order(30, 3, 0.3)
_FIVE = "p AS (SELECT vec_id AS row_id, (embedding::DOUBLE[])[1:5] AS v, cast(label = 0 AS INTEGER) AS y, 1.0::DOUBLE AS w FROM embeddings)"
# the mean of every tree when only the features of a subset are known, for all 32 subsets
_SUBSETS = """walk AS (SELECT row_id, v, s, tree, 1::BIGINT AS node, 1.0::DOUBLE AS share FROM p, (SELECT unnest(range(32)) AS s), (SELECT DISTINCT tree FROM nodes)
    UNION ALL SELECT w.row_id, w.v, w.s, w.tree, c.node, w.share * CASE WHEN (w.s >> n.feature) & 1 = 1 THEN 1.0 ELSE c.rows::DOUBLE / n.rows END
    FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node AND n.feature IS NOT NULL JOIN nodes c ON c.tree = n.tree AND c.node >> 1 = n.node
    WHERE (w.s >> n.feature) & 1 = 0 OR (c.node & 1 = 1) = (w.v[n.feature + 1] > n.edge)),
  known AS (SELECT row_id, s, sum(share * value) AS value FROM walk JOIN nodes USING (tree, node) WHERE feature IS NULL GROUP BY row_id, s),
  phi AS (SELECT a.row_id, j, sum((b.value - a.value) * factorial(bit_count(a.s)) * factorial(4 - bit_count(a.s)) / 120.0) AS phi
    FROM known a, (SELECT unnest(range(5)) AS j) JOIN known b ON b.row_id = a.row_id AND b.s = a.s + (1 << j) WHERE (a.s >> j) & 1 = 0 GROUP BY a.row_id, j)"""


@query(_sql(_FIVE, *tree_sql.bins_sql("p", "p"), *tree_sql.trees_sql(EXPLAINED, "p"), _SUBSETS) + "SELECT row_id, "
       + ", ".join(f"round((SELECT phi FROM phi WHERE phi.row_id = k.row_id AND j = {j}), 5) AS phi_{j}" for j in range(5))
       + """, round(value, 5) AS base, round((SELECT value FROM known a WHERE a.row_id = k.row_id AND s = 31), 5) AS margin FROM known k WHERE s = 0""")
def tree_attribution(spark, sf):
    """Shapley values of five features for every row, their base and the
    model's margin."""
    rows = points(spark, sf).withColumn("embedding", F.slice("embedding", 1, 5))
    model = boosting.HistogramBoosting(EXPLAINED, "embedding", row_key="row_id").fit(rows)
    phi = attribution.tree_attribution(rows, model, features="embedding")
    margins = model.transform(rows).select("row_id", F.round("margin", 5).alias("margin"))
    return phi.select("row_id", *[F.round(F.get("phi", F.lit(j)), 5).alias(f"phi_{j}") for j in range(5)], F.round("base", 5).alias("base")).join(margins, "row_id")
