"""Registered queries: stored models and vectors, linear votes."""

from __future__ import annotations

import json

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from weakspot import constants as C
from weakspot.functions import numeric as N
from weakspot.models import estimators
from weakspot.models.boosting import Growth
from weakspot.models.stored import Classifier
from weakspot.operators import embed, features
from weakspot.operators.store import VectorStore
from weakspot.plans import training, tree_sql
from weakspot.plans.boosted import _ALL, _SPLIT, _sql, split_points
from weakspot.plans.code_view import with_sql
from weakspot.plans.features import points, vectors
from weakspot.plans.registry import query, table
from weakspot.session import scratch_path, written_once

# --- linear families by accelerated proximal steps in SQL --------------------

_SCALED = """e AS (SELECT row_id, v, y, unnest(range(1, 65)) AS pos FROM {}),
  x AS MATERIALIZED (SELECT row_id, y, list((v[pos] - m) / s ORDER BY pos) AS x FROM (
    SELECT *, avg(v[pos]) OVER (PARTITION BY pos) AS m, stddev_pop(v[pos]) OVER (PARTITION BY pos) AS s FROM e) GROUP BY row_id, y),
  n AS (SELECT count(*) AS n, avg(y) AS mean FROM x)"""


def _descent(name: str, rows: str, pull: str, bound: str, shrink: str, steps: int = 400) -> str:
    """A CTE (k, w) of accelerated proximal steps. ``pull`` is a row's factor
    of its x in the gradient, given ``dot`` = w . x, y and n; coordinate 65 is
    the constant, with its own shrinkage (0 where it is free)."""
    return f"""{name} AS (SELECT 0 AS k, list_transform(range(65), lambda i: 0.0::DOUBLE) AS w, list_transform(range(65), lambda i: 0.0::DOUBLE) AS z, 1.0::DOUBLE AS t
    UNION ALL (WITH r AS (SELECT list_append(x, 1.0::DOUBLE) AS x, y, n, mean, z FROM {name}, {rows}, n WHERE k < {steps}),
      f AS (SELECT x, n, {pull} AS f FROM (SELECT *, list_dot_product(x, z) AS dot FROM r)),
      g AS (SELECT pos, sum(f * x[pos]) AS g, any_value(n) AS n FROM (SELECT unnest(range(1, 66)) AS pos, x, f, n FROM f) GROUP BY pos),
      u AS (SELECT pos, z[pos] - g / ({bound}) AS u, ({shrink}) / ({bound}) AS cut FROM g, {name}),
      v AS (SELECT list(sign(u) * greatest(abs(u) - cut, 0.0) ORDER BY pos) AS w2 FROM u HAVING count(*) > 0)
      SELECT k + 1, w2, list_transform(range(1, 66), lambda i: w2[i] + (t - 1) / ((1 + sqrt(1 + 4 * t * t)) / 2) * (w2[i] - w[i])), (1 + sqrt(1 + 4 * t * t)) / 2 FROM {name}, v))"""


_LASSO = _descent("lasso", "x", "(dot - y) / n", "4.0", "CASE WHEN pos = 65 THEN 0.0 ELSE 0.01 END")
_ELASTIC = _descent("elastic", "x", "(dot - y) / n", "4.0", "CASE WHEN pos = 65 THEN 0.0 ELSE 0.005 END").replace(
    "sign(u) * greatest(abs(u) - cut, 0.0)", "sign(u) * greatest(abs(u) - cut, 0.0) / CASE WHEN pos = 65 THEN 1.0 ELSE 1.0 + 0.005 / 4.0 END")
_SVM = _descent("svm", "x", "-2.0 * 0.01 * (2 * y - 1) * greatest(1.0 - (2 * y - 1) * dot, 0.0)", "2.0 * 0.01 * 4.0 * n", "1.0")
_LOGIT = _descent("logit", "x", "(1.0 / (1.0 + exp(-dot)) - y) / n", "1.0", "CASE WHEN pos = 65 THEN 0.0 ELSE 1.0 / n END", 1500)


_VOTED = """votes AS (SELECT 'emb_' || (pos - 1) AS feature, cast(pos - 1 AS INTEGER) AS pos, cast(abs(l.w[pos]) > 1e-5 AS INTEGER) AS lasso, cast(abs(e.w[pos]) > 1e-5 AS INTEGER) AS elastic_net,
  cast(abs(s.w[pos]) > 1e-5 AS INTEGER) AS svm, cast(abs(g.w[pos]) > 1e-5 AS INTEGER) AS logistic
FROM (SELECT unnest(range(1, 65)) AS pos), (SELECT w FROM lasso WHERE k = 400) l, (SELECT w FROM elastic WHERE k = 400) e,
  (SELECT w FROM svm WHERE k = 400) s, (SELECT w FROM logit WHERE k = 1500) g)"""


@query(_sql(_ALL, _SCALED.format("p"), _LASSO, _ELASTIC, _SVM, _LOGIT, _VOTED) + "SELECT feature, lasso, elastic_net, svm, logistic FROM votes")
def linear_votes(spark, sf):
    """Votes of the four sparse linear families on scaled features."""
    rows = vectors(spark, sf)
    ready = written_once(features.scale(rows.select("features", "label"), features.fit_scaler(rows)), "scaled")
    scores = []
    for spec in estimators.linear_voters(ready.count()):
        found = spec.make().fit(ready).coefficients
        scores.append([float(w) for w in found])
    names = [s.name for s in estimators.linear_voters(1)]
    made = spark.createDataFrame([(f"emb_{i}", *w) for i, w in enumerate(zip(*scores))], ["feature", *names])
    return made.select("feature", *[N.large_enough(n, C.COEFFICIENT_FLOOR).alias(n) for n in names])


@query(_sql(_SPLIT, _SCALED.format("train"), _LASSO, _ELASTIC, _SVM, _LOGIT, _VOTED, """ranked AS (SELECT feature, pos, lasso + elastic_net + svm + logistic AS votes,
    row_number() OVER (ORDER BY lasso + elastic_net + svm + logistic DESC, feature) - 1 AS place FROM votes)""")
       + """SELECT CASE part WHEN 'train' THEN 'train' ELSE 'test' END AS split, feature, cast(r.place AS INTEGER) AS pos, cast(votes AS BIGINT) AS votes,
  count(*) AS rows, round(sum(v[r.pos + 1]), 4) AS total, cast(sum(y) AS BIGINT) AS positives FROM split, ranked r WHERE votes >= 3 GROUP BY ALL""")
def stored_selection(spark, sf):
    """Votes of the linear families on the train part, stored with the winners
    and both parts cut to them, and read back: names, places, votes and sums."""
    rows = split_points(spark, sf).withColumn("features", array_to_vector(F.col("embedding").cast("array<double>"))).drop("embedding")
    train, test = rows.filter("split = 'train'").drop("split"), rows.filter("split <> 'train'").drop("split")
    path = scratch_path(spark, "selection")
    training.select_features(train, test, features.feature_names(64, []), 3, estimators.linear_voters(train.count()), path)
    back = spark.read.parquet(f"{path}/selected")
    names = features.name_table(back, features.names_of(back))
    votes = spark.read.parquet(f"{path}/winners").select(F.col("feature").alias("name"), "votes")
    cells = back.select("split", "label", F.posexplode("features").alias("pos", "x"))
    sums = cells.groupBy("split", "pos").agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum(F.col("x").cast("double")), 4).alias("total"),
                                             F.sum("label").alias("positives"))
    return sums.join(names, "pos").join(votes, "name").select("split", F.col("name").alias("feature"), "pos", F.col("votes").cast("long").alias("votes"), "rows", "total", "positives")


# --- stored models ----------------------------------------------------------

STORED = Growth(rounds=30, depth=3, rate=0.3)


@query(_sql(_ALL, *tree_sql.bins_sql("p", "p"), *tree_sql.trees_sql(STORED, "p")) + "SELECT row_id, round(margin, 5) AS margin, cast(margin > 0 AS INTEGER) AS prediction FROM margins")
def stored_model(spark, sf):
    """Margins of a boosted stage that was saved in a pipeline and loaded."""
    rows = points(spark, sf)
    stage = Classifier(kind="boosting", settings=json.dumps({"rounds": 30, "depth": 3, "rate": 0.3}), featuresCol="embedding")
    path = scratch_path(spark, "pipeline")
    Pipeline(stages=[stage]).fit(rows).write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    return loaded.transform(rows).select("row_id", F.round("margin", 5).alias("margin"), F.col("prediction").cast("int").alias("prediction"))


# --- vectors that are written range by range ----------------------------------

def _digit(i: int):
    """A fixed vector table: component i of a token, from its digest."""
    return (F.conv(F.substring(F.md5("token"), 4 * i + 1, 4), 16, 10).cast("double") / 65536.0)


def _fixed_vectors(rows):
    """Vectors of all tokens. No token holds a space, so the tokens of a text
    are those of its parts between spaces, of which equal ones are read once."""
    parts = rows.select(F.explode(F.split(F.coalesce(F.col("code"), F.lit("")), " ")).alias("part")).distinct()
    tokens = F.regexp_extract_all("part", F.lit(C.TOKEN_PATTERN), F.lit(0))
    return parts.select(F.explode(tokens).alias("token")).distinct().withColumn("vector", F.array(*[_digit(i) for i in range(4)]))


_POOLED = """t AS (SELECT doc_id AS row_id, unnest((regexp_extract_all(text, '{}'))[1:256]) AS token FROM documents),
  p AS (SELECT row_id, {} FROM t GROUP BY row_id)"""


def _pooled_sql() -> str:
    from weakspot.plans.features import _VISIBLE, _WORD

    means = ", ".join(f"round(avg(('0x' || substr(md5(token), {4 * i + 1}, 4))::INTEGER / 65536.0::DOUBLE), 6) AS v{i}" for i in range(4))
    return with_sql(_POOLED.format(f"{_WORD}|{_VISIBLE}", means)) + "SELECT * FROM p"


def _documents(spark, sf):
    return table(spark, sf, "documents").select(F.col("doc_id").alias("row_id"), F.col("text").alias("code"))


@query(_pooled_sql())
def embed_pooled(spark, sf):
    """Mean vectors of the first 256 tokens of each document under a fixed table."""
    rows = _documents(spark, sf)
    made = embed.pooled_embedding(rows, _fixed_vectors(rows))
    return made.select("row_id", *[F.round(F.get("embedding", F.lit(i)), 6).alias(f"v{i}") for i in range(4)])


@query(_pooled_sql())
def embed_resume(spark, sf):
    """The same vectors, written range by range: a run that stops after three
    ranges, a second one that ends them, then a run that finds nothing to do."""
    rows = _documents(spark, sf)
    vectors_of = embed.VectorTable.of(_fixed_vectors(rows))
    store = VectorStore(spark, scratch_path(spark, "vectors"))

    def encode(part):
        return embed.pooled_embedding(part, vectors_of)

    left = store.write(rows, encode, parts=8, most=3, together=5)
    again = VectorStore(spark, store.path)
    if again.write(rows, encode, parts=8, together=5) or not left or again.write(rows, encode) or again.catch_up(rows.filter("code IS NULL"), encode):
        raise RuntimeError("ranges are left")
    return again.read().select("row_id", *[F.round(F.get("embedding", F.lit(i)), 6).alias(f"v{i}") for i in range(4)])
