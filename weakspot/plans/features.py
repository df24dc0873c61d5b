"""Registered queries: features, samples, splits, balancing, metrics."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weakspot import constants as C
from weakspot.functions import text as X
from weakspot.operators import balance, embed, enrich, features, graph, metrics, neighbours, sampling
from weakspot.plans import dataset as flow
from weakspot.plans.code_view import (
    IDS_SQL, NUMBER_SQL, VIEW, VIEW_ENRICHED, VIEW_IDS, VIEW_SQL, ENRICHED_SQL, code_view, strip_sql, with_ids, with_sql,
)
from weakspot.plans.registry import query, table
from weakspot.session import written_once

MIN_COUNT = 20  # smallest count of a frequent category, for small tables

_WORD = r"[A-Za-z_][\p{L}\p{N}_]+|\p{Nd}+|==|!=|<=|>="
_VISIBLE = (r"[^\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
            r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")


def tokens_sql(x: str) -> str:
    return f"len(regexp_extract_all({x}, '{_WORD}|{_VISIBLE}'))"


# --- tabular features -------------------------------------------------------

@query(f"SELECT doc_id, cast({tokens_sql('text')} AS INTEGER) AS code_token_count FROM documents")
def token_count(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.token_count("text").alias("code_token_count"))


_SLIM = f"""slim AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY cwe_id) >= {MIN_COUNT} AND cwe_id IS NOT NULL
  THEN cwe_id ELSE 'CWE_OTHER' END AS cwe_id_slim FROM {{}})"""


@query(VIEW_IDS + f"SELECT cwe_id, count(*) AS count FROM ids WHERE cwe_id IS NOT NULL GROUP BY cwe_id HAVING count(*) >= {MIN_COUNT}")
def frequent_categories(spark, sf):
    return features.frequent_values(with_ids(code_view(spark, sf, label=False)), "cwe_id", MIN_COUNT)


@query(with_sql(VIEW_SQL, IDS_SQL, _SLIM.format("ids")) + "SELECT row_id, cwe_id, cwe_id_slim FROM slim")
def rare_category(spark, sf):
    return features.collapse_rare(with_ids(code_view(spark, sf, label=False)).select("row_id", "cwe_id"), "cwe_id", MIN_COUNT)


_LANGS = ["de", "en", "es", "fr"]


@query(VIEW + "SELECT row_id, " + ", ".join(f"cast(language = '{v}' AS INTEGER) AS language_{v}" for v in _LANGS) + " FROM v")
def one_hot(spark, sf):
    return features.one_hot(code_view(spark, sf, label=False), ["language"], ["row_id"])[0]


@query(with_sql(VIEW_SQL, """cats AS (SELECT DISTINCT 'language_' || language AS name, 0 AS block, language AS value FROM v
    UNION SELECT DISTINCT 'dataset_' || dataset, 1, dataset FROM v),
  placed AS (SELECT *, row_number() OVER (ORDER BY block, value) - 1 AS pos FROM cats)""")
       + """SELECT row_id, cast(pos AS INTEGER) AS pos FROM v JOIN placed
  ON (block = 0 AND value = language) OR (block = 1 AND value = dataset)""")
def one_hot_vector(spark, sf):
    """Positions of the set flags of the vector form."""
    encoded, _ = features.one_hot_vector(code_view(spark, sf, label=False).select("row_id", "language", "dataset"), ["language", "dataset"])
    return (encoded.select("row_id", F.posexplode(vector_to_array("one_hot")).alias("pos", "flag"))
            .filter("flag = 1").select("row_id", "pos"))


def _enriched(spark, sf) -> DataFrame:
    """Enriched rows that leave their text in the scan."""
    rows = enrich.code_features(with_ids(code_view(spark, sf, label=False)))
    lean = rows.withColumn("code_token_count", X.token_count("code")).drop("code", "cve_number")
    return enrich.duplicate_counts(lean)


_META = _SLIM.format("enriched") + rf""",
  numbers AS (SELECT row_id, 'language_' || language AS h1, 'dataset_' || dataset AS h2, 'cwe_id_slim_' || cwe_id_slim AS h3,
  [cast({tokens_sql('code')} AS DOUBLE),
   coalesce(try_cast(nullif(regexp_extract(cve_id, '(?i)CVE-(\d{{4}})-(\d+)', 2), '') AS DOUBLE), 0),
   code_len, code_lines, coalesce(cve_year, 0), coalesce(year_count, 0), code_dup_count, coalesce(code_year_dup_count, 0)]::DOUBLE[] AS nums
  FROM slim)"""
_CELLS = """cells AS (SELECT row_id, unnest(['code_token_count', 'cve_number', 'code_len', 'code_lines', 'cve_year', 'year_count',
    'code_dup_count', 'code_year_dup_count']) AS feature, unnest(nums) AS value FROM numbers
  UNION ALL SELECT row_id, unnest([h1, h2, h3]), 1.0 FROM numbers)"""


@query(with_sql(VIEW_SQL, IDS_SQL, ENRICHED_SQL, _META, _CELLS) + "SELECT row_id, feature, value FROM cells WHERE value <> 0")
def meta_features(spark, sf):
    """All non-zero cells of the feature table, in long form."""
    numbers = [c for c in C.NUMERIC_FEATURES if c != "cve_number"]
    rows = written_once(
        _enriched(spark, sf).select("row_id", "language", "dataset", "cve_id", "cwe_id", *numbers), "enriched")
    wide, names = features.meta_features(rows, MIN_COUNT)
    cells = F.array(*[F.struct(F.lit(n).alias("feature"), F.col(f"`{n}`").cast("double").alias("value")) for n in names])
    return wide.select("row_id", F.inline(cells)).filter("value <> 0")


@query(with_sql(VIEW_SQL, IDS_SQL, ENRICHED_SQL, _META, _CELLS) + "SELECT row_id, feature, value FROM cells WHERE value <> 0")
def meta_vector(spark, sf):
    """The same cells from the sparse vector and its table of names."""
    numbers = [c for c in C.NUMERIC_FEATURES if c != "cve_number"]
    rows = written_once(_enriched(spark, sf).select("row_id", "language", "dataset", "cve_id", "cwe_id", *numbers), "enriched")
    made, names = features.meta_vector(rows, MIN_COUNT)
    cells = made.select("row_id", F.posexplode(vector_to_array("features")).alias("pos", "value")).filter("value <> 0")
    return cells.join(names, "pos").select("row_id", F.col("name").alias("feature"), "value")


@query(VIEW_ENRICHED + f"""SELECT row_id, label, language, dataset, cast(code_len AS DOUBLE) AS code_len,
  cast(code_lines AS DOUBLE) AS code_lines, coalesce(cast(cve_year AS DOUBLE), -1.0) AS cve_year,
  coalesce(cast(year_count AS DOUBLE), -1.0) AS year_count, cast(code_dup_count AS DOUBLE) AS code_dup_count,
  coalesce(cast(code_year_dup_count AS DOUBLE), -1.0) AS code_year_dup_count, coalesce(cve_id, 'CVE-UNKNOWN') AS cve_id,
  coalesce(cwe_id, 'CWE-NONE') AS cwe_id, cast({tokens_sql('code')} AS INTEGER) AS code_token_count
  FROM enriched WHERE label IS NOT NULL AND norm <> ''""")
def prepared_features(spark, sf):
    """The imputed table without its text; counts cover unlabelled rows."""
    return flow.prepare_features(with_ids(code_view(spark, sf)))


# --- samples and splits -----------------------------------------------------

SAMPLE_N = 300


@query(f"SELECT doc_id, lang FROM documents ORDER BY md5('42|' || doc_id) LIMIT {SAMPLE_N}")
def sample_n(spark, sf):
    return sampling.sample_n(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id", SAMPLE_N)


@query(with_sql(VIEW_SQL, IDS_SQL, "filled AS (SELECT row_id, coalesce(cve_id, 'CVE-UNKNOWN') AS cve_id FROM ids)",
                """placed AS (SELECT cve_id, row_number() OVER (ORDER BY md5('42|' || cve_id)) AS place,
    ceil(0.2 * count(*) OVER ()) AS n_test FROM (SELECT DISTINCT cve_id FROM filled))""")
       + "SELECT row_id, cve_id, CASE WHEN place <= n_test THEN 'test' ELSE 'train' END AS split FROM filled JOIN placed USING (cve_id)")
def group_split(spark, sf):
    rows = with_ids(code_view(spark, sf, label=False)).select("row_id", F.coalesce("cve_id", F.lit("CVE-UNKNOWN")).alias("cve_id"))
    return sampling.group_split(rows)


@query("""WITH placed AS (SELECT doc_id, row_number() OVER (ORDER BY md5('222|' || doc_id)) AS place, count(*) OVER () AS n FROM documents),
  edges AS (SELECT *, n - ceil(0.3 * n) AS train_end, n - ceil(0.5 * ceil(0.3 * n)) AS dev_end FROM placed)
SELECT doc_id, CASE WHEN place <= train_end THEN 'train' WHEN place <= dev_end THEN 'dev' ELSE 'test' END AS split FROM edges""")
def row_split(spark, sf):
    return sampling.row_split(table(spark, sf, "documents").select("doc_id"), "doc_id")


# --- balancing --------------------------------------------------------------

def _labelled(spark, sf) -> DataFrame:
    return code_view(spark, sf).filter(F.col("label").isNotNull()).select("row_id", "label", "language")


_LABELLED = "labelled AS (SELECT row_id, label, language FROM v WHERE label IS NOT NULL)"
_SIZES = """sizes AS (SELECT count(*) FILTER (label = 1) AS n_min, count(*) FILTER (label = 0) AS n_max FROM labelled)"""


@query(with_sql(VIEW_SQL, _LABELLED, _SIZES, """placed AS (SELECT *, row_number() OVER (PARTITION BY label
  ORDER BY md5('42|' || row_id)) AS place FROM labelled)""")
       + "SELECT row_id, label, language FROM placed, sizes WHERE place <= n_min")
def undersample(spark, sf):
    return balance.undersample(_labelled(spark, sf))


@query(with_sql(VIEW_SQL, _LABELLED, _SIZES, """placed AS (SELECT *, row_number() OVER (ORDER BY md5('42|' || row_id)) - 1 AS rank
  FROM labelled WHERE label = 1)""", f"""draws AS (SELECT draw, {NUMBER_SQL.format("'42|copy-1|' || draw")} % n_min AS rank
  FROM (SELECT unnest(range(n_max - n_min)) AS draw, n_min FROM sizes))""")
       + """SELECT row_id, label, language, NULL::BIGINT AS draw FROM labelled
  UNION ALL SELECT row_id, label, language, draw FROM draws JOIN placed USING (rank)""")
def oversample(spark, sf):
    return balance.oversample(_labelled(spark, sf))


def points(spark, sf) -> DataFrame:
    """Vectors with label 0 as the minority class 1."""
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("row_id"), "embedding", (F.col("label") == 0).cast("int").alias("label"))


_POINTS = "p AS (SELECT vec_id AS row_id, embedding::DOUBLE[] AS v, cast(label = 0 AS INTEGER) AS label FROM embeddings)"


def _near(source: str, k: int, where: str = "") -> str:
    return f"""(SELECT a.row_id, b.row_id AS neighbour, list_distance(a.v, b.v) AS distance, a.v AS v, b.v AS bv,
    row_number() OVER (PARTITION BY a.row_id ORDER BY list_distance(a.v, b.v), b.row_id) - 1 AS position
    FROM {source} a JOIN {source} b ON a.row_id <> b.row_id QUALIFY position < {k})"""


@query(with_sql(_POINTS) + f"SELECT row_id, cast(position AS INTEGER) AS position, neighbour, round(distance, 6) AS distance FROM {_near('p', 5)}")
def nearest_neighbours(spark, sf):
    return neighbours.exact_neighbours(points(spark, sf), 5).withColumn("distance", F.round("distance", 6))


_SMOTE = ",\n  ".join([
    _POINTS, "m AS (SELECT *, row_number() OVER (ORDER BY md5('42|' || row_id)) - 1 AS rank FROM p WHERE label = 1)",
    f"near AS {_near('m', 5)}",
    "sizes AS (SELECT count(*) FILTER (label = 1) AS n_min, count(*) FILTER (label = 0) AS n_max FROM p)",
    f"""draws AS (SELECT draw, {NUMBER_SQL.format("'42|edge|' || draw")} % (n_min * 5) AS edge,
    cast({NUMBER_SQL.format("'42|step|' || draw")} AS DOUBLE) / 1152921504606846976.0::DOUBLE AS step
    FROM (SELECT unnest(range(n_max - n_min)) AS draw, n_min FROM sizes))""",
    """made AS (SELECT draw, near.row_id AS base, neighbour, step, near.v, bv,
    list_transform(list_zip(near.v, bv), lambda z: z[1] + step * (z[2] - z[1])) AS point
    FROM draws JOIN (SELECT near.*, rank FROM near JOIN m USING (row_id)) near ON near.rank * 5 + near.position = draws.edge)""",
])


@query("WITH " + _SMOTE + """ SELECT draw, base, neighbour, round(step, 6) AS step, cast(pos - 1 AS INTEGER) AS pos,
  round(point[pos], 6) AS value FROM (SELECT *, unnest(range(1, len(point) + 1)) AS pos FROM made)""")
def smote(spark, sf):
    made = balance.smote_draws(points(spark, sf))
    return made.select("draw", "base", "neighbour", F.round("step", 6).alias("step"),
                       F.posexplode("embedding").alias("pos", "value")).withColumn("value", F.round("value", 6))


def _links(source: str) -> str:
    return f"""near1 AS {_near(source, 1)},
  links AS (SELECT a.row_id AS a, a.neighbour AS b FROM near1 a JOIN near1 b ON a.neighbour = b.row_id AND b.neighbour = a.row_id
    JOIN {source} x ON x.row_id = a.row_id JOIN {source} y ON y.row_id = a.neighbour
    WHERE a.row_id < a.neighbour AND x.label <> y.label)"""


@query(with_sql(_POINTS, _links("p")) + "SELECT a, b FROM links")
def tomek_links(spark, sf):
    return balance.tomek_links(points(spark, sf))


@query("WITH " + _SMOTE + """, grown AS (SELECT cast(row_id AS VARCHAR) AS row_id, v, label FROM p
  UNION ALL SELECT 'smote:' || draw, point, 1 FROM made), """ + _links("grown") + """
SELECT row_id, label FROM grown WHERE row_id NOT IN (SELECT a FROM links UNION ALL SELECT b FROM links)""")
def smote_tomek(spark, sf):
    return balance.smote_tomek(points(spark, sf)).select("row_id", "label")


@query(VIEW + """SELECT count(*) FILTER (label = 0) AS negatives, count(*) FILTER (label = 1) AS positives,
  count(DISTINCT label) AS classes, round(cast(count(*) FILTER (label = 0) AS DOUBLE) / count(*) FILTER (label = 1), 6) AS ratio FROM v""")
def imbalance_ratio(spark, sf):
    return metrics.imbalance_ratio(code_view(spark, sf)).withColumn("ratio", F.round("ratio", 6))


@query(with_sql(VIEW_SQL, _LABELLED, _SIZES) + """SELECT row_id, label,
  round(CASE WHEN label = 1 THEN cast(n_max AS DOUBLE) / n_min ELSE 1.0 END, 6) AS weight FROM labelled, sizes""")
def class_weights(spark, sf):
    rows = _labelled(spark, sf)
    sizes = balance.class_sizes(rows)
    return rows.select("row_id", "label", F.round(balance.class_weight("label", sizes[0] / sizes[1]), 6).alias("weight"))


# --- metrics ----------------------------------------------------------------

def scored(spark, sf) -> DataFrame:
    return code_view(spark, sf).filter(F.col("label").isNotNull()).select(
        "label", F.col("pred").alias("prediction"), "pred_b", "score_a", "score_b", "language")


_SCORED = "s AS (SELECT label, pred AS prediction, pred_b, score_a, score_b, language FROM v WHERE label IS NOT NULL)"


def _scores_sql(source: str, keys: str) -> str:
    """Metrics over a relation with tp, fp, fn, tn."""
    p, r = "coalesce(tp / nullif(tp + fp, 0), 0)", "coalesce(tp / nullif(tp + fn, 0), 0)"
    return f"""SELECT {keys} tp, fp, fn, tn, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy,
  round({p}, 6) AS precision, round({r}, 6) AS recall, round(coalesce(2 * {p} * {r} / nullif({p} + {r}, 0), 0), 6) AS f1 FROM {source}"""


def _outcomes(y: str, p: str) -> str:
    return (f"count(*) FILTER ({y} AND {p}) AS tp, count(*) FILTER (NOT {y} AND {p}) AS fp, "
            f"count(*) FILTER ({y} AND NOT {p}) AS fn, count(*) FILTER (NOT {y} AND NOT {p}) AS tn")


def _rounded(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


SCORE_COLUMNS = ["accuracy", "precision", "recall", "f1"]


@query(with_sql(VIEW_SQL, _SCORED, f"c AS (SELECT language, {_outcomes('(label = 1)', '(prediction = 1)')} FROM s GROUP BY language)")
       + _scores_sql("c", "language,"))
def binary_metrics(spark, sf):
    return _rounded(metrics.binary_metrics(scored(spark, sf), ["language"]), SCORE_COLUMNS)


@query(with_sql(VIEW_SQL, _SCORED) + """SELECT label, count(*) FILTER (prediction = 0) AS pred_0,
  count(*) FILTER (prediction = 1) AS pred_1 FROM s GROUP BY label""")
def confusion(spark, sf):
    return metrics.confusion(scored(spark, sf))


@query(with_sql(VIEW_SQL, _SCORED, """k AS (SELECT unnest([0, 1]) AS c),
  c1 AS (SELECT c, count(*) FILTER (label = c AND prediction = c) AS tp, count(*) FILTER (prediction = c) AS pp,
    count(*) FILTER (label = c) AS support FROM k, s GROUP BY c),
  c2 AS (SELECT c, support, coalesce(tp / nullif(pp, 0), 0) AS p, coalesce(tp / nullif(support, 0), 0) AS r, tp FROM c1),
  c3 AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f FROM c2),
  r AS (SELECT cast(c AS VARCHAR) AS class, p, r, f, support FROM c3
    UNION ALL SELECT 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support), sum(support) FROM c3
    UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(support) FROM c3
    UNION ALL SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support),
      sum(f * support) / sum(support), sum(support) FROM c3)""")
       + "SELECT class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, cast(support AS BIGINT) AS support FROM r")
def class_report(spark, sf):
    return _rounded(metrics.class_report(scored(spark, sf)), ["precision", "recall", "f1"])


_CURVE = """points AS (SELECT score_a AS threshold, count(*) FILTER (label = 1) AS pos, count(*) AS n FROM s GROUP BY score_a),
  curve AS (SELECT threshold, cast(sum(pos) OVER w AS BIGINT) AS tp, cast(sum(n) OVER w AS BIGINT) AS cn, pos,
    cast(sum(pos) OVER () AS BIGINT) AS total FROM points WINDOW w AS (ORDER BY threshold DESC))"""


@query(with_sql(VIEW_SQL, _SCORED, _CURVE) + """SELECT threshold, tp, cn - tp AS fp, round(tp / cn, 6) AS precision,
  round(tp / total, 6) AS recall FROM curve""")
def pr_curve(spark, sf):
    return _rounded(metrics.pr_curve(scored(spark, sf), score="score_a").drop("new_tp"), ["precision", "recall"])


@query(with_sql(VIEW_SQL, _SCORED, _CURVE) + "SELECT round(sum(pos * tp / cn) / max(total), 6) AS average_precision FROM curve")
def average_precision(spark, sf):
    return _rounded(metrics.average_precision(metrics.pr_curve(scored(spark, sf), score="score_a")), ["average_precision"])


_GRID = f"""g AS (SELECT wa.w AS w_a, wb.w AS w_b FROM (SELECT unnest([1, 2, 3, 4]) AS w) wa, (SELECT unnest([1, 2, 3, 4]) AS w) wb),
  voted AS (SELECT w_a, w_b, label, (score_a * w_a + score_b * w_b) / (w_a + w_b)
    > ((1 - score_a) * w_a + (1 - score_b) * w_b) / (w_a + w_b) AS vote FROM s, g),
  c AS (SELECT w_a, w_b, {_outcomes('(label = 1)', 'vote')} FROM voted GROUP BY w_a, w_b)"""


def _grid(spark, sf) -> DataFrame:
    rows = scored(spark, sf).withColumns({"not_a": 1 - F.col("score_a"), "not_b": 1 - F.col("score_b")})
    return metrics.weight_grid(rows, ("not_a", "score_a"), ("not_b", "score_b"))


@query(with_sql(VIEW_SQL, _SCORED, _GRID) + _scores_sql("c", "w_a, w_b,"))
def weight_grid(spark, sf):
    return _rounded(_grid(spark, sf), SCORE_COLUMNS)


@query(with_sql(VIEW_SQL, _SCORED, _GRID, f"m AS ({_scores_sql('c', 'w_a, w_b,')})")
       + "SELECT w_a, w_b, f1 FROM m ORDER BY f1 DESC, w_a, w_b LIMIT 1")
def best_weights(spark, sf):
    return _rounded(metrics.best_weights(_grid(spark, sf)), ["f1"])


_F1 = "coalesce(2 * count(*) FILTER (label = 1 AND {0} = 1) / nullif(count(*) FILTER (label = 1) + count(*) FILTER ({0} = 1), 0), 0)"


@query(with_sql(VIEW_SQL, _SCORED, f"f AS (SELECT {_F1.format('prediction')} AS b, {_F1.format('pred_b')} AS t FROM s)")
       + """SELECT round(b, 6) AS base_f1, round(t, 6) AS tuned_f1,
  round(CASE WHEN b > 0 THEN 100 * (t - b) / b END, 6) AS improvement FROM f""")
def improvement(spark, sf):
    return _rounded(metrics.improvement(scored(spark, sf), "prediction", "pred_b"), ["base_f1", "tuned_f1", "improvement"])


def _by_model(spark, sf) -> DataFrame:
    """Two rule predictions as competing models, in one pass."""
    rows = scored(spark, sf).select("label", F.inline(F.array(
        F.struct(F.lit("long_text").alias("model"), F.col("prediction")),
        F.struct(F.lit("medium_text").alias("model"), F.col("pred_b").alias("prediction")))))
    return _rounded(metrics.binary_metrics(rows, ["model"]), SCORE_COLUMNS)


_MODELS = f"""both_models AS (SELECT label, 'long_text' AS model, prediction FROM s UNION ALL SELECT label, 'medium_text', pred_b FROM s),
  c AS (SELECT model, {_outcomes('(label = 1)', '(prediction = 1)')} FROM both_models GROUP BY model)"""


@query(with_sql(VIEW_SQL, _SCORED, _MODELS) + _scores_sql("c", "model,"))
def model_ranking(spark, sf):
    return metrics.ranked(_by_model(spark, sf))


@query(with_sql(VIEW_SQL, _SCORED, _MODELS, f"m AS ({_scores_sql('c', 'model,')})")
       + "SELECT * FROM m ORDER BY f1 DESC, model LIMIT 1")
def model_winner(spark, sf):
    return metrics.winner(_by_model(spark, sf))


# --- vectors ----------------------------------------------------------------

_E = "e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v, unnest(range(1, len(embedding) + 1)) AS pos FROM embeddings)"


@query(with_sql(_E) + """SELECT label, cast(pos - 1 AS INTEGER) AS pos,
  round(coalesce(sum(v[pos]) FILTER (vec_id % 3 <> 0), 0) / greatest(count(*) FILTER (vec_id % 3 <> 0), 1), 6) AS value
  FROM e GROUP BY label, pos""")
def mean_pool(spark, sf):
    rows = table(spark, sf, "embeddings").withColumn("mask", (F.col("vec_id") % 3 != 0).cast("int"))
    return embed.mean_pool_rows(rows, "label", "embedding", "mask").select(
        "label", F.posexplode("pooled").alias("pos", "value")).withColumn("value", F.round("value", 6))


@query(with_sql(_E) + """SELECT vec_id, cast(pos - 1 AS INTEGER) AS pos, round(CASE vec_id % 3 WHEN 0 THEN 0
  WHEN 1 THEN v[pos] ELSE (v[pos] + v[len(v) + 1 - pos]) / 2 END, 6) AS value FROM e""")
def mean_pool_tokens(spark, sf):
    """Two vectors in each row stand for its tokens; none, one or both count."""
    use = F.col("vec_id") % 3
    rows = table(spark, sf, "embeddings").select(
        "vec_id", F.array("embedding", F.reverse("embedding")).alias("hidden"),
        F.array((use >= 1).cast("int"), (use == 2).cast("int")).alias("mask"))
    return rows.select("vec_id", F.posexplode(embed.mean_pool("hidden", "mask")).alias("pos", "value")).withColumn(
        "value", F.round("value", 6))


@query(with_sql(VIEW_SQL, IDS_SQL, ENRICHED_SQL, _SLIM.format("enriched"), rf"""langs AS (SELECT DISTINCT language FROM v),
  onehot AS (SELECT row_id, list(cast(s.language = l.language AS DOUBLE) ORDER BY l.language) AS oh FROM slim s, langs l GROUP BY row_id),
  m AS (SELECT vec_id AS row_id, list_concat(list_concat(embedding::DOUBLE[], oh),
    [code_len, code_lines, coalesce(cve_year, 0), coalesce(year_count, 0)]::DOUBLE[]) AS f
    FROM embeddings JOIN slim ON vec_id = slim.row_id JOIN onehot ON onehot.row_id = vec_id),
  x AS (SELECT row_id, f, unnest(range(1, len(f) + 1)) AS pos FROM m)""")
       + """SELECT row_id, count(*) AS size, round(sum(f[pos]), 4) AS total, round(sum(pos * f[pos]), 4) AS placed FROM x GROUP BY row_id""")
def assemble_join(spark, sf):
    """Embeddings joined to tabular features by key, checked by sums that
    change when a value is at another place."""
    vectors = table(spark, sf, "embeddings").select(F.col("vec_id").alias("row_id"), "embedding")
    wide, names = features.one_hot(_enriched(spark, sf), ["language"],
                                   ["row_id", "code_len", "code_lines", "cve_year", "year_count"])
    names = [*names, "code_len", "code_lines", "cve_year", "year_count"]
    x = features.assemble(vectors, wide, names).select(
        "row_id", F.posexplode(vector_to_array("features")).alias("pos", "x"))
    return x.groupBy("row_id").agg(F.count(F.lit(1)).alias("size"), F.round(F.sum("x"), 4).alias("total"),
                                   F.round(F.sum((F.col("pos") + 1) * F.col("x")), 4).alias("placed"))


def vectors(spark, sf) -> DataFrame:
    """(row_id, features, label) with label 0 as class 1."""
    from pyspark.ml.functions import array_to_vector

    return points(spark, sf).select("row_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"), "label")


@query(with_sql(_E) + """SELECT vec_id AS row_id, cast(pos - 1 AS INTEGER) AS pos,
  round((v[pos] - avg(v[pos]) OVER w) / stddev_pop(v[pos]) OVER w, 4) AS value FROM e WINDOW w AS (PARTITION BY pos)""")
def scale(spark, sf):
    rows = vectors(spark, sf)
    return features.scale(rows, features.fit_scaler(rows)).select(
        "row_id", F.posexplode(vector_to_array("scaled")).alias("pos", "value")).withColumn("value", F.round("value", 4))


@query("""SELECT vec_id AS row_id, round(embedding[6]::DOUBLE, 6) AS first, round(embedding[2]::DOUBLE, 6) AS second,
  round(embedding[64]::DOUBLE, 6) AS third FROM embeddings""")
def feature_slice(spark, sf):
    kept = features.keep_features(vectors(spark, sf), [5, 1, 63]).withColumn("x", vector_to_array("selected"))
    return kept.select("row_id", *[F.round(F.get("x", F.lit(i)), 6).alias(n) for i, n in enumerate(["first", "second", "third"])])


@query(f"SELECT doc_id AS row_id, 768 AS size, cast({tokens_sql('text')} > 0 AS INTEGER) AS total FROM documents")
def embed_text(spark, sf):
    """Hashed embedding of whole texts; token shares sum to one."""
    rows = table(spark, sf, "documents").select(F.col("doc_id").alias("row_id"), F.col("text").alias("code"))
    return embed.hashed_embedding(rows).select(
        "row_id", F.size("embedding").alias("size"),
        F.round(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x)).cast("int").alias("total"))


def letter_shares():
    """Encoder for the batch hook: shares of eight letters in each text."""
    def encode(texts: list[str]) -> np.ndarray:
        return np.array([[t.count(c) / max(len(t), 1) for c in "aeinorst"] for t in texts])

    return encode


@query("""SELECT doc_id AS row_id, cast(pos - 1 AS INTEGER) AS pos, round(cast(
  (length(text) - length(replace(text, substr('aeinorst', pos, 1), ''))) / greatest(length(text), 1) AS FLOAT)::DOUBLE, 4) AS value
  FROM documents, (SELECT cast(unnest(range(1, 9)) AS INTEGER) AS pos)""")
def encode_batches(spark, sf):
    rows = table(spark, sf, "documents").select(F.col("doc_id").alias("row_id"), "text")
    return embed.encode_batches(rows, "text", ["row_id"], letter_shares).select(
        "row_id", F.posexplode("embedding").alias("pos", "value")).withColumn("value", F.round(F.col("value").cast("double"), 4))


@query("""SELECT d.doc_id AS row_id, d.lang, len(e.embedding) AS size, round(e.embedding[1]::DOUBLE, 6) AS head
  FROM documents d JOIN embeddings e ON d.doc_id = e.vec_id""")
def attach_embeddings(spark, sf):
    rows = table(spark, sf, "documents").select(F.col("doc_id").alias("row_id"), "lang")
    ready = table(spark, sf, "embeddings").select(F.col("vec_id").alias("row_id"), "embedding")
    return embed.attach_embeddings(rows, ready).select(
        "row_id", "lang", F.size("embedding").cast("bigint").alias("size"),
        F.round(F.get("embedding", F.lit(0)).cast("double"), 6).alias("head"))


@query("SELECT count(*) AS vectors, 5 * count(*) AS edges, true AS enough FROM embeddings")
def neighbour_graph(spark, sf):
    """The graph of near neighbours: its edges, and whether it holds at least
    0.9 of the exact ones."""
    rows = points(spark, sf)
    made = written_once(graph.neighbour_graph(rows, 5), "graph")
    found = graph.recall(made, rows, 5)
    return made.agg(F.count_distinct("row_id").alias("vectors"), F.count(F.lit(1)).alias("edges")).withColumn("enough", F.lit(found >= 0.9))
