"""Stored models, resumable vectors, pooled and trained token vectors."""

import json
import re

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F
from test_models import learnable

from weakspot.models.stored import Classifier
from weakspot.operators import embed
from weakspot.operators.store import VectorStore


@pytest.mark.parametrize("kind, settings", [
    ("svm", {"c": 0.02}), ("ada_boost", {"rounds": 3}), ("extra_trees", {"trees": 5, "depth": 4}),
    ("boosting", {"rounds": 3, "leaves": 5, "depth": None, "prior": True})])
def test_saved_stages_score_alike(spark, tmp_path, kind, settings):
    _, _, df = learnable(spark, 150, 4)
    stage = Classifier(kind=kind, settings=json.dumps(settings))
    Pipeline(stages=[stage]).write().save(str(tmp_path / "plain"))
    again = Pipeline.load(str(tmp_path / "plain")).getStages()[0]
    assert again.getOrDefault("settings") == json.dumps(settings) and again.uid == stage.uid
    fitted = Pipeline(stages=[stage]).fit(df)
    fitted.write().save(str(tmp_path / "fitted"))
    loaded = PipelineModel.load(str(tmp_path / "fitted"))
    kept = [c for c in ("row_id", "prediction", "margin") if c in fitted.transform(df).columns]
    assert loaded.transform(df).select(kept).exceptAll(fitted.transform(df).select(kept)).isEmpty()
    assert loaded.transform(df).select("prediction").distinct().count() == 2


def encode(rows):
    return rows.select("row_id", F.array(F.col("x").cast("double") * 2).alias("vector"))


def test_a_store_goes_on_where_it_stopped(spark, tmp_path):
    rows = spark.createDataFrame([(i, i * 10) for i in range(100)] + [(None, 5)], "row_id long, x long").repartition(4)
    store = VectorStore(spark, str(tmp_path / "s"))
    assert store.read() is None and store.write(rows, encode, parts=5, most=2) == 3
    first = store.read().count()
    assert 0 < first < 100

    def broken(part):
        encode(part).write.parquet(f"{store.path}/data/orphan")  # a folder that was never published
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        store.write(rows, broken)
    seen = []

    def counted(part):
        seen.append(part.count())
        return encode(part)

    again = VectorStore(spark, str(tmp_path / "s"))
    assert again.read().count() == first and again.write(rows, counted, parts=99) == 0
    assert sum(seen) == 100 - first  # nothing is encoded twice
    assert sorted((r.row_id, r.vector) for r in again.read().collect()) == [(i, [i * 20.0]) for i in range(100)]
    assert again.vacuum() == 1 and again.read().count() == 100
    more = rows.union(spark.createDataFrame([(1000, 1), (-5, 2)], "row_id long, x long"))
    assert again.catch_up(more, encode) == 2 and again.catch_up(more, encode) == 0 and again.read().count() == 102
    with pytest.raises(RuntimeError, match="another writer"):
        again._publish("ranges.json", {})


def test_a_store_encodes_ranges_together(spark, tmp_path):
    rows = spark.createDataFrame([(i, i * 10) for i in range(100)] + [(None, 5)], "row_id long, x long").repartition(4)
    store, seen = VectorStore(spark, str(tmp_path / "w")), []

    def counted(part):
        seen.append(part.count())
        return encode(part).filter("row_id < 20 OR row_id >= 40")  # a range may have no vectors

    assert store.write(rows, counted, parts=5, most=2, together=4) == 3 and len(seen) == 1
    assert store.write(rows, counted, together=2) == 0 and len(seen) == 3 and sum(seen) == 100
    assert sorted(store.finished()) == [f"range-{i:05d}" for i in range(5)] and store.vacuum() == 0
    assert sorted((r.row_id, r.vector) for r in store.read().collect()) == [(i, [i * 20.0]) for i in range(100) if not 20 <= i < 40]
    assert store.read().columns == ["row_id", "vector"] and store.catch_up(rows.filter("row_id >= 40"), encode) == 0


def test_a_store_by_text_keys(spark, tmp_path):
    rows = spark.range(50).select(F.md5(F.col("id").cast("string")).alias("row_id"), F.col("id").alias("x"))
    store = VectorStore(spark, str(tmp_path / "t"))
    assert store.write(rows, encode, parts=4) == 0 and store.read().count() == 50 == store.read().select("row_id").distinct().count()
    empty = VectorStore(spark, str(tmp_path / "e"))
    assert empty.write(rows.limit(0), encode, parts=4) == 0 and empty.read() is None


def test_pooled_vectors(spark):
    table = spark.createDataFrame([("aa", [1.0, 0.0]), ("bb", [0.0, 2.0])], "token string, vector array<double>")
    rows = spark.createDataFrame([(1, "aa bb aa zz"), (2, "zz"), (3, None), (4, "bb aa aa")], "row_id int, code string")
    got = {r.row_id: r.embedding for r in embed.pooled_embedding(rows, table).collect()}
    assert {i: pytest.approx(v) for i, v in {1: [2 / 3, 2 / 3], 4: [2 / 3, 2 / 3]}.items()} == got
    assert embed.pooled_embedding(rows, table, max_tokens=1).filter("row_id = 4").first().embedding == [0.0, 2.0]


def test_trained_vectors_join_words_of_one_context(spark):
    r = np.random.default_rng(1)
    groups = [["red", "green", "blue"], ["one", "two", "three"]]
    rows = [(i, " ".join(r.choice(groups[i % 2], 12))) for i in range(300)]
    df = spark.createDataFrame(rows, "row_id int, code string")
    made = embed.train_vectors(df, dim=4, least=2)
    got = {t.token: np.array(t.vector) for t in made.collect()}
    assert set(got) == {w for g in groups for w in g}

    def cosine(a, b):
        return got[a] @ got[b] / np.linalg.norm(got[a]) / np.linalg.norm(got[b])

    assert min(cosine("red", "green"), cosine("one", "three")) > 0.9 and abs(cosine("red", "two")) < 0.5
    assert embed.train_vectors(df.limit(0)).count() == 0


def test_pooled_embedding_by_a_large_table(spark, monkeypatch):
    """The same vectors by broadcast and by shuffle, by plain sums and by the summarizer, from the front and from whole texts."""
    from weakspot.operators.embed import VectorTable

    texts = ["a bb a ccc", "bb " * 300 + "ccc", "x" * 5000 + " a", "==" * 900 + "a", " " * 3000 + "a bb", "zz", "", None, "é! a", "a" + " b" * 255 + " ccc"]
    rows = spark.createDataFrame([*enumerate(texts), (0, "ccc ccc"), (None, "a bb")], "row_id long, code string")
    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("bb", [0.0, 2.0]), ("ccc", [4.0, 8.0]), ("==", [16.0, 0.0]), ("!", None), (None, [9.0, 9.0])],
                                    "token string, vector array<double>")
    known = {r.token: r.vector for r in vectors.collect() if r.token and r.vector}
    want: dict = {}
    for key, text in [*enumerate(texts), (0, "ccc ccc"), (None, "a bb")]:
        want.setdefault(key, []).extend(known[t] for t in re.findall(r"[A-Za-z_]\w+|\d+|==|!=|<=|>=|\S", text or "")[:256] if t in known)
    want = {k: [sum(c) / len(v) for c in zip(*v)] for k, v in want.items() if v}
    for small, width, hot in ((None, 64, 4096), (False, 64, 4096), (False, 64, 2), (False, 1, 2)):
        monkeypatch.setattr(embed, "PLAIN_WIDTH", width)
        monkeypatch.setattr(embed, "HOT_TOKENS", hot)
        if small is not None:
            monkeypatch.setattr(embed, "is_small", lambda df: False)
        got = embed.pooled_embedding(rows, VectorTable.of(vectors))
        assert {r.row_id: r.embedding for r in got.collect()} == want
