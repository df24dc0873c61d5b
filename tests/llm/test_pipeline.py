"""The pipeline against its stages done by hand on small tables."""

import corpus_pipeline as pipeline
from test_operators import brute_components

from weakspot.llm import labelled, pii, quality, toxicity

SF = "/root/testdata/sf0.01"


def test_pipeline(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = sorted(docs.collect())
    for operator, parts, out, wanted in ((quality, 3, 1, 1), (toxicity, 5, 0, 0)):
        frame = spark.createDataFrame(rows, docs.schema)
        model = operator.fit(frame, labels, labelled.fold("doc_id", parts) != out)
        scores = model.scores([(r["text"] or "").encode() for r in rows])
        rows = [r for r, s in zip(rows, scores) if (s >= 0.5) == bool(wanted)]
    _, label = brute_components([r["text"] for r in rows], 5, 80)
    rows = [r for i, r in enumerate(rows) if label[i] == i]
    want = {r["doc_id"]: pii.redact(r["text"] or "", pii.find(r["text"] or "")) for r in rows}
    held = docs
    for name, stage in pipeline.STAGES[:-1]:
        held = pipeline.written_once(stage(spark, held, SF), "test-stage")
        assert held.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in held.collect()} == want
    packed = pipeline.STAGES[-1][1](spark, held, SF)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == set(want)


def test_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
