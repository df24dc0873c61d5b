"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all that the one before it
kept, and returns the columns of ``documents`` (the last one: pieces).
``run`` writes each stage's result as Parquet to the shared folder and reads
it again. Empty tables pass through; NULL texts are empty texts.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weakspot.llm import jaccard, labelled, packing, pii, quality, toxicity
from weakspot.plans.registry import table
from weakspot.session import written_once

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _accepted(spark: SparkSession, docs: DataFrame, sf_dir: str, operator, parts: int, out: int, wanted: int) -> DataFrame:
    """Documents that the classifier, fitted on their labelled rows outside its test fold, predicts as wanted."""
    model = operator.fit(docs, table(spark, sf_dir, "labels"), labelled.fold("doc_id", parts) != out)
    scored = quality.score(docs, model, keep=COLUMNS)
    return scored.filter(F.col("predicted") == wanted).select(*COLUMNS)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of good quality."""
    return _accepted(spark, docs, sf_dir, quality, 3, 1, 1)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't toxic."""
    return _accepted(spark, docs, sf_dir, toxicity, 5, 0, 0)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates.

    Five words and 0.8, as near duplicates are meant in stages. Documents
    without a doc_id have no group and stay.
    """
    groups = jaccard.classes(docs, width=5, percent=80)
    others = groups.filter("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(others, "doc_id", "left_anti").select(*COLUMNS)


def mask_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; n_chars is the new length."""
    return pii.masked(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences of 1,024 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                        public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", keep_quality),
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", one_of_each),
    ("PII", mask_personal),
    ("packing", pack_windows),
]

ORACLE_SQL = None  # fitted models have no SQL; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written_once(stage(spark, docs, sf_dir), "stage-" + name.split()[0].lower())
    return docs
