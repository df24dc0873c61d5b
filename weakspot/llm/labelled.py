"""Bounded samples of labelled rows to fit a classifier on, and its folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(key: str, parts: int) -> Column:
    """crc32 of the key as text modulo ``parts``; a NULL key counts as ''."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % parts


def sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, most: int, key: str = "doc_id",
           text: str = "text", seed: int = 11) -> tuple[DataFrame, dict[int, int]]:
    """((key, text, label) of at most ``most`` training rows of each label,
    all training rows' counts by label).

    Which rows are taken depends on their key alone. The ids are chosen
    before any text is read, so only the bounded sample carries text.
    """
    known = (labels.groupBy(key).agg(F.max(label).cast("int").alias("y")).filter(train & F.col("y").isin(0, 1) & F.col(key).isNotNull()))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = [F.xxhash64(F.lit(seed), key), F.col(key)]
    chosen = known.filter("y = 0").orderBy(*order).limit(most).unionByName(known.filter("y = 1").orderBy(*order).limit(most))
    # at most 2 * most rows of a key and a label
    rows = docs.select(key, F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(chosen), key)
    return rows, counts
