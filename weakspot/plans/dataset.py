"""Flow: staged collections to one enriched, imputed table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from weakspot import constants as C
from weakspot.functions import text as X
from weakspot.operators import clean, enrich, features, sampling
from weakspot.session import written_once
from weakspot.sources.collections import combine, load_paired, load_single, load_targeted


def build(paired: DataFrame | None, single: DataFrame | None, targeted: DataFrame | None = None,
          tree: DataFrame | None = None, id_column: str | None = None) -> DataFrame:
    """All collections normalised, their ids unified, united."""
    return combine([
        None if paired is None else load_paired(paired, id_column=id_column),
        None if single is None else load_single(single, id_column=id_column),
        load_targeted(targeted, id_column=id_column),
        tree,
    ])


def prepare(table: DataFrame, dimension: DataFrame) -> DataFrame:
    """Cleaned, sparse columns dropped, enriched, imputed."""
    kept = clean.drop_sparse(clean.drop_blank(clean.drop_missing(table, ["code"])),
                             protect=["row_id", "code", "label", "language", "dataset", "cve_id", "cwe_id"])
    return clean.impute(enrich.enrich(kept, dimension))


def prepare_features(table: DataFrame) -> DataFrame:
    """The prepared table without its text, for feature building.

    The same rows and values as ``prepare``, plus the token count. All that
    depends on the text is derived in its scan, so only narrow rows are ever
    shuffled; embeddings read the text where it lies and join on ``row_id``.
    """
    rows = clean.drop_blank(clean.drop_missing(table, ["code"]))
    derived = enrich.code_features(rows).withColumn("code_token_count", X.token_count("code")).drop("code")
    counts = clean.drop_missing(enrich.duplicate_counts(derived), ["label"])
    kept = [c for c in C.IMPUTE_COLUMNS if c != "code"]
    return clean.fill_missing(counts.withColumn("label", X.checked_int("label", "label"))).select(
        "row_id", *kept, "code_token_count")


def split_features(prepared: DataFrame, rows: int | None = None, min_count: int = 50) -> tuple[DataFrame, list[str]]:
    """Sampled if asked, group split, tabular features with their names.

    Takes the result of ``prepare`` or of ``prepare_features``. The narrow
    columns are written first, since the sample, the split and the category
    list each read them again and must not scan the text each time.
    """
    narrow = written_once(features.numeric_features(prepared).drop("code"), "prepared")
    sampled = narrow if rows is None else sampling.sample_n(narrow, "row_id", rows)
    split = sampling.group_split(sampled, "cve_id")
    return features.meta_features(split, min_count, keep=["label", "split"])
