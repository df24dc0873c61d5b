"""Recursive scan of source files, one row for each file."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weakspot import constants as C
from weakspot.functions import text as X
from weakspot.sources.tables import empty_core


def scan_tree(
    spark: SparkSession, root: str, dataset: str = C.TREE_DATASET, languages: dict[str, str] = C.TREE_LANGUAGES
) -> DataFrame:
    """Labelled files below ``root``; an absent root gives an empty table.

    The label is decided by the file name, so the glob admits only names
    with ``bad`` or ``good`` in them and no other file is ever opened.
    """
    suffixes = ",".join(s.lstrip(".") for s in languages)
    named = "{[bB][aA][dD],[gG][oO][oO][dD]}"
    try:
        files = (spark.read.format("binaryFile")
                 .option("recursiveFileLookup", True)
                 .option("pathGlobFilter", f"*{named}*.{{{suffixes}}}")
                 .load(root))
    except AnalysisException:
        return empty_core(spark)
    name = F.element_at(F.split("path", "/"), -1)
    return (
        files.select(F.col("path").alias("row_id"), name.alias("name"), "content")
        .select(
            "row_id",
            X.unify_newlines(X.decode_dropping_invalid("content")).alias("code"),
            X.label_from_name("name").alias("label"),
            X.language_from_name("name", languages).alias("language"),
            F.lit(dataset).alias("dataset"),
            F.lit(None).cast("string").alias("cve_id"),
            X.extract_cwe("name").alias("cwe_id"),
        )
        .filter(F.col("label").isNotNull() & X.not_blank("code"))
    )
