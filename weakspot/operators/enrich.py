"""Derived ids, sizes, duplicate counts and descriptions."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weakspot import constants as C
from weakspot.functions import text as X
from weakspot.operators.spread import join_group_values, lookup_join
from weakspot.session import written_once
from weakspot.sources.tables import require_columns

DUPLICATE_KEYS = ["code_key", "__key2"]


def code_features(df: DataFrame) -> DataFrame:
    """Parsed CVE parts, code length, lines and content key; no shuffle."""
    stripped = df.withColumn("__code", X.strip("code"))  # once, not once for each feature
    key, second = X.content_key("__code")
    present = F.col("__code").isNotNull()
    return stripped.withColumns({
        "code_key": F.when(present, key),
        "__key2": F.when(present, second),
        "code_len": F.length("__code"),
        "code_lines": X.line_count("__code"),
        "cve_year": X.cve_year("cve_id"),
        "cve_number": X.cve_number("cve_id"),
    }).drop("__code")


def duplicate_counts(df: DataFrame, row_key: str = "row_id") -> DataFrame:
    """Rows for the same year, the same code, and the same code and year.

    All three come from one pre-aggregated count by (code, year), written
    once. A code has at most 10,000 four-digit years, so its years fit one map,
    and one join on the code attaches two of the counts; the yearly totals are
    broadcast under the same bound. Only codes seen more than once enter the
    join. A row with NULL year has NULL year counts.

    Without ``code`` the derived rows are written first, so the text behind
    them is scanned once. The text itself is shuffled only when the caller
    keeps it; drop it first where the counts are all that is wanted.
    """
    year = F.col("cve_year")
    if "code" not in df.columns:
        df = written_once(df, "derived")
    pairs = written_once(df.groupBy(*DUPLICATE_KEYS, "cve_year").agg(F.count(F.lit(1)).alias("n")), "pairs")
    per_year = F.map_from_entries(F.collect_list(F.when(year.isNotNull(), F.struct("cve_year", "n"))))
    repeated = (pairs.filter(F.col("code_key").isNotNull()).groupBy(*DUPLICATE_KEYS)
                .agg(F.sum("n").alias("__dups"), per_year.alias("__years"))
                .filter(F.col("__dups") > 1))
    years = pairs.filter(year.isNotNull()).groupBy("cve_year").agg(F.sum("n").alias("year_count"))
    joined = join_group_values(
        df.join(F.broadcast(years), "cve_year", "left"), repeated,
        keys=DUPLICATE_KEYS, values=["__dups", "__years"], size="__dups", row_key=row_key,
    )
    has_code = F.col("code_key").isNotNull()
    return joined.withColumns({
        "code_dup_count": F.when(has_code, F.coalesce("__dups", F.lit(1))),
        "code_year_dup_count": F.when(
            has_code & year.isNotNull(),
            F.coalesce(F.try_element_at("__years", year), F.lit(1))),
    }).drop("__dups", "__years")


def missing_ids(df: DataFrame, dimension: DataFrame, key: str = "cwe_id") -> DataFrame:
    """Distinct ids of the table that the dimension does not hold."""
    ids = df.select(key).filter(F.col(key).isNotNull() & ~F.col(key).isin(C.OTHER_IDS)).distinct()
    return ids.join(dimension.select(key), key, "left_anti")


def with_fixed_rows(dimension: DataFrame) -> DataFrame:
    """The dimension with a description for the catch-all ids.

    Descriptions it already has for them are kept.
    """
    spark = dimension.sparkSession
    fixed = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("cwe_id"), F.lit(C.OTHER_DESCRIPTION).alias("description")) for i in C.OTHER_IDS
    ])))
    return dimension.unionByName(fixed.join(dimension.select("cwe_id"), "cwe_id", "left_anti"))


def describe(df: DataFrame, dimension: DataFrame, row_key: str = "row_id") -> DataFrame:
    """``cwe_description`` by exact id; unknown ids and null words are NULL."""
    require_columns(df, ["cwe_id"])
    names = with_fixed_rows(dimension.select("cwe_id", "description")).select(
        "cwe_id", X.null_when(X.strip("description"), C.FILL_TOKENS).alias("cwe_description"))
    return lookup_join(df, names, "cwe_id", row_key)


def load_dimension(spark: SparkSession, path: str) -> DataFrame:
    """The id dimension; absent means empty, unreadable is an error."""
    try:
        return spark.read.parquet(path).select("cwe_id", "description")
    except AnalysisException as reason:
        if reason.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "cwe_id string, description string")


def extend_dimension(spark: SparkSession, path: str, df: DataFrame, pages: DataFrame, refresh: bool = False) -> DataFrame:
    """Add descriptions of ids the dimension lacks, from stored pages.

    ``pages`` holds (cwe_id, html). Known ids are never parsed again unless
    ``refresh`` rebuilds the dimension; new rows are appended. Several pages
    of one id give one row, with the first description in text order.
    """
    from weakspot.operators.html import describe_pages

    known = load_dimension(spark, path)
    if refresh:
        known = known.limit(0)
    wanted = missing_ids(df, known)
    found = describe_pages(pages.join(wanted, "cwe_id"), "cwe_id", "html")
    found = found.groupBy("cwe_id").agg(F.min("description").alias("description"))
    rows = wanted.join(found, "cwe_id", "left").select("cwe_id", "description")
    rows.write.mode("overwrite" if refresh else "append").parquet(path)
    return spark.read.parquet(path)


def enrich(df: DataFrame, dimension: DataFrame, row_key: str = "row_id") -> DataFrame:
    """Descriptions, parsed ids, sizes and duplicate counts."""
    require_columns(df, ["code", "cve_id", "cwe_id"])
    return describe(duplicate_counts(code_features(df), row_key).drop("__key2"), dimension, row_key)
