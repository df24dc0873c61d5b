"""Column reports and value counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weakspot import constants as C
from weakspot.functions import numeric as N
from weakspot.functions import text as X


def value_counts(df: DataFrame, column: str, keep_null: bool = False) -> DataFrame:
    rows = df if keep_null else df.filter(F.col(column).isNotNull())
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def top_values(df: DataFrame, column: str, n: int, keep_null: bool = True) -> DataFrame:
    """Most frequent values; ties in value order."""
    return (value_counts(df, column, keep_null)
            .orderBy(F.desc("count"), F.asc_nulls_first(column)).limit(n))


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)


def null_summary(df: DataFrame) -> DataFrame:
    """Missing count and percent by column, largest first."""
    types = dict(df.dtypes)
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(N.is_missing(c, types[c])).alias(c) for c in df.columns],
    )
    return (counts.unpivot("__rows", df.columns, "column", "null_count")
            .select("column", "null_count",
                    (F.lit(100.0) * F.try_divide("null_count", "__rows")).alias("null_percent"))
            .orderBy(F.desc("null_count"), "column"))


def column_profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Type, distinct values, missing values for every column.

    Columns are unpivoted to (column, hash pair), so one two-step count
    distinct serves all of them: repeats are dropped before the shuffle and
    long text never travels. ``approximate`` uses a sketch instead.
    """
    types = dict(df.dtypes)
    cells = [
        F.struct(
            F.lit(i).alias("position"),
            F.when(~N.is_missing(c, types[c]), F.struct(*X.content_key(F.col(f"`{c}`").cast("string")))).alias("value"),
        )
        for i, c in enumerate(df.columns)
    ]
    distinct = F.approx_count_distinct("value") if approximate else F.count_distinct("value")
    counted = (df.select(F.inline(F.array(*cells)))
               .groupBy("position")
               .agg(distinct.alias("unique_count"),
                    F.count_if(F.col("value").isNull()).alias("null_count"),
                    F.count(F.lit(1)).alias("row_count")))
    names = F.array(*[F.lit(c) for c in df.columns])
    dtypes = F.array(*[F.lit(types[c]) for c in df.columns])
    return counted.select(
        F.get(names, F.col("position")).alias("column"),
        F.get(dtypes, F.col("position")).alias("dtype"),
        "unique_count", "null_count",
        (F.col("row_count") - F.col("null_count")).alias("non_null_count"),
        N.percent_text(F.try_divide("null_count", "row_count")).alias("null_percentage"),
    )


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def first_rows(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    return df.orderBy(key).limit(n)


def with_nulls_only(profile: DataFrame) -> DataFrame:
    return profile.filter(F.col("null_count") > 0)


def text_profile(df: DataFrame, column: str) -> DataFrame:
    """Distinct and missing counts of one text column after token cleanup."""
    cleaned = X.null_when(X.strip(F.col(column).cast("string")), C.FILL_TOKENS)
    return (df.select(cleaned.alias("value"))
            .agg(F.count_distinct(F.when(F.col("value").isNotNull(), F.struct(*X.content_key("value"))))
                  .alias("unique_count"),
                 F.count_if(F.col("value").isNull()).alias("null_count"),
                 F.count(F.lit(1)).alias("__rows"))
            .select(
                F.lit(column).alias("column"), "unique_count", "null_count",
                N.percent_text(F.try_divide("null_count", "__rows")).alias("null_percentage")))
