"""Row and column cleaning, imputation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from weakspot import constants as C
from weakspot.functions import numeric as N
from weakspot.functions import text as X
from weakspot.sources.tables import require_columns


def drop_missing(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.na.drop(subset=columns)


def drop_blank(df: DataFrame, column: str = "code") -> DataFrame:
    return df.filter(X.not_blank(column))


def clean_code(df: DataFrame, required: list[str] = ["code", "label"]) -> DataFrame:
    """Rows with code and label; code trimmed, label an integer."""
    return (drop_missing(df, required).withColumn("code", X.strip("code"))
            .filter(F.col("code") != "")
            .withColumn("label", X.checked_int("label", "label")))


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The frame and an observation that holds its row count once any later
    job has run, so counting costs no job of its own."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def null_ratios(df: DataFrame) -> DataFrame:
    """Share of missing values: one row, one column for each column."""
    types = dict(df.dtypes)
    return df.agg(*[
        F.avg(N.is_missing(c, types[c]).cast("double")).alias(c) for c in df.columns
    ])


def drop_sparse(
    df: DataFrame, max_null_ratio: float = C.MAX_NULL_RATIO, protect: list[str] = C.CORE_COLUMNS
) -> DataFrame:
    """Without the columns whose missing share exceeds the limit.

    One aggregate over the table decides; only its single row comes to the
    driver. ``protect`` keeps columns that later steps need.
    """
    ratios = null_ratios(df.drop(*protect)).first() if set(df.columns) - set(protect) else None
    if ratios is None:
        return df
    sparse = [c for c, r in ratios.asDict().items() if r is not None and r > max_null_ratio]
    return df.drop(*sparse)


def fill_missing(df: DataFrame) -> DataFrame:
    """Fixed fills for ids, numbers and text."""
    fills = {
        **{c: F.coalesce(X.null_when(F.col(c).cast("string"), C.FILL_TOKENS), F.lit(v)) for c, v in C.ID_FILL.items()},
        **{c: N.number_or(c, C.NUMERIC_FILL) for c in C.NUMERIC_FILL_COLUMNS},
    }
    return df.withColumns(fills).na.fill(C.TEXT_FILL)


def impute(df: DataFrame) -> DataFrame:
    """Twelve columns without gaps, in rows with code and label."""
    kept = [c for c in ("row_id",) if c in df.columns]
    return fill_missing(clean_code(require_columns(df, C.IMPUTE_COLUMNS).select(*kept, *C.IMPUTE_COLUMNS)))
