"""Tables on shared storage: contracts, readers, writers."""

from __future__ import annotations

import warnings
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weakspot import constants as C
from weakspot.functions.text import null_when

CSV_FORMAT = {"header": True, "quote": '"', "escape": '"',
              "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def require_columns(df: DataFrame, columns: Iterable[str], on_missing: str = "raise") -> DataFrame | None:
    """The frame itself when it has the columns; else an error or None."""
    missing = [c for c in columns if c not in df.columns]
    if not missing:
        return df
    if on_missing == "raise":
        raise ValueError(f"missing required columns: {missing}")
    return None


def empty_core(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], C.CORE_SCHEMA)


def read_split(spark: SparkSession, path: str, split: str = "train") -> DataFrame:
    """One split of a staged collection; splits are ``split=`` folders."""
    return spark.read.parquet(f"{path.rstrip('/')}/split={split}")


def read_optional(
    spark: SparkSession, path: str, required: Iterable[str], split: str | None = None
) -> DataFrame | None:
    """A source that may be absent or of another shape; then None.

    Other faults, such as unreadable files, are raised.
    """
    try:
        df = read_split(spark, path, split) if split else spark.read.parquet(path)
    except AnalysisException as reason:
        if reason.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        warnings.warn(f"going on without {path}: {reason}")
        return None
    return require_columns(df, required, on_missing="none")


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    na_tokens: list[str] | None = C.CSV_NA_TOKENS,
) -> DataFrame:
    """CSV with multi-line quoted cells.

    ``na_tokens`` turns the cells a pandas reader takes as missing into NULL.
    A file with multi-line cells cannot be split, so parallelism is the
    number of files; ``write_csv`` bounds the rows in each.
    """
    reader = spark.read.options(multiLine=True, **CSV_FORMAT)
    df = reader.csv(path, schema=schema) if schema else reader.option("inferSchema", True).csv(path)
    if not na_tokens:
        return df
    return df.select([
        null_when(F.col(f"`{f.name}`"), na_tokens).alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
        for f in df.schema
    ])


def write_csv(df: DataFrame, path: str, rows_per_file: int = 200_000) -> None:
    df.write.mode("overwrite").options(maxRecordsPerFile=rows_per_file, **CSV_FORMAT).csv(path)


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return require_columns(df, columns).select(columns) if columns else df


def write_parquet(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def csv_to_parquet(spark: SparkSession, csv_path: str, parquet_path: str, schema=None) -> DataFrame:
    write_parquet(read_csv(spark, csv_path, schema), parquet_path)
    return spark.read.parquet(parquet_path)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """A table bucketed and sorted on its join key, so that later joins of
    two such tables (vectors with features) need no shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(table)
