"""Code collections normalised to one schema and united."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weakspot import constants as C
from weakspot.functions import text as X
from weakspot.sources.tables import require_columns


def with_row_id(df: DataFrame, dataset: str, id_column: str | None = None) -> DataFrame:
    """``row_id`` that a rerun gives again: a key column, else the place of
    the row in its Parquet file, named by its whole path: files of one name
    in two folders stay apart."""
    place = [F.col(id_column)] if id_column else [F.col("_metadata.file_path"), F.col("_metadata.row_index")]
    return df.withColumn("row_id", F.concat_ws(":", F.lit(dataset), *place))


def unify_ids(df: DataFrame, cve_columns: list[str] | None = None, cwe_columns: list[str] | None = None) -> DataFrame:
    """Canonical ``cve_id`` and ``cwe_id`` from all candidate columns.

    Candidates are the columns whose name contains the word. Columns that
    already carry the canonical name are overwritten, others are kept.
    """
    cve = X.id_candidates(df.columns, "cve") if cve_columns is None else cve_columns
    cwe = X.id_candidates(df.columns, "cwe") if cwe_columns is None else cwe_columns
    return df.withColumns({"cve_id": X.first_id(cve), "cwe_id": X.normalise_cwe(X.first_id(cwe))})


def expand_pairs(
    df: DataFrame, vulnerable: str = "vulnerable_code", fixed: str = "fixed_code", row_id: str = "row_id"
) -> DataFrame:
    """Two labelled rows from each pair of snippets, in one scan."""
    kept = [F.col(f"`{c}`") for c in df.columns if c not in (vulnerable, fixed, row_id)]
    versions = F.array(*[
        F.struct(F.col(f"`{c}`").alias("code"), F.lit(label).alias("label"))
        for c, label in ((vulnerable, 1), (fixed, 0))
    ])
    return (df.select(F.col(row_id).alias("pair_id"), *kept, F.inline(versions))
              .withColumn("row_id", F.concat_ws(":", "pair_id", "label"))
              .drop("pair_id"))


def _finished(df: DataFrame, dataset: str) -> DataFrame:
    """Steps every loader ends with."""
    return unify_ids(
        df.filter(X.not_blank("code"))
          .withColumn("label", X.checked_int("label", "label"))
          .withColumn("dataset", F.lit(dataset))
    )


def load_paired(df: DataFrame, dataset: str = C.PAIRED_DATASET, id_column: str | None = None) -> DataFrame:
    """Collection with a vulnerable and a fixed version in each row."""
    language = X.strip_lower("language") if "language" in df.columns else F.lit(C.UNKNOWN_LANGUAGE)
    named = with_row_id(df, dataset, id_column).withColumn("language", language)
    return _finished(expand_pairs(named), dataset)


def load_single(df: DataFrame, dataset: str = C.SINGLE_DATASET, id_column: str | None = None) -> DataFrame:
    """Collection with one labelled function in each row."""
    named = (with_row_id(df, dataset, id_column).drop("func_after")
             .withColumnsRenamed({"func_before": "code", "vul": "label", "lang": "language"})
             .withColumn("language", X.strip_lower("language")))
    return _finished(named, dataset)


def load_targeted(
    df: DataFrame | None, dataset: str = C.TARGETED_DATASET, id_column: str | None = None, language: str = C.TARGETED_LANGUAGE
) -> DataFrame | None:
    """Best-effort collection: None in, or another shape, gives None."""
    if df is None or require_columns(df, ["func", "target"], on_missing="none") is None:
        return None
    named = (with_row_id(df, dataset, id_column)
             .withColumnsRenamed({"func": "code", "target": "label"})
             .withColumn("language", F.lit(language)))
    return _finished(named, dataset)


def _common_type(types: list[T.DataType]) -> bool:
    """Whether Spark can widen the types by itself."""
    numeric = all(isinstance(t, T.NumericType) for t in types)
    return numeric or len({t.simpleString() for t in types}) == 1


def union_sources(frames: list[DataFrame | None]) -> DataFrame:
    """Union by name; a column a source lacks is NULL, absent sources are
    skipped, metadata of clashing types meets as text."""
    frames = [f for f in frames if f is not None]
    types: dict[str, list[T.DataType]] = {}
    for frame in frames:
        for field in frame.schema:
            types.setdefault(field.name, []).append(field.dataType)
    clashing = {name for name, found in types.items() if not _common_type(found)}
    as_text = [
        f.withColumns({c: F.col(f"`{c}`").cast("string") for c in f.columns if c in clashing})
        if clashing & set(f.columns) else f
        for f in frames
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), as_text)


def ensure_columns(df: DataFrame, columns: list[str], dtype: str = "string") -> DataFrame:
    missing = {c: F.lit(None).cast(dtype) for c in columns if c not in df.columns}
    return df.withColumns(missing) if missing else df


def combine(frames: list[DataFrame | None]) -> DataFrame:
    """All collections as one table in the core schema plus metadata."""
    table = ensure_columns(union_sources(frames), ["cve_id", "cwe_id"])
    return table.filter(X.not_blank("code")).withColumns({
        "label": X.checked_int("label", "label"),
        "language": X.strip_lower("language"),
    })
