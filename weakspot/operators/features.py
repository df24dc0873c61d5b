"""Tabular features, one-hot encoding, assembly and scaling."""

from __future__ import annotations

import math

from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    ElementwiseProduct, OneHotEncoder, StandardScaler, VectorAssembler, VectorSlicer,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weakspot import constants as C
from weakspot.functions import numeric as N
from weakspot.functions import text as X
from weakspot.operators.spread import lookup_join
from weakspot.session import written_once

MAX_WIDE_COLUMNS = 10_000


def frequent_values(df: DataFrame, column: str, min_count: int = C.CWE_MIN_COUNT) -> DataFrame:
    """Values held by at least ``min_count`` rows."""
    return (df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
            .filter(F.col(column).isNotNull() & (F.col("count") >= min_count)))


def collapse_rare(
    df: DataFrame, column: str = "cwe_id", min_count: int = C.CWE_MIN_COUNT, row_key: str = "row_id"
) -> DataFrame:
    """``<column>_slim``: the value when frequent, else the rare category."""
    slim = f"{column}_slim"
    if column not in df.columns:
        return df.withColumn(slim, F.lit(C.RARE_CATEGORY))
    common = frequent_values(df, column, min_count).select(column, F.lit(True).alias("__common"))
    marked = lookup_join(df, common, column, row_key)
    value = F.when(F.col("__common"), F.col(column)).otherwise(F.lit(C.RARE_CATEGORY))
    return marked.withColumn(slim, value).drop("__common").select(*df.columns, slim)


def numeric_features(df: DataFrame) -> DataFrame:
    """The eight numeric features; token count and CVE number are derived,
    the former unless the table brings it because it left the text behind."""
    counted = df if "code_token_count" in df.columns else df.withColumn("code_token_count", X.token_count("code"))
    return counted.withColumn("cve_number", X.cve_number_anywhere("cve_id"))


def categories(df: DataFrame, columns: list[str]) -> list[tuple[str, str]]:
    """Sorted (column, value) pairs, each one a one-hot feature.

    Every pair becomes a column of the result, so the list has to fit the
    driver; more than a frame can hold is an error, never a cut list. The
    vector form has no such limit on names.
    """
    cells = F.array(*[
        F.struct(F.lit(i).alias("position"), F.col(c).cast("string").alias("value")) for i, c in enumerate(columns)
    ])
    found = (df.select(F.inline(cells)).filter(F.col("value").isNotNull()).distinct()
             .limit(MAX_WIDE_COLUMNS + 1).collect())
    if len(found) > MAX_WIDE_COLUMNS:
        raise ValueError("too many categories for named columns; use one_hot_vector")
    return [(columns[r["position"]], r["value"]) for r in sorted(found)]


def one_hot(df: DataFrame, columns: list[str], keep: list[str]) -> tuple[DataFrame, list[str]]:
    """Named 0/1 columns ``<column>_<value>`` in value order; a NULL value
    has 0 in all of them."""
    pairs = categories(df, columns)
    flags = [F.coalesce((F.col(c) == v).cast("int"), F.lit(0)).alias(f"{c}_{v}") for c, v in pairs]
    return df.select(*keep, *flags), [f"{c}_{v}" for c, v in pairs]


def category_places(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, pos): the place of every one-hot feature, columns in
    their order, values sorted. A table of any size; nothing is collected but
    the number of values in each part of the sorted file."""
    cells = F.array(*[F.struct(F.lit(i).alias("__at"), F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                      for i, c in enumerate(columns)])
    found = df.select(F.inline(cells)).filter(F.col("value").isNotNull()).distinct().orderBy("__at", "value")
    # the id counts rows within a part and grows with the part
    held = written_once(found.withColumn("__id", F.monotonically_increasing_id()), "categories")
    part = F.shiftright("__id", 33)
    sizes = {r["part"]: r["n"] for r in held.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    starts, before = [], 0
    for p in sorted(sizes):
        starts.append((p, before))
        before += sizes[p]
    offsets = df.sparkSession.createDataFrame(starts, "__part long, __start long")
    within = F.col("__id") - F.shiftleft(F.col("__part"), 33)
    return (held.withColumn("__part", part).join(F.broadcast(offsets), "__part")
            .select("column", "value", (F.col("__start") + within).alias("pos")))


def one_hot_vector(df: DataFrame, columns: list[str], output: str = "one_hot", row_key: str = "row_id") -> tuple[DataFrame, DataFrame]:
    """The same encoding as one sparse vector, and the places of its features.

    Places are joined to the rows, so the number of categories is not bounded
    by the driver; a NULL value has no flag.
    """
    places = written_once(category_places(df, columns), "places")
    sizes = {r["column"]: r["n"] for r in places.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    kept, before, flags = df.columns, 0, []
    for c in columns:
        size = sizes.get(c, 0)
        if not size:
            continue
        own = places.filter(F.col("column") == c).select(F.col("value").alias("__value"), (F.col("pos") - before).alias("__place"))
        df = lookup_join(df.withColumn("__value", F.col(c).cast("string")), own, "__value", row_key).drop("__value")
        # the last of size + 1 values has no flag; NULL takes it
        attribute = {"ml_attr": {"type": "nominal", "num_vals": size + 1}}
        df = df.withColumn(f"{c}__i", F.coalesce("__place", F.lit(size)).cast("double").alias("i", metadata=attribute)).drop("__place")
        flags.append(f"{c}__f")
        before += size
    if not flags:
        return df.withColumn(output, array_to_vector(F.array().cast("array<double>"))), places
    indexed = [f"{c}__i" for c in columns if c in sizes]
    model = OneHotEncoder(inputCols=indexed, outputCols=flags, dropLast=True).fit(df)
    made = VectorAssembler(inputCols=flags, outputCol=output).transform(model.transform(df))
    return made.select(*kept, output), places


def meta_features(
    df: DataFrame, min_count: int = C.CWE_MIN_COUNT, row_key: str = "row_id", keep: list[str] = ()
) -> tuple[DataFrame, list[str]]:
    """One-hot categories, then the eight numbers, with their names."""
    ready = numeric_features(collapse_rare(df, "cwe_id", min_count, row_key))
    table, names = one_hot(ready, C.ONE_HOT_COLUMNS, [row_key, *keep, *C.NUMERIC_FEATURES])
    ordered = [*names, *C.NUMERIC_FEATURES]
    return table.select(row_key, *keep, *[F.col(f"`{n}`") for n in ordered]), ordered


def meta_vector(df: DataFrame, min_count: int = C.CWE_MIN_COUNT, row_key: str = "row_id", keep: list[str] = (),
                output: str = "features") -> tuple[DataFrame, DataFrame]:
    """``meta_features`` as one sparse vector, for any number of categories,
    and its names (pos, name)."""
    ready = numeric_features(collapse_rare(df, "cwe_id", min_count, row_key))
    encoded, places = one_hot_vector(ready.select(row_key, *keep, *C.NUMERIC_FEATURES, *C.ONE_HOT_COLUMNS), C.ONE_HOT_COLUMNS, "__hot", row_key)
    numbers = encoded.withColumns({n: N.finite(F.col(n)) for n in C.NUMERIC_FEATURES})
    made = VectorAssembler(inputCols=["__hot", *C.NUMERIC_FEATURES], outputCol=output).transform(numbers)
    total = places.count()
    names = places.select("pos", F.concat_ws("_", "column", "value").alias("name")).unionByName(
        name_table(df, C.NUMERIC_FEATURES).select((F.col("pos") + total).alias("pos"), "name"))
    return made.select(row_key, *keep, output), names


def feature_names(dim: int, meta: list[str]) -> list[str]:
    return [f"emb_{i}" for i in range(dim)] + list(meta)


def with_names(df: DataFrame, names: list[str], column: str = "features") -> DataFrame:
    """The vector column with its feature names as metadata, which ML stages
    and Parquet carry along."""
    attributes = {"ml_attr": {"num_attrs": len(names), "attrs": {
        "numeric": [{"idx": i, "name": n} for i, n in enumerate(names)]}}}
    return df.withColumn(column, F.col(column).alias(column, metadata=attributes))


def names_of(df: DataFrame, column: str = "features") -> list[str]:
    attributes = df.schema[column].metadata["ml_attr"]["attrs"]
    return [a["name"] for a in sorted(sum(attributes.values(), []), key=lambda a: a["idx"])]


def name_table(df: DataFrame, names: list[str]) -> DataFrame:
    """(pos, name) rows of a feature vector."""
    return df.sparkSession.range(1).select(
        F.posexplode(F.array(*[F.lit(n) for n in names]).cast("array<string>")).alias("pos", "name"))


def assemble(
    embeddings: DataFrame, meta: DataFrame, names: list[str], row_key: str = "row_id",
    vector: str = "embedding", output: str = "features",
) -> DataFrame:
    """One vector per row from its embedding and its tabular features.

    Both sides are joined on the row key, never zipped by position; two
    tables bucketed on it join without a shuffle. Missing values become 0.
    """
    meta_names = [n for n in names if n in meta.columns]
    others = [c for c in meta.columns if c not in meta_names and c != row_key]
    numbers = F.array(*[N.finite(F.col(f"`{n}`")) for n in meta_names])
    left = embeddings.select(row_key, N.finite_array(vector).alias("__emb"))
    right = meta.select(row_key, *others, numbers.alias("__meta"))
    joined = left.join(right, row_key)
    return joined.select(row_key, *others, array_to_vector(F.concat("__emb", "__meta")).alias(output))


def fit_scaler(train: DataFrame, column: str = "features", output: str = "scaled") -> PipelineModel:
    """Standard scaling by the population deviation, fitted on ``train``.

    Spark divides by the sample deviation; a constant factor corrects it.
    """
    scaler = StandardScaler(inputCol=column, outputCol="__std", withMean=True, withStd=True).fit(train)
    rows = train.count()
    factor = math.sqrt(rows / (rows - 1)) if rows > 1 else 1.0
    fix = ElementwiseProduct(scalingVec=Vectors.dense([factor] * scaler.mean.size), inputCol="__std", outputCol=output)
    return PipelineModel([scaler, fix])


def scale(df: DataFrame, model: PipelineModel) -> DataFrame:
    return model.transform(df).drop("__std")


def keep_features(df: DataFrame, positions: list[int], column: str = "features", output: str = "selected") -> DataFrame:
    """The vector cut to the given positions, in the given order; none give empty vectors."""
    if not positions:  # VectorSlicer refuses an empty choice
        return df.withColumn(output, array_to_vector(F.array().cast("array<double>")))
    return VectorSlicer(inputCol=column, outputCol=output, indices=list(positions)).transform(df)


def write_features(df: DataFrame, path: str, vector: str = "features") -> None:
    """Feature table partitioned by split, floats instead of doubles."""
    values = vector_to_array(vector, "float32") if not isinstance(df.schema[vector].dataType, T.ArrayType) \
        else F.col(vector).cast("array<float>")
    kept = df.schema[vector].metadata
    df.withColumn(vector, values.alias(vector, metadata=kept)).write.mode("overwrite").partitionBy("split").parquet(path)
