"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weakspot.session import written_once

MAX_SMALL_ROWS = 200_000
MAX_SMALL_BYTES = 64 * 1024 * 1024


def is_small(df: DataFrame, max_rows: int = MAX_SMALL_ROWS, max_bytes: int = MAX_SMALL_BYTES) -> bool:
    """Measured, not estimated: whether a side may be broadcast.

    Reads at most ``max_rows + 1`` rows of it.
    """
    strings = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
               for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    arrays = [F.coalesce(F.size(F.col(f"`{f.name}`")), F.lit(0)) * 8
              for f in df.schema if isinstance(f.dataType, T.ArrayType)]
    width = sum(strings + arrays, F.lit(16 * len(df.columns)))
    seen = (df.limit(max_rows + 1).select(width.cast("bigint").alias("w"))
            .agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("w"), F.lit(0)).alias("bytes")).first())
    return seen["rows"] <= max_rows and seen["bytes"] <= max_bytes


def lookup_join(rows: DataFrame, dimension: DataFrame, key: str, row_key: str, salts: int = 64, max_hot: int = 4096) -> DataFrame:
    """Left join to a dimension with unique keys.

    The dimension is written once, since it is measured and then joined. If
    small it is broadcast. Otherwise the rows of a key that holds more than
    1/max_hot of all rows (so there are fewer than ``max_hot`` such keys) go
    to ``salts`` tasks, and only the entries of these keys are replicated.
    Rows without a key match nothing and are spread by ``row_key``.
    """
    held = written_once(dimension, "dimension")
    if is_small(held):
        return rows.join(F.broadcast(held), key, "left")
    sizes = written_once(rows.groupBy(F.col(key)).agg(F.count(F.lit(1)).alias("__n")), "key-sizes")
    total = sizes.agg(F.sum("__n").alias("n")).first()["n"] or 0
    hot = sizes.filter(F.col(key).isNotNull() & (F.col("__n") * max_hot > total)).select(key, F.lit(True).alias("__hot"))
    last = F.when(F.col("__hot"), F.lit(salts - 1)).otherwise(F.lit(0))
    salted = (held.join(F.broadcast(hot), key, "left")
              .withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long")))).drop("__hot"))
    salt = (F.when(F.col(key).isNull(), F.xxhash64(row_key))
            .when(F.col("__hot"), F.pmod(F.xxhash64(row_key), F.lit(salts))).otherwise(F.lit(0)).cast("long"))
    return (rows.join(F.broadcast(hot), key, "left").withColumn("__salt", salt).drop("__hot")
            .join(salted, [key, "__salt"], "left").drop("__salt"))


def join_group_values(
    rows: DataFrame,
    groups: DataFrame,
    keys: list[str],
    values: list[str],
    size: str,
    row_key: str,
    max_hot: int = 1024,
    hot_rows: int = 1_000_000,
) -> DataFrame:
    """Left join rows to per-group values whatever the group sizes.

    ``groups`` has one row for each key and its row count in ``size``. The
    at most ``max_hot`` largest groups of ``hot_rows`` rows or more are
    joined by broadcast, and their rows get a key of their own in the
    shuffled join for the other groups, so they spread over all tasks. A
    group beyond the ``max_hot`` largest holds under 1/max_hot of the rows.
    ``keys[0]`` must be a bigint hash. Values must be bounded, for theirs
    are broadcast: a map of at most 10,000 years makes 1,024 groups 120 MB.
    """
    held = groups.select(*keys, F.struct(*values).alias("__v"), size)
    hot = (held.filter(F.col(size) >= hot_rows).orderBy(F.desc(size), *keys).limit(max_hot)
           .select(*keys, F.col("__v").alias("__hot")))
    cold = held.select(*[F.col(k).alias(f"__c_{k}") for k in keys], F.col("__v").alias("__cold"))
    # rows of hot groups and rows without a key match nothing in the shuffled join
    lone = F.col("__hot").isNotNull() | F.col(keys[0]).isNull()
    spread = F.when(lone, F.xxhash64(row_key)).otherwise(F.col(keys[0]))
    marked = rows.join(F.broadcast(hot), keys, "left").withColumn("__spread", spread)
    on: list[Column] = [F.col("__spread") == F.col(f"__c_{keys[0]}")]
    on += [F.col(k) == F.col(f"__c_{k}") for k in keys[1:]]
    joined = marked.join(cold, on, "left").withColumn("__v", F.coalesce("__hot", "__cold"))
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns], *[F.col(f"__v.{v}").alias(v) for v in values])
