"""Text to vectors: pooling, a hashed encoder, a hook for model runtimes."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weakspot import constants as C
from weakspot.functions.text import col
from weakspot.operators.spread import is_small, lookup_join
from weakspot.session import written_once

FRONT = 6  # characters read for each token wanted, before a text is read whole
HOT_TOKENS = 4096  # a token with a larger share than one in so many is broadcast, so there are fewer
PLAIN_WIDTH = 64  # widest vectors that are summed by component


def mean_pool(hidden, mask) -> Column:
    """Mean of the unmasked token vectors of one text.

    ``hidden`` is an array of vectors, ``mask`` an array of 0 and 1. The
    count is at least 1, so a text whose tokens are all masked gives zeros.
    """
    hidden, mask = col(hidden), col(mask)
    n = F.greatest(F.aggregate(mask, F.lit(0.0), lambda s, m: s + m), F.lit(1.0))
    scaled = F.zip_with(hidden, mask, lambda v, m: F.transform(v, lambda x: x.cast("double") * m))
    zero = F.transform(F.get(hidden, F.lit(0)), lambda x: F.lit(0.0))
    total = F.aggregate(scaled, zero, lambda s, v: F.zip_with(s, v, lambda a, b: a + b))
    return F.transform(total, lambda x: x / n)


def mean_pool_rows(df: DataFrame, key: str, vector: str, mask: str | None = None) -> DataFrame:
    """The same over one token vector per row; partial sums per task keep
    any number of rows of one key apart until they are one vector each."""
    values = F.col(vector).cast("array<double>")
    weight = F.lit(1.0)
    if mask is not None:
        weight = F.col(mask).cast("double")
        values = F.zip_with(values, F.array_repeat(weight, F.size(vector)), lambda x, m: x * m)
    n = F.greatest(F.col("__n"), F.lit(1.0))
    return (df.select(key, array_to_vector(values).alias("__v"), weight.alias("__m"))
            .groupBy(key).agg(Summarizer.sum(F.col("__v")).alias("__sum"), F.sum("__m").alias("__n"))
            .select(key, F.transform(vector_to_array("__sum"), lambda x: x / n).alias("pooled")))


def hashed_embedding(df: DataFrame, text: str = "code", dim: int = C.EMBEDDING_DIM, max_tokens: int | None = None,
                     output: str = "embedding") -> DataFrame:
    """Mean of one-hot token vectors under a fixed hash: no training, no
    vocabulary to collect or broadcast, no Python.

    ``max_tokens`` pools over the first tokens only, as a model with a
    bounded input does; None pools over the whole text.
    """
    tokens = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(C.TOKEN_PATTERN), F.lit(0))
    used = tokens if max_tokens is None else F.slice(tokens, 1, max_tokens)
    counted = HashingTF(inputCol="__tokens", outputCol="__tf", numFeatures=dim).transform(
        df.withColumn("__tokens", used))
    # counts add up to the number of tokens, so the 1-norm is the mean's divisor
    shares = Normalizer(p=1.0, inputCol="__tf", outputCol="__mean").transform(counted)
    return shares.withColumn(output, vector_to_array("__mean", "float32")).drop("__tokens", "__tf", "__mean")


def first_tokens(df: DataFrame, key: str, text: str = "code", max_tokens: int | None = C.MAX_TOKENS) -> DataFrame:
    """(key, token) for each of the first ``max_tokens`` tokens of each text; None: for all.

    Tokens are taken from the front of a text. All but the last of them are
    those of the whole text, so only a text whose front has too few is read whole.
    """
    found = lambda x: F.regexp_extract_all(x, F.lit(C.TOKEN_PATTERN), F.lit(0))
    whole = F.coalesce(F.col(text), F.lit(""))
    if max_tokens is None:
        return df.select(key, F.explode(found(whole)).alias("token"))
    reach = FRONT * max_tokens
    front = df.select(key, whole.alias("__text")).withColumn("__front", found(F.substring("__text", 1, reach)))
    enough = (F.size("__front") > max_tokens) | (F.char_length("__text") <= reach)
    used = front.select(key, F.when(enough, F.col("__front")).otherwise(found(F.col("__text"))).alias("__used"))
    return used.select(key, F.explode(F.slice("__used", 1, max_tokens)).alias("token"))


@dataclass(frozen=True)
class VectorTable:
    """A written table (token, vector), and what joins with it ask for."""

    rows: DataFrame
    small: bool
    width: int

    @classmethod
    def of(cls, vectors: DataFrame) -> VectorTable:
        rows = written_once(vectors.select("token", "vector").filter("token IS NOT NULL AND vector IS NOT NULL"), "vector-table")
        first = rows.select(F.size("vector").alias("n")).first()
        return cls(rows, is_small(rows), first["n"] if first else 0)


def _looked_up(tokens: DataFrame, vectors: VectorTable) -> DataFrame:
    """(key, token, vector) of the tokens that the table has.

    Unless the whole table is small, the vectors of at most ``HOT_TOKENS``
    frequent tokens are broadcast and only the other tokens are shuffled.
    """
    if vectors.small:
        return tokens.join(F.broadcast(vectors.rows), "token")
    held = written_once(tokens, "first-tokens")
    sizes = written_once(held.groupBy("token").agg(F.count(F.lit(1)).alias("n")), "token-sizes")
    total = sizes.agg(F.sum("n").alias("n")).first()["n"] or 0
    hot = sizes.filter(F.col("n") * HOT_TOKENS > total).select("token")
    near = written_once(vectors.rows.join(F.broadcast(hot), "token", "left_semi"), "hot-vectors")
    far = held.join(F.broadcast(hot), "token", "left_anti").join(vectors.rows, "token")
    return held.join(F.broadcast(near), "token").unionByName(far)


def pooled_embedding(df: DataFrame, vectors: DataFrame | VectorTable, key: str = "row_id", text: str = "code",
                     max_tokens: int | None = C.MAX_TOKENS, output: str = "embedding") -> DataFrame:
    """(key, mean vector) of each text over its first tokens, by a table
    (token, vector). Tokens that the table lacks are masked; a text without
    known tokens has no row. A ``VectorTable`` serves many calls: it is
    written and measured once.
    """
    table = vectors if isinstance(vectors, VectorTable) else VectorTable.of(vectors)
    known = _looked_up(first_tokens(df, key, text, max_tokens), table)
    if 0 < table.width <= PLAIN_WIDTH:  # plain sums stay in the memory of a hash aggregation
        sums = [F.sum(F.get("vector", F.lit(i)).cast("double")).alias(f"__s{i}") for i in range(table.width)]
        summed = known.groupBy(key).agg(F.count(F.lit(1)).alias("__n"), *sums)
        return summed.select(key, F.array(*[F.col(f"__s{i}") / F.col("__n") for i in range(table.width)]).alias(output))
    whole = array_to_vector(F.transform("vector", lambda x: x.cast("double")))
    summed = known.select(key, whole.alias("__v")).groupBy(key).agg(Summarizer.sum(F.col("__v")).alias("__s"), F.count(F.lit(1)).alias("__n"))
    return summed.select(key, F.transform(vector_to_array("__s"), lambda x: x / F.col("__n")).alias(output))


def train_vectors(df: DataFrame, dim: int = 64, window: int = 4, least: int = 5, text: str = "code", seed: int = 42) -> DataFrame:
    """(token, vector) from co-occurrence counts by a randomised low-rank factorisation.

    Counts of tokens within ``window`` of each other, as positive pointwise
    mutual information, are the sparse matrix A. A hashed sign matrix W of
    ``dim`` columns gives Y = A W, two power steps sharpen it, and an orthonormal
    base Q of its columns gives the small matrix T = Q' A Q. With T = U diag(l) U'
    the vectors are the rows of Q U diag(sqrt |l|), so their products come near
    to A. Only Y'Y and T, dim by dim, reach the driver; A is symmetric and stays
    in rows (token, other, weight) of the shared folder. Tokens with fewer than
    ``least`` occurrences are left out.
    """
    tokens = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(C.TOKEN_PATTERN), F.lit(0))
    held = df.select(tokens.alias("t"))
    singles = written_once(held.select(F.explode("t").alias("token")).groupBy("token").agg(
        F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least), "tokens")
    total = singles.agg(F.sum("n")).first()[0]
    if not total:
        return df.sparkSession.createDataFrame([], "token string, vector array<double>")
    steps = F.array(*[F.lit(k) for k in [*range(-window, 0), *range(1, window + 1)]])
    near = F.flatten(F.transform("t", lambda x, i: F.transform(
        F.filter(F.transform(steps, lambda k: F.get("t", i + k)), lambda y: y.isNotNull()), lambda y: F.struct(x.alias("token"), y.alias("other")))))
    pairs = held.select(F.explode(near).alias("p")).groupBy("p.token", "p.other").agg(F.count(F.lit(1)).alias("c"))
    sizes = F.col("n").cast("double")
    weighed = lookup_join(lookup_join(pairs, singles, "token", "other").withColumn("__a", sizes).drop("n"),
                          singles.withColumnRenamed("token", "other"), "other", "token").filter("__a IS NOT NULL AND n IS NOT NULL")
    mutual = F.log(F.col("c") * F.lit(float(total)) / (F.col("__a") * sizes * 2 * window))
    matrix = written_once(weighed.select("token", "other", mutual.alias("weight")).filter("weight > 0"), "mutual")
    signs = F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda i: F.when(F.xxhash64(F.col("other"), i, F.lit(seed)) % 2 == 0, 1.0).otherwise(-1.0))

    def times(source: DataFrame) -> DataFrame:
        """A times the vectors of ``source``, row by row."""
        scaled = array_to_vector(F.transform("vector", lambda x: x * F.col("weight")))
        return written_once(source.select("token", scaled.alias("__v")).groupBy("token").agg(Summarizer.sum(F.col("__v")).alias("__s"))
                            .select("token", vector_to_array("__s").alias("vector")), "product")

    def by_other(vectors: DataFrame) -> DataFrame:
        return lookup_join(matrix, vectors.withColumnRenamed("token", "other"), "other", "token").filter("vector IS NOT NULL")

    y = times(matrix.withColumn("vector", signs))
    for _ in range(2):
        y = times(by_other(_orthonormal(y, dim)))
    base = written_once(_orthonormal(y, dim), "base")
    both = times(by_other(base)).withColumnRenamed("vector", "__b").join(base, "token")
    small = _products(both, "vector", "__b", dim)
    values, turn = np.linalg.eigh((small + small.T) / 2)
    return _turned(base, turn * np.sqrt(np.abs(values)))


def _products(df: DataFrame, left: str, right: str, dim: int) -> np.ndarray:
    """Sums of left_i * right_j over all rows, dim by dim."""
    cells = df.select(F.posexplode(left).alias("i", "__x"), right).select("i", F.transform(right, lambda b: b * F.col("__x")).alias("row"))
    found = {r["i"]: r["s"].toArray() for r in cells.groupBy("i").agg(Summarizer.sum(array_to_vector("row")).alias("s")).collect()}
    return np.array([found.get(i, np.zeros(dim)) for i in range(dim)])


def _turned(df: DataFrame, turn: np.ndarray) -> DataFrame:
    """(token, vector times the matrix)."""
    columns = [F.array(*[F.lit(float(v)) for v in turn[:, j]]) for j in range(turn.shape[1])]
    dot = [F.aggregate(F.zip_with("vector", c, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x) for c in columns]
    return df.select("token", F.array(*dot).alias("vector"))


def _orthonormal(y: DataFrame, dim: int) -> DataFrame:
    """The rows with their columns made orthonormal; directions without
    weight become 0."""
    values, directions = np.linalg.eigh(_products(y.withColumn("__b", F.col("vector")), "vector", "__b", dim))
    scale = np.where(values > values.max() * 1e-12, 1.0 / np.sqrt(np.maximum(values, 1e-300)), 0.0)
    return _turned(y, directions * scale)


def encode_batches(
    df: DataFrame,
    text: str,
    keep: list[str],
    make_encoder: Callable[[], Callable[[list[str]], np.ndarray]],
    batch_rows: int = C.BATCH_ROWS,
    output: str = "embedding",
) -> DataFrame:
    """Vectors from any encoder of text batches.

    ``make_encoder`` runs once in each task and returns a function from a
    list of texts to a matrix with one row for each.
    """
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = make_encoder()
        for batch in batches:
            for start in range(0, len(batch), batch_rows):
                part = batch.iloc[start:start + batch_rows]
                vectors = np.asarray(encoder(part[text].fillna("").tolist()), dtype="float32")
                yield part[keep].assign(**{output: list(vectors)})

    return df.select(*dict.fromkeys([*keep, text])).mapInPandas(encode, f"{fields}, `{output}` array<float>")


def attach_embeddings(df: DataFrame, embeddings: DataFrame, row_key: str = "row_id", vector: str = "embedding") -> DataFrame:
    """Ready vectors by row key."""
    return df.join(embeddings.select(row_key, vector), row_key)
