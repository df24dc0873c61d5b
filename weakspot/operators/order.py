"""Exact seeded order without a global sort.

Rows are ordered by the md5 of a seed and a key, which no repartitioning or
rerun changes. The leading hex digits of that order key are a bucket of
known, even share, so ranks and cut-offs come from a histogram of at most
16^digits buckets plus a look into single buckets.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weakspot.functions.text import all_of, col

DIGITS = 4


def order_key(seed: int, *keys) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[col(k).cast("string") for k in keys]))


def hash_number(key: Column) -> Column:
    """Non-negative 60-bit number from an order key."""
    return F.conv(F.substring(key, 1, 15), 16, 10).cast("bigint")


def unit_fraction(key: Column) -> Column:
    """Number in [0, 1) from an order key."""
    return hash_number(key).cast("double") / float(2 ** 60)


def bucket_offsets(df: DataFrame, key: str, by: list[str], digits: int = DIGITS) -> DataFrame:
    """Rows before and in each leading-digit bucket, within each class.

    The window orders a histogram of at most 16^digits rows for a class,
    however many rows the table has.
    """
    histogram = df.groupBy(*by, F.substring(key, 1, digits).alias("__bucket")).agg(F.count(F.lit(1)).alias("__n"))
    before = W.partitionBy(*by).orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    return histogram.withColumn("__offset", F.coalesce(F.sum("__n").over(before), F.lit(0)))


def with_rank(df: DataFrame, key: str, by: list[str] = [], digits: int = DIGITS) -> DataFrame:
    """Dense 0-based ``rank`` of each row in key order, within classes.

    ``by`` must be a column of few values (a label). The broadcast is the
    histogram; the windows run over even hash buckets.
    """
    offsets = bucket_offsets(df, key, by, digits)
    inside = W.partitionBy(*by, "__bucket").orderBy(key)
    return (df.withColumn("__bucket", F.substring(key, 1, digits))
            .join(F.broadcast(offsets), [*by, "__bucket"])
            .withColumn("rank", F.col("__offset") + F.row_number().over(inside) - 1)
            .drop("__bucket", "__offset", "__n"))


def cutoffs(
    df: DataFrame,
    key: str,
    pick: Callable[[dict[tuple, int]], dict[tuple, list[int]]],
    by: list[str] = [],
    digits: int = DIGITS,
) -> tuple[dict[tuple, int], dict[tuple, str]]:
    """Class sizes, and the order key at each rank ``pick`` asks for.

    ``pick`` gets ``{class: rows}`` and returns ``{class: ranks}``; the
    result maps ``(class..., rank)`` to a key and has no entry for a rank at
    or past the class size. Comparing a row's own key with a cut-off then
    replaces ranking, sorting or joining the rows. What comes to the driver
    is the histogram, at most 16^digits counts for a class, and the keys.
    The second job reads only the buckets that hold an asked rank.
    """
    narrow = df.select(*by, key, F.substring(key, 1, digits).alias("__bucket"))
    histogram: dict[tuple, list] = {}
    for row in narrow.groupBy(*by, "__bucket").agg(F.count(F.lit(1)).alias("n")).collect():
        histogram.setdefault(tuple(row[c] for c in by), []).append((row["__bucket"], row["n"]))
    sizes = {cls: sum(n for _, n in counts) for cls, counts in histogram.items()}

    targets = []  # (class, bucket, rank inside the bucket, rank)
    for cls, ranks in pick(sizes).items():
        before = 0
        for bucket, n in sorted(histogram.get(cls, [])):
            targets += [(cls, bucket, r - before, r) for r in ranks if before <= r < before + n]
            before += n
    if not targets:
        return sizes, {}

    def in_class(cls: tuple) -> Column:
        return all_of([F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(by, cls)])

    def any_of(conditions: list[Column]) -> Column:
        return reduce(lambda a, b: a | b, conditions)

    held = narrow.filter(any_of([in_class(c) & (F.col("__bucket") == b) for c, b, _, _ in targets]))
    inside = F.row_number().over(W.partitionBy(*by, "__bucket").orderBy(key)) - 1
    found = held.withColumn("__at", inside).filter(any_of([
        in_class(c) & (F.col("__bucket") == b) & (F.col("__at") == at) for c, b, at, _ in targets
    ])).collect()
    keys = {(*[row[c] for c in by], row["__bucket"], row["__at"]): row[key] for row in found}
    return sizes, {(*c, r): keys[(*c, b, at)] for c, b, at, r in targets}


def first_n(df: DataFrame, key: str, n: int, digits: int = DIGITS) -> DataFrame:
    """The ``n`` rows that come first in key order."""
    _, cut = cutoffs(df, key, lambda sizes: {(): [n]}, digits=digits)
    return df.filter(F.col(key) < cut[(n,)]) if cut else df
