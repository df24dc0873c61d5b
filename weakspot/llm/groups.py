"""Connected components and joins to groups, whatever the group sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weakspot.session import drop_scratch, written_once

MOST_HOT = 1_000


def attach(rows: DataFrame, groups: DataFrame, keys: list[str], values: list[str], size: str, total: int) -> DataFrame:
    """Left join of rows to one row per group.

    ``size`` is a group's share of the ``total`` rows. Groups above a
    thousandth are at most a thousand, so they are broadcast; the others
    are shuffled, and none of them is more than a thousandth of the rows.
    """
    held = groups.select(*keys, F.struct(*values).alias("__v"), F.col(size).alias("__n"))
    limit = max(1, total // MOST_HOT)
    hot = held.filter(F.col("__n") > limit).select(*keys, F.col("__v").alias("__hot"))
    marked = rows.join(F.broadcast(hot), keys, "left")
    cold = held.filter(F.col("__n") <= limit).select(*keys, F.col("__v").alias("__cold"))
    rest = marked.filter("__hot IS NULL").join(cold, keys, "left")
    columns = [F.col(f"`{c}`") for c in rows.columns]
    taken = lambda df, v: df.select(*columns, *[F.col(f"{v}.{n}").alias(n) for n in values])
    return taken(marked.filter("__hot IS NOT NULL"), "__hot").unionByName(taken(rest, "__cold"))


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(id, component) of every vertex with an edge; the smallest id names a component.

    Alternates large-star and small-star: each vertex's neighbours are
    linked to its smallest one until only stars are left, a number of rounds
    that grows with the logarithm of the longest chain. Each round is
    written to the shared folder; only its size and checksum reach the
    driver.
    """
    pairs = edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).filter("u <> v").distinct()
    pairs = written_once(pairs, "edges")
    before = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        larger = (both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                  .filter("u <> v").distinct())
        smallest = larger.groupBy("u").agg(F.min("v").alias("m"))
        smaller = (larger.join(smallest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                   .unionByName(smallest.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        last, pairs = pairs, written_once(smaller, "stars")
        drop_scratch(last)
        state = tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before:
            break
        before = state
    return (pairs.select(F.col("u").alias("id"), F.col("v").alias("component"))
            .unionByName(pairs.select(F.col("v").alias("id"), F.col("v").alias("component"))).groupBy("id").agg(F.min("component").alias("component")))
