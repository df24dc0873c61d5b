"""Class rebalancing, exact in size and repeatable under a seed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weakspot import constants as C
from weakspot.operators.neighbours import exact_neighbours
from weakspot.operators.order import cutoffs, hash_number, order_key, unit_fraction, with_rank
from weakspot.operators.spread import lookup_join

DRAWS_PER_KEY = 100_000


def class_sizes(df: DataFrame, label: str = "label") -> dict[int, int]:
    return {r[label]: r["count"] for r in df.groupBy(label).count().collect()}


def undersample(df: DataFrame, row_key: str = "row_id", label: str = "label", seed: int = C.SAMPLE_SEED) -> DataFrame:
    """Every class cut to the size of the smallest one.

    A row stays when its order key lies below its class's cut-off: a filter,
    with no rows moved.
    """
    keyed = df.withColumn("__order", order_key(seed, row_key))
    _, cut = cutoffs(keyed, "__order", lambda sizes: {c: [min(sizes.values())] for c in sizes}, by=[label])
    keep = F.lit(True)
    for (cls, _), key in cut.items():
        keep = keep & ((F.col(label) != cls) | (F.col("__order") < key))
    return keyed.filter(keep).drop("__order")


def _draw(seed: int, what: str, n: int) -> Column:
    """Index below ``n`` for each draw, with replacement."""
    return F.pmod(hash_number(order_key(seed, F.lit(what), F.col("draw"))), F.lit(n))


def _join_draws(draws: DataFrame, table: DataFrame, n_draws: int, n_table: int, on: str) -> DataFrame:
    """Draws joined to the rows they point at.

    When few rows take many draws each, the rows are replicated so that one
    join key takes about DRAWS_PER_KEY draws.
    """
    salts = max(1, -(-n_draws // (n_table * DRAWS_PER_KEY)))
    if salts == 1:
        return draws.join(table, on)
    salted = table.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return draws.withColumn("__salt", (F.col("draw") % salts).cast("int")).join(salted, [on, "__salt"]).drop("__salt")


def oversample(df: DataFrame, row_key: str = "row_id", label: str = "label", seed: int = C.SAMPLE_SEED) -> DataFrame:
    """Every row, plus draws from the smaller classes up to the largest.

    ``draw`` numbers the drawn copies within their class and is NULL on the
    originals.
    """
    sizes = class_sizes(df, label)
    largest = max(sizes.values())
    result = df.withColumn("draw", F.lit(None).cast("bigint"))
    for cls, n in sorted(sizes.items()):
        if n == largest:
            continue
        members = df.filter(F.col(label) == cls).withColumn("__order", order_key(seed, row_key))
        numbered = with_rank(members, "__order").drop("__order")
        draws = df.sparkSession.range(largest - n).select(F.col("id").alias("draw")).withColumn(
            "rank", _draw(seed, f"copy-{cls}", n))
        copies = _join_draws(draws, numbered, largest - n, n, "rank")
        result = result.unionByName(copies.select(*df.columns, "draw"))
    return result


def smote_draws(
    df: DataFrame, row_key: str = "row_id", vector: str = "embedding", label: str = "label",
    k: int = C.SMOTE_NEIGHBOURS, seed: int = C.SAMPLE_SEED, block_rows: int = 512, search=None,
) -> DataFrame:
    """Synthetic points: (draw, base, neighbour, step, vector, label).

    ``search`` may be ``graph.neighbour_graph`` where the exact search is too much.

    A draw picks a minority row and one of its k nearest minority rows, and
    lies at a random step on the way from one to the other. Rows and their
    neighbours form numbered edges, so a draw is one join on its edge.
    """
    sizes = class_sizes(df, label)
    minority, n = min(sizes.items(), key=lambda e: (e[1], e[0]))
    wanted = max(sizes.values()) - n
    if n <= k:
        raise ValueError(f"class {minority} has {n} rows; {k} neighbours need more")
    members = (df.filter(F.col(label) == minority)
               .select(row_key, F.col(vector).cast("array<double>").alias("__v"))
               .withColumn("__order", order_key(seed, row_key)))
    ranked = with_rank(members, "__order").drop("__order")
    near = search(members, k, row_key, "__v") if search else exact_neighbours(members, k, row_key, "__v", block_rows)
    ends = members.select(F.col(row_key).alias("neighbour"), F.col("__v").alias("__end"))
    edges = (lookup_join(near.drop("distance"), ends, "neighbour", row_key)
             .join(ranked, row_key)
             .withColumn("edge", F.col("rank") * k + F.col("position")))
    draws = df.sparkSession.range(wanted).select(F.col("id").alias("draw")).withColumns({
        "edge": _draw(seed, "edge", n * k),
        "step": unit_fraction(order_key(seed, F.lit("step"), F.col("draw"))),
    })
    moved = F.zip_with("__v", "__end", lambda a, b: a + F.col("step") * (b - a))
    return _join_draws(draws, edges, wanted, n * k, "edge").select(
        "draw", F.col(row_key).alias("base"), "neighbour", "step",
        moved.alias(vector), F.lit(minority).alias(label))


def smote(
    df: DataFrame, row_key: str = "row_id", vector: str = "embedding", label: str = "label",
    k: int = C.SMOTE_NEIGHBOURS, seed: int = C.SAMPLE_SEED, block_rows: int = 512, search=None,
) -> DataFrame:
    """Originals and synthetic minority points: (row_id text, vector, label)."""
    kind = df.schema[label].dataType
    real = df.select(F.col(row_key).cast("string").alias(row_key), F.col(vector).cast("array<double>").alias(vector), label)
    made = smote_draws(df, row_key, vector, label, k, seed, block_rows, search).select(
        F.concat(F.lit("smote:"), F.col("draw").cast("string")).alias(row_key), vector, F.col(label).cast(kind).alias(label))
    return real.unionByName(made)


def tomek_links(
    df: DataFrame, row_key: str = "row_id", vector: str = "embedding", label: str = "label", block_rows: int = 512, search=None
) -> DataFrame:
    """(a, b): rows of different classes that are each other's nearest.

    Both ends of a mutual pair write the same ordered pair, so counting
    pairs finds them and a row that is nearest to many is no hot key.
    """
    nearest = search(df, 1, row_key, vector) if search else exact_neighbours(df, 1, row_key, vector, block_rows)
    labelled = nearest.join(df.select(row_key, label), row_key)
    return (labelled.groupBy(F.least(row_key, "neighbour").alias("a"), F.greatest(row_key, "neighbour").alias("b"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(label).alias("lo"), F.max(label).alias("hi"))
            .filter((F.col("n") == 2) & (F.col("lo") != F.col("hi"))).select("a", "b"))


def remove_tomek(df: DataFrame, row_key: str = "row_id", vector: str = "embedding", label: str = "label",
                 block_rows: int = 512, search=None) -> DataFrame:
    """Without both rows of every link."""
    links = tomek_links(df, row_key, vector, label, block_rows, search)
    ends = links.select(F.explode(F.array("a", "b")).alias(row_key))
    return df.join(ends, row_key, "left_anti")


def smote_tomek(df: DataFrame, row_key: str = "row_id", vector: str = "embedding", label: str = "label",
                k: int = C.SMOTE_NEIGHBOURS, seed: int = C.SAMPLE_SEED, block_rows: int = 512, search=None) -> DataFrame:
    """Synthetic points added, then every link removed."""
    from weakspot.session import written_once

    grown = written_once(smote(df, row_key, vector, label, k, seed, block_rows, search), "smote")
    return remove_tomek(grown, row_key, vector, label, block_rows, search)


def class_weight(label: str, ratio: float) -> Column:
    """Weight ``ratio`` for class 1, in place of resampling."""
    return F.when(F.col(label) == 1, F.lit(float(ratio))).otherwise(F.lit(1.0))
