"""Exact nearest neighbours without comparing rows pair by pair in SQL.

Equal vectors are first folded into one point, so a group of copies costs
one point whatever its size. Points go to the cell of their nearest pivot;
neighbouring cells make a tile of bounded size, a row of packed vectors in the
shared folder. A tile first searches itself, which bounds how far each point's
neighbours can be; by the triangle inequality only tiles inside that bound are
searched further. Pairs of tiles are a Cartesian product of the stored tiles,
so no vector is shuffled for a pair: compared pairs may grow with the square of
the points, what is shuffled and written grows with the points. A task compares
one tile with the next as matrix products and keeps at most k candidates for a
point over all the tiles it meets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weakspot.functions.text import content_key
from weakspot.operators.order import first_n, order_key
from weakspot.operators.spread import join_group_values, lookup_join
from weakspot.session import written_once

MAX_PIVOTS = 1024
SLACK = 1e-9
TILE_BLOCKS = 8  # blocks of rows that a tile holds
SLICE_ROWS = 512  # queries of one matrix product
SHARE_BYTES = 128 << 20  # vectors of the right side that a task holds
MAX_FILES = 1024  # files of packed tiles


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of two matrices, up to rounding."""
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T), 0.0)


def _candidates(queries: np.ndarray, points: np.ndarray, bound: np.ndarray, k: int, own: bool = False):
    """(rows, columns, distances) that hold the k nearest points of each query
    within its bound; ``own`` says that the points are the queries.

    The matrix product only preselects; distances that decide are computed
    from the differences.
    """
    square, other = (queries * queries).sum(1), (points * points).sum(1)
    slack = SLACK * (1.0 + square + (other.max() if len(other) else 0.0))
    right = np.concatenate([points.T, np.ones((1, len(points))), other[None, :]])
    found = []
    for start in range(0, len(queries), SLICE_ROWS):
        part = slice(start, start + SLICE_ROWS)
        n = len(queries[part])
        near = np.column_stack([-2.0 * queries[part], square[part], np.ones(n)]) @ right
        if own:
            near[np.arange(n), np.arange(start, start + n)] = np.inf
        limit = bound[part] ** 2
        hit = near <= (limit + slack[part])[:, None]
        if np.count_nonzero(hit) > 16 * k * n and near.shape[1] > k:  # a loose bound
            limit = np.minimum(np.partition(near, k - 1, axis=1)[:, k - 1], limit)
            hit = near <= (limit + slack[part])[:, None]
        rows, cols = np.divmod(np.flatnonzero(hit), near.shape[1])
        kept = np.isfinite(near[rows, cols])
        found.append((rows[kept] + start, cols[kept]))
    rows, cols = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, int), np.zeros(0, int))
    exact = np.empty(len(rows))
    step = max(1, 4_000_000 // max(1, queries.shape[1]))
    for i in range(0, len(rows), step):
        gap = queries[rows[i:i + step]] - points[cols[i:i + step]]
        exact[i:i + step] = np.sqrt((gap * gap).sum(1))
    return rows, cols, exact


def _sortable(ids) -> np.ndarray:
    """Text keys as an array that numpy sorts by code point."""
    ids = np.asarray(ids)
    return ids.astype("U") if ids.dtype == object and len(ids) and isinstance(ids[0], str) else ids


class _Best:
    """The k nearest so far, by (distance, id), of each query."""

    def __init__(self, k: int, bound: np.ndarray):
        self.k, self.bound = k, bound.copy()
        self.rows, self.ids, self.away = np.zeros(0, int), None, np.zeros(0)

    def add(self, rows: np.ndarray, ids: np.ndarray, away: np.ndarray) -> None:
        if not len(rows):
            return
        if self.ids is not None:
            rows, ids, away = np.append(self.rows, rows), np.append(self.ids, ids), np.append(self.away, away)
        order = np.lexsort((ids, away, rows))
        rows, ids, away = rows[order], ids[order], away[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        kept = place < self.k
        last = place == self.k - 1
        self.bound[rows[last]] = np.minimum(self.bound[rows[last]], away[last])
        self.rows, self.ids, self.away = rows[kept], ids[kept], away[kept]

    def found(self, query_ids: np.ndarray) -> pd.DataFrame:
        ids = query_ids[:0] if self.ids is None else self.ids
        return pd.DataFrame({"pid": query_ids[self.rows], "other": ids, "distance": self.away})


def _packed(vectors: np.ndarray) -> bytes:
    """As bytes, of floats where that loses nothing."""
    small = vectors.astype("float32")
    return (small if (small == vectors).all() else vectors).tobytes()


def _unpack(data: bytes, rows: int, dim: int) -> np.ndarray:
    kind = "float32" if len(data) == 4 * rows * dim else "float64"
    return np.frombuffer(data, dtype=kind).reshape(rows, dim).astype("float64")


def _tiles(centre: np.ndarray, sizes: list[int], most: int) -> list[tuple[int, int]]:
    """(first tile, tiles) of each cell: cells along a chain of near centres
    share a tile of at most ``most`` rows, a larger cell has several."""
    open_, at, tile, filled = np.ones(len(sizes), bool), 0, 0, 0
    out = [(0, 1)] * len(sizes)
    for _ in sizes:
        open_[at] = False
        if filled and filled + sizes[at] > most:
            tile, filled = tile + 1, 0
        parts = -(-sizes[at] // most)
        out[at] = (tile, parts)
        tile, filled = (tile + parts, 0) if parts > 1 else (tile, filled + sizes[at])
        if open_.any():
            at = int(np.where(open_, _distances(centre[at:at + 1], centre)[0], np.inf).argmin())
    return out


def _nearest_points(points: DataFrame, k: int, block_rows: int, seed: int) -> DataFrame:
    """(pid, other, distance): k nearest among distinct (pid, vector)."""
    count, dim = points.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    kind = points.schema["pid"].dataType.simpleString()
    flat = f"pid {kind}, other {kind}, distance double"
    if count < 2:
        return points.sparkSession.createDataFrame([], flat)
    n_pivots = min(MAX_PIVOTS, -(-count // block_rows))
    chosen = first_n(points.withColumn("__order", order_key(seed, "pid")), "__order", n_pivots)
    pivots = np.array([r["vector"] for r in chosen.collect()], dtype="float64")

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                vectors = np.stack(batch["vector"].to_numpy())
                cell = _distances(vectors, pivots).argmin(1)
                own = np.sqrt(((vectors - pivots[cell]) ** 2).sum(1))
                yield batch.assign(cell=cell.astype("int32"), away=own)

    assigned = written_once(
        points.mapInPandas(assign, f"pid {kind}, vector array<double>, cell int, away double"), "cells")
    stats = assigned.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("far"),
                                         F.min("away").alias("near")).orderBy("cell").collect()
    cells = np.array([r["cell"] for r in stats])
    far, near = np.array([r["far"] for r in stats]), np.array([r["near"] for r in stats])
    centre = pivots[cells]
    placed = _tiles(centre, [r["n"] for r in stats], TILE_BLOCKS * block_rows)
    first, parts = (np.array(c) for c in zip(*placed))
    tiles = int((first + parts).max())
    cuts = points.sparkSession.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(int(c)).alias("cell"), F.lit(int(t)).alias("first"), F.lit(int(p)).alias("parts"))
        for c, t, p in zip(cells, first, parts)])))
    laid = (assigned.drop("away").join(F.broadcast(cuts), "cell")
            .withColumn("tile", (F.col("first") + F.pmod(F.xxhash64("pid"), F.col("parts"))).cast("int")).drop("first", "parts", "cell"))

    def reach(vectors: np.ndarray, bound: np.ndarray, some: np.ndarray) -> np.ndarray:
        """Which of some cells each vector's bound may reach into."""
        to_centre = np.sqrt(_distances(vectors, centre[some]))
        least = np.maximum(np.maximum(to_centre - far[some], near[some] - to_centre), 0.0)
        return least <= bound[:, None] + SLACK * (1.0 + to_centre) + np.sqrt(SLACK)

    def search_self(block: pd.DataFrame) -> pd.DataFrame:
        vectors, ids = np.stack(block["vector"].to_numpy()), _sortable(block["pid"].to_numpy())
        best = _Best(k, np.full(len(ids), np.inf))
        rows, cols, away = _candidates(vectors, vectors, best.bound, k, own=True)
        best.add(rows, ids[cols], away)
        met = np.zeros(len(cells), bool)
        for i in range(0, len(ids), SLICE_ROWS):
            met |= reach(vectors[i:i + SLICE_ROWS], best.bound[i:i + SLICE_ROWS], np.arange(len(cells))).any(0)
        tile = int(block["tile"].iat[0])
        wanted = sorted({t for c in np.flatnonzero(met) for t in range(first[c], first[c] + parts[c])} - {tile})
        found = best.found(ids)
        return pd.DataFrame({
            "tile": [tile], "ids": [ids], "data": [_packed(vectors)], "bound": [best.bound],
            "wanted": [np.array(wanted, dtype="int32")],
            **{c: [found[c].to_numpy()] for c in ("pid", "other", "distance")}})

    packed = laid.repartition(min(tiles, MAX_FILES), "tile").groupBy("tile").applyInPandas(
        search_self, f"tile int, ids array<{kind}>, data binary, bound array<double>, wanted array<int>, "
                     f"pid array<{kind}>, other array<{kind}>, distance array<double>")
    if tiles == 1:
        return packed.select(F.inline(F.arrays_zip("pid", "other", "distance")))
    packed = written_once(packed, "tiles")
    own = packed.select(F.inline(F.arrays_zip("pid", "other", "distance")))

    def search_other(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, best, ids, vectors = None, None, None, None
        for batch in batches:
            for row in batch.itertuples(index=False):
                if row.q_tile != at:
                    if best is not None:
                        yield best.found(ids)
                    at, ids, best = row.q_tile, _sortable(row.q_ids), _Best(k, np.asarray(row.q_bound))
                    vectors = _unpack(row.q_data, len(ids), dim)
                there = _sortable(row.ids)
                here = np.flatnonzero((first <= row.tile) & (row.tile < first + parts))
                pick = np.flatnonzero(reach(vectors, best.bound, here).any(1))
                if len(pick):
                    rows, cols, away = _candidates(vectors[pick], _unpack(row.data, len(there), dim), best.bound[pick], k)
                    best.add(pick[rows], there[cols], away)
        if best is not None:
            yield best.found(ids)

    # a task holds its share of the right side and passes over its left tiles
    shares = max(1, -(-8 * dim * count // SHARE_BYTES))
    left = packed.select(F.col("tile").alias("q_tile"), F.col("ids").alias("q_ids"), F.col("data").alias("q_data"),
                         F.col("bound").alias("q_bound"), F.col("wanted").alias("q_wanted"))
    right = packed.select("tile", "ids", "data").coalesce(shares)
    pairs = left.join(right.hint("shuffle_replicate_nl"), F.array_contains("q_wanted", F.col("tile")))
    others = pairs.drop("q_wanted").mapInPandas(search_other, flat)
    best = W.partitionBy("pid").orderBy("distance", "other")
    return (own.unionByName(others).withColumn("__rn", F.row_number().over(best))
            .filter(F.col("__rn") <= k).drop("__rn"))


def exact_neighbours(
    df: DataFrame, k: int, row_key: str = "row_id", vector: str = "embedding", block_rows: int = 512, seed: int = 42
) -> DataFrame:
    """(row_key, position, neighbour, distance): the k nearest other rows.

    Euclidean distance, ties in row key order, position from 0.
    """
    rows = df.select(F.col(row_key).alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    first, second = content_key("vector")
    rows = rows.withColumns({"__k1": first, "__k2": second})
    keys = ["__k1", "__k2"]
    by_id = W.partitionBy(*keys).orderBy("id")
    # Spark prunes to k + 1 rows for a key before the shuffle
    kept = rows.withColumn("__rn", F.row_number().over(by_id)).filter(F.col("__rn") <= k + 1)
    points = kept.groupBy(*keys).agg(
        F.sort_array(F.collect_list("id")).alias("members"),
        F.any_value("vector").alias("vector"),
    ).withColumn("pid", F.get("members", F.lit(0)))
    points = written_once(points, "points")

    # the lookup may read it more than once
    nearest = written_once(_nearest_points(points.select("pid", "vector"), k, block_rows, seed), "nearest")
    # a nearby point stands for all its copies, of which k + 1 are enough
    copies = points.select(F.col("pid").alias("other"), F.col("members"))
    near = (lookup_join(nearest, copies, "other", "pid")
            .select("pid", F.transform("members", lambda m: F.struct(
                F.col("distance").alias("distance"), m.alias("neighbour"))).alias("c")))
    own = points.select("pid", F.transform("members", lambda m: F.struct(
        F.lit(0.0).alias("distance"), m.alias("neighbour"))).alias("c"))
    # at most k + 1 lists of at most k + 1 entries for a point
    gathered = own.unionByName(near).groupBy("pid").agg(
        F.slice(F.sort_array(F.flatten(F.collect_list("c"))), 1, k + 1).alias("near"))
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__size"))
    groups = points.select("pid", *keys).join(gathered, "pid").join(sizes, keys)
    joined = join_group_values(rows.select("id", *keys), groups, keys, ["near"], "__size", "id")
    others = F.slice(F.filter("near", lambda c: c["neighbour"] != F.col("id")), 1, k)
    return (joined.select("id", F.posexplode(others).alias("position", "c"))
            .select(F.col("id").alias(row_key), "position", "c.neighbour", "c.distance"))
