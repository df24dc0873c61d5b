"""Exact top-k inner products by tiles.

Vectors become whole numbers, so scores are exact and ties are real. All
rows are dealt by hash into shards of bounded size, the stated queries into
blocks; a tile is one block against one shard, a matrix product in one task
that keeps k rows for a query. Lists of at most k entries are merged up a
tree with a bounded fan-in, so no task or driver sees all of a query's
candidates however many shards there are.

A vector that is NULL or holds NULL, NaN or infinite components takes no
part, nor does one whose length differs from the query's. Repeated vectors
are candidates of their own; ties go to the smaller id. An empty table or no
query gives no rows; extra columns are ignored. Scores wrap as 64-bit
integers, components beyond 64 bits count as the nearest one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weakspot.llm.arrow import map_columns
from weakspot.session import written_once

SHARD_ROWS = 16_384
BLOCK_ROWS = 4_096
FAN_IN = 16
STEP_CELLS = 4_000_000


def usable(vector: str) -> Column:
    """Not NULL, not empty, all components finite."""
    v = F.col(vector)
    limit = F.lit(float("inf"))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0)
                      & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit)), F.lit(False))


def pack_rows(df: DataFrame, key: str, vector: str, group: str, keep: list[str] = ()) -> DataFrame:
    """One row for each group and length: ids and matrix as bytes, ids ascending."""
    def one(keys: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(key)
        matrix = np.stack(frame[vector].to_numpy()).astype("float64")
        return pd.DataFrame({group: [keys[0]], "width": [keys[1]], "ids": [frame[key].to_numpy().astype("int64").tobytes()],
                             "matrix": [matrix.tobytes()]})

    return (df.withColumn("width", F.size(vector)).groupBy(group, "width")
            .applyInPandas(one, f"`{group}` long, width int, ids binary, matrix binary"))


def _numbers(data: bytes, width: int, scale: float) -> np.ndarray:
    scaled = np.floor(np.frombuffer(data, dtype="float64").reshape(-1, width) * scale)
    top = float(2 ** 63)
    whole = np.where(np.abs(scaled) < top, scaled, 0.0).astype("int64")
    return np.where(scaled >= top, np.iinfo("int64").max, np.where(scaled < -top, np.iinfo("int64").min, whole))


def tile_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T as 64-bit integers; through floats where those are exact."""
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)), dtype="int64")
    bound = float(np.abs(a.astype("float64")).max()) * float(np.abs(b.astype("float64")).max()) * a.shape[1]
    if bound < 2 ** 53:
        return (a.astype("float64") @ b.astype("float64").T).astype("int64")
    return a @ b.T


def best_of_tile(q_ids, queries, ids, points, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query id, ids, scores) of the k best other rows; ids are ascending."""
    step = max(1, STEP_CELLS // max(1, len(ids)))
    for low in range(0, len(q_ids), step):
        scores = tile_scores(queries[low:low + step], points)
        for qid, row in zip(q_ids[low:low + step], scores):
            if len(row) > k + 1:
                # one more than k, for the query itself may be among them
                limit = np.partition(row, len(row) - k - 1)[len(row) - k - 1]
                above, equal = np.flatnonzero(row > limit), np.flatnonzero(row == limit)
                pick = np.sort(np.concatenate([above, equal[:k + 1]]))
            else:
                pick = np.arange(len(row))
            pick = pick[ids[pick] != qid]
            pick = pick[np.argsort(-row[pick].astype("float64") if abs(row[pick]).max(initial=0) < 2 ** 53 else
                                   np.array([-int(x) for x in row[pick]], dtype=object), kind="stable")][:k]
            yield int(qid), ids[pick], row[pick]


def top_k(df: DataFrame, queries: Column, k: int = 10, scale: float = 1024.0, key: str = "vec_id", vector: str = "embedding",
          shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, key, score): each query's k highest other rows."""
    rows = df.select(F.col(f"`{key}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"),
                     F.coalesce(queries, F.lit(False)).alias("q")).filter(F.col("id").isNotNull() & usable("v"))
    counted = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.col("q").cast("long")), F.lit(0)).alias("q")).first()
    shards, blocks = max(1, -(-counted["n"] // shard_rows)), max(1, -(-counted["q"] // block_rows))
    hashed = F.xxhash64("id")
    points = pack_rows(rows.select("id", "v", F.pmod(hashed, F.lit(shards)).alias("shard")), "id", "v", "shard")
    asked = pack_rows(rows.filter("q").select("id", "v", F.pmod(hashed, F.lit(blocks)).alias("block")), "id", "v", "block")
    asked = asked.select("block", "width", F.col("ids").alias("q_ids"), F.col("matrix").alias("q_matrix"),
                         F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"))
    tiles = asked.join(points, ["shard", "width"])

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for tile in batch.to_pylist():
                width = tile["width"]
                ids, q_ids = np.frombuffer(tile["ids"], "int64"), np.frombuffer(tile["q_ids"], "int64")
                found = list(best_of_tile(q_ids, _numbers(tile["q_matrix"], width, scale), ids,
                                          _numbers(tile["matrix"], width, scale), k))
                yield {"query_id": [f[0] for f in found], "node": [tile["shard"]] * len(found),
                       "best": [[{"down": ~int(s), "id": int(i)} for i, s in zip(f[1], f[2])] for f in found]}

    columns = ["shard", "width", "ids", "matrix", "q_ids", "q_matrix"]
    tops = map_columns(tiles, columns, "query_id long, node long, best array<struct<down: long, id: long>>", run)
    tops = written_once(tops, "tile-tops")
    nodes = shards
    while True:
        # ~score ascending is score descending, without overflow
        nodes = -(-nodes // FAN_IN)
        tops = (tops.withColumn("node", F.floor(F.col("node") / FAN_IN)).groupBy("query_id", "node")
                .agg(F.slice(F.sort_array(F.flatten(F.collect_list("best"))), 1, k).alias("best")))
        if nodes <= 1:
            break
    return (tops.select("query_id", F.posexplode("best").alias("at", "b"))
            .select("query_id", (F.col("at") + 1).alias("rank"), F.col("b.id").alias(key), F.bitwise_not("b.down").alias("score")))
