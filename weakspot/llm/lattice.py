"""Near-duplicate vectors by E8 lattice hashing.

A table projects unit vectors onto random orthonormal directions, eight at a
time, and decodes each eight to the nearest point of the E8 lattice; the
points of a table's decoders make one cell. Near vectors fall into the same
cell or into neighbouring ones, so a vector also probes the cells that
result from stepping to the nearest minimal vectors of the lattice. Vectors
that share a cell in any table, one at home and the other at home or as a
probe, are compared by cosine in double precision.

Equal vectors of one label are one class, whatever their number. Only cells
with a possible partner get vectors. A crowded cell is cut into blocks, and
pairs of blocks are compared as matrix products; tasks emit counts and a
spanning forest, never pairs. A pair that meets in several cells is counted
in the one with the smallest number.

A NULL, empty, zero or non-finite vector or one without a label links with
nothing. Repeated rows are members of their class. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weakspot.llm.arrow import map_columns
from weakspot.llm.groups import attach, components
from weakspot.llm.topk import usable
from weakspot.llm.words import mix
from weakspot.session import written_once

TABLES = 10
EIGHTS = 2           # lattice decoders of a table
SCALE = 4.2          # lattice units for a projected unit vector
PROBES = 6
BLOCK = 1_024
SEED = 29


@lru_cache(maxsize=1)
def minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    whole = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            whole.append(v)
    half = [np.array(s) / 2 for s in product((1.0, -1.0), repeat=8) if np.prod(s) > 0]
    return np.array(whole + half)


def _decode_d8(x: np.ndarray) -> np.ndarray:
    """Nearest points whose coordinates are whole and sum to an even number."""
    near = np.rint(x)
    odd = np.flatnonzero(near.sum(1) % 2 != 0)
    if len(odd):
        off = x[odd] - near[odd]
        worst = np.abs(off).argmax(1)
        step = np.where(off[np.arange(len(odd)), worst] >= 0, 1.0, -1.0)
        near[odd, worst] += step
    return near


def decode_e8(x: np.ndarray) -> np.ndarray:
    """Nearest E8 points: the better of D8 and D8 shifted by a half."""
    a, b = _decode_d8(x), _decode_d8(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1))[:, None], a, b)


@lru_cache(maxsize=8)
def directions(width: int, tables: int, eights: int, seed: int) -> np.ndarray:
    """tables x (8 * eights) x width; orthonormal within a table where the width allows."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(tables):
        rows = rng.standard_normal((8 * eights, width))
        if width >= 8 * eights:
            rows = np.linalg.qr(rows.T)[0].T
        else:
            rows /= np.sqrt((rows ** 2).sum(1, keepdims=True))
        out.append(rows * np.sqrt(min(width, 64) / 64))
    return np.array(out)


def cells(unit: np.ndarray, tables: int = TABLES, eights: int = EIGHTS, scale: float = SCALE, probes: int = PROBES,
          seed: int = SEED) -> np.ndarray:
    """rows x tables x (1 + probes) cell numbers, the home cell first."""
    turns = directions(unit.shape[1], tables, eights, seed)
    out = np.empty((len(unit), tables, 1 + probes), dtype="int64")
    roots = minimal_vectors()
    ways = [w for w in product(range(3), repeat=eights) if any(w)]
    weight = mix(np.arange(1, 8 * eights + 1, dtype="uint64") * np.uint64(0x9E3779B9))

    def number(points: np.ndarray, t: int) -> np.ndarray:
        return mix((np.rint(points * 2).astype("int64").view("uint64") * weight).sum(1) + np.uint64(t + 1)).view("int64")

    for t in range(tables):
        x = unit @ turns[t].T * scale
        home, steps, gaps = [], [], []
        for e in range(eights):
            part = x[:, 8 * e:8 * e + 8]
            point = decode_e8(part)
            gain = (part - point) @ roots.T
            best = np.argpartition(-gain, 2, axis=1)[:, :2]
            value = np.take_along_axis(gain, best, axis=1)
            turn = np.argsort(-value, axis=1)
            best, value = np.take_along_axis(best, turn, axis=1), np.take_along_axis(value, turn, axis=1)
            home.append(point)
            steps.append(np.stack([np.zeros_like(point), roots[best[:, 0]], roots[best[:, 1]]]))
            gaps.append(np.stack([np.zeros(len(unit)), 2 - 2 * value[:, 0], 2 - 2 * value[:, 1]]))
        base = np.concatenate(home, axis=1)
        out[:, t, 0] = number(base, t)
        cost = np.stack([sum(gaps[e][w[e]] for e in range(eights)) for w in ways])
        order = np.argsort(cost, axis=0, kind="stable")[:probes]
        every = np.stack([number(base + np.concatenate([steps[e][w[e]] for e in range(eights)], axis=1), t) for w in ways])
        out[:, t, 1:] = np.take_along_axis(every, order, axis=0).T
    return out


def _hash_classes(known: DataFrame, tables: int, eights: int, scale: float, probes: int) -> DataFrame:
    """(cid, label, mult, width, unit vector, codes) with both as bytes."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            vectors = batch.column("v").to_pylist()
            widths = np.array([len(v) for v in vectors], dtype="int64")
            units, codes = [None] * len(vectors), [None] * len(vectors)
            for width in np.unique(widths):
                at = np.flatnonzero(widths == width)
                matrix = np.array([vectors[i] for i in at], dtype="float64")
                matrix /= np.abs(matrix).max(1, keepdims=True)  # keeps squares in range
                unit = matrix / np.sqrt((matrix * matrix).sum(1, keepdims=True))
                made = cells(unit, tables, eights, scale, probes)
                for j, i in enumerate(at):
                    units[i], codes[i] = unit[j].tobytes(), made[j].ravel()
            yield {"cid": batch.column("cid"), "label": batch.column("label"), "mult": batch.column("mult"), "width": widths,
                   "unit": units, "codes": codes}

    return map_columns(known, ["cid", "label", "mult", "v"],
                       "cid long, label long, mult long, width int, unit binary, codes array<long>", run)


def _smallest_meeting(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest cell in which each pair of code matrices meets."""
    top = np.iinfo("int64").max
    home_a, home_b = a[:, :, :1], b[:, :, :1]
    at_a = np.where((home_a == b).any(2), home_a[:, :, 0], top).min(1)
    at_b = np.where((home_b == a).any(2), home_b[:, :, 0], top).min(1)
    return np.minimum(at_a, at_b)


def _compare(frame: pd.DataFrame, tables: int, threshold: float) -> pd.DataFrame:
    """Counts and a spanning forest of the pairs that this cell decides."""
    cell, low, high = frame["cell"].iat[0], frame["low"].iat[0], frame["high"].iat[0]
    ids, mult, home, block = (frame[c].to_numpy() for c in ("cid", "mult", "home", "block"))
    unit = np.stack([np.frombuffer(u, "float64") for u in frame["unit"]])
    codes = np.stack([np.asarray(c, dtype="int64") for c in frame["codes"]]).reshape(len(ids), tables, -1)
    first, second = np.flatnonzero(block == low), np.flatnonzero(block == high)
    added, parent = np.zeros(len(ids), dtype="int64"), np.arange(len(ids))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for start in range(0, len(first), 256):
        rows = first[start:start + 256]
        x, y = np.nonzero(unit[rows] @ unit[second].T >= threshold)
        x, y = rows[x], second[y]
        fits = (x < y if low == high else np.ones(len(x), dtype=bool)) & (home[x] | home[y])
        x, y = x[fits], y[fits]
        for at in range(0, len(x), 65_536):
            i, j = x[at:at + 65_536], y[at:at + 65_536]
            own = _smallest_meeting(codes[i], codes[j]) == cell
            i, j = i[own], j[own]
            np.add.at(added, i, mult[j])
            np.add.at(added, j, mult[i])
            for a, b in zip(i, j):
                a, b = root(a), root(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
    hit = np.flatnonzero(added)
    return pd.DataFrame({"cid": ids[hit], "links": added[hit], "other": ids[[root(i) for i in hit]] if len(hit) else ids[:0]})


def near_duplicates(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = 0.93,
                    tables: int = TABLES, eights: int = EIGHTS, scale: float = SCALE, probes: int = PROBES) -> DataFrame:
    """(key, n_links, component_id, kept) of every row; keys are whole numbers."""
    rows = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"),
                     F.col(f"`{label}`").cast("long").alias("label"))
    good = usable("v") & F.col("label").isNotNull() & F.col("id").isNotNull() & F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False))
    marked = rows.select("id", "label", "v", good.alias("good")).withColumns({"k1": F.xxhash64("v"), "k2": F.xxhash64(F.lit(3), "v")})
    keys = ["label", "k1", "k2"]
    known = written_once(marked.filter("good").groupBy(*keys).agg(
        F.min("id").alias("cid"), F.count(F.lit(1)).alias("mult"), F.first("v").alias("v")), "vectors")
    hashed = written_once(_hash_classes(known, tables, eights, scale, probes), "cells")
    entries = hashed.select("cid", "label", "width", F.posexplode("codes").alias("pos", "cell")).select(
        "cid", "label", "width", "cell", (F.col("pos") % (probes + 1) == 0).alias("home"))
    # a probe that meets its own home or another probe of the vector adds nothing
    entries = entries.groupBy("label", "width", "cell", "cid").agg(F.max("home").alias("home"))
    held = entries.groupBy("label", "width", "cell").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("home").cast("long")).alias("homes"))
    held = held.filter("n > 1 AND homes > 0").withColumn("blocks", F.ceil(F.col("n") / BLOCK)).drop("n", "homes")
    dealt = (entries.join(held, ["label", "width", "cell"]).withColumn("block", F.pmod(F.xxhash64("cid", F.lit(5)), F.col("blocks")))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}))
    full = dealt.select("cid", "label", "width", "cell", "home", "block", "low", "high").join(
        hashed.select("cid", "mult", "unit", "codes"), "cid")

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        return _compare(frame, tables, threshold)

    found = written_once(full.groupBy("label", "width", "cell", "low", "high").applyInPandas(one, "cid long, links long, other long"), "links")
    counts = found.groupBy("cid").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("cid").alias("a"), F.col("other").alias("b")))
    result = (known.select(*keys, "cid", "mult").join(counts, "cid", "left").join(joined.withColumnRenamed("id", "cid"), "cid", "left")
              .withColumns({"n_links": F.coalesce("links", F.lit(0)) + F.col("mult") - 1, "component": F.coalesce("component", "cid")}))
    total = rows.count()
    good_rows = attach(marked.filter("good").select("id", *keys), result, keys, ["n_links", "component"], "mult", total)
    others = marked.filter(~F.col("good")).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    return (good_rows.select("id", "n_links", "component").unionByName(others)
            .select(F.col("id").alias(key), "n_links", F.col("component").alias("component_id"), (F.col("id") == F.col("component")).alias("kept")))
