"""Quality classifier: hashed word n-gram logistic regression by FTRL.

Features of a text are word n-grams of two kinds, hashed into a table of
fixed size: unigrams and bigrams of the words (letters only, lower case) and
of their shapes (the signs in the word, all capitals, a repeat of a recent
word). Their values are shares of the text's words, so a text's length does
not move its score; a score is a sparse dot product.

Training follows the regularised leader. The labelled sample is dealt to a
fixed number of shards; in each round every shard runs the sequential update
from the shared state, and the changes are averaged per coordinate. The
sample is bounded by a parameter, the state by the table; scoring reads every
text whole.

A NULL or empty text has no features and gets the score of the bias. Without
labels, or with one label only, the score is the share of that label (0.5
without any). Repeated rows are scored alike; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weakspot.llm import labelled
from weakspot.llm.arrow import map_columns, pieces, raw_texts
from weakspot.llm.words import SPACE, Words, _powers, mix, row_sums
from weakspot.session import written_once

BITS = 18
SAMPLE_ROWS = 4_000  # labelled rows of each label that the fit may use
SHARDS = 8
ROUNDS = 3
ALPHA, BETA, L1, L2 = 2.0, 0.05, 0.002, 0.02
SCALE = 6.0

LETTER = np.zeros(256, dtype=bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
UPPER = np.zeros(256, dtype=bool)
UPPER[65:91] = True
LOWERED = np.arange(256, dtype="uint64")
LOWERED[65:91] += np.uint64(32)
LOWERED = np.where(LETTER, LOWERED + np.uint64(1), np.uint64(0))
SIGN = np.where(LETTER | SPACE, np.uint64(0), mix(np.arange(256, dtype="uint64") + np.uint64(77)))


def features(texts: list[bytes], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(indices, bounds): text i has ``bounds[i]:bounds[i + 1]``, four for each word."""
    words = Words(texts)
    n = len(words.starts)
    if not n:
        return np.zeros(0, dtype="int64"), words.bounds * 4
    power, inverse = _powers(len(words.bytes) + 1)
    name = mix(words.sums(LOWERED[words.bytes] * power[:len(words.bytes)]) * inverse[words.starts])
    signs = words.sums(SIGN[words.bytes])
    upper, letters = words.sums(UPPER[words.bytes].astype("uint64")), words.sums(LETTER[words.bytes].astype("uint64"))
    owner = np.repeat(np.arange(len(texts)), np.diff(words.bounds))
    again = np.zeros(n, dtype="uint64")
    for back in (1, 2, 3):
        if n > back:
            again[back:] |= ((name[back:] == name[:-back]) & (owner[back:] == owner[:-back])).astype("uint64")
    shout = ((upper >= 2) & (upper == letters)).astype("uint64")
    shape = mix(signs + shout * np.uint64(0x51ED27) + again * np.uint64(0xA24BAED) + (letters == 0).astype("uint64") * np.uint64(0x9FB21C6))
    first = np.zeros(n, dtype=bool)
    first[words.bounds[:-1][np.diff(words.bounds) > 0]] = True

    def pairs(x):
        before = np.concatenate([np.zeros(1, dtype="uint64"), x[:-1]])
        before[first] = 0
        return mix(before * np.uint64(0x9E3779B97F4A7C15) + x)

    kinds = [name, pairs(name), shape, pairs(shape)]
    made = np.stack([mix(k + np.uint64(i + 1)) >> np.uint64(64 - bits) for i, k in enumerate(kinds)], axis=1)
    return made.ravel().astype("int64"), words.bounds * 4


def sparse(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct indices and values of each text."""
    index, bounds = features(texts)
    for low, high in zip(bounds[:-1], bounds[1:]):
        at, count = np.unique(index[low:high], return_counts=True)
        yield at, count * (SCALE * 4.0 / max(4, high - low))


def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The leader for gradient sums z and squared sums n."""
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def follow(rows: list[tuple[np.ndarray, np.ndarray, int]], z: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sequential updates of one shard; the last cell is the bias."""
    z, n = z.copy(), n.copy()
    bias = len(z) - 1
    for at, value, y in rows:
        at, value = np.append(at, bias), np.append(value, 1.0)
        w = weights(z[at], n[at])
        g = (sigmoid(float(w @ value)) - y) * value
        root = np.sqrt(n[at] + g * g)
        z[at] += g - (root - np.sqrt(n[at])) / ALPHA * w
        n[at] += g * g
    return z, n


class Model:
    """Weights of the hashed features, the bias last; or one score for all."""

    def __init__(self, weight: np.ndarray, constant: float | None = None):
        self.weight, self.constant = weight, constant

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        out = np.empty(len(texts))
        for low, high in pieces(texts):
            index, bounds = features(texts[low:high])
            size = np.maximum(np.diff(bounds), 4)
            out[low:high] = row_sums(self.weight[index], bounds) * (SCALE * 4.0) / size
        return sigmoid(out + self.weight[-1])


def fit(docs: DataFrame, labels: DataFrame, train, label: str = "quality", key: str = "doc_id", text: str = "text",
        sample_rows: int = SAMPLE_ROWS, rounds: int = ROUNDS, shards: int = SHARDS) -> Model:
    """Learns from at most ``sample_rows`` training rows of each label."""
    rows, counts = labelled.sample(docs, labels, label, train, sample_rows, key, text)
    if len(counts) < 2:
        return Model(np.zeros(1), float(next(iter(counts), 0.5)))
    rows = written_once(rows.select("text", "y", F.xxhash64(F.lit(5), key).alias("order"))
                        .withColumn("shard", F.pmod("order", F.lit(shards)).cast("int")), "quality-sample")
    size = (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)
    context = docs.sparkSession.sparkContext
    for _ in range(rounds):
        shared = context.broadcast((z, n))

        def one(frame: pd.DataFrame) -> pd.DataFrame:
            frame = frame.sort_values(["order", "text"])
            own = [t.encode() for t in frame["text"]]
            made: list[tuple] = []
            for low, high in pieces(own):
                made += [(at, value, y) for (at, value), y in zip(sparse(own[low:high]), frame["y"].iloc[low:high])]
            z0, n0 = shared.value
            z1, n1 = follow(made, z0, n0)
            moved = np.flatnonzero((z1 != z0) | (n1 != n0))
            return pd.DataFrame({"at": moved, "z": (z1 - z0)[moved], "n": (n1 - n0)[moved]})

        change = (rows.groupBy("shard").applyInPandas(one, "at long, z double, n double").groupBy("at")
                  .agg(F.sum("z").alias("z"), F.sum("n").alias("n")).toArrow().to_pandas())  # at most one row per table cell
        at = change["at"].to_numpy()
        z[at] += change["z"].to_numpy() / shards
        n[at] += change["n"].to_numpy() / shards
        shared.unpersist()
    return Model(weights(z, n))


def score(docs: DataFrame, model, key: str = "doc_id", text: str = "text", keep: list[str] = ()) -> DataFrame:
    """(key, *keep, score double, predicted int); ``model`` scores UTF-8 texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = [key, *[c for c in keep if c != key]]
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            values = shared.value.scores(raw_texts(batch, text))
            yield {**{c: batch.column(c) for c in columns}, "score": values, "predicted": (values >= 0.5).astype("int32")}

    return map_columns(docs, list(dict.fromkeys([*columns, text])), f"{fields}, score double, predicted int", run)
