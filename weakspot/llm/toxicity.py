"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on toxic and one on ordinary
text. A text is cut into windows; each window is compressed with either
dictionary, and the toxic one saves bytes where the text uses what toxic text
uses. Mean, greatest and summed savings are turned into a probability by a
logistic calibration on labelled rows that the dictionaries have not seen.

For a match to mean a shared word and not a shared syllable, words are
spelled as 8-byte codes of the whole word in lower case. Every word of a text
is in a window; each class's training windows hold what is typical of that
class. A fixed marker behind each window
that both dictionaries know keeps the compressor from storing short windows
raw, where a difference would be lost.

The fit uses a bounded sample of labelled rows; its vocabularies and its
training windows are bounded too. Scoring covers every window of every text.

A NULL or empty text has no windows and gets the calibrated score of no
savings. Without labels of both classes the score is that label's share (0
without any). Repeated rows are scored alike; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weakspot.llm import labelled
from weakspot.llm.arrow import map_columns, pieces, texts
from weakspot.llm.quality import LETTER, sigmoid
from weakspot.llm.words import Words, mix
from weakspot.session import written_once

SAMPLE_ROWS = 4_000      # labelled rows of each label that the fit may use
WINDOW = 16              # words
LEAST_DOCS, RATIO = 6, 8.0
VOCABULARY = 16_384      # words typical of a class
TRAINING_WINDOWS = 30_000
DICTIONARY = 12_288      # bytes
LEVEL = 5
MARKER = mix(np.arange(12, dtype="uint64") + np.uint64(991)).tobytes()


def word_codes(own: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the runs of letters, bounds."""
    words = Words([t.lower().encode() for t in own], ~LETTER)
    return words.hashes(), words.bounds


def _among(codes: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(codes), dtype=bool)
    return table[np.minimum(np.searchsorted(table, codes), len(table) - 1)] == codes


def windows(codes: np.ndarray) -> list[bytes]:
    return [codes[i:i + WINDOW].tobytes() for i in range(0, len(codes), WINDOW)]


def train_dictionary(samples: list[bytes]) -> bytes:
    """Dictionary content; plain concatenation where there is too little to train on."""
    try:
        made = zstandard.train_dictionary(DICTIONARY, samples, k=16, d=8).as_bytes()
    except zstandard.ZstdError:
        made = b"".join(samples)[-DICTIONARY:]
    return made + MARKER


class Savings:
    """Per text: windows, mean, greatest and summed bytes saved by the toxic dictionary."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.parts = (toxic, ordinary)
        self.tools = None

    def __getstate__(self):
        return self.parts

    def __setstate__(self, parts):
        self.parts, self.tools = parts, None

    def _compressors(self):
        if self.tools is None:
            self.tools = []
            for content in self.parts:
                held = zstandard.ZstdCompressionDict(content)
                held.precompute_compress(level=LEVEL)
                self.tools.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_content_size=False, write_dict_id=False))
        return self.tools

    def of(self, own: list[str]) -> np.ndarray:
        toxic, ordinary = self._compressors()
        out = np.zeros((len(own), 4))
        codes, bounds = word_codes(own)
        for i, (low, high) in enumerate(zip(bounds[:-1], bounds[1:])):
            cut = [w + MARKER for w in windows(codes[low:high])]
            if cut:
                saved = np.array([len(ordinary.compress(w)) - len(toxic.compress(w)) for w in cut], dtype="float64")
                out[i] = len(cut), saved.mean(), saved.max(), saved.sum()
        return out


def _inputs(savings: np.ndarray) -> np.ndarray:
    """Calibration inputs from (windows, mean, greatest, sum)."""
    n, mean, top, total = savings.T
    size = np.log1p(n)
    return np.stack([np.ones_like(n), mean, top, total / np.sqrt(np.maximum(n, 1)), size, top * size / 8, np.minimum(top, 6)], axis=1)


def calibrate(savings: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression with a small ridge, by Newton steps."""
    x = _inputs(savings)
    beta = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], 1e-2)
    for _ in range(40):
        p = sigmoid(x @ beta)
        slope = x.T @ (weight * (p - y)) + ridge * beta
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        beta -= step
        if np.abs(step).max() < 1e-8:
            break
    return beta


class Model:
    def __init__(self, savings: Savings | None, beta: np.ndarray | None, constant: float | None = None):
        self.savings, self.beta, self.constant = savings, beta, constant

    def scores(self, raw: list[bytes]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(raw), self.constant)
        out = np.empty(len(raw))
        for low, high in pieces(raw):
            out[low:high] = sigmoid(_inputs(self.savings.of([t.decode("utf-8", "replace") for t in raw[low:high]])) @ self.beta)
        return out


def fit(docs: DataFrame, labels: DataFrame, train, label: str = "toxic", key: str = "doc_id", text: str = "text",
        sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learns from at most ``sample_rows`` training rows of each label: three
    quarters for the dictionaries, the rest for the calibration."""
    rows, counts = labelled.sample(docs, labels, label, train, sample_rows, key, text)
    if len(counts) < 2:
        return Model(None, None, float(next(iter(counts), 0)))

    def encode(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            own = texts(batch)
            for low, high in pieces([t.encode() for t in own]):
                codes, bounds = word_codes(own[low:high])
                yield {"y": batch.column("y")[low:high], "part": batch.column("part")[low:high], "text": own[low:high],
                       "codes": [codes[a:b].view("int64") for a, b in zip(bounds[:-1], bounds[1:])]}

    parted = rows.withColumn("part", F.pmod(F.xxhash64(F.lit(23), key), F.lit(4)).cast("int"))
    coded = written_once(map_columns(parted, ["text", "y", "part"], "y int, part int, text string, codes array<long>", encode),
                         "toxicity-sample")
    seen = coded.filter("part > 0")
    spread = (seen.select("y", F.explode(F.array_distinct("codes")).alias("code")).groupBy("code")
              .agg(F.sum(F.expr("bigint(y = 1)")).alias("t"), F.sum(F.expr("bigint(y = 0)")).alias("o")))
    sizes = {r["y"]: r["n"] for r in seen.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    even = F.lit(sizes.get(0, 1) / max(1, sizes.get(1, 1)))  # classes as if equally large
    typical = {1: spread.filter((F.col("t") >= LEAST_DOCS) & (F.col("t") * even >= RATIO * (F.col("o") + 0.5))).orderBy(F.desc("t"), "code"),
               0: spread.filter((F.col("o") >= LEAST_DOCS) & (F.col("o") >= RATIO / 4 * (F.col("t") * even + 0.5))).orderBy(F.desc("o"), "code")}
    table = lambda df: np.sort(df.toArrow().to_pandas()["code"].to_numpy(dtype="int64").view("uint64"))
    content = {}
    for y, chosen in typical.items():
        vocabulary = table(chosen.limit(VOCABULARY).select("code"))

        def cut(batches: Iterator[pa.RecordBatch], vocabulary=vocabulary):
            for batch in batches:
                kept = [np.asarray(c, dtype="int64").view("uint64") for c in batch.column("codes").to_pylist()]
                yield {"window": [w for c in kept for w in windows(c[_among(c, vocabulary)])]}

        made = map_columns(seen.filter(F.col("y") == y), ["codes"], "window binary", cut)
        taken = made.orderBy(F.xxhash64("window"), "window").limit(TRAINING_WINDOWS).toArrow().to_pandas()["window"]
        content[y] = train_dictionary([bytes(w) for w in taken])
    savings = Savings(content[1], content[0])
    shared = docs.sparkSession.sparkContext.broadcast(savings)

    def measure(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            made = shared.value.of(texts(batch))
            yield {"y": batch.column("y"), **{n: made[:, i] for i, n in enumerate(("n", "mean", "top", "total"))}}

    unseen = map_columns(coded.filter("part = 0"), ["text", "y"], "y int, n double, mean double, top double, total double",
                         measure).toArrow().to_pandas().sort_values(["y", "n", "mean", "top", "total"])  # at most 2 * sample_rows numbers
    y = unseen["y"].to_numpy(dtype="float64")
    # between the balanced sample's and the labelled rows' own shares
    share = {v: (counts[v] / max(1, int((y == v).sum()))) ** 0.5 for v in (0, 1)}
    weight = np.where(y == 1, share[1], share[0])
    weight *= len(y) / max(weight.sum(), 1e-9)
    return Model(savings, calibrate(unseen[["n", "mean", "top", "total"]].to_numpy(), y, weight))
