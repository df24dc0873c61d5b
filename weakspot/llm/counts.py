"""Token counts by a two-tier lookup on the map side.

A sentencepiece BPE whose pieces hold the space mark only at their front
never merges across the place where a space follows another character. A text
(with the mark the library puts before it) therefore falls into pre-tokens,
each a run of spaces with the word behind it, whose token counts add up.

Tier one is a table from the number of a frequent pre-token to its token
count: every task keeps a summary of its most frequent pre-tokens over all its
texts, summaries are merged along a tree of written tables, and the result (at
most ``TABLE`` entries of 10 bytes at half load, whatever the corpus) is
broadcast as an open-addressing hash table that NumPy probes a batch at a time.
Tier two is a bounded cache in each worker for the rest; what is in neither is
encoded by the library. No pre-token crosses the network, only summaries of
bounded size do. Which pre-tokens stand in which tier changes the speed alone:
every count is the library's own.

Pre-tokens are known by 64-bit numbers; two of a lookup share one with a
probability of about 2^-64. A NULL text is empty and has no tokens. Rows with
equal ids or texts are counted as rows of their own; extra columns are ignored;
an empty table gives no rows. A text of any length is counted whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weakspot.llm.arrow import map_columns, pieces, raw_texts
from weakspot.llm.words import Words, mix
from weakspot.session import written_once

TABLE = 1 << 16  # entries of tier one
OF_TASK = 1 << 12  # entries of one task's summary
HELD = 1 << 14  # entries that a task keeps while it counts
CACHE = 100_000  # entries of tier two, about 10 MB a worker
FAN_IN = 32  # partitions whose summaries one task merges

MARK = "▁"  # fixed value: the library's space mark
_MARK = MARK.encode()
_ONLY_SPACE = np.zeros(256, dtype=bool)
_ONLY_SPACE[0x20] = True
_STEP = np.uint64(0xD1B54A32D192ED03)


@lru_cache(maxsize=2)
def _library(model: str):
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

    tool = SentencePieceProcessor(model_file=model)
    spec = sentencepiece_model_pb2.ModelProto()
    spec.ParseFromString(tool.serialized_model_proto())
    rules = spec.normalizer_spec
    plain = rules.name == "identity" and rules.add_dummy_prefix and not rules.remove_extra_whitespaces
    if not plain or any(MARK in tool.id_to_piece(i).lstrip(MARK) for i in range(tool.get_piece_size())):
        raise ValueError("the model normalises texts or has pieces across spaces, so pre-tokens are not independent")
    return tool, {}


def encoded_lengths(model: str, found: list[tuple[int, bytes]]) -> list[int]:
    """Tokens of pre-tokens, each given as its spaces and its word."""
    tool, _ = _library(model)
    # the library puts one space mark before what it is given
    own = [" " * (spaces - 1) + word.decode() for spaces, word in found]
    return [len(ids) if text else 1 for text, ids in zip(own, tool.encode(own, num_threads=1))]


class PreTokens:
    """The pre-tokens of some texts: numbers, spaces, words; ``bounds`` by text."""

    def __init__(self, texts: list[bytes]):
        texts = [t.replace(_MARK, b" ") if _MARK in t else t for t in texts]
        words = Words(texts, _ONLY_SPACE)
        self.words, self.bounds = words, words.bounds
        sizes = np.fromiter(map(len, texts), dtype="int64", count=len(texts))
        begins = np.cumsum(sizes + 1) - sizes - 1
        self.ends_at = begins + sizes
        before = np.empty(len(words.starts), dtype="int64")
        before[1:] = words.ends[:-1]
        has = np.flatnonzero(self.bounds[1:] > self.bounds[:-1])
        before[self.bounds[:-1][has]] = begins[has] - 1  # the mark before the text
        self.spaces = words.starts - before
        last = begins - 1
        last[has] = words.ends[self.bounds[1:][has] - 1]
        # spaces behind the last word, or all of a text without words
        self.tail = np.where(sizes > 0, self.ends_at - last, 0)
        self.numbers = mix(words.hashes() + _STEP * self.spaces.astype("uint64"))

    def at(self, i: int) -> tuple[int, bytes]:
        return int(self.spaces[i]), self.words.bytes[self.words.starts[i]:self.words.ends[i]].tobytes()


class Summary:
    """The most frequent pre-tokens so far, with their counts."""

    def __init__(self, most: int = HELD):
        self.most, self.numbers, self.counts, self.seen = most, np.zeros(0, "uint64"), np.zeros(0, "int64"), {}

    def add(self, found: PreTokens) -> None:
        numbers, first, counts = np.unique(found.numbers, return_index=True, return_counts=True)
        places = dict(zip(numbers.tolist(), first.tolist())) if len(numbers) <= self.most else None
        self.numbers, self.counts = top(np.concatenate([self.numbers, numbers]), np.concatenate([self.counts, counts]), self.most)
        new = [n for n in self.numbers.tolist() if n not in self.seen]
        at = [places[n] for n in new] if places is not None else first[np.searchsorted(numbers, np.asarray(new, "uint64"))].tolist()
        self.seen.update(zip(new, map(found.at, at)))
        if len(self.seen) > 2 * self.most:
            self.seen = {n: self.seen[n] for n in self.numbers.tolist()}

    def result(self, model: str, most: int = OF_TASK) -> tuple[np.ndarray, np.ndarray, list[int]]:
        numbers, counts = top(self.numbers, self.counts, most)
        return numbers, counts, encoded_lengths(model, [self.seen[n] for n in numbers.tolist()])


def top(numbers: np.ndarray, counts: np.ndarray, most: int, lengths: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Counts added up by number, the ``most`` largest of them in order of number."""
    numbers, first, place = np.unique(numbers, return_index=True, return_inverse=True)
    counts = np.bincount(place, weights=counts, minlength=len(numbers)).astype("int64")
    kept = np.sort(np.lexsort((numbers, -counts))[:most])
    return (numbers[kept], counts[kept]) + (() if lengths is None else (lengths[first][kept],))


class Lookup:
    """Open addressing with linear probing, at most half full."""

    def __init__(self, numbers: np.ndarray, lengths: np.ndarray):
        bits = max(4, int(len(numbers)).bit_length() + 1)
        self.shift, self.mask = np.uint64(64 - bits), np.uint64((1 << bits) - 1)
        self.keys, self.values = np.zeros(1 << bits, "uint64"), np.full(1 << bits, -1, "int32")
        slot = numbers >> self.shift
        left = np.arange(len(numbers))
        while len(left):
            free = left[self.values[slot[left]] < 0]
            self.keys[slot[free]], self.values[slot[free]] = numbers[free], lengths[free]  # of equal slots the last one stays
            left = left[self.keys[slot[left]] != numbers[left]]
            slot[left] = (slot[left] + np.uint64(1)) & self.mask

    def get(self, numbers: np.ndarray) -> np.ndarray:
        """The lengths, -1 where a number is unknown."""
        slot = numbers >> self.shift
        out = np.where(self.keys[slot] == numbers, self.values[slot], -1)
        left = np.flatnonzero((out < 0) & (self.values[slot] >= 0))
        while len(left):
            slot[left] = (slot[left] + np.uint64(1)) & self.mask
            there = slot[left]
            out[left] = np.where(self.keys[there] == numbers[left], self.values[there], -1)
            left = left[(out[left] < 0) & (self.values[there] >= 0)]
        return out


def frequent(docs: DataFrame, model: str, text: str = "text", entries: int = TABLE) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and token counts of the most frequent pre-tokens of all texts."""
    schema = "numbers array<long>, counts array<long>, lengths array<int>"

    def row(numbers, counts, lengths):
        return {"numbers": [numbers.view("int64")], "counts": [counts], "lengths": [lengths]}

    def count(batches: Iterator[pa.RecordBatch]):
        held = Summary()
        for batch in batches:
            own = raw_texts(batch, text)
            for start, end in pieces(own):
                held.add(PreTokens(own[start:end]))
        if len(held.numbers):
            yield row(*held.result(model))

    def merge(batches: Iterator[pa.RecordBatch]):
        numbers, counts, lengths = np.zeros(0, "uint64"), np.zeros(0, "int64"), np.zeros(0, "int32")
        for batch in batches:
            for i in range(batch.num_rows):
                own = [batch.column(c)[i].values.to_numpy() for c in ("numbers", "counts", "lengths")]
                numbers, counts, lengths = top(np.concatenate([numbers, own[0].view("uint64")]), np.concatenate([counts, own[1]]),
                                               entries, np.concatenate([lengths, own[2]]))
        if len(numbers):
            yield row(numbers, counts, lengths)

    columns = ["numbers", "counts", "lengths"]
    level = written_once(map_columns(docs, [text], schema, count), "frequent")
    while (rows := level.count()) > 1:
        # neighbouring partitions are joined, nothing is shuffled
        level = written_once(map_columns(level.coalesce(max(1, rows // FAN_IN)), columns, schema, merge), "frequent")
    found = level.first()
    if found is None:
        return np.zeros(0, "uint64"), np.zeros(0, "int32")
    return np.asarray(found["numbers"], dtype="int64").view("uint64"), np.asarray(found["lengths"], dtype="int32")


def lengths_of(found: PreTokens, table: Lookup, model: str) -> np.ndarray:
    """Tokens of every pre-token: table, then cache, then library."""
    _, cache = _library(model)
    out = table.get(found.numbers)
    missed = np.flatnonzero(out < 0)
    if len(missed):
        numbers, first, place = np.unique(found.numbers[missed], return_index=True, return_inverse=True)
        own = [cache.get(n, -1) for n in numbers.tolist()]
        unknown = [i for i, n in enumerate(own) if n < 0]
        for start in range(0, len(unknown), 1000):
            part = unknown[start:start + 1000]
            for i, n in zip(part, encoded_lengths(model, [found.at(missed[first[i]]) for i in part])):
                own[i] = n
        if len(cache) + len(unknown) > CACHE:  # the older half goes
            for n in list(cache)[:len(cache) // 2 + len(unknown)]:
                del cache[n]
        cache.update((int(numbers[i]), own[i]) for i in unknown[:CACHE // 2])
        out[missed] = np.asarray(own, dtype="int32")[place]
    return out


def token_counts(docs: DataFrame, model: str, keep: list[str], text: str = "text") -> DataFrame:
    """The kept columns, n_bytes and n_tokens of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent(docs, model, text))

    def run(batches: Iterator[pa.RecordBatch]):
        table = Lookup(*shared.value)
        for batch in batches:
            own = raw_texts(batch, text)
            counts = []
            for start, end in pieces(own):
                found = PreTokens(own[start:end])
                total = np.concatenate([[0], np.cumsum(lengths_of(found, table, model), dtype="int64")])
                tails = found.tail
                runs, place = np.unique(tails, return_inverse=True)
                behind = [encoded_lengths(model, [(int(n), b"")])[0] if n else 0 for n in runs]
                counts.append(total[found.bounds[1:]] - total[found.bounds[:-1]] + np.asarray(behind, dtype="int64")[place])
            yield {**{c: batch.column(c) for c in keep}, "n_bytes": [len(t) for t in own],
                   "n_tokens": np.concatenate(counts) if counts else []}

    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
    return map_columns(docs, list(dict.fromkeys([*keep, text])), ", ".join([*kinds, "n_bytes long", "n_tokens long"]), run)
