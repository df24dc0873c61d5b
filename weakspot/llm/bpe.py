"""Byte-level BPE by recursive queries.

Each task keeps an embedded DuckDB, and gives it the distinct words of its
texts that it hasn't met. A recursive query holds a word's tokens; a step
lays them out as one row per token position, joins adjacent positions with
the merge table, takes each word's pair of lowest rank (the leftmost, if
equal) and contracts it, until no word has a pair left. An ordered
aggregation over the positions turns ids back into bytes.

A merge table row is a token cut into two tokens in any way, so the same
pairs merge as when the bytes themselves are looked up in the rank file.
A step's rows stay for words of at most ``BRIEF``
bytes, whose shortest list is the last; longer words hold one row each.
Words beyond ``LONG`` bytes, for which copying a token list at each step
would be quadratic, follow the same rule with a heap.

A NULL or empty text has no tokens. Distinct words of a batch are encoded
once; results stay in two bounded generations, so words that return are not
encoded again and words that don't are forgotten. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import heapq
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from weakspot.llm.arrow import map_columns, pieces, texts
from weakspot.llm.segments import segments

LONG = 1_024
KEPT = 96 << 20  # bytes of a generation of results: keys, ids, decoded bytes and about ENTRY for the objects
ENTRY = 320
BRIEF = 32
CONTRACTED = """
    SELECT s.w, s.tokens[:b.pos - 1] || [b.made] || s.tokens[b.pos + 2:]
    FROM step s JOIN (
        SELECT p.w, min(m.made * 4096 + p.pos) AS best, (best // 4096)::INTEGER AS made, best % 4096 AS pos
        FROM (SELECT w, pos, tokens[pos] AS a, tokens[pos + 1] AS b
              FROM (SELECT w, tokens, unnest(range(1, len(tokens))) AS pos FROM step)) p
        JOIN merges m ON m.pair = p.a::BIGINT * 1048576 + p.b
        GROUP BY p.w
    ) b ON s.w = b.w
"""
ENCODE_BRIEF = f"""
WITH RECURSIVE step(w, tokens) AS (SELECT w, tokens FROM start UNION ALL {CONTRACTED})
SELECT w, arg_min(tokens, len(tokens)) AS tokens FROM step GROUP BY w
"""
ENCODE = f"""
WITH RECURSIVE step(w, tokens) USING KEY (w) AS (SELECT w, tokens FROM start UNION {CONTRACTED})
SELECT w, tokens FROM step
"""
DECODE = """
SELECT p.w, array_to_string(any_value(p.tokens), ',') AS ids, unhex(array_to_string(list(v.hex ORDER BY p.pos), '')) AS raw
FROM (SELECT w, tokens, unnest(tokens) AS id, generate_subscripts(tokens, 1) AS pos FROM done) p JOIN vocabulary v ON v.id = p.id
GROUP BY p.w
"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


def merge_table(ranks: dict[bytes, int]) -> list[tuple[int, int, int]]:
    """(left id, right id, merged id) of every cut of every token."""
    return [(ranks[t[:i]], ranks[t[i:]], made) for t, made in ranks.items() for i in range(1, len(t))
            if t[:i] in ranks and t[i:] in ranks]


class Encoder:
    """One embedded database with the merge table and the vocabulary."""

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.names = {i: t for t, i in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        self.ids, self.raw = {}, {}  # by segment or word
        self.old: tuple[dict, dict] = {}, {}
        self.used = 0
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        rows = merge_table(self.ranks)
        merges = pa.table({"pair": pa.array([a * 1048576 + b for a, b, _ in rows], pa.int64()),  # noqa: F841
                           "made": pa.array([r[2] for r in rows], pa.int64())})
        vocabulary = pa.table({"id": pa.array(list(self.names), pa.int64()), "hex": [t.hex() for t in self.names.values()]})  # noqa: F841
        self.db.execute("CREATE TABLE merges AS SELECT * FROM merges")
        self.db.execute("CREATE TABLE vocabulary AS SELECT * FROM vocabulary")
        self.bytes = np.array([self.ranks[bytes([b])] for b in range(256)], dtype="int32")

    def words(self, words: list[str]) -> None:
        """Encodes words, then decodes their ids; keeps both."""
        raw = [w.encode() for w in words]
        size = np.fromiter(map(len, raw), "int64", len(raw))
        for low, high, query in ((-1, BRIEF, ENCODE_BRIEF), (BRIEF, LONG, ENCODE)):
            own = np.flatnonzero((size > low) & (size <= high))
            if not len(own):
                continue
            ends = np.concatenate([[0], np.cumsum(size[own])]).astype("int32")
            joined = np.frombuffer(b"".join([raw[i] for i in own]), "uint8")
            start = pa.table({"w": own, "tokens": pa.ListArray.from_arrays(ends, self.bytes[joined])})  # noqa: F841
            self.db.execute(f"CREATE OR REPLACE TEMP TABLE done AS {query}")
            made = self.db.sql(DECODE).to_arrow_table()
            names = [words[i] for i in made.column("w").to_pylist()]
            self.ids.update(zip(names, made.column("ids").to_pylist()))
            self.raw.update(zip(names, made.column("raw").to_pylist()))
        for i in np.flatnonzero(size > LONG):
            ids = self.heap(raw[i])
            self.ids[words[i]] = ",".join(map(str, ids))
            self.raw[words[i]] = b"".join(self.names[t] for t in ids)
        self.used += ENTRY * len(words) + 4 * int(size.sum())

    def heap(self, raw: bytes) -> list[int]:
        """The same contraction for one long word in n log n."""
        parts: list[bytes | None] = [raw[i:i + 1] for i in range(len(raw))]
        after, before = list(range(1, len(raw) + 1)), list(range(-1, len(raw) - 1))
        queue: list[tuple[int, int, bytes]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < len(raw) and (rank := self.ranks.get(pair := parts[i] + parts[after[i]])) is not None:
                heapq.heappush(queue, (rank, i, pair))

        for i in range(len(raw)):
            offer(i)
        while queue:
            _, i, pair = heapq.heappop(queue)
            j = after[i]
            if parts[i] is None or j >= len(raw) or parts[i] + parts[j] != pair:
                continue
            parts[i], parts[j], after[i] = pair, None, after[j]
            if after[i] < len(raw):
                before[after[i]] = i
            offer(i)
            offer(before[i])
        return [self.ranks[p] for p in parts if p is not None]

    def encode(self, own: list[str]) -> Iterator[tuple[str, bytes]]:
        """Each text's ids joined by commas, and the bytes they decode to."""
        if self.used > KEPT:
            self.old, self.ids, self.raw, self.used = (self.ids, self.raw), {}, {}, 0
        cut = [segments(t) for t in own]
        new = self.recall(set().union(*cut))
        if new:
            split = [self.pattern.findall(p) for p in new]
            unknown = self.recall(set().union(*split))
            if unknown:
                self.words(unknown)
            ids, raw = self.ids.__getitem__, self.raw.__getitem__
            for p, words in zip(new, split):
                if len(words) > 1:  # one word is a segment itself
                    self.ids[p] = ",".join(map(ids, words))
                    self.raw[p] = b"".join(map(raw, words))
                    self.used += ENTRY + 4 * len(p)
        ids, raw = self.ids.__getitem__, self.raw.__getitem__
        for parts in cut:
            yield ",".join(map(ids, parts)), b"".join(map(raw, parts))

    def recall(self, wanted: set[str]) -> list[str]:
        """Takes what the older generation holds over; returns the rest."""
        ids, raw = self.old
        missing = []
        for p in wanted.difference(self.ids):
            if p in ids:
                self.ids[p], self.raw[p] = ids[p], raw[p]
                self.used += ENTRY + 4 * len(p)
            else:
                missing.append(p)
        return missing


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """One for each worker process."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = Encoder(path, pattern)
    return _ENCODERS[path, pattern]


def _encoded(docs: DataFrame, ranks: str, pattern: str, key: str, text: str, fields: str, make) -> DataFrame:
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]):
        from weakspot.llm import bpe  # the worker's own module, so that its encoder outlives the task

        tool = bpe.encoder(ranks, pattern)
        for batch in batches:
            own = texts(batch, text)
            for low, high in pieces([t.encode() for t in own], 4 << 20):
                gc.disable()  # a million strings in no cycle, which a collection would walk again and again
                try:
                    rows = list(tool.encode(own[low:high]))
                finally:
                    gc.enable()
                yield {key: batch.column(key)[low:high], **make(rows)}

    return map_columns(docs, [key, text], f"`{key}` {kind}, {fields}", run)


def encode(docs: DataFrame, ranks: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids array<int>, decoded string) of whole texts."""
    return _encoded(docs, ranks, pattern, key, text, "ids array<int>, decoded string", lambda rows: {
        "ids": [[int(i) for i in ids.split(",")] if ids else [] for ids, _ in rows],
        "decoded": [raw.decode() for _, raw in rows]})


def digest(docs: DataFrame, ranks: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of whole texts."""
    return _encoded(docs, ranks, pattern, key, text, "n_tokens long, ids_sha256 string, decoded_sha256 string", lambda rows: {
        "n_tokens": [ids.count(",") + 1 if ids else 0 for ids, _ in rows],
        "ids_sha256": [hashlib.sha256(ids.encode()).hexdigest() for ids, _ in rows],
        "decoded_sha256": [hashlib.sha256(raw).hexdigest() for _, raw in rows]})
