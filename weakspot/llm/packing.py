"""Packs token streams into fixed windows by minimum bin slack.

A document becomes its token ids and an end id. Whole windows are cut off
its front and stand alone; what remains is shorter than a window. Only how
many remainders there are of each length decides the packing, so a histogram
of at most 1,023 rows is all that the plan needs: a bitset subset-sum over
the lengths left finds the multiset that fills a window best, backtracking
gives its counts, and the same filling is repeated as often as the counts
allow. Each filling uses up a length or settles for less slack, so the plan
stays a few thousand rows whatever the corpus.

Remainders are then numbered within their length, in hash buckets of bounded
size with prefix sums over the bucket counts, and look up their window. No
text or ids are shuffled: ids are cut and hashed where they are made.

A NULL or empty text is its end id alone. Rows with equal ids are packed as
rows of their own. An empty table gives no pieces; extra columns are ignored.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weakspot.llm.arrow import map_columns, texts
from weakspot.session import written_once

WINDOW = 1024
END = 0
BUCKET_ROWS = 100_000
MIN_BUCKETS = 256  # small tables spread over the tasks too


@lru_cache(maxsize=2)
def _encoder(tokenizer: str, ranks: str, pattern: str):
    """(tokenizer, fast encoder of the same vocabulary, special strings)."""
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer)
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(ranks, "rb"))}
    fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})
    special = [t.content for t in whole.get_added_tokens_decoder().values()]
    return whole, fast, special


def token_bytes(own: list[str], tokenizer: str, ranks: str, pattern: str) -> Iterator[bytes]:
    """Each text's ids as little-endian 32-bit numbers.

    The rank file of the same vocabulary encodes a text in one call, which
    takes less than half the time of looking its words up in a cache; a text
    that holds a special token's string goes through the tokenizer.
    """
    whole, fast, special = _encoder(tokenizer, ranks, pattern)
    for text in own:
        if any(s in text for s in special):
            ids = whole.encode(text, add_special_tokens=False).ids
        else:
            ids = fast.encode_ordinary(text)
        yield np.asarray(ids, dtype="<u4").tobytes()


def cut_documents(docs: DataFrame, tokenizer: str, ranks: str, pattern: str, window: int = WINDOW, end: int = END,
                  key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, doc_tokens, crcs): a document's pieces, whole windows first."""
    kind = docs.schema[key].dataType.simpleString()
    tail = np.asarray([end], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            lengths, sums = [], []
            for ids in token_bytes(texts(batch, text), tokenizer, ranks, pattern):
                view = memoryview(ids + tail)
                lengths.append(len(view) // 4)
                sums.append([zlib.crc32(view[i:i + 4 * window]) for i in range(0, len(view), 4 * window)])
            yield {key: batch.column(key), "doc_tokens": lengths, "crcs": sums}

    return map_columns(docs, [key, text], f"`{key}` {kind}, doc_tokens long, crcs array<long>", run)


def fillings(counts: dict[int, int], window: int = WINDOW) -> list[tuple[int, list[int]]]:
    """(repetitions, lengths) until every remainder is placed.

    The longest length left opens the window; the rest is the subset-sum of
    the other lengths that leaves least slack. Counts are bounded by how
    often a length fits, spelled as powers of two for the bitset.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    plan = []
    while left:
        first = max(left)
        room = window - first
        reach, steps = 1, []
        mask = (1 << (room + 1)) - 1
        for n in sorted((n for n in left if n <= room), reverse=True):
            most = min(left[n] - (n == first), room // n)
            take = 1
            while most > 0:
                take = min(take, most)
                steps.append((n, take, reach))
                reach |= (reach << (n * take)) & mask
                most -= take
                take *= 2
            if reach >> room:
                break
        at, chosen = reach.bit_length() - 1, [first]
        for n, take, before in reversed(steps):
            if not before >> at & 1:
                chosen += [n] * take
                at -= n * take
        used = {n: chosen.count(n) for n in chosen}
        times = min(left[n] // c for n, c in used.items())
        plan.append((times, chosen))
        for n, c in used.items():
            left[n] -= c * times
            if not left[n]:
                del left[n]
    return plan


def pack(docs: DataFrame, tokenizer: str, ranks: str, pattern: str, window: int = WINDOW, end: int = END,
         key: str = "doc_id", text: str = "text", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(key, start, length, ids_crc32, doc_tokens, sequence_id, offset) per piece."""
    spark = docs.sparkSession
    cut = written_once(cut_documents(docs, tokenizer, ranks, pattern, window, end, key, text), "pieces")
    rows = cut.count()
    buckets = max(MIN_BUCKETS, -(-rows // bucket_rows))
    rest = F.col("doc_tokens") % window
    narrow = cut.withColumns({"__b": F.pmod(F.xxhash64(key, "doc_tokens", "crcs"), F.lit(buckets)), "__rest": rest.cast("int"),
                              "__full": F.floor(F.col("doc_tokens") / window)})
    # what each bucket holds; prefix sums over buckets make numbers global
    held = written_once(narrow.groupBy("__b", "__rest").agg(F.count(F.lit(1)).alias("n"), F.sum("__full").alias("full")), "counts")
    before = held.withColumn("__base", F.sum("n").over(
        W.partitionBy("__rest").orderBy("__b").rowsBetween(W.unboundedPreceding, -1))).select(
        "__b", "__rest", F.coalesce("__base", F.lit(0)).alias("__base"))
    per_bucket = held.groupBy("__b").agg(F.sum("full").alias("full"))
    fulls = per_bucket.withColumn("__shelf", F.pmod("__b", F.lit(256)))
    shelf_total = fulls.groupBy("__shelf").agg(F.sum("full").alias("t"))
    shelves = {r["__shelf"]: r["t"] for r in shelf_total.collect()}
    lengths = {r["__rest"]: r["n"] for r in held.filter("__rest > 0").groupBy("__rest").agg(F.sum("n").alias("n")).collect()}
    plan = fillings(lengths, window)

    # slots: for a length, ranges of remainder numbers that fall on one place of one filling
    sequence, taken, slots = 0, dict.fromkeys(lengths, 0), []
    for times, chosen in plan:
        offset = 0
        for n in chosen:
            slots.append((n, taken[n], taken[n] + times, sequence, offset))
            taken[n] += times
            offset += n
        sequence += times
    shelf_start, total = [], sequence
    for s in range(256):
        shelf_start.append((s, total))
        total += shelves.get(s, 0)

    firsts = (fulls.join(F.broadcast(spark.createDataFrame(shelf_start, "__shelf long, __start long")), "__shelf")
              .withColumn("__lead", F.col("__start") + F.sum("full").over(
                  W.partitionBy("__shelf").orderBy("__b").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("full"))
              .select("__b", "__lead"))
    in_bucket = W.partitionBy("__b")
    order = [F.col(key), F.col("doc_tokens"), F.col("crcs")]
    numbered = narrow.withColumns({
        "__rn": F.row_number().over(W.partitionBy("__b", "__rest").orderBy(*order)) - 1,
        "__run": F.sum("__full").over(in_bucket.orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("__full")})
    placed = (numbered.join(before, ["__b", "__rest"]).join(firsts, "__b")
              .withColumns({"__no": F.col("__rn") + F.col("__base"), "__seq": F.col("__lead") + F.col("__run")}))
    table: dict[int, list] = {}
    for n, low, high, seq, off in slots:
        table.setdefault(n, []).append((low, high, seq, off))
    index = {n: tuple(np.asarray(column, dtype="int64") for column in zip(*rows_)) for n, rows_ in table.items()}
    shared = spark.sparkContext.broadcast(index)
    kind = docs.schema[key].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]):
        ranges = shared.value
        for batch in batches:
            ids, totals = batch.column(key).to_pylist(), batch.column("doc_tokens").to_pylist()
            numbers, leads = batch.column("__no").to_pylist(), batch.column("__seq").to_pylist()
            made = {n: [] for n in (key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")}
            for i, crcs in enumerate(batch.column("crcs").to_pylist()):
                full, left = divmod(totals[i], window)
                for j, crc in enumerate(crcs):
                    seq, off = leads[i] + j, 0
                    if j == full:
                        low, _, start, offsets = ranges[left]
                        at = int(np.searchsorted(low, numbers[i], side="right")) - 1
                        seq, off = int(start[at] + numbers[i] - low[at]), int(offsets[at])
                    for n, v in zip(made, (ids[i], j * window, window if j < full else left, crc, totals[i], seq, off)):
                        made[n].append(v)
            yield made

    return map_columns(placed, [key, "doc_tokens", "crcs", "__no", "__seq"],
                       f"`{key}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long", place)
