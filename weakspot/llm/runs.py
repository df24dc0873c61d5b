"""Runs (maximal periodic stretches of words) by the branching-tandem test.

The words of a batch of texts are numbered and all suffixes of all texts are
sorted together by prefix doubling, with the text as the first key, so no two
texts share a prefix. The equivalence classes of every doubling step are kept:
they give longest common prefixes by binary descent. Nearest smaller values of
the LCP array (again by doubling) give every LCP interval; no tree is built.

For each interval of depth d, every suffix i of every child but the largest
asks the inverse suffix array whether i + d or i - d lies in the same interval
and another child. If so, two neighbouring equal stretches of d words start at
the smaller of both and differ in the word behind them: a branching tandem.
Small-to-large keeps this at n log n questions. Each maximal stretch of period
d and at least 2 d words ends with exactly one branching tandem; rotating it
to the left as long as the words agree (binary descent over the kept classes)
gives its start. Stretches that coincide differ in the period only, and the
smallest one is the run's.

All of this is NumPy over a batch of bounded size; a longer text is a batch of
its own, with memory of about 4 bytes a word and doubling step. A NULL or empty
text has no words and no runs. Texts are independent: repeated rows are
searched one by one, extra columns are ignored, an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weakspot.llm.arrow import map_columns, pieces, raw_texts

LEAST = 12  # words of the shortest run


class Suffixes:
    """Suffix array, its inverse and the classes of every doubling step over
    several sequences; ``ids`` of the words, ``own`` the sequence of each."""

    def __init__(self, ids: np.ndarray, own: np.ndarray):
        n = len(ids)
        self.n, self.own = n, own
        lengths = np.bincount(own) if n else np.zeros(0, "int64")
        self.ends = np.cumsum(lengths)[own] if n else np.zeros(0, "int64")
        first = own.astype("int64") * (int(ids.max()) + 1 if n else 1) + ids
        self.order = np.argsort(first, kind="stable")
        classes = _classes(first[self.order], self.order)
        self.steps = [classes]
        # positions in groups that are not settled yet
        open_at = _shared(classes[self.order])
        width = 1
        while len(open_at):
            at = self.order[open_at]
            behind = at + width
            second = np.where(behind < self.ends[at], classes[np.minimum(behind, n - 1)].astype("int64") + 1, 0)
            moved = np.lexsort((second, classes[at]))
            at, second = at[moved], second[moved]
            self.order[open_at] = at
            head = np.flatnonzero(np.concatenate([[True], (classes[at][1:] != classes[at][:-1]) | (second[1:] != second[:-1])]))
            group = np.repeat(head, np.diff(np.concatenate([head, [len(at)]])))
            classes = classes.copy()
            classes[at] = open_at[group]  # the class is the first place of its group
            self.steps.append(classes)
            width *= 2
            open_at = open_at[_shared(classes[at])]
        self.places = np.empty(n, dtype="int64")
        self.places[self.order] = np.arange(n)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that the suffixes a and b share at their front."""
        a, b, total = a.copy(), b.copy(), np.zeros(len(a), dtype="int64")
        for step in range(len(self.steps) - 1, -1, -1):
            inside = (a < self.n) & (b < self.n)
            same = np.zeros(len(a), dtype=bool)
            same[inside] = self.steps[step][a[inside]] == self.steps[step][b[inside]]
            total[same] += 1 << step
            a[same] += 1 << step
            b[same] += 1 << step
        return total

    def common_before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that agree in front of the places a and b of one sequence."""
        a, b, total = a.copy(), b.copy(), np.zeros(len(a), dtype="int64")
        start = np.searchsorted(self.ends, self.ends[a])  # the first place of the sequence
        for step in range(len(self.steps) - 1, -1, -1):
            wide = 1 << step
            inside = (a - wide >= start) & (b - wide >= start)
            same = np.zeros(len(a), dtype=bool)
            same[inside] = self.steps[step][a[inside] - wide] == self.steps[step][b[inside] - wide]
            total[same] += wide
            a[same] -= wide
            b[same] -= wide
        return total


def _classes(keys: np.ndarray, order: np.ndarray) -> np.ndarray:
    """By place: where the group of equal keys starts in the order."""
    new = np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, dtype=bool)
    out = np.empty(len(keys), dtype="int32")
    out[order] = np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0)) if len(keys) else 0
    return out


def _shared(sorted_classes: np.ndarray) -> np.ndarray:
    """Places whose class a neighbour has too."""
    if len(sorted_classes) < 2:
        return np.zeros(0, dtype="int64")
    same = sorted_classes[1:] == sorted_classes[:-1]
    return np.flatnonzero(np.concatenate([same, [False]]) | np.concatenate([[False], same]))


def nearest_smaller(values: np.ndarray, forward: bool) -> np.ndarray:
    """The nearest place behind (or before) each with a smaller value. The
    first and the last value are smaller than the others that ask."""
    own = values if forward else values[::-1]
    n = len(own)
    least = [own]
    open_at = np.flatnonzero(own > 0)
    reach = open_at + 1
    step = 0
    climbing = np.ones(len(open_at), dtype=bool)
    # up: double the stride while the whole stride is not smaller
    while climbing.any():
        if len(least) <= step:
            half = 1 << (step - 1)
            last = least[-1]
            least.append(np.minimum(last[:max(0, n - 2 * half + 1)], last[half:half + max(0, n - 2 * half + 1)]))
        row = least[step]
        fits = climbing & (reach < len(row))
        fits[fits] = row[reach[fits]] >= own[open_at[fits]]
        reach[fits] += 1 << step
        climbing = fits
        step += 1
    for step in range(len(least) - 1, -1, -1):
        row = least[step]
        fits = reach < len(row)
        fits[fits] = row[reach[fits]] >= own[open_at[fits]]
        reach[fits] += 1 << step
    out = np.full(n, n, dtype="int64")
    out[open_at] = reach
    return out if forward else n - 1 - out[::-1]


def tandems(suffixes: Suffixes) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of every branching tandem."""
    n, order, places = suffixes.n, suffixes.order, suffixes.places
    lcp = np.zeros(n + 1, dtype="int64")  # lcp[k] of the k-th and the one before it
    touching = np.flatnonzero(suffixes.own[order][1:] == suffixes.own[order][:-1]) + 1 if n else np.zeros(0, "int64")
    touching = touching[suffixes.steps[0][order[touching]] == suffixes.steps[0][order[touching - 1]]] if n else touching
    lcp[touching] = suffixes.common(order[touching - 1], order[touching])
    cuts = np.flatnonzero(lcp)
    if not len(cuts):
        return np.zeros(0, "int64"), np.zeros(0, "int64")
    low = nearest_smaller(lcp, forward=False)[cuts]  # the interval is low .. high - 1
    high = nearest_smaller(lcp, forward=True)[cuts]
    # cuts of one interval, in order, are the borders of its children
    moved = np.lexsort((cuts, high, low))
    cuts, low, high = cuts[moved], low[moved], high[moved]
    head = np.concatenate([[True], (low[1:] != low[:-1]) | (high[1:] != high[:-1])])
    tail = np.concatenate([head[1:], [True]])
    number = np.cumsum(head) - 1
    first_of = np.flatnonzero(head)
    # a child ends at each cut, and one more behind the last cut of an interval
    begin = np.concatenate([np.where(head, low, np.concatenate([[0], cuts[:-1]])), cuts[tail]])
    end = np.concatenate([cuts, high[tail]])
    of = np.concatenate([number, number[tail]])
    sizes = end - begin
    by_size = np.lexsort((begin, -sizes, of))
    largest = np.concatenate([[True], of[by_size][1:] != of[by_size][:-1]])
    asked = by_size[~largest]
    sizes, begin, end, of = sizes[asked], begin[asked], end[asked], of[asked]
    depth, left, right = lcp[cuts[first_of]], low[first_of], high[first_of]
    starts, periods = [], []
    block = np.cumsum(sizes) // (1 << 20)  # questions are put a million at a time
    for at in np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(block)) + 1):
        many = sizes[at]
        child = np.repeat(at, many)
        place = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + begin[child]
        i, d = order[place], depth[of[child]]
        for other in (i + d, i - d):
            ok = (other >= 0) & (other < n)
            where = places[np.where(ok, other, 0)]
            ok &= (where >= left[of[child]]) & (where < right[of[child]]) & ((where < begin[child]) | (where >= end[child]))
            starts.append(np.minimum(i, other)[ok])
            periods.append(d[ok])
    return np.concatenate(starts), np.concatenate(periods)


def find(ids: np.ndarray, own: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Rows (start, length, period) of all runs of several sequences, by
    start, then period; starts count from the first word of all."""
    suffixes = Suffixes(ids, own)
    start, period = tandems(suffixes)
    if not len(start):
        return np.zeros((0, 3), dtype="int64")
    end = start + 2 * period
    start = start - suffixes.common_before(start, start + period)
    keep = end - start >= least
    start, end, period = start[keep], end[keep], period[keep]
    moved = np.lexsort((period, end, start))
    start, end, period = start[moved], end[moved], period[moved]
    smallest = np.concatenate([[True], (start[1:] != start[:-1]) | (end[1:] != end[:-1])]) if len(start) else np.zeros(0, dtype=bool)
    found = np.stack([start, end - start, period], axis=1)[smallest]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def collapse(found: np.ndarray, n: int) -> np.ndarray:
    """Which of n words stay: those that no run holds behind its first period."""
    change = np.zeros(n + 1, dtype="int64")
    np.add.at(change, found[:, 0] + found[:, 2], 1)
    np.add.at(change, found[:, 0] + found[:, 1], -1)
    return np.cumsum(change)[:n] == 0


def find_runs(docs: DataFrame, keep: list[str], text: str = "text", least: int = LEAST) -> DataFrame:
    """The kept columns, n_words, ``runs`` (start, length, period; by start,
    then period) and ``collapsed``, the text of the words that stay."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            texts = raw_texts(batch, text)
            for start, end in pieces(texts):
                words = [t.split() for t in texts[start:end]]  # of bytes: ASCII white space
                sizes = np.fromiter(map(len, words), dtype="int64", count=len(words))
                numbers: dict[bytes, int] = {}
                ids = np.fromiter((numbers.setdefault(w, len(numbers)) for own in words for w in own), dtype="int64", count=int(sizes.sum()))
                own = np.repeat(np.arange(len(words)), sizes)
                found = find(ids, own, least)
                stays = collapse(found, len(ids))
                begins = np.cumsum(sizes) - sizes
                border = np.searchsorted(found[:, 0], np.append(begins, len(ids)))
                found[:, 0] -= begins[own[found[:, 0]]]
                runs, kept = [], []
                for i, w in enumerate(words):
                    runs.append([dict(zip(("start", "length", "period"), r)) for r in found[border[i]:border[i + 1]].tolist()])
                    left = stays[begins[i]:begins[i] + sizes[i]]
                    kept.append(b" ".join(w if left.all() else [x for x, ok in zip(w, left) if ok]).decode())
                yield {**{c: batch.column(c).slice(start, end - start) for c in keep}, "n_words": sizes, "runs": runs, "collapsed": kept}

    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
    made = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return map_columns(docs, list(dict.fromkeys([*keep, text])), ", ".join([*kinds, made]), run)


def planted(key: str = "doc_id", text: str = "text") -> Column:
    """The text with a periodic end, for a tenth of the keys: every word
    from the a-th on becomes the word of its period. NULL keys count as ''."""
    checksum = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    whole = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(whole, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def repeated(words: Column) -> Column:
        n, g = F.size(words).cast("long"), F.floor(checksum / 10)
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
        at = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.when(i >= a, a + F.pmod(i - a, p)).otherwise(i))
        return F.when(n > 0, F.concat_ws(" ", F.transform(at, lambda i: F.get(words, i.cast("int"))))).otherwise(F.lit(""))

    return F.when(checksum % 10 == 0, F.get(F.transform(F.array(words), repeated), F.lit(0))).otherwise(whole)


def digest_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document with its planted end: the number of runs, the longest
    one (smallest start, then period, among equals) and digests."""
    found = find_runs(docs.select(F.col(key), planted(key, text).alias("text")), [key])
    longest = F.get(F.array_sort("runs", lambda a, b: F.when(a["length"] != b["length"], F.when(a["length"] > b["length"], -1).otherwise(1))
                                 .when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1))
                                 .when(a["period"] < b["period"], -1).when(a["period"] > b["period"], 1).otherwise(0)), F.lit(0))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return (found.withColumn("__best", longest).select(
        key, F.size("runs").cast("long").alias("n_runs"), *[F.col(f"__best.{c}").alias(c) for c in ("start", "length", "period")],
        F.floor(F.col("__best.length") * 1000 / F.col("__best.period")).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")))
