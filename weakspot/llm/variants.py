"""Spelling variants: words at one edit from another, by permuterm rotations.

A word with a terminator behind it has one rotation for each place. Rotated so
that one of its characters comes last, a word shares everything before that
character with all words that differ in this character alone, and what they
share, read as a whole rotation, belongs to the word without the character.
Replacements and indels of one place are therefore one prefix range of the
sorted rotations: the prefix itself (the shorter word) and the prefix with one
more character (the longer words). Each rotation is dealt out twice, as itself
and without its last character, the rotations are sorted within partitions, and
a scan of a range's members gives each of them its neighbours there.

A range has one character open, so it holds at most one word for each of the 90
letters and the shorter word: a scan keeps the two best members instead of
emitting pairs, and no group can grow with the data. An insertion that can be
made at several places (a letter beside its like) counts at the first place
only, so every pair of near words meets in exactly one range.

Words are numbered in code-point order, and rows of rotations carry the number
and not the word. Prefixes above ``PLAIN`` characters are replaced by a 178-bit
checksum of their parts that is made for all places in one pass, so a word of a
million letters gives two million short rows.

A NULL text has no words, a NULL key counts as ''. Repeated rows count again.
Extra columns are ignored; an empty table, or one without such words, gives no
rows. Of near words that are equally frequent the smallest is the form.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weakspot.llm.arrow import map_columns, texts
from weakspot.session import written_once

LETTERS = "[A-Za-zÀ-ÿ]+"
SHORTEST = 7
LEAST_SEEN = 2
TIMES = 10  # a form is so many times as frequent as its variant
PLAIN = 64  # characters of the longest prefix that is kept as it is
HELD = 20 << 20  # bytes of words a task counts before it hands them on
BATCH = 20_000  # rows of rotations handed on at once

END = "$"  # the terminator; no word holds it
_LOWER = {c: c + 32 for c in range(65, 91)}
_PRIME, _BASE = (1 << 89) - 1, 0x9E3779B97F4A7C15F39CC1


def slips(doc: str, word: str, part: int = 31) -> str:
    """The word, without one of its letters for one in ``part`` of (doc, word)."""
    h = zlib.crc32(f"{doc}:{word}".encode())
    if h % part:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1:]


def count_words(docs: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = SHORTEST, rewrite=slips) -> DataFrame:
    """(word, n) of all words of all texts, A to Z lower-cased and passed
    through ``rewrite`` with their document's key."""
    letters = re.compile(LETTERS)

    def run(batches: Iterator[pa.RecordBatch]):
        held: Counter[str] = Counter()
        size = 0
        for batch in batches:
            for doc, own in zip(batch.column("__key").to_pylist(), texts(batch, text)):
                # a word too short to count stays out, whether it loses a letter or not
                found = Counter(w for w in letters.findall(own.translate(_LOWER)) if len(w) >= shortest)
                for word, n in found.items():
                    word = rewrite(doc, word)
                    if len(word) >= shortest:
                        size += 0 if word in held else len(word) + 100
                        held[word] += n
                if size >= HELD:
                    yield {"word": list(held), "n": list(held.values())}
                    held.clear()
                    size = 0
        yield {"word": list(held), "n": list(held.values())}

    rows = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("__key"), F.col(text).alias(text))
    return map_columns(rows, ["__key", text], "word string, n long", run).groupBy("word").agg(F.sum("n").alias("n"))


def numbered(words: DataFrame) -> DataFrame:
    """``id`` in code-point order: rows are dealt by range and sorted, and
    numbers grow with the partition, then the row."""
    return written_once(words.orderBy("word").withColumn("id", F.monotonically_increasing_id()), "words")


def _sums(letters: str) -> list[int]:
    """Checksums of all beginnings."""
    out, h = [0], 0
    for c in letters:
        h = (h * _BASE + ord(c) + 1) % _PRIME
        out.append(h)
    return out


def rotations(word: str) -> Iterator[tuple[str, bool, bool]]:
    """(prefix, skips, first) of every rotation of the word, as itself and
    without its last character; ``first`` is false where the skipped
    character follows its like."""
    n = len(word)
    if n <= PLAIN:
        doubled = word + END + word
        for p in range(n + 1):
            yield doubled[p:p + n + 1], False, True
    if n - 1 <= PLAIN:
        for p in range(n):
            yield word[p + 1:] + END + word[:p], True, p == 0 or word[p - 1] != word[p]
    if n > PLAIN:
        front, back = _sums(word), _sums(word[::-1])
        for p in range(n + 1):
            yield f"{END}{n}:{p}:{front[p]:x}:{back[n - p]:x}", False, True
        if n - 1 > PLAIN:
            for p in range(n):
                yield f"{END}{n - 1}:{p}:{front[p]:x}:{back[n - p - 1]:x}", True, p == 0 or word[p - 1] != word[p]


def rotation_rows(words: DataFrame) -> DataFrame:
    """(prefix, skips, first, id, n): every rotation of every word."""

    def run(batches: Iterator[pa.RecordBatch]):
        made: dict[str, list] = {c: [] for c in ("prefix", "skips", "first", "id", "n")}
        for batch in batches:
            for id_, word, n in zip(*(batch.column(c).to_pylist() for c in ("id", "word", "n"))):
                for row in rotations(word):
                    for column, value in zip(made.values(), (*row, id_, n)):
                        column.append(value)
                    if len(made["id"]) >= BATCH:
                        yield made
                        made = {c: [] for c in made}
        yield made

    return map_columns(words, ["id", "word", "n"], "prefix string, skips boolean, first boolean, id long, n long", run)


def _better(a: tuple | None, b: tuple | None) -> tuple | None:
    """Of two (n, id) the more frequent one, then the smaller id."""
    if a is None or b is None:
        return a or b
    return a if (-a[0], a[1]) <= (-b[0], b[1]) else b


def scan(members: list[tuple[bool, bool, int, int]]) -> Iterator[tuple[int, int, tuple]]:
    """(id, near words, best (n, id)) of each member of one prefix range that
    has a neighbour there. Members are (skips, first, id, n)."""
    longer = [m for m in members if m[0]]
    shorter = next((m for m in members if not m[0]), None)
    ranked = sorted(((n, i) for _, _, i, n in longer), key=lambda x: (-x[0], x[1]))[:2]
    for _, first, i, n in longer:
        near = len(longer) - 1
        best = next(((m, j) for m, j in ranked if j != i), None)
        if shorter and first:
            near, best = near + 1, _better(best, (shorter[3], shorter[2]))
        if near:
            yield i, near, best
    if shorter:
        grown = [(n, i) for _, first, i, n in longer if first]
        if grown:
            yield shorter[2], len(grown), min(grown, key=lambda x: (-x[0], x[1]))


def neighbours(words: DataFrame) -> DataFrame:
    """(id, n_near, best (n, id)) of the words (id, word, n) that have a near word."""
    spark = words.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rotation_rows(words).repartition(parts, "prefix").sortWithinPartitions("prefix", "skips")

    def run(batches: Iterator[pa.RecordBatch]):
        prefix, members = None, []
        made: dict[str, list] = {c: [] for c in ("id", "near", "best_n", "best_id")}

        def closed():
            if len(members) > 1:
                for i, near, (n, j) in scan(members):
                    for column, value in zip(made.values(), (i, near, n, j)):
                        column.append(value)

        for batch in batches:
            for at, *member in zip(*(batch.column(c).to_pylist() for c in ("prefix", "skips", "first", "id", "n"))):
                if at != prefix:
                    closed()
                    prefix, members = at, []
                members.append(tuple(member))
            if made["id"]:
                yield made
                made = {c: [] for c in made}
        closed()
        yield made

    found = map_columns(dealt, ["prefix", "skips", "first", "id", "n"], "id long, near long, best_n long, best_id long", run)
    # the largest n first, then the smallest id
    best = F.max(F.struct(F.col("best_n").alias("n"), (-F.col("best_id")).alias("id")))
    return (found.groupBy("id").agg(F.sum("near").alias("n_near"), best.alias("__b"))
            .select("id", "n_near", F.col("__b.n").alias("form_n"), (-F.col("__b.id")).alias("form_id")))


def roots(links: DataFrame) -> DataFrame:
    """(id, root) of the ids whose form leads on, by pointer doubling.

    A form is ``TIMES`` times as frequent as its word, so chains end and are
    no longer than the digits of the largest count: five rounds at most.
    """
    held = written_once(links, "forms")
    while True:
        onward = held.select(F.col("id").alias("root"), F.col("root").alias("__next"))
        moved = written_once(held.join(onward, "root", "left").select(
            "id", F.coalesce("__next", "root").alias("root"), F.col("__next").isNotNull().alias("moved")), "roots")
        held = moved.drop("moved")
        if moved.filter("moved").isEmpty():
            return held


def variants(counts: DataFrame, least: int = LEAST_SEEN, times: int = TIMES) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of counted words (word, n)
    with at least ``least`` occurrences."""
    words = numbered(counts.filter(F.col("n") >= least))
    near = written_once(neighbours(words).join(words.select("id", "n"), "id")
                        .withColumn("__is", F.col("form_n") >= times * F.col("n")), "near")
    links = near.filter("__is").select("id", F.col("form_id").alias("root"))
    ends = roots(links)
    names = words.select(F.col("id").alias("__id"), F.col("word").alias("__word"))
    leads = (near.filter("__is").select("id", "form_id", "form_n").join(ends, "id")
             .join(names.withColumnsRenamed({"__id": "form_id", "__word": "form"}), "form_id")
             .join(names.withColumnsRenamed({"__id": "root", "__word": "root_word"}), "root")
             .select("id", "form", "form_n", "root_word"))
    return (words.join(near.select("id", "n_near"), "id", "left").join(leads, "id", "left")
            .select("word", "form", F.coalesce("root_word", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"))
