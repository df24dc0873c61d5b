"""Spelling variants, periodic runs and token counts against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import types as T
from sentencepiece import SentencePieceProcessor

from weakspot.llm import counts, queries, runs, variants

SF = "/root/testdata/sf0.001"
MODEL = P.path("piece_bpe_32k.model")
CLASHING = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
                        + [T.StructField(n, T.StringType()) for n in ("word", "n", "runs", "start", "n_tokens", "n_bytes", "prefix", "id", "root")])
LONG = " ".join(f"letters{'abcdefgh'[i % 8]}x word{i % 9}" for i in range(8_000))
LETTERS = "q" * 3000 + "z" + "q" * 3000
TEXTS = [(1, None), (2, ""), (3, "one"), (4, " \t\n "), (5, LONG), (6, LONG), (7, "again again again again again again again again again again again again"),
         (7, "again again again again again again again again again again again again"), (None, "no key at all  here"), (8, "日本語 text's\t\tok 123 ▁ mark  end "),
         (9, LETTERS + " " + LETTERS[1:] + " " + LETTERS), (10, LETTERS[1:] + " " + "q" * 2999 + "zz" + "q" * 3000 + " É"), (11, "x\0y  \n"), (12, "élèvess élèvees élèvess ÉLÈVESS")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, *"abcdefghi") for i, t in TEXTS], CLASHING)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], CLASHING)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# --- token counts -----------------------------------------------------------

def test_counts_equal_the_library(odd, docs):
    tool = SentencePieceProcessor(model_file=MODEL)
    for table in (odd, docs):
        made = counts.token_counts(table, MODEL, ["doc_id"]).collect()
        want = [(r["doc_id"], len((r["text"] or "").encode()), len(tool.encode(r["text"] or ""))) for r in table.collect()]
        assert [tuple(r) for r in made] == want


def test_counts_of_random_spaces_and_marks():
    tool, draw = SentencePieceProcessor(model_file=MODEL), random.Random(5)
    own = ["".join(draw.choice(["a", "th", " ", "  ", "▁", "é", "1", "\n", "\t", "ing", " the", "日", "<s>", "\0"]) for _ in range(draw.randrange(25)))
           for _ in range(2_000)]
    found = counts.PreTokens([t.encode() for t in own])
    numbers, first = np.unique(found.numbers, return_index=True)
    half = counts.Lookup(numbers[::2], np.asarray(counts.encoded_lengths(MODEL, [found.at(i) for i in first[::2]])))
    for table in (half, counts.Lookup(np.zeros(0, "uint64"), np.zeros(0, "int32"))):
        total = np.concatenate([[0], np.cumsum(counts.lengths_of(found, table, MODEL))])
        tails = [counts.encoded_lengths(MODEL, [(int(n), b"")])[0] if n else 0 for n in found.tail]
        assert (total[found.bounds[1:]] - total[found.bounds[:-1]] + tails).tolist() == [len(tool.encode(t)) for t in own]


def test_lookup_finds_what_was_put_in():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 5_000, dtype="uint64") * np.uint64(2))
    clash = np.concatenate([keys, np.arange(500, dtype="uint64") + np.uint64(5)])  # 500 keys of one slot
    table = counts.Lookup(clash, np.arange(len(clash)))
    assert table.get(clash).tolist() == list(range(len(clash)))
    assert (table.get(keys + np.uint64(1)) == -1).all()


def test_frequent_merges_many_tasks(docs):
    numbers, lengths = counts.frequent(docs.repartition(40), MODEL)
    want = Counter()
    for r in docs.collect():
        found = counts.PreTokens([r["text"].encode()])
        want.update(found.numbers.tolist())
    most = [n for n, _ in want.most_common(50)]
    assert set(most) <= set(numbers.tolist()) and len(numbers) <= counts.TABLE and min(lengths) >= 1


def test_counts_query(odd, empty, spark):
    assert counts.token_counts(empty, MODEL, ["doc_id"]).count() == 0
    made = queries.op13_token_counts(spark, SF)
    assert made.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert {r["over_limit"] for r in made.collect() if r["n_tokens"] > 4096} == {True}


# --- periodic runs ----------------------------------------------------------

def brute_runs(w, least=12):
    out, n = [], len(w)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q) and not any(w[i:j + q - r] == w[i + r:j + q] for r in range(1, q)):
                out.append((i, j + q - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force():
    draw = random.Random(7)
    for _ in range(150):
        parts = []
        for _ in range(draw.randrange(1, 5)):
            w = [draw.randrange(draw.choice([1, 2, 2, 3, 6])) for _ in range(draw.randrange(60))]
            if w and draw.random() < 0.6:
                a = draw.randrange(len(w))
                p = 1 + (len(w) - a) // (3 + draw.randrange(8))
                w = [w[a + (i - a) % p] if i >= a else x for i, x in enumerate(w)]
            parts.append(w)
        ids, own = np.array(sum(parts, []), dtype="int64"), np.repeat(np.arange(len(parts)), [len(w) for w in parts])
        for least in (2, 12):
            want, base = [], 0
            for w in parts:
                want += [(s + base, n, q) for s, n, q in brute_runs(w, least)]
                base += len(w)
            assert [tuple(r) for r in runs.find(ids, own, least).tolist()] == want


def expected_runs(doc, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(("" if doc is None else str(doc)).encode()), len(w)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[a + (i - a) % p] if i >= a else x for i, x in enumerate(w)]
    found = brute_runs(w)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    return (doc, len(found), *best, None if best[0] is None else 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in dropped).encode()).hexdigest())


def test_runs_query_equals_brute_force(spark, odd, empty, docs):
    short = docs.filter("length(text) < 1500")
    planted = spark.createDataFrame([(i, " ".join(f"w{k * k % 37}" for k in range(40 + i))) for i in range(300)], "doc_id long, text string")
    for table in (short, odd.filter("doc_id IS NULL OR doc_id NOT IN (5, 6)"), planted):
        made = runs.digest_runs(table)
        assert made.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
        assert sorted(map(tuple, made.collect()), key=repr) == sorted((expected_runs(r["doc_id"], r["text"]) for r in table.collect()), key=repr)
    assert any(expected_runs(r["doc_id"], r["text"])[1] for r in planted.collect())
    assert runs.digest_runs(empty).count() == 0 and runs.digest_runs(odd).count() == len(TEXTS)


def test_runs_of_a_long_periodic_text(spark):
    text = " ".join(f"t{i % 700}" for i in range(60_000))
    row = runs.find_runs(spark.createDataFrame([(1, text)], "doc_id long, text string"), ["doc_id"]).first()
    assert [tuple(r) for r in row["runs"]] == [(0, 60_000, 700)]
    assert row["collapsed"] == " ".join(f"t{i}" for i in range(700)) and row["n_words"] == 60_000


# --- spelling variants ------------------------------------------------------

def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[i + (len(a) >= len(b)):] == b[i + (len(b) >= len(a)):]


def brute_variants(counted):
    out, form = {}, {}
    for w, n in counted.items():
        others = [v for v in counted if near(w, v)]
        best = min(others, key=lambda v: (-counted[v], v), default=None)
        form[w] = best if best and counted[best] >= 10 * n else None
        out[w] = [w, n, len(others), form[w], counted[form[w]] if form[w] else None]
    for w in out:
        end = w
        while form[end]:
            end = form[end]
        out[w].append(end)
    return sorted(map(tuple, out.values()))


def rows_of(table):
    return sorted((r["word"], r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in table.collect())


def test_variants_equal_brute_force(spark):
    draw = random.Random(9)
    base = ["aaaaaab", "aaaaaaab", "aabaaaa", "nettles", "nettle", "éclairs", "eclairs", "abababa", "bababab", "k" * 64, "k" * 65, "k" * 66, "k" * 90 + "m" + "k" * 40]
    counted = {w: draw.choice([2, 3, 30, 400, 5_000]) for w in base}
    for _ in range(1_500):
        w = draw.choice(list(counted))
        i, c = draw.randrange(len(w)), draw.choice("abkz")
        made = draw.choice([w[:i] + w[i + 1:], w[:i] + c + w[i:], w[:i] + c + w[i + 1:], w + c])
        if len(made) > 2:
            counted[made] = draw.choice([1, 2, 2, 3, 25, 300, 4_000])
    table = spark.createDataFrame(list(counted.items()), "word string, n long")
    kept = {w: n for w, n in counted.items() if n >= 2}
    want = brute_variants(kept)
    assert rows_of(variants.variants(table)) == want
    assert any(r[5] not in (r[0], r[3]) for r in want)  # a chain of two forms


def counted_by_hand(rows):
    counted = Counter()
    for doc, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if c.isascii() else c for c in w)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 7:
                counted[w] += 1
    return counted


def test_words_are_counted_whole(odd, docs):
    for table in (odd, docs):
        want = counted_by_hand([(r["doc_id"], r["text"]) for r in table.collect()])
        assert {r["word"]: r["n"] for r in variants.count_words(table).collect()} == want


def test_variants_edges(odd, empty):
    made = rows_of(variants.variants(variants.count_words(odd)))
    kept = {w: n for w, n in counted_by_hand(TEXTS).items() if n >= 2}
    assert made == brute_variants(kept) and LETTERS in kept
    assert variants.variants(variants.count_words(empty)).count() == 0


def test_a_range_counts_an_indel_once():
    assert len(list(variants.rotations("aab"))) == 7
    found = Counter()
    for prefix, skips, first in variants.rotations("aab"):
        for other, longer, _ in variants.rotations("ab"):
            if prefix == other and skips and not longer and first:
                found["indel"] += 1
    assert found["indel"] == 1
    rows = list(variants.scan([(False, True, 1, 9), (True, True, 2, 5), (True, False, 3, 9)]))
    assert rows == [(2, 2, (9, 1)), (3, 1, (5, 2)), (1, 1, (5, 2))]


def test_savings_are_those_of_each_window_of_whole_words():
    """Against two plain compress calls a window, built word by word."""
    import re

    import zstandard

    from weakspot.llm import toxicity

    code = lambda word: toxicity.word_codes([word])[0].tobytes()
    vocabulary = [f"ordinaryword{'abcdefgh'[i % 8]}{'klmnopqr'[i // 8]}" for i in range(64)]
    contents = [b"".join(code(w) for w in part) + toxicity.MARKER for part in (vocabulary[:32], vocabulary[32:])]
    own = ["", " 12 ;", " ".join(vocabulary[:20]), " ".join(vocabulary[20:50]) + ", the The THE", "Ordinarywordak " * 40]
    found = toxicity.Savings(*contents).of(own)
    packers = [zstandard.ZstdCompressor(level=toxicity.LEVEL, dict_data=zstandard.ZstdCompressionDict(c), write_content_size=False,
                                        write_dict_id=False) for c in contents]
    for text, row in zip(own, found):
        words = re.findall("[a-z]+", text.lower())
        saved = []
        for i in range(0, len(words), toxicity.WINDOW):
            window = b"".join(code(w) for w in words[i:i + toxicity.WINDOW]) + toxicity.MARKER
            toxic, ordinary = (len(p.compress(window)) for p in packers)
            saved.append(ordinary - toxic)
        expected = [len(saved), np.mean(saved), max(saved), sum(saved)] if saved else [0, 0, 0, 0]
        assert np.allclose(row, expected)
    assert code("ordinaryworda") != code("ordinarywordb")
    assert found[2][3] > 0
