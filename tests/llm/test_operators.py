"""Brute-force checks, edge cases and held-out accuracy of the operators."""

import hashlib
import math
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weakspot.llm import bpe, hmm, jaccard, labelled, lattice, mincut, packing, pii, quality, topk, toxicity
from weakspot.llm.segments import Cache, segments

SF = "/root/testdata/sf0.001"
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("score", T.StringType()), T.StructField("n", T.LongType())])  # clashing extra columns
LONG = " ".join(f"word{i % 97} mail{i}@example.org" for i in range(6_000))
ODD = [(1, None, "x", 1), (2, "", "x", 1), (3, "one", "x", 1), (4, " \t\n ", "x", 1), (5, LONG, None, None), (6, LONG, "y", 2),
       (7, "Same text here twice over", "z", 3), (7, "Same text here twice over", "z", 3), (None, "no key at all", "z", 3),
       (8, "日本語 text's I'LL don't\t\tok 123,456!!!  end", "q", 4), (9, "a  b <|endoftext|> c" + "-" * 3000, "q", 5)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def spans_by_pattern(text):
    def luhn(d):
        return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0

    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for kind, pattern, low, high in (("card", r"[0-9]([\x20-]?[0-9])+", 12, 19), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 9, 15)):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if low <= len(digits) <= high and (kind == "phone" or luhn(digits)):
                out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], pii.RANK[s[0]]))


PII_TEXTS = ["a@b@c.de a.b+c@x-y.co.uk. @no.de x@y", "1.2.3.4.5.6.7.8 999.1.1.1 0001.2.3.4 1..2.3.4", "4111 1111 1111 1111 5-5 1 2  3",
             "+1 (017) 555-7713, +49-30 1234567+1 2", "é@b.de 日a@b.cc+1.2.3.4", "4111111111111111@mail.example.com +4111111111111111",
             "IBAN: DE89 3704 0044 0532 0130 00 and account no: 12345678", 'token = "9c8b45435718dcc700c184a7e303cdc64c6a8f00"',
             "see https://x.example/a?b=c). done", "", "1", "+", "@"]


def test_pii_base_spans_equal_the_patterns(docs):
    texts = PII_TEXTS + [r["text"] for r in docs.collect()]
    for text in texts:
        assert [s for s in pii.find(text) if s[0] in pii.BASE_KINDS] == spans_by_pattern(text), text[:80]
    kinds = {k for t in PII_TEXTS for k, _, _ in pii.find(t)}
    assert kinds == set(pii.KINDS)
    assert pii.redact("mail a@b.de now", pii.find("mail a@b.de now")) == "mail [EMAIL] now"


def test_pii_edges(odd, empty):
    rows = pii.digest_spans(odd).collect()
    assert len(rows) == len(ODD) and pii.digest_spans(empty).count() == 0
    none = hashlib.sha256(b"").hexdigest()
    assert all(r["base_sha256"] == none and r["spans"] == "" for r in rows if r["doc_id"] in (1, 2, 3, 4))
    assert {r["n_email"] for r in rows if r["doc_id"] in (5, 6)} == {6_000}
    assert pii.find_spans(odd).count() == len(ODD) and pii.masked(odd).columns == odd.columns


def test_pii_of_long_runs_is_quick():
    begin = time.time()
    for text in ("0" * 1_000_000, "1." * 500_000, " " * 1_000_000, "account" + " " * 1_000_000, "+1" + "(" * 1_000_000, "a" * 1_000_000 + "@",
                 "0" * 5_000 + ".1.1.1", "@" * 200_000, "token=" + "\t" * 1_000_000):
        assert [s for s in pii.find(text) if s[0] in pii.BASE_KINDS] == ([("ip", 0, 5_006)] if "1.1.1" in text[4_990:5_010] and text[0] == "0" else [
            s for s in pii.find(text) if s[0] == "ip"])
    assert time.time() - begin < 40
    draw = __import__("random").Random(3)
    for _ in range(3_000):
        text = "".join(draw.choice(["1", "25", "256", "0", ".", ".", ".", "..", " ", "300", "0001"]) for _ in range(draw.randrange(30)))
        assert [s for s in pii.find(text) if s[0] == "ip"] == [s for s in spans_by_pattern(text) if s[0] == "ip"], text


def test_broken_markup_ends():
    begin = time.time()
    for html in ("<a " + '""' * 10_000, "<a " + "'\"" * 10_000 + "<p>x</p>", "<a href='x" + "y" * 100_000, "<" * 100_000, "<svg" + " '" * 10_000):
        assert mincut.main_text(html) is not None
    assert time.time() - begin < 20
    whole = '<article><p title="a > b" lang=en>This is a long enough sentence for the text of an article, in full.</p></article>'
    assert mincut.main_text(whole) == "This is a long enough sentence for the text of an article, in full."


def test_segments_do_not_change_tokens(docs):
    for text in [r["text"] for r in docs.collect()] + [t[1] or "" for t in ODD] + [" a", "a ", "a  b", "a \n b  c"]:
        assert "".join(segments(text)) == text


@pytest.fixture(scope="module")
def reference():
    path = P.path("byte_bpe_multi_50k.tiktoken")
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})


def test_bpe_equals_the_library(odd, empty, docs, reference):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    for table in (docs, odd):
        made = bpe.encode(table, path, P.PATTERN).collect()
        want = table.collect()
        for r, w in zip(made, want):
            text = w["text"] or ""
            assert r["ids"] == reference.encode_ordinary(text) and r["decoded"] == text
    digests = bpe.digest(odd, path, P.PATTERN).collect()
    for r, w in zip(digests, ODD):
        ids = reference.encode_ordinary(w[1] or "")
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((w[1] or "").encode()).hexdigest()
    assert bpe.digest(empty, path, P.PATTERN).count() == 0


def test_bpe_long_word_by_heap(reference):
    tool = bpe.Encoder(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    for word in ("ab" * 2_000, "straßeundhaus" * 300):
        assert tool.heap(word.encode()) == reference.encode_ordinary(word)
        tool.words([word])
        assert tool.ids[word] == ",".join(map(str, tool.heap(word.encode()))) and tool.raw[word] == word.encode()


def test_bpe_generations_do_not_change_ids(reference, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT", 5_000)
    tool = bpe.Encoder(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    for i in range(40):
        own = [f"again and  again, it's word{i % 7} or {i * 37}... ", "", "straße" * 40 + f" end{i // 2}"]
        for text, (ids, raw) in zip(own, tool.encode(own)):
            assert ids == ",".join(map(str, reference.encode_ordinary(text))) and raw == text.encode()
        assert tool.used < 60_000 and len(tool.ids) == len(tool.raw)
    assert tool.old[0]


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header class="top"><h2>Site name</h2></header>
<nav><ul><li><a href="/">Home</a></li><li><a href="/b">Other things</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies to make this long sentence look like content, really we do, every day.</p></div>
<main><article><header><h1>A headline &amp; more</h1></header><p>First <b>para</b>graph of the
  article, long enough to be content.</p><div class="ad">Buy this now. It is very good and long enough to be text.</div>
<p>Second paragraph<br>goes on here, with a <a href="x">link</a> in it.</p><p>Short.</p></article>
<section class="comments"><h3>Comments</h3><p>I really liked this article, it told me a lot about everything. Thank you.</p></section></main>
<aside><p>Related reading that is also quite long and full of words, as sidebars are.</p></aside>
<form><label>Search</label><input name="q"><button>Go</button></form><script>if (a < b) { document.write("<p>no</p>"); }</script>
<footer><p>&copy; 2020 Someone. All rights reserved by the people of this site.</p></footer></body></html>"""


def test_mincut_page():
    assert mincut.main_text(PAGE) == ("A headline & more First paragraph of the article, long enough to be content. "
                                      "Second paragraph goes on here, with a link in it. Short.")


def test_mincut_tables(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        import html
        want = " ".join(html.unescape(re.sub(r"<[^>]+>", lambda m: "" if m[0] in ("<b>", "</b>") else "\n", inner)).split())
        assert mincut.main_text(r["html"]) == want
    schema = "page_id long, url string, html string, text string"
    rows = mincut.extract(spark.createDataFrame([(1, None, None, "x"), (2, "u", "", "x"), (3, "u", "<p>", "y"), (3, "u", "<p>", "y"),
                                                 (4, "u", "<article>" + "<p>A sentence that is long. </p>" * 5_000, "z")], schema), ["page_id", "url"]).collect()
    assert [r["text"] for r in rows[:4]] == [""] * 4 and rows[4]["n_chars"] == 5_000 * 25 - 1
    assert mincut.extract(spark.createDataFrame([], schema), ["page_id", "url"]).count() == 0


def test_mincut_is_the_cheapest_labelling():
    rng = np.random.default_rng(3)
    for _ in range(200):
        n = int(rng.integers(1, 9))
        costs = [int(c) for c in rng.integers(-50, 50, n)]
        edges = {(a, b): int(rng.integers(0, 40)) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.5}

        def price(side):
            return (sum(-c for c, s in zip(costs, side) if not s and c < 0) * 0 + sum(max(c, 0) for c, s in zip(costs, side) if not s)
                    + sum(max(-c, 0) for c, s in zip(costs, side) if s) + sum(w for (a, b), w in edges.items() if side[a] != side[b]))

        best = min(price([bool(m >> i & 1) for i in range(n)]) for m in range(1 << n))
        assert price(mincut.label(costs, edges)) == best


@pytest.mark.parametrize("operator,label,parts,out,least", [(quality, "quality", 3, 1, 0.97), (toxicity, "toxic", 5, 0, 0.9)])
def test_classifiers(spark, odd, empty, operator, label, parts, out, least):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = operator.fit(docs, labels, labelled.fold("doc_id", parts) != out, label)
    scored = quality.score(docs, model).join(labels, "doc_id").filter(labelled.fold("doc_id", parts) == out)
    assert scored.filter(F.col("predicted") == F.col(label)).count() / scored.count() > least
    rows = quality.score(odd, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (1, 2, 4)}) == 1
    assert quality.score(empty, model).count() == 0
    assert len({r["score"] for r in quality.score(odd, operator.fit(odd, labels.limit(0), F.lit(True), label)).collect()}) == 1


def test_hmm_base_and_forward(spark, odd, empty):
    docs = spark.read.parquet(f"{SF}/documents.parquet").unionByName(odd, allowMissingColumns=True).select("doc_id", "text")
    rows = docs.collect()
    got = {(r["doc_id"], r["n_tokens"], round(r["base_score"], 6)): r for r in hmm.score(docs, labelled.fold("doc_id", 7) == 2, sample_rounds=2).collect()}
    tokens = [[*(r["text"] or "").encode().lower().split(), None] for r in rows]
    held = [zlib.crc32(str(r["doc_id"] if r["doc_id"] is not None else "").encode()) % 7 == 2 for r in rows]
    count = Counter(t for ts, h in zip(tokens, held) if not h for t in ts)
    total, distinct = sum(count.values()), len(count)
    for r, ts, h in zip(rows, tokens, held):
        base = sum(math.log10((count[t] + 1) / (total + distinct + 1)) for t in ts)
        near = [v for (i, n, b), v in got.items() if i == r["doc_id"] and n == len(ts) and abs(b - base) < 1e-4]
        assert near and near[0]["held_out"] == h and near[0]["train_tokens"] == total
        assert near[0]["n_known"] == sum(count[t] > 0 for t in ts)
    better = [v for v in got.values() if v["held_out"] and v["n_tokens"] > 20]
    assert np.mean([v["score"] > v["base_score"] for v in better]) > 0.8
    assert hmm.score(empty, F.lit(False)).count() == 0


def test_hmm_recursions_by_enumeration():
    from itertools import product
    rng = np.random.default_rng(1)
    model = hmm.Hmm(np.array([0.6, 0.4]), np.array([[0.7, 0.3], [0.2, 0.8]]), rng.dirichlet(np.ones(4), 2).T)
    sequences = [np.array(s, dtype="<u2") for s in ([0, 3, 1, 2], [2], [1, 1, 0])]
    start, move, emit = model.expected(sequences)
    want_move, want_emit, want_logs = np.zeros((2, 2)), np.zeros((4, 2)), []
    for s in sequences:
        paths = {p: model.start[p[0]] * np.prod([model.move[a, b] for a, b in zip(p, p[1:])]) * np.prod([model.emit[x, z] for x, z in zip(s, p)])
                 for p in product(range(2), repeat=len(s))}
        whole = sum(paths.values())
        want_logs.append(math.log10(whole))
        for p, w in paths.items():
            for a, b in zip(p, p[1:]):
                want_move[a, b] += w / whole
            for x, z in zip(s, p):
                want_emit[x, z] += w / whole
    assert np.allclose(model.logs(sequences), want_logs) and np.allclose(move, want_move) and np.allclose(emit, want_emit)


@pytest.mark.parametrize("piece", [1, 2, 7, 64])
def test_hmm_borders_of_pieces_change_nothing(piece):
    rng = np.random.default_rng(piece)
    model = hmm.Hmm(rng.dirichlet(np.ones(3)), rng.dirichlet(np.ones(3), 3), rng.dirichlet(np.ones(9), 3).T)
    sequences = [rng.integers(0, 9, n).astype("<u2") for n in (1, 2, 7, 8, 64, 65, 300, 0, 14)]
    for whole, cut in zip(model.expected(sequences, 10_000), model.expected(sequences, piece)):
        assert np.allclose(whole, cut, rtol=1e-9)


def test_most_frequent_words(spark):
    rows = [((i * 2654435761 << 31) % 2**64 - 2**63, i % 5, i % 7, 1 + i % 9) for i in range(3_000)]
    counts = spark.createDataFrame(rows, "word long, kind int, n long, seen long")
    for most in (1, 100, 700, 2_999, 3_000, 5_000):
        made = [r["seen"] for r in hmm.most_frequent(counts, most).collect()]
        assert sorted(made, reverse=True) == sorted((r[3] for r in rows), reverse=True)[:most]


def test_hmm_words_outside_the_tables(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    fold = labelled.fold("doc_id", 7) == 2
    whole = {r["doc_id"]: r for r in hmm.score(docs, fold, sample_rounds=1).collect()}
    monkeypatch.setattr(hmm, "SHARED", 300)
    for r in hmm.score(docs, fold, sample_rounds=1).collect():
        same = whole[r["doc_id"]]
        assert r["n_known"] == same["n_known"] and abs(r["base_score"] - same["base_score"]) < 1e-6


def brute_components(texts, width, percent):
    sets = []
    for text in texts:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    label = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both) and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if v == old else v for v in label]
    return [len(s) for s in sets], label


@pytest.mark.parametrize("width,percent", [(4, 85), (5, 80)])
def test_jaccard_equals_all_pairs(spark, docs, empty, width, percent, monkeypatch):
    monkeypatch.setattr(jaccard, "LONG", 4)  # long lists, stars and their closing on small data
    rng = np.random.default_rng(2)
    base = [f"w{i}" for i in range(120)]
    near = []
    for _ in range(60):  # near copies of one text, many of which link only through others
        words = list(base)
        for at in rng.integers(0, 120, int(rng.integers(0, 5))):
            words[at] = f"x{rng.integers(0, 9)}"
        near.append(" ".join(words))
    texts = [r["text"] for r in docs.orderBy("doc_id").collect()] + near + ["A b C d e", "a B c D e", "one", "one", None, "", LONG, LONG + " tail"]
    sizes, label = brute_components(texts, width, percent)
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n string")
    got = sorted(jaccard.classes(frame, width=width, percent=percent).collect())
    assert [r["n_shingles"] for r in got] == sizes
    assert [r["component_id"] for r in got] == label
    assert jaccard.classes(empty).count() == 0


VECTORS = "vec_id long, embedding array<float>, label int, id string"


def odd_vectors():
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=8)], i % 3, "x") for i in range(300)]
    rows += [(300 + i, rows[0][1], 0, "x") for i in range(40)]
    rows += [(400 + i, [float(x) + 0.05 * float(e) for x, e in zip(rows[1][1], rng.normal(size=8))], 1, "x") for i in range(40)]
    return rows + [(500, None, 1, "x"), (501, [0.0] * 8, 1, "x"), (502, [float("nan")] * 8, 1, "x"), (503, [None] * 8, 1, "x"),
                   (504, [float("inf")] * 8, 1, "x"), (505, rows[0][1], None, "x"), (506, [], 1, "x"), (600, rows[2][1], 2, "x")]


def test_topk_equals_sorting(spark):
    rows = odd_vectors()
    frame = spark.createDataFrame(rows, VECTORS)
    good = {r[0]: np.floor(np.array(r[1], dtype="float32").astype("float64") * 1024).astype("int64") for r in rows
            if r[1] and None not in r[1] and np.isfinite(r[1]).all()}
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in
                 topk.top_k(frame, F.col("vec_id") % 100 == 0, shard_rows=16, block_rows=2).collect())
    want = []
    for q in sorted(i for i in good if i % 100 == 0):
        best = sorted(((-int(good[q] @ v), i) for i, v in good.items() if i != q))[:10]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert got == want
    assert topk.top_k(frame.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_topk_large_numbers(spark):
    frame = spark.createDataFrame([(0, [3e9, 1.0], 1, "x"), (1, [2e3, 5.0], 1, "x")], VECTORS)
    row = topk.top_k(frame, F.col("vec_id") == 0).collect()[0]
    a, b = math.floor(1024 * float(np.float32(3e9))), 2048000
    assert row["score"] == a * b + 1024 * 5120


def test_lattice_decodes_to_the_nearest_point():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 8))
    roots = lattice.minimal_vectors()
    assert len(roots) == 240 and np.allclose((roots ** 2).sum(1), 2)
    near = lattice.decode_e8(x)
    own = ((x - near) ** 2).sum(1)
    assert (own[:, None] <= ((x[:, None] - near[:, None] - roots) ** 2).sum(2) + 1e-9).all() and own.max() <= 1 + 1e-9


@pytest.mark.parametrize("source", ["odd", "embeddings"])
def test_lattice_recall(spark, source, monkeypatch):
    monkeypatch.setattr(lattice, "BLOCK", 16)
    if source == "odd":
        frame = spark.createDataFrame(odd_vectors(), VECTORS)
    else:
        held = spark.read.parquet(f"{SF}/embeddings.parquet")
        near = held.filter("vec_id < 60").select((F.col("vec_id") + 10_000).alias("vec_id"), F.transform(
            "embedding", lambda x, i: (x + 0.04 * F.sin(i * 37.0 + F.col("vec_id"))).cast("float")).alias("embedding"), "label")
        frame = held.unionByName(near)
    rows = frame.select("vec_id", "embedding", "label").collect()
    good = [r for r in rows if r["label"] is not None and r["embedding"] and None not in r["embedding"]
            and np.isfinite(r["embedding"]).all() and np.any(r["embedding"])]
    unit = np.array([r["embedding"] for r in good], dtype="float64")
    unit /= np.sqrt((unit ** 2).sum(1, keepdims=True))
    same = np.array([r["label"] for r in good])
    links = (unit @ unit.T >= 0.93) & (same[:, None] == same[None, :])
    np.fill_diagonal(links, False)
    got = {r["vec_id"]: r for r in lattice.near_duplicates(frame).collect()}
    assert len(got) == len(rows)
    true, found = links.sum(1), np.array([got[r["vec_id"]]["n_links"] for r in good])
    assert (found <= true).all() and found.sum() >= 0.9 * true.sum() > 0
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in got if i not in {r["vec_id"] for r in good})
    assert lattice.near_duplicates(frame.limit(0)).count() == 0


def pack(table):
    return packing.pack(table, P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


def test_packing_covers_every_id_once(spark, docs, empty):
    from tokenizers import Tokenizer
    tool = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    table = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(9_000 + i, r[1]) for i, r in enumerate(ODD)], "doc_id long, text string"))
    ids = {r["doc_id"]: [*tool.encode(r["text"] or "", add_special_tokens=False).ids, 0] for r in table.collect()}
    held, met = {}, Counter()
    for r in pack(table).collect():
        own = ids[r["doc_id"]]
        part = np.asarray(own[r["start"]:r["start"] + r["length"]], dtype="<u4")
        assert r["doc_tokens"] == len(own) and len(part) == r["length"] > 0 and zlib.crc32(part.tobytes()) == r["ids_crc32"]
        met.update((r["doc_id"], i) for i in range(r["start"], r["start"] + r["length"]))
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(met.values()) == {1} and len(met) == sum(map(len, ids.values()))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(held) * 1024 <= 1.02 * len(met) + 1024
    assert pack(empty).count() == 0


def test_packing_encodes_a_text_in_one_call(monkeypatch):
    tool, fast, special = packing._encoder(P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)[:3]
    called = []

    class Counting:
        def encode_ordinary(self, text):
            called.append(text)
            return fast.encode_ordinary(text)

    monkeypatch.setattr(packing, "_encoder", lambda *names: (tool, Counting(), special))
    own = [r[1] or "" for r in ODD] + [" ".join(f"w{i}x{i * 7}" for i in range(3_000)), "a" * 50_000, " " * 50_000, "\n " * 9_000]
    want = [np.asarray(tool.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in own]
    assert list(packing.token_bytes(own, "", "", "")) == want
    assert called == [t for t in own if not any(s in t for s in special)]


def test_fillings_are_the_least_slack():
    rng = np.random.default_rng(6)
    for _ in range(30):
        counts = {int(n): int(c) for n, c in zip(rng.integers(1, 40, 6), rng.integers(1, 5, 6))}
        left = dict(counts)
        for times, chosen in packing.fillings(counts, 40):
            first = max(n for n, c in left.items() if c)
            best = {first}
            sums = {0}
            for n, c in left.items():
                for _ in range(c - (n == first)):
                    sums |= {s + n for s in sums if s + n + first <= 40}
            assert first in best and sum(chosen) == first + max(sums)
            for n in chosen:
                left[n] -= times
        assert not any(left.values())


def test_duckdb_is_the_recursion():
    """Both recursions end where contracting step by step ends."""
    tool = bpe.Encoder(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    words = [" information", "aaaaaaa", "straße", "\x00\x01", "x", "ab" * 12, "日本語日本語", " internationalisation" * 3]
    start = tool.db.from_arrow(pa.table({"w": list(range(len(words))), "tokens": pa.array(  # noqa: F841
        [[int(tool.bytes[b]) for b in w.encode()] for w in words], pa.list_(pa.int32()))}))
    tool.db.register("start", start)
    made = [dict(tool.db.execute(q).fetchall()) for q in (bpe.ENCODE_BRIEF, bpe.ENCODE)]
    for i, word in enumerate(words):
        parts = [word.encode()[j:j + 1] for j in range(len(word.encode()))]
        while True:
            ranked = [(tool.ranks[a + b], j) for j, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in tool.ranks]
            if not ranked:
                break
            j = min(ranked)[1]
            parts[j:j + 2] = [parts[j] + parts[j + 1]]
        want = [tool.ranks[p] for p in parts]
        assert made[0][i] == want and made[1][i] == want


def test_scores_do_not_depend_on_the_batch():
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(["Word", "other,", "THIRD", "x.", "12"], rng.integers(0, 60))).encode() for _ in range(300)]
    model = quality.Model(rng.normal(0, 1, (1 << quality.BITS) + 1))
    whole = model.scores(texts)
    order = rng.permutation(len(texts))
    assert (model.scores([texts[i] for i in order]) == whole[order]).all()
    assert all(model.scores([t])[0] == v for t, v in zip(texts, whole))


def test_ftrl_equals_a_plain_loop():
    texts = [b"good calm words here", b"bad !!! BAD bad", b"calm words again here", b"!!! 12 BAD", b""]
    rows = [(at, value, y) for (at, value), y in zip(quality.sparse(texts), [1, 0, 1, 0, 1])]
    size = (1 << quality.BITS) + 1
    z, n = quality.follow(rows, np.zeros(size), np.zeros(size))
    sums, squares = {}, {}

    def leader(i):
        if abs(sums.get(i, 0.0)) <= quality.L1:
            return 0.0
        step = (quality.BETA + math.sqrt(squares.get(i, 0.0))) / quality.ALPHA + quality.L2
        return -(sums[i] - math.copysign(quality.L1, sums[i])) / step

    for at, value, y in rows:
        cells = {**dict(zip(at.tolist(), value.tolist())), size - 1: 1.0}
        w = {i: leader(i) for i in cells}
        p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in cells.items())))
        for i, v in cells.items():
            g, before = (p - y) * v, squares.get(i, 0.0)
            sums[i] = sums.get(i, 0.0) + g - (math.sqrt(before + g * g) - math.sqrt(before)) / quality.ALPHA * w[i]
            squares[i] = before + g * g
    used = sorted(sums)
    assert np.allclose(z[used], [sums[i] for i in used]) and np.allclose(n[used], [squares[i] for i in used])
    assert np.count_nonzero(n) <= len(used)


def test_segment_cache_is_bounded():
    cache = Cache(20_000)
    for i in range(2_000):
        cache.keep(f"rare{i}", b"12345678")
        assert cache.get("often") or cache.keep("often", b"x")
    assert cache.get("often") == b"x" and cache.get("rare0") is None and len(cache.young) + len(cache.old) < 200
