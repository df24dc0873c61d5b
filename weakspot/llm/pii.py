"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in one pass over a text: at-signs,
plus signs, digits, scheme marks and words that announce an identifier. At
an anchor a small deterministic parser expands to the left and right, finds
the boundaries and validates. Work is linear in the text; nothing leaves the
task but offsets.

Base kinds are exactly the leftmost, non-overlapping matches of their
patterns; the other kinds are spans that only the anchors give:

* ``url``: a scheme mark with its scheme and what follows up to white space,
  quotes or angle brackets, without closing punctuation;
* ``account``: a number of 6 to 34 characters after an account word, of
  which at least 4 are digits; after ``iban`` it must pass the mod-97 test;
* ``secret``: 16 to 256 key characters with a digit after a word such as
  ``token``, ``password`` or ``api_key``.

A NULL or empty text has no spans. Equal texts give equal spans. Spans of
different kinds may overlap; both are reported. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from weakspot.llm.arrow import map_columns, texts

BASE_KINDS = ["email", "ip", "card", "phone"]
KINDS = [*BASE_KINDS, "url", "account", "secret"]
RANK = {kind: i for i, kind in enumerate(KINDS)}

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9.]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
URL_TAIL = re.compile(r"://[^\s<>\"'`]+")
SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
GLUE = r"[\x20_-]?(?:no\.?|nr\.?|number|id)?[\x20\t]*+(?:[:=#][\x20\t]*+)?[\"']?"
ACCOUNT = re.compile(GLUE + r"([A-Za-z0-9](?:[\x20-]?[A-Za-z0-9]){5,33})(?![A-Za-z0-9])")
IBAN = re.compile(GLUE + r"([A-Za-z]{2}[0-9]{2}(?:\x20?[A-Za-z0-9]){10,30})(?![A-Za-z0-9])")
SECRET = re.compile(r"[\x20\t]*[:=][\x20\t]*[\"']?([A-Za-z0-9+/=_.-]{16,256})(?![A-Za-z0-9+/=_-])")
CUES = {"account": ["account", "acct", "konto", "compte", "cuenta"], "iban": ["iban"],
        "secret": ["token", "secret", "password", "passwd", "api_key", "apikey", "api-key", "access_key"]}


@lru_cache(maxsize=1)
def _anchors() -> ahocorasick.Automaton:
    """One entry per spelling; the value is (what to parse, length)."""
    found = ahocorasick.Automaton()
    for sign, kind in (("@", "email"), ("+", "phone"), ("://", "url"), *((d, "digit") for d in "0123456789")):
        found.add_word(sign, (kind, len(sign)))
    for kind, words in CUES.items():
        for word in words:
            for spelling in {word, word.capitalize(), word.upper()}:
                found.add_word(spelling, (kind, len(spelling)))
    found.make_automaton()
    return found


def _digits(text: str) -> list[int]:
    return [int(c) for c in text if "0" <= c <= "9"]


def _ips(text: str, start: int, end: int) -> Iterator[tuple[str, int, int]]:
    """Leftmost groups of four numbers with a point between each two, in a
    stretch of digits and points, cut once at its points: a group that fails
    is passed over whole, as its pattern has matched."""
    parts = []
    at = start
    for own in text[start:end].split("."):
        parts.append((at, own))
        at += len(own) + 1
    i = 0
    while i + 3 < len(parts):
        four = parts[i:i + 4]
        empty = next((j for j, (_, own) in enumerate(four) if not own), None)
        if empty is not None:
            i += empty + 1
            continue
        if all(len(own) <= 3 or len(own.lstrip("0")) <= 3 for _, own in four) and all(int(own[-3:]) <= 255 for _, own in four):
            yield "ip", four[0][0], four[3][0] + len(four[3][1])
        i += 4


def _luhn(digits: list[int]) -> bool:
    doubled = [d * 2 - 9 if d > 4 else d * 2 for d in digits[-2::-2]]
    return (sum(doubled) + sum(digits[-1::-2])) % 10 == 0


def _iban(text: str) -> bool:
    plain = text.replace(" ", "").upper()
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def find(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind; code points, end exclusive."""
    spans: list[tuple[str, int, int]] = []
    email_end = ip_done = card_done = phone_done = url_done = 0
    for last, (kind, length) in _anchors().iter(text):
        at = last - length + 1
        if kind == "digit":
            if at >= ip_done:
                ip_done = DOTTED.match(text, at).end()
                if ip_done - at >= 7:
                    spans += _ips(text, at, ip_done)
            if at >= card_done:
                m = CARD.match(text, at)
                card_done = m.end() if m else at + 1
                if m and m.end() - at >= 12:
                    digits = _digits(m[0])
                    if 12 <= len(digits) <= 19 and _luhn(digits):
                        spans.append(("card", at, m.end()))
        elif kind == "email":
            start = at
            while start > email_end and text[start - 1] in LOCAL:
                start -= 1
            if start < at and (m := DOMAIN.match(text, at)):
                email_end = m.end()
                spans.append(("email", start, email_end))
        elif kind == "phone":
            if at >= phone_done and (m := PHONE.match(text, at)):
                phone_done = m.end()
                if 9 <= len(_digits(m[0])) <= 15:
                    spans.append(("phone", at, phone_done))
        elif kind == "url":
            start = at
            while start > url_done and text[start - 1] in SCHEME:
                start -= 1
            while start < at and not text[start].isalpha():
                start += 1
            if start < at and (m := URL_TAIL.match(text, at)):
                url_done = at + len(m[0].rstrip(".,;:!?)]}"))
                if url_done > at + 3:
                    spans.append(("url", start, url_done))
        elif at == 0 or not text[at - 1].isalnum():
            m = {"account": ACCOUNT, "iban": IBAN, "secret": SECRET}[kind].match(text, last + 1)
            if m and (_iban(m[1]) if kind == "iban" else len(_digits(m[1])) >= (4 if kind == "account" else 1)):
                spans.append(("secret" if kind == "secret" else "account", *m.span(1)))
    return sorted(spans, key=lambda s: (s[1], RANK[s[0]], s[2]))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind in brackets; of spans
    that overlap the first names the whole stretch."""
    out, done, i = [], 0, 0
    while i < len(spans):
        kind, start, end = spans[i]
        i += 1
        while i < len(spans) and spans[i][1] < end:
            end = max(end, spans[i][2])
            i += 1
        out += [text[done:start], f"[{kind.upper()}]"]
        done = end
    return "".join([*out, text[done:]]) if out else text


def find_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, spans array<struct<kind, start, end>>, redacted) of whole texts."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            own = texts(batch, text)
            found = [find(t) for t in own]
            yield {key: batch.column(key), "spans": [[{"kind": k, "start": s, "end": e} for k, s, e in f] for f in found],
                   "redacted": [redact(t, f) for t, f in zip(own, found)]}

    return map_columns(docs, [key, text], f"`{key}` {kind}, spans array<struct<kind: string, start: long, end: long>>, "
                                          "redacted string", run)


def masked(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns, the text redacted; NULL becomes the empty text."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            yield {**{c: batch.column(c) for c in batch.schema.names}, text: [redact(t, find(t)) for t in texts(batch, text)]}

    return map_columns(docs, docs.columns, fields, run)


def digest_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts of the base kinds, their digest, all spans as text and counts
    of the added kinds, for each row."""
    kind = docs.schema[key].dataType.simpleString()
    counts = {k: f"n_{k}" for k in BASE_KINDS}
    added = {k: f"n_{k}" for k in KINDS if k not in counts}

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            found = [find(t) for t in texts(batch, text)]
            base = [[s for s in f if s[0] in counts] for f in found]
            yield {key: batch.column(key), **{name: [sum(s[0] == k for s in f) for f in found] for k, name in {**counts, **added}.items()},
                   "base_sha256": [hashlib.sha256(joined(b).encode()).hexdigest() for b in base],
                   "spans": [joined(f) for f in found]}

    longs = lambda names: ", ".join(f"{n} long" for n in names.values())
    return map_columns(docs, [key, text], f"`{key}` {kind}, {longs(counts)}, base_sha256 string, spans string, {longs(added)}", run)
