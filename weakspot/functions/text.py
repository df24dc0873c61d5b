"""Text and identifier expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from weakspot import constants as C


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Trim every Unicode space, which a bare ``trim`` does not."""
    return F.btrim(col(c), F.lit(C.WHITESPACE))


def not_blank(c) -> Column:
    return strip(c) != ""


def strip_lower(c) -> Column:
    return F.lower(strip(c))


def null_when(c, tokens: list[str]) -> Column:
    """NULL where the value is one of ``tokens``."""
    c = col(c)
    return F.when(~c.isin(tokens), c)


def clean_id(c, any_case: bool) -> Column:
    """Trimmed id text, NULL for null-like words.

    ``any_case`` is the mode for one candidate column; with several
    candidates the words are matched exactly, so ``NULL`` survives there.
    """
    text = strip(col(c).cast("string"))
    if any_case:
        return F.when(~F.lower(text).isin(C.NULL_TOKENS_ANY_CASE), text)
    return null_when(text, C.NULL_TOKENS_EXACT)


def first_id(columns: list[str]) -> Column:
    """First usable id over candidate columns, in column order."""
    if not columns:
        return F.lit(None).cast("string")
    single = len(columns) == 1
    return F.coalesce(*[clean_id(F.col(f"`{c}`"), any_case=single) for c in columns])


def group_or_null(c, pattern: str, group: int) -> Column:
    """One regex group, NULL when the pattern is absent."""
    return F.nullif(F.regexp_extract(col(c), pattern, group), F.lit(""))


def extract_cwe(c) -> Column:
    """``CWE-<digits>`` from the first weakness id in the text, else NULL."""
    return F.concat(F.lit("CWE-"), group_or_null(c, C.CWE_PATTERN, 2))


def normalise_cwe(c) -> Column:
    """Normalised weakness id; text without one is kept, trimmed."""
    return F.coalesce(extract_cwe(c), strip(c))


def cwe_number(c) -> Column:
    return group_or_null(c, C.CWE_NUMBER_PATTERN, 1)


def cve_year(c) -> Column:
    return group_or_null(strip(c), C.CVE_STRICT_PATTERN, 1).try_cast("int")


def cve_number(c) -> Column:
    return group_or_null(strip(c), C.CVE_STRICT_PATTERN, 2).try_cast("bigint")


def cve_number_anywhere(c) -> Column:
    """Number of the first CVE id found anywhere in the text, as a double."""
    return group_or_null(c, C.CVE_LOOSE_PATTERN, 2).try_cast("double")


def token_count(c) -> Column:
    """Number of tokens, without building them.

    Each token of several characters becomes one character, spaces go, and
    what is left is one character for each token.
    """
    short = F.regexp_replace(col(c), C.LONG_TOKEN_PATTERN, "x")
    return F.coalesce(F.length(F.translate(short, C.WHITESPACE, "")), F.lit(0))


def line_count(c) -> Column:
    c = col(c)
    return F.length(c) - F.length(F.replace(c, F.lit("\n"))) + 1


def content_key(c) -> list[Column]:
    """Two 64-bit hashes with different seeds: equal pairs mean equal text.

    One 64-bit hash meets itself by chance at 10^10 rows; a pair does not.
    """
    c = col(c)
    return [F.xxhash64(c), F.xxhash64(F.lit(1), c)]


def first_sentence(c) -> Column:
    """Text before the first full stop, with the stop put back."""
    head = strip(F.split_part(col(c), F.lit("."), F.lit(1)))
    return F.when(head != "", F.concat(head, F.lit(".")))


def display_description(c) -> Column:
    c = col(c)
    shown = F.coalesce(F.when(c != "", c), F.lit(C.NO_DESCRIPTION))
    return F.substring(shown, 1, C.DISPLAY_CHARS)


def unify_newlines(c) -> Column:
    return F.regexp_replace(col(c), "\r\n?", "\n")


def decode_dropping_invalid(content) -> Column:
    """UTF-8 text of a binary column without its undecodable bytes.

    Invalid bytes turn into U+FFFD and are removed. A U+FFFD that the file
    itself holds is carried through behind a marker.
    """
    mark = "\x00weakspot\x00"
    raw = F.replace(col(content).cast("string"), F.lit("\ufffd"), F.lit(mark))
    valid = F.replace(F.make_valid_utf8(raw), F.lit("\ufffd"))
    return F.replace(valid, F.lit(mark), F.lit("\ufffd"))


def label_from_name(name) -> Column:
    """1 for names with ``bad``, 0 for ``good``, NULL otherwise; bad wins."""
    lower = F.lower(col(name))
    return F.when(lower.contains("bad"), 1).when(lower.contains("good"), 0)


def language_from_name(name, languages: dict[str, str]) -> Column:
    """Language by file extension, e.g. ``{".c": "c"}``."""
    name = col(name)
    return F.coalesce(*[
        F.when(name.endswith(suffix), F.lit(language))
        for suffix, language in languages.items()
    ])


def checked_int(c, what: str) -> Column:
    """Integer value; a value that is missing or no integer fails the job."""
    c = col(c)
    message = F.concat(F.lit(f"{what} is not an integer: "), F.coalesce(c.cast("string"), F.lit("NULL")))
    return F.coalesce(c.try_cast("int"), F.raise_error(message).cast("int"))


def id_candidates(columns: list[str], word: str) -> list[str]:
    """Columns whose name contains ``word`` in any letter case."""
    return [c for c in columns if word in c.lower()]


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))
