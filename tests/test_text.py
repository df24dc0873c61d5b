import re

import pytest
from pyspark.sql import functions as F

from weakspot import constants as C
from weakspot.functions import numeric as N
from weakspot.functions import text as X
from weakspot.operators.html import block_text


def values(spark, texts, expr):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in rows.orderBy("i").select(expr(F.col("t"))).collect()]


def test_whitespace_is_what_strip_removes():
    assert set(C.WHITESPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


def test_strip_and_length(spark):
    texts = ["　 a b\x1f\n", "\t\n", "", None, "é\U0001f600x"]
    assert values(spark, texts, X.strip) == [t if t is None else t.strip() for t in texts]
    assert values(spark, texts, lambda c: F.length(X.strip(c))) == [t if t is None else len(t.strip()) for t in texts]


def test_cwe(spark):
    texts = ["CWE121_Stack_Based", "cwe-79", "CWE_007", "none", "NVD-CWE-noinfo", None]
    assert values(spark, texts, X.extract_cwe) == ["CWE-121", "CWE-79", "CWE-007", None, None, None]
    assert values(spark, [" NVD-CWE-noinfo ", "x cwe_5"], X.normalise_cwe) == ["NVD-CWE-noinfo", "CWE-5"]
    assert values(spark, ["CWE-79", "cwe-79", "a CWE-12b"], X.cwe_number) == ["79", None, "12"]


def test_cve(spark):
    texts = [" cve-2014-0160 ", "xCVE-2014-1", "CVE-2014-" + "1" * 20, "CVE-14-1", None]
    assert values(spark, texts, X.cve_year) == [2014, None, 2014, None, None]
    assert values(spark, texts, X.cve_number) == [160, None, None, None, None]
    assert values(spark, ["xCVE-2014-0160y", "none", None], X.cve_number_anywhere) == [160.0, None, None]


def test_token_count_is_that_of_the_pattern(spark):
    pattern = re.compile(r"[A-Za-z_]\w+|\d+|==|!=|<=|>=|[^\s]")
    texts = ["if (a1==b) x<=10;", "", "é9ü _a a ab1é ٣٤x", "a==!=<>=b", "　x \x1cy1", "a\nb\r\nc!==d", "日本 x日本 ½ x½"]
    assert values(spark, texts + [None], X.token_count) == [len(pattern.findall(t)) for t in texts] + [0]


def test_token_patterns_agree(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert rows.filter(X.token_count("text") != F.regexp_count("text", F.lit(C.TOKEN_PATTERN))).count() == 0


def test_sentences_and_lines(spark):
    assert values(spark, ["Hello. W", ".x", "abc", "", None], X.first_sentence) == ["Hello.", None, "abc.", None, None]
    assert values(spark, ["a\nb\nc", ""], X.line_count) == [3, 1]
    assert values(spark, ["", None, "x" * 130], X.display_description) == [C.NO_DESCRIPTION] * 2 + ["x" * 120]
    assert values(spark, ["a\r\nb\rc\n"], X.unify_newlines) == ["a\nb\nc\n"]


def test_null_tokens(spark):
    texts = ["NULL", " none ", "None", "NaN", "", "x"]
    assert values(spark, texts, lambda c: X.clean_id(c, True)) == [None] * 5 + ["x"]
    assert values(spark, texts, lambda c: X.clean_id(c, False)) == ["NULL"] + [None] * 4 + ["x"]


def test_label_from_name(spark):
    assert values(spark, ["X_bad.c", "goodBad.c", "good.java", "main.c"], X.label_from_name) == [1, 1, 0, None]


def test_checked_int(spark):
    assert values(spark, ["1", "0"], lambda c: X.checked_int(c, "label")) == [1, 0]
    for wrong in ("x", None):
        with pytest.raises(Exception, match="label is not an integer"):
            values(spark, [wrong], lambda c: X.checked_int(c, "label"))


def test_bytes_that_are_no_text_are_dropped(spark):
    raw = [b"a\xffb", "é�z".encode(), b"\xe2\x82x", b"ok"]
    rows = spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate(raw)], "i int, b binary").orderBy("i")
    assert [r[0] for r in rows.select(X.decode_dropping_invalid("b")).collect()] == [
        b.decode(errors="ignore") for b in raw]


def test_numbers(spark):
    rows = spark.createDataFrame([("n/a",), (None,), ("2.5",), ("NaN",), ("-Infinity",)], "t string")
    assert [r[0] for r in rows.select(N.number_or("t", -1)).collect()] == [-1.0, -1.0, 2.5, -1.0, float("-inf")]
    assert [r[0] for r in rows.select(N.finite("t")).collect()] == [0.0, 0.0, 2.5, 0.0, -N.DOUBLE_MAX]
    shares = spark.createDataFrame([(0.6015,), (0.0,), (1.0,), (0.12345,)], "s double")
    assert [r[0] for r in shares.select(N.percent_text("s")).collect()] == ["60.15%", "0.0%", "100.0%", "12.34%"]


PAGES = {
    "<div id='Description'>A <b>b</b><h3>no</h3><div>c.<script>x</script></div> d</div><div>e</div>": "A b c. d",
    "<h2>The description</h2><p>x</p><div>y<table><tr><td>z</td></tr></table> &amp; w</div>": "y & w",
    "<section><h2>Description</h2></section><div>y</div>": None,
    "<h2>Other</h2><div>n</div><h2>DESCRIPTION</h2><div>y<br>z</div>": "y z",
    "<h2>Description</h2><div>n</div><div id='Description'>y</div>": "y",
    "<div id='Description'><p>a<p>b</div>c": "a b",
    "<div id='Description'> </div>": None,
    "": None,
}


@pytest.mark.parametrize("page", PAGES)
def test_description_block(page):
    assert block_text(page) == PAGES[page]


def test_pages_reach_the_parser_a_few_at_a_time(spark):
    from weakspot.operators import html

    page = '<div id="Description">first <b>part</b>. second</div>'
    rows = [(i, page if i % 3 else None if i % 2 else "<p>none</p>") for i in range(200)]
    made = html.describe_pages(spark.createDataFrame(rows, "page_id long, html string").coalesce(1), "page_id", "html")
    assert "MapInArrow" in made._jdf.queryExecution().executedPlan().toString() and html.PAGES <= 64
    got = {r.page_id: (r.block, r.description) for r in made.collect()}
    assert got == {i: ("first part . second", "first part.") if i % 3 else (None, None) for i in range(200)}
