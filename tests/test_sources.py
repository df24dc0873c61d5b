import pytest
from pyspark.sql import functions as F

from weakspot.operators import clean, enrich, profile
from weakspot.plans import dataset as flow
from weakspot.sources import collections, tables, tree


def test_scan_tree(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    files = {"a/CWE121_x_bad.c": b"int x;\r\ny\xff", "a/b/Good.java": b"class", "a/main.c": b"no", "a/bad.cpp": b"no",
             "a/b/good_empty.c": b" \n", "BAD.c": b"z"}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    rows = {r.row_id.split("/")[-1]: r for r in tree.scan_tree(spark, f"file://{tmp_path}").collect()}
    assert set(rows) == {"CWE121_x_bad.c", "Good.java", "BAD.c"}
    first = rows["CWE121_x_bad.c"]
    assert (first.code, first.label, first.language, first.cwe_id, first.cve_id) == ("int x;\ny", 1, "c", "CWE-121", None)
    assert rows["Good.java"].label == 0 and rows["Good.java"].language == "java"


def test_absent_sources(spark, tmp_path):
    assert tree.scan_tree(spark, str(tmp_path / "none")).count() == 0
    assert tables.read_optional(spark, str(tmp_path / "none"), ["func"]) is None
    spark.range(1).write.parquet(str(tmp_path / "other"))
    assert tables.read_optional(spark, str(tmp_path / "other"), ["func"]) is None
    with pytest.raises(ValueError, match="func"):
        tables.require_columns(spark.range(1), ["func"])


def test_split_folders_and_stable_ids(spark, tmp_path):
    pairs = spark.createDataFrame([("a", "b"), ("c", " ")], "vulnerable_code string, fixed_code string")
    pairs.coalesce(1).write.parquet(str(tmp_path / "set" / "split=train"))
    loaded = collections.load_paired(tables.read_split(spark, str(tmp_path / "set")))
    first = {r.row_id: r.code for r in loaded.collect()}
    assert sorted(first.values()) == ["a", "b", "c"] and len(first) == 3
    assert first == {r.row_id: r.code for r in loaded.repartition(3).collect()}


def test_csv_round_trip(spark, tmp_path):
    rows = [(1, 'a "q" \\ b\nc,\r\nd', None), (2, "None", "x"), (3, "'", " y ")]
    df = spark.createDataFrame(rows, "i int, code string, note string")
    tables.write_csv(df, str(tmp_path / "csv"))
    back = {r.i: r for r in tables.read_csv(spark, str(tmp_path / "csv"), df.schema).collect()}
    assert back[1].code == rows[0][1] and back[1].note is None
    assert back[2].code is None and back[2].note == "x" and back[3].note == " y "
    plain = {r.i: r for r in tables.read_csv(spark, str(tmp_path / "csv"), df.schema, na_tokens=None).collect()}
    assert plain[2].code == "None"


def test_union_of_clashing_types(spark):
    a = spark.createDataFrame([(1, 5)], "row_id int, extra int")
    b = spark.createDataFrame([(2, "x")], "row_id int, extra string")
    c = spark.createDataFrame([(3,)], "row_id bigint")
    rows = {r.row_id: r.extra for r in collections.union_sources([a, None, b, c]).collect()}
    assert rows == {1: "5", 2: "x", 3: None}


def test_unify_ids_overwrites_and_keeps(spark):
    df = spark.createDataFrame([("None", "cve-1", " CWE_7 ", "k")], "CVE_A string, cve_id string, CweX string, other string")
    row = collections.unify_ids(df).first()
    assert (row.CVE_A, row.cve_id, row.cwe_id, row.other) == ("None", "cve-1", "CWE-7", "k")


def test_null_years_have_no_counts(spark):
    rows = [(1, "x", None), (2, "x", "bogus"), (3, "x ", "CVE-2001-1"), (4, "y", "CVE-2001-2"), (5, "x", "CVE-2002-1")]
    df = spark.createDataFrame(rows, "row_id int, code string, cve_id string")
    found = {r.row_id: (r.year_count, r.code_dup_count, r.code_year_dup_count)
             for r in enrich.duplicate_counts(enrich.code_features(df)).collect()}
    assert found == {1: (None, 4, None), 2: (None, 4, None), 3: (2, 4, 1), 4: (2, 1, 1), 5: (1, 4, 1)}


def test_describe_keeps_known_text(spark):
    df = spark.createDataFrame([(1, "CWE-1"), (2, "CWE-Other"), (3, None), (4, "cwe-1"), (5, "CWE-2")], "row_id int, cwe_id string")
    dim = spark.createDataFrame([("CWE-1", "One."), ("CWE-2", " None ")], "cwe_id string, description string")
    found = {r.row_id: r.cwe_description for r in enrich.describe(df, dim).collect()}
    assert found[1] == "One." and found[2].startswith("Rare") and found[3] is None and found[4] is None and found[5] is None
    with pytest.raises(ValueError):
        enrich.describe(df.drop("cwe_id"), dim)


def test_dimension_refresh(spark, tmp_path):
    df = spark.createDataFrame([("CWE-1",), ("CWE-2",)], "cwe_id string")
    pages = spark.createDataFrame([("CWE-1", "<div id='Description'>One. Two</div>")], "cwe_id string, html string")
    path = str(tmp_path / "dim")
    first = {r.cwe_id: r.description for r in enrich.extend_dimension(spark, path, df, pages).collect()}
    assert first == {"CWE-1": "One.", "CWE-2": None}
    again = enrich.extend_dimension(spark, path, df, pages)
    assert again.count() == 2
    assert enrich.extend_dimension(spark, path, df.limit(1), pages, refresh=True).count() == 1


def test_profile_and_sparse(spark):
    df = spark.createDataFrame([(1.0, None, "a"), (float("nan"), "x", "a"), (2.0, None, "b"), (2.0, None, "b")],
                               "n double, s string, t string")
    rows = {r.column: r for r in profile.column_profile(df).collect()}
    assert (rows["n"].unique_count, rows["n"].null_count, rows["n"].null_percentage) == (2, 1, "25.0%")
    assert (rows["s"].unique_count, rows["s"].null_count, rows["s"].dtype) == (1, 3, "string")
    assert {r.column: r.unique_count for r in profile.column_profile(df, approximate=True).collect()} == {"n": 2, "s": 1, "t": 2}
    # a quarter is not more than a quarter
    assert clean.drop_sparse(df, protect=[]).columns == ["n", "t"]
    assert clean.drop_sparse(df, protect=["s"]).columns == ["n", "s", "t"]
    assert [r.column for r in profile.null_summary(df).collect()] == ["s", "n", "t"]


def test_observed_counts(spark):
    df, before = clean.counted(spark.range(10), "before")
    df, after = clean.counted(df.filter("id > 3"), "after")
    df.write.format("noop").mode("overwrite").save()
    assert (before.get["rows"], after.get["rows"]) == (10, 6)


def test_whole_flow(spark):
    paired = spark.createDataFrame([(1, "a\nb", "c", "C", "CVE-2001-1")],
                                   "id int, vulnerable_code string, fixed_code string, language string, cve string")
    single = spark.createDataFrame([(1, "a\nb", "f", "1", "C", "CWE79"), (2, " ", "f", "0", "C", None)],
                                   "id int, func_before string, func_after string, vul string, lang string, cwe string")
    dim = spark.createDataFrame([("CWE-79", "x.")], "cwe_id string, description string")
    table = flow.build(paired, single, id_column="id")
    assert table.count() == 3
    rows = {r.row_id: r for r in flow.prepare(table, dim).collect()}
    assert rows["megavul:1:1"].code_dup_count == 2.0 and rows["megavul:1:1"].cve_id == "CVE-2001-1"
    assert rows["bigvul:1"].cve_id == "CVE-UNKNOWN" and rows["bigvul:1"].year_count == -1.0
    assert all(v is not None for r in rows.values() for v in r)
    lean = flow.prepare_features(table)
    shared = [c for c in lean.columns if c != "code_token_count"]
    assert {tuple(r) for r in lean.select(shared).collect()} == {tuple(r) for r in flow.prepare(table, dim).select(shared).collect()}
    assert flow.split_features(lean, min_count=1)[1] == flow.split_features(flow.prepare(table, dim), min_count=1)[1]
    parts, names = flow.split_features(flow.prepare(table, dim), min_count=1)
    assert parts.count() == 3 and "language_c" in names and names[-1] == "code_year_dup_count"


def test_bucketed_tables_join_without_shuffle(spark):
    tables.write_bucketed(spark.range(100).withColumn("x", F.rand(1)), "bucketed_a", "id", 4)
    tables.write_bucketed(spark.range(100).withColumn("y", F.rand(2)), "bucketed_b", "id", 4)
    joined = spark.table("bucketed_a").hint("merge").join(spark.table("bucketed_b"), "id")
    assert joined.count() == 100
    assert "Exchange hashpartitioning" not in joined._jdf.queryExecution().executedPlan().toString()
