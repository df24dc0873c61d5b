"""Registered queries: sources, cleaning, profiling, enrichment, imputation."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weakspot import constants as C
from weakspot.functions import text as X
from weakspot.operators import clean, enrich, html, profile
from weakspot.plans import dataset as flow
from weakspot.plans.code_view import (
    CVE_RAW, CWE_RAW, VIEW, VIEW_ENRICHED, VIEW_IDS, VIEW_SQL, IDS_SQL, code_view, cve_part_sql, cwe_sql, clean_id_sql,
    strip_sql, with_ids, with_sql,
)
from weakspot.plans.registry import query, table
from weakspot.session import qualified, scratch_path
from weakspot.sources import collections, tables, tree


# --- cleaning ---------------------------------------------------------------

@query(VIEW + f"""SELECT row_id, {strip_sql('code')} AS code, label FROM v
WHERE label IS NOT NULL AND {strip_sql('code')} <> ''""")
def clean_code(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_code(code_view(spark, sf).select("row_id", "code", "label"))


@query(VIEW + f"""SELECT dataset, count(*) AS rows_before,
  count(*) FILTER (label IS NOT NULL AND {strip_sql('code')} <> '') AS rows_after,
  count(*) FILTER (NOT (label IS NOT NULL AND {strip_sql('code')} <> '')) AS rows_dropped FROM v GROUP BY dataset""")
def row_counts(spark, sf):
    kept = F.col("label").isNotNull() & X.not_blank("code")
    return code_view(spark, sf).groupBy("dataset").agg(
        F.count(F.lit(1)).alias("rows_before"), F.count_if(kept).alias("rows_after"),
        F.count_if(~kept).alias("rows_dropped"))


@query(VIEW + "SELECT row_id, code, language, dataset, n_chars, cve_raw, cwe_raw, num_raw FROM v")
def drop_sparse(spark, sf):
    rows = code_view(spark, sf).select(
        "row_id", "code", "label", "language", "dataset", "n_chars", "cve_raw", "cve_alt", "cwe_raw", "num_raw")
    return clean.drop_sparse(rows, protect=["row_id", "code"])


# --- identifiers ------------------------------------------------------------

@query(VIEW_ENRICHED + rf"""SELECT row_id, cast(code_len AS INTEGER) AS code_len,
  cast(code_lines AS INTEGER) AS code_lines, cve_year, cve_number, try_cast(nullif(regexp_extract(cve_id, '(?i)CVE-(\d{{4}})-(\d+)', 2), '') AS DOUBLE) AS cve_number_loose,
  lower({strip_sql('language')}) AS language FROM enriched""")
def cve_features(spark, sf):
    return enrich.code_features(with_ids(code_view(spark, sf, label=False))).select(
        "row_id", "code_len", "code_lines", "cve_year", "cve_number",
        X.cve_number_anywhere("cve_id").alias("cve_number_loose"), X.strip_lower("language").alias("language"))


@query(VIEW_IDS + "SELECT row_id, cve_raw, cwe_raw, cve_id, cwe_id FROM ids")
def unify_ids_single(spark, sf):
    return collections.unify_ids(code_view(spark, sf, label=False).select("row_id", "cve_raw", "cwe_raw"))


_CWE_FIRST = f"coalesce({clean_id_sql('cwe_alt', False)}, {clean_id_sql('cwe_raw', False)})"


@query(with_sql(VIEW_SQL, "w AS (SELECT row_id, cve_alt, cve_raw, CASE WHEN row_id % 17 = 0 THEN 'null' "
                "WHEN row_id % 19 = 0 THEN 'NULL' END AS cwe_alt, cwe_raw FROM v)") + f"""
SELECT row_id, coalesce({clean_id_sql('cve_alt', False)}, {clean_id_sql('cve_raw', False)}) AS cve_id,
  coalesce({cwe_sql(_CWE_FIRST)}, {_CWE_FIRST}) AS cwe_id FROM w""")
def unify_ids_multi(spark, sf):
    alt = F.when(F.col("row_id") % 17 == 0, "null").when(F.col("row_id") % 19 == 0, "NULL")
    rows = code_view(spark, sf, label=False).select("row_id", "cve_alt", "cve_raw", alt.alias("cwe_alt"), "cwe_raw")
    return collections.unify_ids(rows).select("row_id", "cve_id", "cwe_id")


@query(VIEW + f"SELECT row_id, {cwe_sql('cwe_raw')} AS cwe FROM v")
def cwe_extract(spark, sf):
    return code_view(spark, sf, label=False).select("row_id", X.extract_cwe("cwe_raw").alias("cwe"))


# --- sources ----------------------------------------------------------------

def _turn_pairs(spark, sf) -> DataFrame:
    turns = table(spark, sf, "conversations")
    asked = turns.filter("role = 'user'").select("conv_id", F.col("turn") + 1, F.col("text").alias("vulnerable_code"))
    answered = turns.filter("role = 'assistant'").select("conv_id", "turn", F.col("text").alias("fixed_code"))
    return (asked.toDF("conv_id", "turn", "vulnerable_code").join(answered, ["conv_id", "turn"])
            .withColumn("id", F.concat_ws("-", "conv_id", "turn")))


_PAIRS = """pairs AS (SELECT a.conv_id || '-' || b.turn AS id, a.text AS vulnerable_code, b.text AS fixed_code
  FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND a.turn + 1 = b.turn
  WHERE a.role = 'user' AND b.role = 'assistant')"""
_EXPANDED = f"""expanded AS (SELECT 'megavul:' || id || ':1' AS row_id, vulnerable_code AS code, 1 AS label FROM pairs
  UNION ALL SELECT 'megavul:' || id || ':0', fixed_code, 0 FROM pairs),
  paired AS (SELECT *, 'unknown' AS language, 'megavul' AS dataset FROM expanded WHERE {strip_sql('code')} <> '')"""


@query(with_sql(_PAIRS, _EXPANDED) + "SELECT row_id, code, label, language, dataset FROM paired")
def expand_pairs(spark, sf):
    pairs = _turn_pairs(spark, sf).select("id", "vulnerable_code", "fixed_code")
    return collections.load_paired(pairs, id_column="id").select("row_id", "code", "label", "language", "dataset")


def _single(spark, sf) -> DataFrame:
    return code_view(spark, sf).select(
        F.col("row_id").alias("id"), F.col("code").alias("func_before"), F.lit("").alias("func_after"),
        F.coalesce("label", F.lit(0)).alias("vul"), F.upper("language").alias("lang"), "cve_raw", "cwe_raw", "n_chars")


def _targeted(spark, sf) -> DataFrame:
    return table(spark, sf, "pages").select(
        F.col("page_id").alias("id"), F.col("html").alias("func"), (F.col("page_id") % 2).alias("target"),
        F.concat(F.lit("size "), F.length("html").cast("string")).alias("n_chars"),
        F.expr(CWE_RAW.replace("doc_id", "page_id")).alias("cwe_name"))


_SINGLE = f"""single AS (SELECT 'bigvul:' || row_id AS row_id, code, coalesce(label, 0) AS label, language,
  'bigvul' AS dataset, cve_id, cwe_id, cast(n_chars AS string) AS n_chars FROM ids WHERE {strip_sql('code')} <> '')"""
_TARGETED = f"""named AS (SELECT *, {CWE_RAW.replace('doc_id', 'page_id')} AS cwe_name FROM pages),
  targeted AS (SELECT 'diversevul:' || page_id AS row_id, html AS code, cast(page_id % 2 AS INTEGER) AS label,
  'c/cpp' AS language, 'diversevul' AS dataset, NULL AS cve_id,
  coalesce({cwe_sql(clean_id_sql('cwe_name', True))}, {clean_id_sql('cwe_name', True)}) AS cwe_id,
  'size ' || length(html) AS n_chars FROM named WHERE {strip_sql('html')} <> '')"""
_UNION_COLUMNS = "row_id, code, label, language, dataset, cve_id, cwe_id, n_chars"
_UNION = f"""SELECT {_UNION_COLUMNS} FROM single
  UNION ALL SELECT row_id, code, label, language, dataset, NULL, NULL, NULL FROM paired"""
_UNION_LIST = [c.strip() for c in _UNION_COLUMNS.split(",")]


@query(with_sql(VIEW_SQL, IDS_SQL, _SINGLE, _TARGETED, _PAIRS, _EXPANDED)
       + _UNION + f" UNION ALL SELECT {_UNION_COLUMNS} FROM targeted")
def union_sources(spark, sf):
    return flow.build(_turn_pairs(spark, sf).select("id", "vulnerable_code", "fixed_code"), _single(spark, sf),
                      _targeted(spark, sf), id_column="id").select(*_UNION_LIST)


@query(with_sql(VIEW_SQL, IDS_SQL, _SINGLE, _PAIRS, _EXPANDED)
       + _UNION.replace("cwe_id, n_chars FROM single", "cwe_id, cast(n_chars AS BIGINT) AS n_chars FROM single"))
def optional_source(spark, sf):
    absent = tables.read_optional(spark, f"{sf}/no_such_collection", ["func", "target"], "train")
    other_shape = tables.read_optional(spark, f"{sf}/documents.parquet", ["func", "target"])
    nowhere = tree.scan_tree(spark, f"{sf}/no_such_folder")
    return collections.combine([
        collections.load_paired(_turn_pairs(spark, sf).select("id", "vulnerable_code", "fixed_code"), id_column="id"),
        collections.load_single(_single(spark, sf), id_column="id"),
        collections.load_targeted(absent), collections.load_targeted(other_shape), nowhere,
    ]).select(*_UNION_LIST)


_NAME = """concat(url, '_', CASE page_id % 4 WHEN 0 THEN 'goodB2G' WHEN 1 THEN 'x_BAD' WHEN 2 THEN 'goodBad' ELSE 'main' END,
  CASE WHEN page_id % 3 = 0 THEN '.c' ELSE '.java' END)"""


@query(f"""SELECT * FROM (SELECT page_id, CASE WHEN contains(lower({_NAME}), 'bad') THEN 1
  WHEN contains(lower({_NAME}), 'good') THEN 0 END AS label,
  CASE WHEN page_id % 3 = 0 THEN 'c' ELSE 'java' END AS language FROM pages) WHERE label IS NOT NULL""")
def label_from_name(spark, sf):
    named = table(spark, sf, "pages").select("page_id", F.expr(_NAME).alias("name"))
    return named.select("page_id", X.label_from_name("name").alias("label"),
                        X.language_from_name("name", C.TREE_LANGUAGES).alias("language")).filter(F.col("label").isNotNull())


_FILE = """concat('CWE', cast(doc_id % 40 AS string), '_', CASE doc_id % 3 WHEN 0 THEN 'bad' WHEN 1 THEN 'Good' ELSE 'main' END,
  '_', cast(doc_id AS string), CASE WHEN doc_id % 2 = 0 THEN '.c' ELSE '.java' END)"""


def export_files(df: DataFrame, root: str, name: str, text: str) -> int:
    """Write each text to a file of its own below ``root``, from the tasks.

    A rerun task writes the same names again, so retries do no harm.
    """
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(root)
        for batch in batches:
            for folder in {f"d{hash_of % 16}" for hash_of in map(len, batch[text])}:
                system.create_dir(f"{base}/{folder}", recursive=True)
            for file, content in zip(batch[name], batch[text]):
                with system.open_output_stream(f"{base}/d{len(content) % 16}/{file}") as out:
                    out.write(content.encode())
            yield pd.DataFrame({"n": [len(batch)]})

    return df.select(name, text).mapInPandas(write, "n bigint").agg(F.sum("n")).first()[0]


@query(f"""SELECT {_FILE} AS name, text AS code, CASE doc_id % 3 WHEN 0 THEN 1 ELSE 0 END AS label,
  CASE WHEN doc_id % 2 = 0 THEN 'c' ELSE 'java' END AS language, 'juliet' AS dataset,
  'CWE-' || cast(doc_id % 40 AS string) AS cwe_id FROM documents WHERE doc_id % 3 <> 2 AND {strip_sql('text')} <> ''""")
def scan_tree(spark, sf):
    root = qualified(spark, scratch_path(spark, "tree"))
    export_files(table(spark, sf, "documents").select(F.expr(_FILE).alias("name"), "text"), root, "name", "text")
    return tree.scan_tree(spark, root).select(
        F.element_at(F.split("row_id", "/"), -1).alias("name"), "code", "label", "language", "dataset", "cwe_id")


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def roundtrip_csv(spark, sf):
    rows, path = table(spark, sf, "documents"), scratch_path(spark, "csv")
    tables.write_csv(rows, path)
    return tables.read_csv(spark, path, rows.schema)


@query(VIEW + "SELECT row_id, code, label, language FROM v")
def roundtrip_parquet(spark, sf):
    path = scratch_path(spark, "parquet")
    tables.write_parquet(code_view(spark, sf), path, by=["dataset"])
    return tables.read_parquet(spark, path, ["row_id", "code", "label", "language"])


@query(VIEW + "SELECT row_id, language, nullif(num_raw, 'n/a') AS num_raw, n_chars FROM v")
def csv_to_parquet(spark, sf):
    """A cell ``n/a`` is missing after the way through CSV."""
    rows = code_view(spark, sf, label=False).select("row_id", "language", "num_raw", "n_chars", "code")
    csv, parquet = scratch_path(spark, "csv"), scratch_path(spark, "parquet")
    tables.write_csv(rows, csv)
    return tables.csv_to_parquet(spark, csv, parquet, rows.schema).select("row_id", "language", "num_raw", "n_chars")


@query("SELECT doc_id, source, n_chars FROM documents WHERE lang = 'en'")
def named_split(spark, sf):
    """One split of a staged collection, here by language."""
    path = scratch_path(spark, "collection")
    tables.write_parquet(table(spark, sf, "documents").select("doc_id", "source", "n_chars", F.col("lang").alias("split")), path, by=["split"])
    return tables.read_split(spark, path, "en")


# --- counts and profiles ----------------------------------------------------

@query("SELECT lang AS language, count(*) AS count FROM documents WHERE lang IS NOT NULL GROUP BY lang")
def value_counts_lang(spark, sf):
    return profile.value_counts(code_view(spark, sf, label=False), "language")


@query(VIEW + "SELECT label, count(*) AS count FROM v GROUP BY label")
def value_counts_nulls(spark, sf):
    return profile.value_counts(code_view(spark, sf), "label", keep_null=True)


@query(VIEW_IDS + "SELECT cwe_id, count(*) AS count FROM ids GROUP BY cwe_id ORDER BY count DESC, cwe_id NULLS FIRST LIMIT 10")
def top_values(spark, sf):
    return profile.top_values(with_ids(code_view(spark, sf, label=False)), "cwe_id", 10)


@query(VIEW_IDS + "SELECT DISTINCT cwe_id FROM ids WHERE cwe_id IS NOT NULL")
def distinct_cwes(spark, sf):
    return profile.distinct_sorted(with_ids(code_view(spark, sf, label=False)), "cwe_id")


_PROFILED = {"code": "string", "label": "int", "language": "string", "dataset": "string", "cve_raw": "string",
             "cve_alt": "string", "cwe_raw": "string", "num_raw": "string", "score_a": "double"}


@query(VIEW + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS null_count, "
    f"round(100.0 * count(*) FILTER ({c} IS NULL) / count(*), 6) AS null_percent FROM v" for c in _PROFILED))
def null_summary(spark, sf):
    return profile.null_summary(code_view(spark, sf).select(*_PROFILED)).withColumn(
        "null_percent", F.round("null_percent", 6))


def _profile_sql(column: str, dtype: str, x: str) -> str:
    return (f"SELECT '{column}' AS \"column\", '{dtype}' AS dtype, count(DISTINCT {x}) AS unique_count, "
            f"count(*) FILTER ({x} IS NULL) AS null_count, count({x}) AS non_null_count, "
            f"cast(round_even(100.0::DOUBLE * count(*) FILTER ({x} IS NULL) / count(*), 2) AS VARCHAR) || '%' AS null_percentage FROM v")


@query(VIEW + " UNION ALL ".join(_profile_sql(c, t, c) for c, t in _PROFILED.items()))
def column_profile(spark, sf):
    return profile.column_profile(code_view(spark, sf).select(*_PROFILED))


@query(VIEW + f"SELECT * FROM ({' UNION ALL '.join(_profile_sql(c, t, c) for c, t in _PROFILED.items())}) WHERE null_count > 0")
def null_report(spark, sf):
    return profile.with_nulls_only(profile.column_profile(code_view(spark, sf).select(*_PROFILED)))


@query(VIEW + "SELECT count(*) AS rows, 13 AS columns FROM v")
def table_shape(spark, sf):
    return profile.table_shape(code_view(spark, sf, label=False))


@query(VIEW + "SELECT row_id, language, cve_raw FROM v ORDER BY row_id LIMIT 5")
def first_rows(spark, sf):
    return profile.first_rows(code_view(spark, sf, label=False).select("row_id", "language", "cve_raw"), "row_id")


_CLEANED = f"CASE WHEN {strip_sql('cve_raw')} NOT IN ('None', 'nan', '') THEN {strip_sql('cve_raw')} END"


@query(VIEW + f"""SELECT 'cve_raw' AS "column", count(DISTINCT {_CLEANED}) AS unique_count,
  count(*) - count({_CLEANED}) AS null_count,
  cast(round_even(100.0::DOUBLE * (count(*) - count({_CLEANED})) / count(*), 2) AS VARCHAR) || '%' AS null_percentage FROM v""")
def text_profile(spark, sf):
    return profile.text_profile(code_view(spark, sf, label=False), "cve_raw")


# --- enrichment -------------------------------------------------------------

@query(VIEW_ENRICHED + "SELECT row_id, year_count, code_dup_count, code_year_dup_count FROM enriched")
def dup_counts(spark, sf):
    rows = with_ids(code_view(spark, sf, label=False)).select("row_id", "code", "cve_id")
    return enrich.duplicate_counts(enrich.code_features(rows)).select(
        "row_id", "year_count", "code_dup_count", "code_year_dup_count")


def dimension(spark, sf) -> DataFrame:
    """Descriptions of the ids below 25 that the table holds."""
    number = X.cwe_number("cwe_id").try_cast("int")
    return (with_ids(code_view(spark, sf, label=False)).select("cwe_id", number.alias("n")).filter("n < 25").distinct()
            .select("cwe_id", F.concat(F.lit("Weakness "), F.col("n").cast("string"), F.lit(".")).alias("description")))


_DIMENSION = r"""dim0 AS (SELECT DISTINCT cwe_id, 'Weakness ' || try_cast(regexp_extract(cwe_id, 'CWE-(\d+)', 1) AS INTEGER) || '.' AS description
  FROM ids WHERE try_cast(nullif(regexp_extract(cwe_id, 'CWE-(\d+)', 1), '') AS INTEGER) < 25),
  dim AS (SELECT * FROM dim0 UNION ALL SELECT unnest(['CWE-Other', 'CWE-OTHER']), 'Rare or uncommon weakness, grouped for statistical purposes.')"""


@query(with_sql(VIEW_SQL, IDS_SQL, _DIMENSION) + """SELECT row_id, cwe_id, description AS cwe_description,
  left(coalesce(description, '[ERROR/NONE] - Description not found.'), 120) AS shown FROM ids LEFT JOIN dim USING (cwe_id)""")
def cwe_lookup(spark, sf):
    rows = with_ids(code_view(spark, sf, label=False)).select("row_id", "cwe_id")
    return enrich.describe(rows, dimension(spark, sf)).select(
        "row_id", "cwe_id", "cwe_description", X.display_description("cwe_description").alias("shown"))


@query(with_sql(VIEW_SQL, IDS_SQL, _DIMENSION) + """SELECT DISTINCT cwe_id FROM ids
  WHERE cwe_id IS NOT NULL AND cwe_id NOT IN (SELECT cwe_id FROM dim)""")
def cwe_missing(spark, sf):
    return enrich.missing_ids(with_ids(code_view(spark, sf, label=False)), dimension(spark, sf))


def _description_pages(spark, sf) -> DataFrame:
    """The given pages with their article as a description block."""
    page = F.replace(F.replace("html", F.lit("<article>"), F.lit('<div id="Description">')), F.lit("</article>"), F.lit("</div>"))
    return table(spark, sf, "pages").select("page_id", page.alias("html"))


# flat form: the block has no inner div; text nodes are stripped, joined by one space
_BLOCK = rf"""blocks AS (SELECT page_id, list_aggregate(list_filter(list_transform(
    regexp_split_to_array(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '<[^>]*>'),
    lambda x: {strip_sql("regexp_replace(replace(x, '&quot;', chr(34)), '&amp;?', '&', 'g')")}), lambda x: x <> ''), 'string_agg', ' ') AS block FROM pages),
  described AS (SELECT page_id, block, CASE WHEN {strip_sql("split_part(block, '.', 1)")} <> ''
    THEN {strip_sql("split_part(block, '.', 1)")} || '.' END AS description FROM blocks)"""


@query(with_sql(_BLOCK) + "SELECT page_id, block, description FROM described")
def html_description(spark, sf):
    return html.describe_pages(_description_pages(spark, sf), "page_id", "html")


@query(with_sql(_BLOCK) + "SELECT page_id, block, description FROM described")
def html_heading(spark, sf):
    """The same blocks, nested, next to a heading that names a description."""
    opened = F.replace("html", F.lit("<article>"), F.lit("<section><h2>Extended description</h2><p>first</p><div><div><div>"))
    page = F.replace(opened, F.lit("</article>"), F.lit("</div></div></div><div>second</div></section>"))
    return html.describe_pages(table(spark, sf, "pages").select("page_id", page.alias("html")), "page_id", "html")


@query(with_sql(VIEW_SQL, IDS_SQL, _DIMENSION, _BLOCK) + """, wanted AS (SELECT DISTINCT cwe_id FROM ids
    WHERE cwe_id IS NOT NULL AND cwe_id NOT IN (SELECT cwe_id FROM dim)),
  keyed AS (SELECT 'CWE-' || page_id AS cwe_id, description FROM described)
SELECT cwe_id, description FROM dim0 UNION ALL SELECT cwe_id, description FROM wanted LEFT JOIN keyed USING (cwe_id)""")
def dimension_update(spark, sf):
    path = scratch_path(spark, "dimension")
    tables.write_parquet(dimension(spark, sf), path)
    pages = _description_pages(spark, sf).select(
        F.concat(F.lit("CWE-"), F.col("page_id").cast("string")).alias("cwe_id"), "html")
    return enrich.extend_dimension(spark, path, with_ids(code_view(spark, sf, label=False)), pages)


# --- imputation and the whole flow ------------------------------------------

_IMPUTED = f"""SELECT row_id, norm AS code, label, language, dataset,
  coalesce(try_cast(num_raw AS DOUBLE), -1.0) AS code_len, cast(code_lines AS DOUBLE) AS code_lines,
  coalesce(cast(cve_year AS DOUBLE), -1.0) AS cve_year, coalesce(cast(year_count AS DOUBLE), -1.0) AS year_count,
  cast(code_dup_count AS DOUBLE) AS code_dup_count, coalesce(cast(code_year_dup_count AS DOUBLE), -1.0) AS code_year_dup_count,
  coalesce(cve_id, 'CVE-UNKNOWN') AS cve_id, coalesce(cwe_id, 'CWE-NONE') AS cwe_id FROM enriched
  WHERE label IS NOT NULL AND norm <> ''"""


@query(VIEW_ENRICHED + _IMPUTED)
def impute(spark, sf):
    rows = enrich.duplicate_counts(enrich.code_features(with_ids(code_view(spark, sf))))
    return clean.impute(rows.withColumn("code_len", F.col("num_raw")))


@query(VIEW_ENRICHED.replace("FROM documents LEFT JOIN", "FROM documents JOIN")
       + _IMPUTED.replace("coalesce(try_cast(num_raw AS DOUBLE), -1.0)", "cast(code_len AS DOUBLE)"))
def prepared_table(spark, sf):
    """Clean, drop sparse columns, describe, enrich, impute."""
    rows = with_ids(code_view(spark, sf).filter(F.col("label").isNotNull()))
    return flow.prepare(rows, dimension(spark, sf))


@query(VIEW_ENRICHED + """SELECT language, count(*) AS n_rows, cast(sum(code_len) AS BIGINT) AS chars,
  cast(sum(code_lines) AS BIGINT) AS lines, count(cve_year) AS with_cve,
  count(*) FILTER (code_dup_count > 1) AS duplicated, max(code_dup_count) AS largest_group,
  cast(sum(code_year_dup_count) AS BIGINT) AS same_year FROM enriched GROUP BY language""")
def language_summary(spark, sf):
    """Sizes, ids and duplicates of the code table by language."""
    rows = with_ids(code_view(spark, sf, label=False)).select("row_id", "code", "language", "cve_id")
    return enrich.duplicate_counts(enrich.code_features(rows).drop("code")).groupBy("language").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("code_len").alias("chars"), F.sum("code_lines").alias("lines"),
        F.count("cve_year").alias("with_cve"), F.count_if(F.col("code_dup_count") > 1).alias("duplicated"),
        F.max("code_dup_count").alias("largest_group"), F.sum("code_year_dup_count").alias("same_year"))
