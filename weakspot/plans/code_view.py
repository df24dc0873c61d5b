"""Code table over the given tables, as a Spark view and as SQL.

The given tables hold no vulnerability ids; fixed expressions of the key
stand in for them. Their text is valid in Spark and in the oracle engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weakspot.constants import WHITESPACE
from weakspot.plans.registry import table

CVE_RAW = """CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 11 = 0 THEN ' None '
    WHEN doc_id % 13 = 0 THEN 'bogus'
    ELSE concat(' cve-', cast(2000 + doc_id % 20 AS string), '-', lpad(cast(doc_id % 137 AS string), 4, '0'), ' ') END"""
CVE_ALT = f"CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 5 = 0 THEN 'NULL' ELSE {CVE_RAW} END"
CWE_RAW = """CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 9 = 0 THEN 'NVD-CWE-noinfo'
    WHEN doc_id % 8 = 0 THEN 'CWE-Other' WHEN doc_id % 4 = 1 THEN concat('cwe', cast(doc_id % 40 AS string))
    WHEN doc_id % 4 = 2 THEN concat('CWE_', cast(doc_id % 40 AS string), '_Stack')
    ELSE concat('CWE-', cast(doc_id % 40 AS string)) END"""
COLUMNS = {
    "row_id": "doc_id",
    "code": "text",
    "label": "toxic",
    "language": "lang",
    "dataset": "source",
    "n_chars": "n_chars",
    "cve_raw": CVE_RAW,
    "cve_alt": CVE_ALT,
    "cwe_raw": CWE_RAW,
    "num_raw": "CASE WHEN doc_id % 6 = 0 THEN 'n/a' WHEN doc_id % 10 = 0 THEN NULL ELSE cast(n_chars AS string) END",
    "pred": "CASE WHEN n_chars > 1500 THEN 1 ELSE 0 END",
    "pred_b": "CASE WHEN n_chars > 900 THEN 1 ELSE 0 END",
    "score_a": "cast(doc_id % 101 AS double) / cast(100 AS double)",
    "score_b": "cast(doc_id * 37 % 101 AS double) / cast(100 AS double)",
}


def code_view(spark: SparkSession, sf_dir: str, label: bool = True) -> DataFrame:
    """The view; without ``label`` the documents are read and not joined."""
    rows = table(spark, sf_dir, "documents")
    if label:
        rows = rows.join(table(spark, sf_dir, "labels").select("doc_id", "toxic"), "doc_id", "left")
    return rows.select(*[F.expr(e).alias(n) for n, e in COLUMNS.items() if label or n != "label"])


def with_ids(df: DataFrame) -> DataFrame:
    """The view with unified ids from one candidate column each."""
    from weakspot.sources.collections import unify_ids

    return unify_ids(df, ["cve_raw"], ["cwe_raw"])


# --- the same in SQL --------------------------------------------------------

VIEW_SQL = "v AS (SELECT {} FROM documents LEFT JOIN labels USING (doc_id))".format(
    ", ".join(f"{e} AS {n}" for n, e in COLUMNS.items()))


def strip_sql(x: str) -> str:
    return f"trim({x}, '{WHITESPACE}')"


def clean_id_sql(x: str, any_case: bool) -> str:
    text = strip_sql(x)
    if any_case:
        return f"CASE WHEN lower({text}) NOT IN ('', 'nan', 'none', 'null') THEN {text} END"
    return f"CASE WHEN {text} NOT IN ('', 'nan', 'NaN', 'None', 'none', 'null') THEN {text} END"


def cwe_sql(x: str) -> str:
    return rf"'CWE-' || nullif(regexp_extract({x}, '(?i)(CWE)[-_]?(\p{{Nd}}+)', 2), '')"


def cve_part_sql(x: str, group: int, kind: str) -> str:
    return rf"try_cast(nullif(regexp_extract({strip_sql(x)}, '^(?i)CVE-(\d{{4}})-(\d+)$', {group}), '') AS {kind})"


IDS_SQL = f"""ids AS (SELECT *, {clean_id_sql('cve_raw', True)} AS cve_id,
    coalesce({cwe_sql(clean_id_sql('cwe_raw', True))}, {clean_id_sql('cwe_raw', True)}) AS cwe_id FROM v)"""
ENRICHED_SQL = f"""feat AS (SELECT *, {strip_sql('code')} AS norm,
    {cve_part_sql('cve_id', 1, 'INTEGER')} AS cve_year, {cve_part_sql('cve_id', 2, 'BIGINT')} AS cve_number FROM ids),
  enriched AS (SELECT *, length(norm) AS code_len, length(norm) - length(replace(norm, chr(10), '')) + 1 AS code_lines,
    CASE WHEN cve_year IS NOT NULL THEN count(*) OVER (PARTITION BY cve_year) END AS year_count,
    count(*) OVER (PARTITION BY norm) AS code_dup_count,
    CASE WHEN cve_year IS NOT NULL THEN count(*) OVER (PARTITION BY norm, cve_year) END AS code_year_dup_count
    FROM feat)"""
NUMBER_SQL = "('0x' || substr(md5({}), 1, 15))::BIGINT"


def with_sql(*ctes: str) -> str:
    return "WITH " + ",\n  ".join(ctes) + "\n"


VIEW = with_sql(VIEW_SQL)
VIEW_IDS = with_sql(VIEW_SQL, IDS_SQL)
VIEW_ENRICHED = with_sql(VIEW_SQL, IDS_SQL, ENRICHED_SQL)
