"""Literals that decide results and must not drift."""

# --- fixed values: text and identifiers -----------------------------------

# Characters str.strip() removes, in code point order.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Values read as missing when a single id column is cleaned (any letter case).
NULL_TOKENS_ANY_CASE = ["", "nan", "none", "null"]
# Values read as missing when several id columns are merged (exact spelling).
NULL_TOKENS_EXACT = ["", "nan", "NaN", "None", "none", "null"]
# Values read as missing when ids are imputed or descriptions cleaned (exact).
FILL_TOKENS = ["None", "nan", ""]
# Cells a CSV reader of the pandas family reads as missing.
CSV_NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

CWE_PATTERN = r"(?i)(CWE)[-_]?(\p{Nd}+)"
CWE_NUMBER_PATTERN = r"CWE-(\d+)"
CVE_STRICT_PATTERN = r"^(?i)CVE-(\d{4})-(\d+)$"
CVE_LOOSE_PATTERN = r"(?i)CVE-(\d{4})-(\d+)"
# Identifier of two or more characters, number, two-character comparison, or
# any other visible character; letters, digits and spaces as Unicode has them.
TOKEN_PATTERN = (
    r"[A-Za-z_][\p{L}\p{N}_]+|\p{Nd}+|==|!=|<=|>="
    r"|[^\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)

# The tokens of the pattern above that are longer than one character.
LONG_TOKEN_PATTERN = r"[A-Za-z_][\p{L}\p{N}_]++|\p{Nd}++|[=!<>]="

# --- fixed values: schema --------------------------------------------------

CORE_SCHEMA = (
    "row_id string, code string, label int, language string, dataset string, "
    "cve_id string, cwe_id string"
)
# Ids and languages the collections get when they bring none themselves.
PAIRED_DATASET = "megavul"
SINGLE_DATASET = "bigvul"
TARGETED_DATASET = "diversevul"
TREE_DATASET = "juliet"
UNKNOWN_LANGUAGE = "unknown"
TARGETED_LANGUAGE = "c/cpp"
TREE_LANGUAGES = {".c": "c", ".java": "java"}

CORE_COLUMNS = ["code", "label", "language", "dataset", "cve_id", "cwe_id"]
IMPUTE_COLUMNS = [
    "code", "label", "language", "dataset", "code_len", "code_lines",
    "cve_year", "year_count", "code_dup_count", "code_year_dup_count",
    "cve_id", "cwe_id",
]
NUMERIC_FEATURES = [
    "code_token_count", "cve_number", "code_len", "code_lines", "cve_year",
    "year_count", "code_dup_count", "code_year_dup_count",
]
ONE_HOT_COLUMNS = ["language", "dataset", "cwe_id_slim"]

# --- fixed values: imputation and lookups ----------------------------------

ID_FILL = {"cve_id": "CVE-UNKNOWN", "cwe_id": "CWE-NONE"}
TEXT_FILL = {"language": "UNKNOWN", "dataset": "UNKNOWN"}
NUMERIC_FILL_COLUMNS = [
    "code_len", "code_lines", "cve_year", "year_count", "code_dup_count",
    "code_year_dup_count",
]
NUMERIC_FILL = -1.0
MAX_NULL_RATIO = 0.25
CWE_MIN_COUNT = 50
RARE_CATEGORY = "CWE_OTHER"
OTHER_IDS = ["CWE-Other", "CWE-OTHER"]
OTHER_DESCRIPTION = "Rare or uncommon weakness, grouped for statistical purposes."
NO_DESCRIPTION = "[ERROR/NONE] - Description not found."
DISPLAY_CHARS = 120

# --- fixed values: sampling, splits, models --------------------------------

SAMPLE_ROWS = 50_000
GROUP_TEST_SHARE = 0.2
SAMPLE_SEED = 42
SPLIT_SEED = 222
SMOTE_NEIGHBOURS = 5
COEFFICIENT_FLOOR = 1e-5
EMBEDDING_DIM = 768
MAX_TOKENS = 256
BATCH_ROWS = 32
