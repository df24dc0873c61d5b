"""The registered queries of this subpackage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weakspot.llm import bpe, counts, hmm, jaccard, labelled, lattice, mincut, packing, pii, quality, runs, topk, toxicity, variants
from weakspot.plans.registry import query, table


@query()
def op1_hmm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probabilities of every document; rows with remainder 2 of 7 are held out."""
    return hmm.score(table(spark, sf_dir, "documents"), labelled.fold("doc_id", 7) == 2)


@query()
def op2_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document, by anchor expansion."""
    return pii.digest_spans(table(spark, sf_dir, "documents"))


@query()
def op3_mincut_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page by minimum cut."""
    return mincut.extract(table(spark, sf_dir, "pages"), ["page_id", "url"])


@query()
def op4_bpe_recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's byte-level BPE ids and of what they decode to."""
    return bpe.digest(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def _classified(spark: SparkSession, sf_dir: str, operator, parts: int, out: int) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = operator.fit(docs, table(spark, sf_dir, "labels"), labelled.fold("doc_id", parts) != out)
    scored = quality.score(docs, model)
    return scored.select("doc_id", (labelled.fold("doc_id", parts) == out).alias("held_out"), "score", "predicted")


@query()
def op5_quality_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; rows with remainder 1 of 3 are held out."""
    return _classified(spark, sf_dir, quality, 3, 1)


@query()
def op6_toxicity_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; rows with remainder 0 of 5 are held out."""
    return _classified(spark, sf_dir, toxicity, 5, 0)


@query()
def op7_jaccard_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 4-word shingles have a Jaccard similarity of 0.85 or more."""
    return jaccard.classes(table(spark, sf_dir, "documents"))


@query()
def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best rows of every vector whose id is divisible by 100."""
    found = topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
    return found.select("query_id", F.col("rank").cast("int"), "vec_id", "score")


@query()
def op9_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of vectors of one label with a cosine of 0.93 or more."""
    return lattice.near_duplicates(table(spark, sf_dir, "embeddings"))


@query()
def op10_pack_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 1,024 tokens by minimum bin slack."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                        public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


# crc32 by its table of 256 entries; letters are ASCII or two bytes beginning with 195
_VARIANTS_SQL = r"""WITH RECURSIVE crc_table AS (
    SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
    FROM (SELECT unnest(range(256))::BIGINT AS i)),
  found AS (SELECT coalesce(doc_id::VARCHAR, '') AS doc, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS w FROM documents)),
  counted AS (SELECT doc, w, count(*) AS n FROM found WHERE length(w) >= 7 GROUP BY doc, w),
  hashed AS (SELECT w, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc || ':' || w, ''),
      lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195::BIGINT, unicode(c)::BIGINT - 64] END))),
      lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]))) AS h FROM counted, crc_table),
  slipped AS (SELECT CASE WHEN h % 31 = 0 THEN substr(w, 1, (h % length(w))::BIGINT) || substr(w, (h % length(w))::BIGINT + 2) ELSE w END AS word, n FROM hashed),
  words AS (SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
  cut AS (SELECT word, n, p, substr(word, 1, p - 1) || substr(word, p + 1) AS v FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM words)),
  near AS (SELECT a.word AS a, a.n AS a_n, b.word AS b, b.n AS b_n FROM cut a JOIN cut b ON a.v = b.v AND a.p = b.p AND a.word <> b.word
    UNION SELECT cut.word, cut.n, words.word, words.n FROM cut JOIN words ON v = words.word
    UNION SELECT words.word, words.n, cut.word, cut.n FROM cut JOIN words ON v = words.word),
  best AS (SELECT a, a_n, count(*) AS n_near, first(b ORDER BY b_n DESC, b) AS b, max(b_n) AS b_n FROM near GROUP BY a, a_n),
  forms AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN b_n >= 10 * n THEN b END AS form,
    CASE WHEN b_n >= 10 * n THEN b_n END AS form_n FROM words LEFT JOIN best ON a = word),
  steps(word, place) AS (SELECT word, word FROM forms UNION ALL SELECT s.word, f.form FROM steps s JOIN forms f ON f.word = s.place AND f.form IS NOT NULL),
  ends AS (SELECT s.word, s.place AS root FROM steps s JOIN forms f ON f.word = s.place AND f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)"""


@query(_VARIANTS_SQL)
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their near words, form and root."""
    return variants.variants(variants.count_words(table(spark, sf_dir, "documents")))


@query()
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, with planted ends in a tenth of them."""
    return runs.digest_runs(table(spark, sf_dir, "documents"))


@query()
def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document, and whether it has more than 4,096 tokens."""
    counted = counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), ["doc_id"])
    return counted.withColumn("over_limit", F.col("n_tokens") > 4096)
