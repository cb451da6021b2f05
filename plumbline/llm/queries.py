"""The registered queries of the operators, and their twins in DuckDB's SQL where it can say them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import (
    alignment,
    decontaminate,
    hard_negatives,
    html_text,
    licenses,
    packing,
    quality,
    rule_ledger,
    simhash,
    token_counts,
    toxicity,
    url_rules,
    vector_links,
)
from plumbline.llm.common import remainder
from plumbline.session import ensure_checkpoint_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


def _judged(documents: DataFrame, scores: DataFrame, held_out: tuple[int, int], threshold: float) -> DataFrame:
    modulus, own = held_out
    return scores.select(
        "doc_id",
        (remainder(F.col("doc_id"), modulus) == own).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


@query
def op1_html_text(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page, and its length in code points; a null html has the empty text."""
    found = html_text.extract_text(_table(spark, folder, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


@query
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document by a model fitted on the labels outside the held-out remainder; null and empty texts score too."""
    documents = _table(spark, folder, "documents")
    model = toxicity.fit_toxicity(documents, _table(spark, folder, "labels"))
    scores = toxicity.score_toxicity(documents, model)
    return _judged(documents, scores, toxicity.HELD_OUT, toxicity.THRESHOLD)


@query
def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """All documents come in, those of low quality are taken out, toxic ones come (back) with digits masked."""
    documents, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    ledger = token_counts.TokenLedger(spark, f"{ensure_checkpoint_dir(spark)}/ledger-{uuid.uuid4().hex}").create()
    ledger.commit(1, token_counts.counted(documents))
    low = labels.where("quality = 0").select("doc_id").distinct()
    ledger.commit(2, token_counts.deleted(documents.select("doc_id").join(low, "doc_id", "left_semi")))
    masked = documents.withColumn("text", F.regexp_replace("text", "[0-9]+", "#"))
    toxic = labels.where("toxic = 1").select("doc_id").distinct()
    # Counted where the texts are read, then joined: a semi join would be moved below and shuffle the texts.
    revised = token_counts.counted(masked).join(toxic, "doc_id")
    for _ in range(2):  # delivered twice, counted once
        ledger.commit(3, revised)
    return ledger.totals()


ORACLES["op3_token_counts"] = f"""
WITH live AS (
  SELECT source, lang, doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS masked,
         CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)
              THEN regexp_replace(text, '[0-9]+', '#', 'g') ELSE text END AS text
  FROM documents
  WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)
     OR doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0)),
counts AS (
  {' UNION ALL '.join(
      f"SELECT source, lang, '{name}' AS tokenizer, len(regexp_extract_all(text, '{pattern}')) AS n FROM live"
      for name, pattern in token_counts.TOKENIZERS.items())})
SELECT source, lang, tokenizer, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_tokens
FROM counts GROUP BY source, lang, tokenizer
"""


@query
def op4_embedding_links(spark: SparkSession, folder: str) -> DataFrame:
    """Links and components of all vectors; what is no usable vector stands alone."""
    return vector_links.link_vectors(_table(spark, folder, "embeddings"))


@query
def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Every leak of a benchmark item in a document."""
    return decontaminate.find_leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


@query
def op6_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """The longest rule that fits every page's url, and the verdict; without a rule a page is allowed."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    judged = url_rules.judge_urls(_table(spark, folder, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


_RULES_SQL = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
ORACLES["op6_url_filters"] = f"""
WITH rules(rhost, rpath, verdict) AS (VALUES {_RULES_SQL}),
cut AS (SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0
                             THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
urls AS (SELECT DISTINCT host, path FROM parts),
best AS (SELECT host, path, rhost || rpath AS rule, verdict FROM urls JOIN rules
         ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
         QUALIFY row_number() OVER (PARTITION BY host, path
                                    ORDER BY length(rhost) + length(rpath) DESC, length(rhost) DESC) = 1)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN best USING (host, path)
"""


@query
def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document by a model fitted on the labels outside the held-out remainder; null and empty texts score too."""
    documents = _table(spark, folder, "documents")
    model = quality.fit_quality(documents, _table(spark, folder, "labels"))
    scores = quality.score_quality(documents, model)
    return _judged(documents, scores, quality.HELD_OUT, quality.THRESHOLD)


@query
def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document; texts without words have fingerprint 0 and are one component."""
    found = simhash.near_duplicates(_table(spark, folder, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Base phrases, labels and score of every document; null texts count as empty."""
    found = licenses.scan_licenses(_table(spark, folder, "documents"))
    return found.drop("expressions")


@query
def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    """The pieces of every document and their places in sequences of 2048 tokens; a null text is one end token."""
    return packing.pack_documents(_table(spark, folder, "documents"))


@query
def op11_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Measures, failure bits and the verdict of the latest policy for every document, from a stored ledger."""
    found = rule_ledger.judge(rule_ledger.stored_ledger(_table(spark, folder, "documents")))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failures"
    )


_BLANK = r"\x20\x09-\x0D"
ORACLES["op11_quality_rules"] = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
split AS (SELECT r, regexp_extract_all(text, '[^{_BLANK}]+') AS ws FROM docs),
words AS (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM split),
windows AS (SELECT r, p, w AS w0, lead(w, 1) OVER o AS w1, lead(w, 2) OVER o AS w2, lead(w, 3) OVER o AS w3,
                   lead(w, 4) OVER o AS w4 FROM words WINDOW o AS (PARTITION BY r ORDER BY p)),
often AS (SELECT r, p FROM windows WHERE w4 IS NOT NULL
          QUALIFY count(*) OVER (PARTITION BY r, w0, w1, w2, w3, w4) > 1),
covered AS (SELECT DISTINCT r, p + unnest([0, 1, 2, 3, 4]) AS p FROM often),
repeats AS (SELECT r, count(*) AS n_repeat_words FROM covered GROUP BY r),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs),
line_counts AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines
                WHERE regexp_matches(line, '[^{_BLANK}]') GROUP BY r),
measures AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[{_BLANK}]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(n_lines, 0) AS n_lines
  FROM docs JOIN split USING (r) LEFT JOIN repeats USING (r) LEFT JOIN line_counts USING (r)),
bits AS (
  SELECT *, CAST(CASE WHEN n_words < 10 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
              + CASE WHEN 10 * n_symbols > 3 * n_words THEN 4 ELSE 0 END + CASE WHEN word_chars < 2 * n_words THEN 8 ELSE 0 END
              + CASE WHEN word_chars > 15 * n_words THEN 16 ELSE 0 END
              + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 32 ELSE 0 END AS BIGINT) AS failures FROM measures)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failures & 3 <> 0 AS base_failed,
       failures = 0 AS kept, failures FROM bits
"""


@query
def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Every 50th id is an anchor, every 7th has its label moved on; rows that lack anything take no part."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = _table(spark, folder, "embeddings").withColumn("label", moved)
    return hard_negatives.mine(vectors, F.col("vec_id") % 50 == 0)


ORACLES["op13_hard_negatives"] = """
WITH rows AS (
  SELECT row_number() OVER () AS r, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS parts
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.r AS ar, a.vec_id AS anchor_id, c.r AS cr, c.vec_id AS other_id, a.label = c.label AS same,
         CAST(list_dot_product(a.parts, c.parts) AS BIGINT) AS score
  FROM rows a JOIN rows c ON a.vec_id % 50 = 0 AND a.r <> c.r AND len(a.parts) = len(c.parts)),
positives AS (
  SELECT ar, anchor_id, cr AS pr, other_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, other_id, cr) <= 5),
negatives AS (
  SELECT p.anchor_id, positive_id, positive_score, n.other_id AS negative_id, n.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.ar, pr ORDER BY n.score DESC, n.other_id, n.cr) AS INTEGER) AS rank
  FROM positives p JOIN pairs n ON p.ar = n.ar AND NOT n.same
   AND 50 * positive_score <= 100 * n.score AND 100 * n.score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 3
"""


@query
def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Groups and links of two tokenizers' tokens for every document, and how often its pairs are linked in the corpus."""
    return alignment.align_documents(_table(spark, folder, "documents")).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
