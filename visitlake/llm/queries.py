"""One query for each operator, over its whole table, and its SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from corpus_pipeline import run as run_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlake.llm import auction, bpe, hyperminhash, kronecker, latent, linespread, productquant, recompression, resharding, secrets, suffixes, toxicity, urlrules
from visitlake.llm.common import read


def op1_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latent.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op2_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(
        read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op3_boosted_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_flow_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From six shards by id to eight of near equal bytes."""
    placed = resharding.by_bytes(read(spark, sf_dir, "documents"), shards=8, old_shards=6)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
                         F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "old_shard")


def op5_token_indexed_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = urlrules.rule_table(spark, urlrules.GIVEN + urlrules.OWN)
    judged = urlrules.judge(read(spark, sf_dir, "pages"), rules)
    return judged.select("page_id", "host", "path", F.when(F.col("tier") == 0, F.col("rule")).alias("rule"), "verdict")


def op6_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.linked(read(spark, sf_dir, "documents"))


def op7_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    stripped = linespread.remove_boilerplate(read(spark, sf_dir, "documents"))
    return stripped.select("doc_id", "text", F.col("__n_lines").cast("long").alias("n_lines"), F.col("__n_removed").cast("long").alias("n_removed"))


def op8_lyndon_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(read(spark, sf_dir, "documents"))


def op9_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source owns a document, and holds one repository for each language."""
    return secrets.scan_documents(read(spark, sf_dir, "documents"), F.col("source"), F.concat_ws("/", "source", "lang"))


def op10_product_quantisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return productquant.linked(read(spark, sf_dir, "embeddings"))


def op11_kronecker_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some labels are moved on by one, so that rows that are alike carry different ones."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return kronecker.mined(read(spark, sf_dir, "embeddings"), label, F.col("vec_id") % 100 == 0)


def op12_auction_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read(spark, sf_dir, "conversations")
    return auction.repaired_conversations(conversations, auction.damaged(conversations))


def op13_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompression.remove_repeats(read(spark, sf_dir, "documents"))


QUERIES = {
    "pipeline": run_pipeline,
    "op1_latent_decontamination": op1_latent_decontamination,
    "op2_prefix_bpe": op2_prefix_bpe,
    "op3_boosted_toxicity": op3_boosted_toxicity,
    "op4_flow_resharding": op4_flow_resharding,
    "op5_token_indexed_rules": op5_token_indexed_rules,
    "op6_hyperminhash": op6_hyperminhash,
    "op7_line_spread": op7_line_spread,
    "op8_lyndon_suffixes": op8_lyndon_suffixes,
    "op9_secret_ownership": op9_secret_ownership,
    "op10_product_quantisation": op10_product_quantisation,
    "op11_kronecker_negatives": op11_kronecker_negatives,
    "op12_auction_repair": op12_auction_repair,
    "op13_recompression": op13_recompression,
}

SQL: dict[str, str] = {
    "op11_kronecker_negatives": """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM rows a JOIN rows b ON len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM pairs WHERE same AND other <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
""",
    "op5_token_indexed_rules": f"""
WITH rests AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rests
), judged AS (
  SELECT *, CASE
      WHEN '.' || host LIKE '%.example.org' AND starts_with(path, '/en/1') THEN 'example.org/en/1'
      WHEN '.' || host LIKE '%.example.org' AND starts_with(path, '/es/') THEN 'example.org/es/'
      WHEN '.' || host LIKE '%.com' AND starts_with(path, '/fr/') THEN 'com/fr/'
      WHEN '.' || host LIKE '%.com' AND starts_with(path, '/de/') THEN 'com/de/'
      WHEN '.' || host LIKE '%.org' AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM parts
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN regexp_matches(host || path, '(^|[^A-Za-z0-9])({"|".join(urlrules.UNWANTED)})($|[^A-Za-z0-9])') THEN 'block'
    ELSE 'allow' END AS verdict
FROM judged
""",
    "op7_line_spread": f"""
WITH split AS (
  SELECT row_number() OVER () AS row, doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents
), held AS (
  SELECT row, doc_id, coalesce(source, '') AS site, text, pos, lines[pos] AS raw, trim(lines[pos], ' ' || chr(9) || chr(13)) AS line
  FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS pos FROM split)
), bad AS (
  SELECT line, min(doc_id) AS home FROM held WHERE line <> ''
  GROUP BY line HAVING least(count(DISTINCT site), count(DISTINCT text)) >= {linespread.SITES}
), kept AS (
  SELECT row, string_agg(raw, chr(10) ORDER BY pos) FILTER (WHERE bad.line IS NULL OR doc_id = home) AS text,
         count(*) FILTER (WHERE bad.line IS NULL OR doc_id = home) AS n FROM held LEFT JOIN bad USING (line) GROUP BY row
)
SELECT doc_id, CASE WHEN split.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text,
       coalesce(len(lines), 0) AS n_lines, coalesce(len(lines) - n, 0) AS n_removed
FROM split LEFT JOIN kept USING (row)
""",
}
