"""The registered queries of the operators, and their SQL where it can express them."""

from pyspark.sql import DataFrame, SparkSession

from fleetspan.llm import alignment, byte_pairs, encoding, forest_dedup, licenses, merkle, minhash, mixing, neighbours, quality, sharding, substring, token_counts
from fleetspan.llm.merkle_sql import MANIFEST


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.substring_dedup(_table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_sources(_table(spark, sf_dir, "documents"))


def op4_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.balanced_shards(_table(spark, sf_dir, "documents"))


def op5_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingles of four words here, as this query's contract says."""
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), k=4)


def op6_attention_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.encoding_digests(_table(spark, sf_dir, "documents"))


def op8_license_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(_table(spark, sf_dir, "documents"))


def op9_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest_dedup.near_vectors(_table(spark, sf_dir, "embeddings"))


def op10_stable_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"))


def op11_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_pairs.encoding_digests(_table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest_check(_table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignments(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpus_pipeline import run

    return run(spark, sf_dir)


def queries():
    named = [op1_substring_dedup, op2_token_counts, op3_source_mix, op4_kd_shards, op5_circulant_minhash, op6_attention_quality, op7_bpe_transducer, op8_license_index, op9_projection_forest, op10_stable_neighbours, op11_byte_pairs, op12_merkle_manifest, op13_token_alignment, pipeline]
    return {f.__name__: f for f in named}


_WORDS = r"[^\x20\x09-\x0D]+"

OP1 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), starts AS (
  SELECT row, unnest(range(1, len(w) - 33)) AS p FROM d WHERE len(w) >= 35
), wins AS (
  SELECT s.row, s.p, md5(array_to_string(w[s.p:s.p + 34], ' ')) AS h FROM starts s JOIN d USING (row)
), twice AS (
  SELECT h FROM wins GROUP BY h HAVING count(*) > 1
), gone AS (
  SELECT DISTINCT row, unnest(range(p, p + 35)) AS p FROM wins WHERE h IN (SELECT h FROM twice)
), gone_of AS (
  SELECT row, list(p) AS ps FROM gone GROUP BY row
), kept AS (
  SELECT d.row, array_to_string(list_filter(w, lambda x, i: NOT list_contains(ps, i)), ' ') AS t, len(ps) AS n FROM d JOIN gone_of USING (row)
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, array_to_string(w, ' '))) AS kept_sha256
FROM d LEFT JOIN kept USING (row)
"""

OP3 = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORDS}')) AS BIGINT) AS size,
    -ln((CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 12) AS BIGINT) + 0.5) / 281474976710656.0)
      / greatest(0.1, coalesce(CAST(strlen(regexp_replace(text, '[\x00-\x40\x5B-\x60\x7B-\x7F]+', '', 'g')) AS DOUBLE) / greatest(strlen(text), 1), 0.0)) AS key
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS DOUBLE) AS source_size,
    CASE (row_number() OVER (ORDER BY source IS NULL, source COLLATE "binary") - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END AS weight
  FROM d GROUP BY source
), u AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS unit
  FROM s WINDOW o AS (ORDER BY 3 * source_size / weight, source IS NULL, source)
), t AS (
  SELECT *, unit * weight >= 3 * source_size AS is_full FROM u
), level AS (
  SELECT arg_min(unit, 3 * source_size / weight) AS unit FROM t WHERE NOT is_full
), targets AS (
  SELECT source, source_size, CASE WHEN is_full THEN 3 * source_size ELSE (SELECT unit FROM level) * weight END AS target FROM t
), plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(floor(target) / source_size) ELSE 0 END AS turns FROM targets
), placed AS (
  SELECT d.*, p.source_size, p.target, p.turns, floor(p.target) - p.turns * p.source_size AS rest,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target,
  CAST(turns * size + greatest(0, least(size, rest - before)) AS BIGINT) AS taken
FROM placed
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_substring_dedup": OP1, "op3_source_mix": OP3, "op12_merkle_manifest": MANIFEST}
