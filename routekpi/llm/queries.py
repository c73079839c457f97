"""One registered query for each operator, with the SQL that checks it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from routekpi.llm import embeddings, exact_dedup, language, line_dedup, mixing, near_dedup, packing, periodic, quality, spelling, substrings, toxicity, warc
from routekpi.llm.scratch import folder

TOKENIZER = "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    out = packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector at cosine 0.9 or more."""
    return embeddings.near_vectors(_table(spark, sf_dir, "embeddings"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade of every document and whether it is good enough."""
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group, keeper and hash of every document."""
    return exact_dedup.mark_exact(_table(spark, sf_dir, "documents"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under 4-word shingle similarity of 0.8 or more."""
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), shingle_words=4)


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without passages of 50 words that an earlier one has."""
    return substrings.remove_repeats(_table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken from every document, and its training position."""
    return mixing.mix(_table(spark, sf_dir, "documents")).drop("source")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by the marginals of its words."""
    return language.identify(_table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op9_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without lines similar to an earlier one."""
    return line_dedup.dedup_lines(_table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document by its nearest labelled examples."""
    out = toxicity.score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted")


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back from them."""
    path = folder(spark, "warc")
    warc.write_archives(_table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form and root of every frequent word; some runs lose a code point, as the contract plants them."""
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"), alter=spelling.every_199th)


def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document; some documents are made periodic first, as the contract plants them."""
    return periodic.run_digests(periodic.find_runs(periodic.plant_runs(_table(spark, sf_dir, "documents"))))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline's packed sequences."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_packing": op1_packing,
    "op2_embeddings": op2_embeddings,
    "op3_quality": op3_quality,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_near_dedup": op5_near_dedup,
    "op6_substrings": op6_substrings,
    "op7_mixing": op7_mixing,
    "op8_language": op8_language,
    "op9_lines": op9_lines,
    "op10_toxicity": op10_toxicity,
    "op11_warc": op11_warc,
    "op12_spelling": op12_spelling,
    "op13_periodic": op13_periodic,
    "pipeline": pipeline,
}

ORACLE = {
    "op4_exact_dedup": r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
""",
    "op11_warc": r"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), q AS (
  SELECT *, payload_bytes >= 1000 AND page_id IS DISTINCT FROM max(page_id) OVER g AS again, max(page_id) OVER g AS lead
  FROM p WINDOW g AS (PARTITION BY payload_digest, payload_bytes)
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN lead END AS refers_to
FROM q
""",
    "op7_mixing": r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS k
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight,
         CAST(sum(sum(size)) OVER () AS BIGINT) AS total
  FROM d GROUP BY source
), cut AS (  -- the sources whose bound lies below the others' level, for every possible cut
  SELECT a.source, (a.total - coalesce(sum(b.source_size * 3) FILTER (WHERE NOT later), 0)) / sum(b.weight) FILTER (WHERE later) AS level,
         a.source_size * 3 / a.weight AS fills
  FROM s a CROSS JOIN LATERAL (
    SELECT b.source_size, b.weight, (b.source_size * 3 / b.weight >= a.source_size * 3 / a.weight) AS later FROM s b
  ) b GROUP BY a.source, a.total, a.source_size, a.weight
), l AS (SELECT arg_min(level, fills) AS level FROM cut WHERE level < fills),
p AS (
  SELECT s.*, CASE WHEN l.level IS NULL OR l.level * weight >= source_size * 3 THEN CAST(source_size * 3 AS DOUBLE) ELSE l.level * weight END AS target
  FROM s LEFT JOIN l ON true
), q AS (
  SELECT doc_id, size, source_size, weight, target, CAST(floor(target + 0.5) AS BIGINT) AS demand,
         CAST(coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first_word
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
), r AS (
  SELECT *, CAST((demand // greatest(source_size, 1)) * size
            + least(greatest(demand % greatest(source_size, 1) - first_word, 0), size) AS BIGINT) AS taken,
         first_word / greatest(demand, 1) AS u
  FROM q
)
SELECT doc_id, size, source_size, target, taken,
       CASE WHEN taken > 0 THEN CASE weight
         WHEN 1 THEN 2.0::DOUBLE * u / (1.5::DOUBLE + sqrt(2.25::DOUBLE - 2.0::DOUBLE * u))
         WHEN 2 THEN 2.0::DOUBLE * u / 2.0::DOUBLE
         ELSE 2.0::DOUBLE * u / (0.5::DOUBLE + sqrt(0.25::DOUBLE + 2.0::DOUBLE * u)) END END AS position
FROM r
""",
}
