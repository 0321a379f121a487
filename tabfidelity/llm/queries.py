"""The operators' queries over the driver's tables, with production parameters, and their SQL where there is any."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup, minhash, packing, quality, sentencepiece_nbest, sharding, substring_dedup, tiff, token_files, url_filter
from .tokens import vocabulary

RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.dedup_substrings(docs, counts=True).select("doc_id", "n_removed", "text")


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_read(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(_read(spark, sf_dir, "pages"), RULES, default="allow")


def op4_sentencepiece_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_nbest.nbest_digests(_read(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"), n=4)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), capacity=4096, end_id=1, cache_parts=250_000)


def op6_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_sample(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(_read(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=2)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_read(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op9_tiff_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiff.media_digests(_read(spark, sf_dir, "documents"))


def op10_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(_read(spark, sf_dir, "documents"), n_shards=8).withColumn("slot", F.col("slot").cast("long"))


QUERIES = {f.__name__: f for f in (op1_substring_dedup, op2_minhash_near_dedup, op3_url_filter, op4_sentencepiece_nbest, op5_best_fit_packing, op6_quality_resampling, op7_token_files, op8_exact_dedup, op9_tiff_pages, op10_byte_shards)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL = {
    "op2_minhash_near_dedup": rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
met AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT u, v FROM met JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v WHERE 100 * met.n >= 75 * (x.n + y.n - met.n)),
reach AS (
  SELECT doc_id AS u, doc_id AS v FROM documents
  UNION
  SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u)
SELECT d.doc_id, coalesce(sizes.n, 0)::BIGINT AS n_shingles, r.c AS component_id, d.doc_id = r.c AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN (SELECT u, min(v) AS c FROM reach GROUP BY u) r ON r.u = d.doc_id""",
    "op3_url_filter": r"""
WITH rules(rule, verdict) AS (VALUES ('net/', 'block'), ('example.net/en/', 'allow'), ('example.com/de/', 'block'), ('org/fr/', 'allow')),
cut AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
fit AS (
  SELECT page_id, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS verdict
  FROM cut JOIN rules ON (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
    AND starts_with(path, substr(rule, strpos(rule, '/'))) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM cut LEFT JOIN fit USING (page_id)""",
    "op8_exact_dedup": f"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, {_LOWER} AS t FROM documents) WINDOW same AS (PARTITION BY t)""",
    "op10_byte_shards": f"""
WITH RECURSIVE steps(i, k, c) AS (
  SELECT i, 0, i FROM range(256) t(i) UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, {0xEDB88320}) ELSE c >> 1 END FROM steps WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS t FROM steps WHERE k = 8),
bytes AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, hex(encode(coalesce(text, ''))) AS x FROM documents),
sums AS (
  SELECT doc_id, size, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, size - 1), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
    lambda a, v: xor(a >> 8, t[(xor(a, v) & 255) + 1]))) AS crc FROM bytes, crc_table),
laid AS (
  SELECT doc_id, size, crc, coalesce(sum(size) OVER (ORDER BY doc_id NULLS FIRST, size, crc ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 8 // sum(size) OVER () AS shard,
    row_number() OVER (ORDER BY doc_id NULLS FIRST, size, crc) AS place FROM sums)
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'bytes' AS law, shard::INTEGER AS shard, place - min(place) OVER (PARTITION BY shard) AS slot, NULL::INTEGER AS grown_shard FROM laid""",
}
