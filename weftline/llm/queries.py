"""The registered queries of this subpackage: thin forms of its operators over the documents table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fingerprint import edited_fingerprints

    return edited_fingerprints(documents(spark, sf_dir))


def op2_virtual_slot_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import shard

    placed, _ = shard(documents(spark, sf_dir), n_shards=16)
    return placed.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "vslot")


def op3_flac_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .flac import media_features

    return media_features(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .byte_bpe import round_trips

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return round_trips(documents(spark, sf_dir), path, public_tokenizers.PATTERN).withColumnRenamed("id", "doc_id")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .token_counts import token_counts

    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts(documents(spark, sf_dir), path, public_tokenizers.PATTERN, limit=1024).withColumnRenamed("id", "doc_id")


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_dedup import near_duplicates

    return near_duplicates(documents(spark, sf_dir)).select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


def op7_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix

    return mix(documents(spark, sf_dir), repeats=2.0).select("doc_id", "source", "mix_epoch", "mix_weight", "mix_block", "mix_position")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import toxicity

    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity(documents(spark, sf_dir), labels).withColumnRenamed("id", "doc_id")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import quality

    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality(documents(spark, sf_dir), labels).select("doc_id", "content_score", "metadata_score", "quality_score", "quality_kept")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring_dedup import repeated_passages

    found = repeated_passages(documents(spark, sf_dir))
    return found.withColumnsRenamed({"id": "doc_id", "start": "start_byte", "size": "n_bytes", "words": "n_words", "kept_id": "kept_doc_id"})


def edited_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can express of op1."""
    return op1_document_fingerprints(spark, sf_dir).select("doc_id", "n_chars", "edited_sha256")


def placed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can express of op2: all rows and bytes are placed on 16 shards, each with its slots from 0 on without a gap."""
    shards = op2_virtual_slot_sharding(spark, sf_dir).groupBy("shard").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"), F.count_distinct("slot").alias("slots"), F.min("slot").alias("low"), F.max("slot").alias("high"))
    gapless = F.bool_and((F.col("low") == 0) & (F.col("high") == F.col("n") - 1) & (F.col("slots") == F.col("n")) & F.col("shard").between(0, 15))
    return shards.agg(F.sum("n").alias("rows"), F.sum("bytes").alias("bytes"), gapless.alias("gapless"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_document_fingerprints": op1_document_fingerprints,
        "op2_virtual_slot_sharding": op2_virtual_slot_sharding,
        "op3_flac_media": op3_flac_media,
        "op4_byte_bpe": op4_byte_bpe,
        "op5_token_counts": op5_token_counts,
        "op6_minhash_near_dedup": op6_minhash_near_dedup,
        "op7_temperature_mixing": op7_temperature_mixing,
        "op8_toxicity": op8_toxicity,
        "op9_quality_classifier": op9_quality_classifier,
        "op10_substring_dedup": op10_substring_dedup,
        "edited_texts": edited_texts,
        "placed_rows": placed_rows,
    }


LINKED = """WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM w),
item AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
pair AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n + b.n AS n, count(*) AS met FROM item a JOIN item b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM pair WHERE 100 * met >= 85 * (n - met) UNION SELECT b, a FROM pair WHERE 100 * met >= 85 * (n - met)),
reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a)
SELECT doc_id, len(s) AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id, least(doc_id, coalesce(low, doc_id)) = doc_id AS kept FROM s LEFT JOIN (SELECT a, min(b) AS low FROM reach GROUP BY 1) ON a = doc_id"""
EDITED = """SELECT doc_id, length(text) AS n_chars, sha256(substr(text, 1, length(text) - length(text) // 2) || substr(coalesce(after, first), 1, length(text) // 2)) AS edited_sha256
FROM (SELECT doc_id, text, lead(text) OVER (ORDER BY doc_id DESC) AS after, first_value(text) OVER (ORDER BY doc_id DESC) AS first FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents))"""
PLACED = "SELECT count(*) AS rows, CAST(sum(octet_length(encode(coalesce(text, ''))) + 1) AS BIGINT) AS bytes, TRUE AS gapless FROM documents"


def oracle_sql() -> dict[str, str]:
    """Queries that SQL can express; the others are held against brute-force versions in tests/llm."""
    return {"op6_minhash_near_dedup": LINKED, "edited_texts": EDITED, "placed_rows": PLACED}
