"""From raw documents to token ids: five stages, each a Parquet table that the next one reads.

1. quality: documents that the co-trained classifier rejects go.
2. near_dedup: one document of each near-duplicate group stays, the one with the smallest id and then text digest.
   Documents are near duplicates from a five-word Jaccard similarity of 0.8 on; at 0.8 a pair falls below the match
   about once in a million. Repeated rows are one; rows that repeat an id are judged by their own texts.
3. substring_dedup: passages that repeat one of a smaller document are cut out of their texts.
4. mixing: sources are repeated towards flatter weights; no document is lost, as the least repeated source has one epoch.
5. encoding: every copy's text as ids, and back.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline import staging
from weftline.llm import textkernel as K
from weftline.llm.byte_bpe import round_trips
from weftline.llm.mixing import mix
from weftline.llm.near_dedup import near_duplicates, without_duplicates
from weftline.llm.quality import quality
from weftline.llm.substring_dedup import repeated_passages, without_passages


def _own_columns(docs: DataFrame, added: list[str], operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The columns of docs in the operator's result, with their values even where they are named like those that it adds."""
    aside = {c: K.fresh([*docs.columns, *added], c) for c in docs.columns if c.lower() in added}
    return operator(docs.withColumnsRenamed(aside)).select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier accepts; each row, whatever it repeats, by its own text and metadata.

    Null columns count as unknown, null and empty texts as texts without words. An empty table gives none.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    added = ["content_score", "metadata_score", "quality_score", "quality_kept"]
    out = _own_columns(docs, added, lambda d: quality(d, labels).where("quality_kept"))
    staging.release(spark)  # what learning has left, before all documents are scored
    return out


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates; of equal ids and texts one row.

    Ties go to the smallest id, then text digest; a null id comes last. Null, empty and blank texts are linked with
    nothing and all stay. An empty table gives none.
    """
    return without_duplicates(docs, near_duplicates(docs, shingle=5, at_least=(80, 100), match=35)).select(*docs.columns)


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without passages that repeat one of a smaller id; n_chars follows the text.

    A document of which nothing visible is left goes. Rows that repeat an id are cut by their own texts. Null ids, and
    null, empty and blank texts, stay as they are. An empty table gives none.
    """
    return without_passages(docs, repeated_passages(docs))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the weight of its source says, once at least; the most repeated source 1.25 times.

    Null and empty sources are one source, null texts one token; equal rows are repeated alike. An empty table gives none.
    """
    out = _own_columns(docs, ["mix_epoch", "mix_weight", "mix_block", "mix_position"], lambda d: mix(d, repeats=1.25))
    staging.release(spark)
    return out


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number and digest of the token ids, and digest of the decoded text, for every row.

    Null and empty texts have no tokens. An empty table gives none.
    """
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return round_trips(docs, path, public_tokenizers.PATTERN).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("substring_dedup", substring_dedup_stage),
    ("mixing", mixing_stage),
    ("encoding", encoding_stage),
]

#: No SQL for the stages: each is held against a brute-force version or an exact round trip in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, on the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staging.put(stage(spark, docs, sf_dir), name)
        staging.release(spark)
    return STAGES[-1][1](spark, docs, sf_dir)
