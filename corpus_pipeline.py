"""Documents to token ids in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All but the last return the
columns of ``documents``: quality rules and decontamination drop rows, near duplicates keep one of each group, and
the secret scan replaces secrets in the texts (and counts n_chars anew). The last returns the tokens.

Rows with a null or empty text fail the quality rules and go in the first stage. Rows that repeat are near duplicates, so
one of them stays; ties go to the smallest id, and where one id has several texts of a group, to one of them. Rows without
an id are near duplicates like others and stay only where no row of their group has an id. Very long texts are worked on
whole. Columns beside those of ``documents`` are left behind at the start. An empty table passes through all stages.

The first four stages send texts alone to Python workers, never whole rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm import bpe, decontam, neardup, quality, secrets
from gleaner.llm.common import keep, small_batches, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the base or host rules reject."""
    small_batches(spark)
    return quality.kept_documents(spark, docs.select(*COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates: that of the smallest id."""
    small_batches(spark)
    return neardup.kept_documents(spark, docs).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    small_batches(spark)
    return decontam.clean_documents(spark, docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in texts by their kind."""
    small_batches(spark)
    clean = secrets.redacted(docs)
    return clean.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.char_length("text").cast("bigint")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of the texts, with digests of the ids and of what they decode to."""
    small_batches(spark)
    return bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.json"), ("n_tokens", "ids", "ids_sha256", "decoded_sha256"), remember=False)


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("secret_scan", secret_scan), ("encoding", encoding)]
#: Near duplicates, guess costs and BPE have no SQL form; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table; each is written as Parquet and reread as the next one's documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
