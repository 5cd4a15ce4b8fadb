"""Queries over the driver's tables, one per operator of this subpackage, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, bytefold, changes, decontam, langid, neardup, phrases, quality, rnnlm, secrets, tokcount, urlfilter, warc
from .common import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host-level quality rules over all documents."""
    out = quality.judge(spark, table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "host_failed")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned from the labelled ones outside fold 0."""
    return langid.identify(spark, table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item, the place and the edits."""
    return decontam.contaminated(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of rules and path templates on all pages."""
    return urlfilter.judge(spark, table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op5_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of all documents and the texts that they decode to, as digests."""
    return bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), ("n_tokens", "ids_sha256", "decoded_sha256"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece-model token counts of all documents."""
    return tokcount.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op7_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return neardup.deduplicate(spark, table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, written as WARC archives with their index and read back through it."""
    return warc.archive(spark, table(spark, sf_dir, "pages")).records().select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents."""
    spans = F.col("spans")
    base = secrets.KINDS[:3]
    return secrets.scan(table(spark, sf_dir, "documents")).select(
        "doc_id",
        *[secrets.counted(spans, k).alias(f"n_{k}") for k in base],
        F.sha2(secrets.joined(spans, *base).cast("binary"), 256).alias("base_sha256"),
        secrets.joined(spans, *secrets.KINDS).alias("spans"),
    )


def op10_gru_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-likelihoods of all documents under a recurrent network and under the unigram model."""
    return rnnlm.score(spark, table(spark, sf_dir, "documents"))


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's best collocations of two and three words in all documents."""
    return phrases.mine(spark, table(spark, sf_dir, "documents"))


def op12_byte_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents by folded ranked merges and the bytes that they decode to, as digests."""
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    return bytefold.encode_decode(table(spark, sf_dir, "documents"), path, pattern, ("n_tokens", "ids_sha256", "decoded_sha256"))


def op13_change_applier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What becomes of all changes of clients, applied in sequence by a stateful stream."""
    done = changes.apply_changes(spark, table(spark, sf_dir, "client_changes"))
    cents = F.floor(100 * F.col("balance") + 0.5).cast("bigint").alias("cents")
    return done.select("change_id", "client_id", "status", "batch", "missed", "city", cents, "current")


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_language_id, op3_decontamination, op4_url_filter, op5_bpe_roundtrip, op6_token_counts, op7_minhash_neardup, op8_warc, op9_secret_scan, op10_gru_scores, op11_phrase_mining, op12_byte_fold, op13_change_applier)}
SQL: dict[str, str] = {"op1_quality_rules": quality.sql(), "op4_url_filter": urlfilter.sql(), "op8_warc": warc.sql(), "op11_phrase_mining": phrases.sql()}
