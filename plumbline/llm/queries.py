"""One query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from plumbline.llm import packing
from plumbline.llm.exact_dedup import exact_duplicates
from plumbline.llm.filter_audit import filter_audit
from plumbline.llm.html_text import extract_text
from plumbline.llm.lexical_search import lexical_search
from plumbline.llm.line_dedup import without_duplicate_lines
from plumbline.llm.lm_score import lm_scores
from plumbline.llm.quality_rules import quality_verdicts
from plumbline.llm.sentencepiece import encode_documents
from plumbline.llm.simhash import near_duplicates
from plumbline.llm.token_counts import token_counts
from plumbline.llm.toxicity import toxicity
from plumbline.llm.warc import fixity_audit


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_warc_fixity(spark: SparkSession, folder: str) -> DataFrame:
    return fixity_audit(_table(spark, folder, "pages"))


def op2_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return encode_documents(_table(spark, folder, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op3_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    found = lm_scores(_table(spark, folder, "documents"))
    return found.withColumns({c: F.round(c, 6) for c in ("log_score", "mean_log_score")})


def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact_duplicates(_table(spark, folder, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op6_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extract_text(_table(spark, folder, "pages"))


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_verdicts(_table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return without_duplicate_lines(docs, counts=True)


def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(_table(spark, folder, "documents"))


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(_table(spark, folder, "documents"), tokenizer_path())


def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op13_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(_table(spark, folder, "documents"), tokenizer_path())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_warc_fixity, op2_sentencepiece, op3_lm_scoring, op4_exact_dedup, op5_toxicity,
        op6_html_extraction, op7_quality_rules, op8_line_dedup, op9_simhash, op10_packing,
        op11_lexical_search, op12_filter_audit, op13_token_counts,
    )
}
