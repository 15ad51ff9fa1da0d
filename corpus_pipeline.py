"""The corpus pipeline: five stages, each over all documents its predecessor kept.

Quality rules and toxicity drop documents, line dedup edits their texts, SimHash and an exact check behind it keep
one document of each group of near-copies, and packing turns the rest into pieces of token sequences.

A stage's result is written and read again by the next. The tables a stage works with are deleted when the next
begins, so that the disk holds those of one stage.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from plumbline.llm.line_dedup import without_duplicate_lines
from plumbline.llm.near_dedup import without_near_copies
from plumbline.llm.packing import pack_documents
from plumbline.llm.quality_rules import passing_quality
from plumbline.llm.queries import tokenizer_path
from plumbline.llm.shared import deleted, recorded, scratch, stored
from plumbline.llm.simhash import one_of_each
from plumbline.llm.toxicity import without_toxic


_left: list[str] = []


def _stage(f):
    @wraps(f)
    def begun(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        deleted(spark, _left)
        _left.clear()
        with recorded(_left):
            return f(spark, docs, sf_dir)

    return begun


@_stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return passing_quality(docs)


@_stage
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@_stage
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_duplicate_lines(docs).withColumn("n_chars", F.length("text").cast("long"))


@_stage
def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash keeps one document of each component of fingerprints; near-copies that are alike but differ in more
    than two bits are found among the rest by their exact similarity."""
    with scratch(spark):
        kept = stored(one_of_each(docs), "simhash-kept", outer=True)
    return without_near_copies(kept)


@_stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("packing", packing),
]
#: Toxicity, near-copies and packing are not SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
