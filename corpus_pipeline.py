"""The corpus pipeline: quality rules, line dedup, SimHash near-dedup,
benchmark decontamination, packing.

Each stage takes the documents its predecessor kept (all columns of
``documents``) and its decision takes effect: rejected documents go, repeated
lines are cut, one document of each near-duplicate group stays (the smallest
id), contaminated documents go; the last stage packs what is left into
sequences of 2,048 tokens and returns the pieces. Between stages the documents
are written as Parquet to the shared folder and read again.

Defined results: null and empty texts have no words, so the quality rules
reject them; repeated rows are judged alike until near-dedup keeps one of
them; extra columns pass through to the packing stage. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shopstream.llm import decontaminate, line_dedup, packing, quality, simhash
from shopstream.llm.common import table
from shopstream.llm.queries import tokenizer_path
from shopstream.session import materialise


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the threshold table."""
    return quality.keep_good(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that recur in a larger id."""
    return line_dedup.dedup_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the sequences that hold the documents' tokens."""
    return packing.pieces(docs.select("doc_id", "text"), tokenizer_path(), with_ids=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", pack),
]

#: SQL has neither XXH64 nor the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
