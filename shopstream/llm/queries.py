"""Registered queries of this folder: one per operator, whole tables, with
production parameters, and their DuckDB twins where SQL can say them."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bitplanes,
    block_dedup,
    decontaminate,
    divergence,
    line_dedup,
    packing,
    pii,
    prefix_hash,
    quality,
    sharding,
    simhash,
    suffix_dedup,
    tool_calls,
)
from .common import table
from .oracle import ORACLE


#: The tokenizer file of the packing query; its path is a parameter of the operator.
TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER)


#: Key of the surrogates; a job passes its own secret.
SURROGATE_KEY = "surrogate-key"

#: JSON schemas of the tools that the tool log of the chat query uses.
TOOLS = {
    "search": {"type": "object", "required": ["text", "turn"], "additionalProperties": False,
               "properties": {"text": {"type": "string", "maxLength": 300}, "turn": {"type": "integer"}}},
    "summarise": {"type": "object", "required": ["text"],
                  "properties": {"text": {"type": "string", "minLength": 60}, "turn": {"type": "integer"}}},
    "translate": {"type": "object", "required": ["text", "turn"],
                  "properties": {"text": {"type": "string"}, "turn": {"type": "integer", "maximum": 4}}},
}


def tool_log(chats: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A tool log of all turns of conversations: a user turn calls a tool with
    its text, a system turn calls one that has no schema, an assistant turn is
    the result of the turn before it. As in logs of real clients, some
    conversations name other calls than the last one (later, several, absent),
    send text that is not JSON, use an id again, answer another call or twice."""
    kind, turn = F.pmod(F.col("conv_id"), F.lit(8)), F.col("turn")

    def call_id(t):
        return F.concat_ws("-", F.lit("call"), F.col("conv_id").cast("string"), t.cast("string"))

    tool = F.get(F.array(*[F.lit(t) for t in TOOLS]), F.pmod(F.col("conv_id") + turn, F.lit(3)).cast("int"))
    before = F.when(turn >= 2, F.array(call_id(turn - 2))).otherwise(F.array().cast("array<string>"))
    after = (F.when(kind == 1, F.array(call_id(turn + 2)))
             .when(kind == 2, F.concat(before, F.array(call_id(turn + 2))))
             .when(kind == 3, F.array(call_id(turn + 2), call_id(turn + 4)))
             .otherwise(before))
    sent = F.to_json(F.struct("turn", "text"))
    calls = chats.where("role in ('user', 'system')").select(
        "conv_id", call_id(F.when((kind == 5) & (turn >= 4), turn - 4).otherwise(turn)).alias("call_id"), "turn",
        F.when(F.col("role") == "system", F.lit("configure")).otherwise(tool).alias("name"),
        F.when((kind == 4) & (turn >= 2), F.col("text")).otherwise(sent).alias("arguments"), after.alias("after"))
    answered = chats.where("role = 'assistant'")
    results = answered.select(
        "conv_id", call_id(F.when(kind == 6, turn + 1).otherwise(turn - 1)).alias("call_id"), "turn",
        F.col("text").alias("content"))
    again = answered.where(kind == 7).select(
        "conv_id", call_id(turn - 1).alias("call_id"), (turn + 1).alias("turn"), F.col("text").alias("content"))
    return calls, results.unionByName(again)


def op1_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = tool_log(table(spark, sf_dir, "conversations"))
    schemas = spark.createDataFrame([(k, json.dumps(v)) for k, v in TOOLS.items()], "name string, schema string")
    out = tool_calls.formatted(calls, results, schemas)
    return out.select("conv_id", "position", "call_id", "name", "status", "valid",
                      F.array_join("errors", "; ").alias("errors"), "message")


def op2_winnowing_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate.judged(docs, table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.repeated_bytes(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op4_fixed_block_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = block_dedup.repeated_words(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


def op5_sampled_splitter_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.assign_shards(table(spark, sf_dir, "documents"), shards=40)
    return out.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"),
                      "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.score(docs).select("doc_id", *quality.BASE, "base_failed", "kept")


def op7_concatenate_and_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pieces(docs, tokenizer_path(), with_ids=False)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = (F.length(text) - F.length(F.translate(text, "\n", "")) + 1).cast("long")
    out = line_dedup.dedup_lines(docs.withColumn("n_lines", lines), n_dropped="n_dropped")
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op9_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace_entities(docs, SURROGATE_KEY)


def op10_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = simhash.grouped(docs)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                      F.col("component").alias("component_id"))


def op11_bitplane_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bitplanes.clustered(table(spark, sf_dir, "embeddings"))
    return out.withColumnRenamed("id", "vec_id")


def op12_level_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_prefix_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = prefix_hash.edited(table(spark, sf_dir, "documents"))
    return out.withColumnRenamed("id", "doc_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = (op1_tool_call_linking, op2_winnowing_decontamination, op3_suffix_array_dedup, op4_fixed_block_dedup,
           op5_sampled_splitter_sharding, op6_quality_rules, op7_concatenate_and_cut, op8_line_dedup,
           op9_surrogates, op10_golay_simhash, op11_bitplane_centroids, op12_level_products,
           op13_prefix_fingerprints)
    return {f.__name__: f for f in ops}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
