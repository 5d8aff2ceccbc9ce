"""Texts that break patterns, recursion and memory, through every operator."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shopstream.llm import (
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
from shopstream.llm.queries import tokenizer_path

N = 1_000_000
ODD = {
    "blanks": "a b" + " " * N + "c d", "newlines": "a" + "\n" * N + "b", "letter": "a" * N, "digits": "7" * N,
    "brackets": "[" * (N // 2) + "]" * (N // 2), "labels": "a@" + "b." * (N // 2) + "com", "at signs": "a@b." * (N // 4),
    "secret": "password=" + "Ab1" * 20_000, "words": "word " * (N // 5), "emoji": "\U0001F600" * (N // 4),
    "dashes": "1-" * (N // 2), "nul": "\0" * N, "mixed": "x1@y.zz 555-123-4567 " * (N // 21),
}


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t) for i, t in enumerate(ODD.values())] + [(50, None), (51, "")]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4).persist()


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "word " * 20), (2, "some other text of a benchmark")], "item_id long, text string")


RUNS = {
    "decontaminate": lambda d, i: decontaminate.judged(d, i),
    "suffix": lambda d, i: suffix_dedup.repeated_bytes(d),
    "blocks": lambda d, i: block_dedup.repeated_words(d),
    "shards": lambda d, i: sharding.assign_shards(d, shards=5),
    "quality": lambda d, i: quality.score(d),
    "lines": lambda d, i: line_dedup.dedup_lines(d),
    "surrogates": lambda d, i: pii.replace_entities(d, "k"),
    "simhash": lambda d, i: simhash.grouped(d),
    "edits": lambda d, i: prefix_hash.edited(d),
}


@pytest.mark.parametrize("name", RUNS)
def test_every_operator_gives_a_row_for_every_odd_text(odd, items, name):
    out = RUNS[name](odd, items)
    # all columns are computed, none is pruned
    n, _ = out.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*out.columns).cast("decimal(38,0)"))).first()
    assert n == odd.count()


def test_packing_keeps_every_token_of_odd_texts(odd):
    got = packing.pieces(odd, tokenizer_path(), with_ids=False).groupBy("doc_id").agg(
        F.sum("length").alias("n"), F.max("doc_tokens").alias("all")).collect()
    assert len(got) == odd.count() and all(r["n"] == r["all"] for r in got)


@pytest.mark.parametrize("name", ["blanks", "newlines", "words"])
def test_both_tokenizer_engines_agree_on_odd_texts(name):
    from tokenizers import Tokenizer
    own = Tokenizer.from_file(tokenizer_path())
    text = " ".join(["x"] * 120) + ODD[name]
    assert np.array_equal(packing.Encoder(tokenizer_path(), added=True).encode(text),
                          own.encode(text, add_special_tokens=False).ids)


def test_audit_and_pipeline_of_odd_texts(spark, odd, items, tmp_path):
    docs = odd.withColumn("lang", F.lit("en")).withColumn("source", F.concat(F.lit("s"), F.col("doc_id") % 3))
    assert divergence.audit(docs).where("part = 'pair'").count() == 6
    docs.withColumn("n_chars", F.length("text").cast("long")).write.parquet(f"{tmp_path}/documents.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() >= 0


def test_surrogates_replace_long_addresses_and_secrets(spark):
    chain, secret = "a@" + "b." * 20_000 + "com", "Ab1" * 5000
    df = spark.createDataFrame([(1, f"mail {chain} end"), (2, f"password={secret} end")], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in pii.replace_entities(df, "k").collect()}
    assert got[1].startswith("mail ") and not got[1].startswith("mail a@b.") and got[1].endswith("com end")
    assert secret not in got[2] and got[2].startswith("password=") and len(got[2]) == len(f"password={secret} end")


def test_tool_arguments_beyond_numbers_and_depth():
    deep = "[" * 5000 + "]" * 5000
    assert tool_calls.parse(deep) == (None, "nested too deep")
    assert tool_calls.parse("[" * 300 + "]" * 300) == (None, "nested too deep")
    value, why = tool_calls.parse("[" * 200 + "]" * 200)
    assert why is None and json.loads(tool_calls.canonical(value)) == value
    assert tool_calls.parse('{"a":1e999}') == (None, "not JSON")
    assert tool_calls.violations(10**400, {"type": "integer", "maximum": 1.5}) == ["$: maximum"]
    assert tool_calls.violations(2.0, {"type": "integer"}) == []
    assert tool_calls.violations(True, {"enum": [1]}) == ["$: enum"]
    assert tool_calls.violations(1.0, {"enum": [1]}) == []
