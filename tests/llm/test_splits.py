"""Results that must not depend on how a scan is split."""

from collections import Counter

import pytest

from shopstream.llm import queries, simhash

from .test_dedup import brute_bytes


@pytest.fixture
def other_splits(spark):
    """Scans planned after a call are split as on fewer cores."""
    name = "spark.sql.files.minPartitionNum"
    yield lambda: spark.conf.set(name, 1)
    spark.conf.unset(name)


def test_suffix_query_with_cores_lost(spark, prose, tmp_path, other_splits):
    shared = prose(20, 1)
    rows = [(i, f"{prose(15, 10 + i)} {shared if i % 2 else ''} {prose(10, 50 + i)}") for i in range(30)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op3_suffix_array_dedup(spark, str(tmp_path))
    other_splits()
    assert sorted((r.doc_id, r.n_removed, r.kept_sha256) for r in out.collect()) == sorted(
        (r[0], r[2], r[4]) for r in brute_bytes(rows))


def test_keep_one_with_cores_lost(spark, prose, tmp_path, other_splits):
    rows = [(i, prose(60, 500 + i % 20)) for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "docs"))
    out = simhash.keep_one(spark.read.parquet(str(tmp_path / "docs")))
    other_splits()
    assert Counter((r.doc_id, r.text) for r in out.collect()) == Counter(rows[:20])
