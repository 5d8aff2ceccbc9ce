"""Sinks published by a manifest: replays, writers, ties, compaction, readers."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from shopstream import constants as C
from shopstream.operators import documents
from shopstream.session import scratch_path
from shopstream.sinks import manifest as M
from shopstream.sinks import tables as sinks
from shopstream.sources import topic as TP
from shopstream.sources.dimension import Dimension, add_version
from shopstream.streaming import jobs

from .conftest import rows

KIND = "k string, v int, d string"
NOW = {"availableNow": True}


def frame(spark, *recs):
    return spark.createDataFrame(list(recs), KIND)


def put(spark, base, batch, *recs, writer="q", **kw):
    sinks.upsert(frame(spark, *recs), base, ["k"], ["v"], "d", batch, writer=writer, **kw)


def read(spark, base, keep="latest"):
    return rows(sinks.read_keyed(spark, base, KIND, ["k"], ["v"], keep), "k", "v", "d")


def test_replays_change_nothing_and_null_partitions_stay(spark):
    base = scratch_path(spark, "t_sink")
    assert read(spark, base) == []
    first = [("a", 1, None), ("b", 2, "d1"), ("c", 3, "d2")]
    put(spark, base, 0, *first)
    put(spark, base, 0, *first)
    put(spark, base, 1, ("b", 5, "d1"), ("e", 1, None))
    put(spark, base, 0, *first)
    assert read(spark, base) == [("a", 1, None), ("b", 5, "d1"), ("c", 3, "d2"), ("e", 1, None)]
    assert M.load(spark, base).version == 2 and M.load(spark, base).last == {"q": 1}
    assert sinks.read_table(spark, base, KIND, ["d=d2"]).count() == 1


def test_a_job_on_a_new_checkpoint_adds_to_the_table(spark):
    base = scratch_path(spark, "t_writers")
    put(spark, base, 0, ("a", 1, "x"), writer="old")
    put(spark, base, 0, ("b", 1, "x"), writer="new")
    assert read(spark, base) == [("a", 1, "x"), ("b", 1, "x")]


def test_of_equal_rows_by_order_the_later_write_wins(spark):
    base = scratch_path(spark, "t_ties")
    put(spark, base, 0, ("a", 1, "zz old"))
    put(spark, base, 1, ("a", 1, "aa new"))
    assert read(spark, base) == [("a", 1, "aa new")]
    assert read(spark, base, "first") == [("a", 1, "zz old")]
    sinks.compact(spark, base, KIND, ["k"], ["v"], "d")  # rows keep their sequence numbers
    put(spark, base, 2, ("a", 1, "mm newest"))
    assert read(spark, base) == [("a", 1, "mm newest")]


def test_compaction_of_some_partitions_and_readers_during_it(spark):
    base = scratch_path(spark, "t_compact")
    for b in range(4):
        put(spark, base, b, ("a", b, "d1"), (f"k{b}", b, "d1"), (f"x{b}", b, "d2"))
    want, table = read(spark, base), sinks.read_keyed(spark, base, KIND, ["k"], ["v"])
    assert sinks.part_counts(spark, base) == {"d=d1": 4, "d=d2": 4}
    sinks.compact(spark, base, KIND, ["k"], ["v"], "d", partitions=["d=d1"])
    assert sinks.part_counts(spark, base) == {"d=d1": 1, "d=d2": 4}
    assert read(spark, base) == want == rows(table, "k", "v", "d")  # the old reader reads its old folders
    put(spark, base, 3, ("z", 9, "d1"))  # a replay stays one after compaction
    assert read(spark, base) == want
    sinks.compact(spark, base, KIND, ["k"], ["v"], "d")
    assert M.vacuum(spark, base, older_than_s=86_400) == 0
    assert M.vacuum(spark, base, older_than_s=-60) > 0
    assert read(spark, base) == want and len(M.load(spark, base).entries) <= 2


def test_partitions_are_folded_after_so_many_batches(spark):
    base = scratch_path(spark, "t_auto")
    for b in range(6):
        put(spark, base, b, ("a", b, "d1"), (f"k{b}", b, "d2" if b % 2 else "d1"), compact_after=2)
        assert max(sinks.part_counts(spark, base).values()) <= 2
    assert len(read(spark, base)) == 7


def test_two_writers_at_once_both_get_in(spark, monkeypatch):
    """The second publish of a version fails and is built upon the first."""
    base = scratch_path(spark, "t_race")
    put(spark, base, 0, ("a", 0, "d"))
    publish, raced = M.publish, []

    def late(s, path, manifest):
        if not raced:
            raced.append(1)
            put(spark, base, 0, ("b", 1, "d"), writer="other")
        return publish(s, path, manifest)
    monkeypatch.setattr(M, "publish", late)
    put(spark, base, 1, ("a", 0, "later"))
    assert read(spark, base) == [("a", 0, "later"), ("b", 1, "d")]
    seqs = rows(spark.read.parquet(f"{base}/data"), "k", sinks.SEQ)
    assert ("a", 2) in seqs and ("b", 1) in seqs
    assert M.publish(spark, base, M.load(spark, base)) is False


def _feed(spark, base, slices, start):
    for recs in slices:
        TP.write_topic_dir(spark.createDataFrame(recs, "key string, value string, topic string, timestamp timestamp"),
                           f"{base}/src")
        jobs.run_until_done(start(TP.read_topic_dir(spark, f"{base}/src", stream=True)), 120)


def _remove_last(folder, is_name):
    """Remove the last of the numbered files of a folder, and its checksum."""
    folder = folder.removeprefix("file://")
    last = max(n for n in os.listdir(folder) if is_name(n))
    for name in (last, f".{last}.crc"):
        if os.path.exists(f"{folder}/{name}"):
            os.remove(f"{folder}/{name}")


def _undo_last_commit(base):
    """What a stop after the sinks and before the commit leaves behind."""
    _remove_last(f"{base}/ck/commits", str.isdigit)


def test_cdc_job_with_a_replayed_batch(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    base = scratch_path(spark, "t_cdc")
    t = dt.datetime(2024, 1, 1)

    def change(table, kind, data, database="shop", entry="ROWDATA"):
        return (None, json.dumps({"database": database, "table": table, "type": kind, "entry_type": entry, "data": data}),
                "feed", t)
    slices = [
        [change("order_info", "INSERT", [{"id": "1"}]), change("order_info", "UPDATE", [{"id": "1"}]),
         change("order_info", "INSERT", []), change("order_info", "INSERT", [{"id": "9"}], database="other")],
        [change("order_detail", "INSERT", [{"id": "1-1", "order_id": "1"}, {"id": "1-2", "order_id": "1"}]),
         change("order_info", "INSERT", [{"id": "8"}], entry="TRANSACTIONBEGIN"), (None, "not json", "feed", t)],
        [change("order_info", "INSERT", [{"id": "2"}]), change("user_info", "INSERT", [{"id": "5"}])]]

    def start(src):
        return jobs.cdc_job(src, f"{base}/out", f"{base}/ck", NOW)
    kind = "key string, value string, topic string, month string"
    table = lambda name: rows(sinks.read_table(spark, f"{base}/out/{name}", kind), "key", "value")
    want = {C.ORDER_INFO_TOPIC: [("1", '{"id":"1"}'), ("2", '{"id":"2"}')],
            C.ORDER_DETAIL_TOPIC: [("1", '{"id":"1-1","order_id":"1"}'), ("1", '{"id":"1-2","order_id":"1"}')]}
    _feed(spark, base, slices, start)
    assert {n: table(n) for n in want} == want
    _undo_last_commit(base)
    jobs.run_until_done(start(TP.read_topic_dir(spark, f"{base}/src", stream=True)), 120)
    assert {n: table(n) for n in want} == want
    # a stop between the two tables: only one of them has the last batch
    _remove_last(f"{base}/out/{C.ORDER_INFO_TOPIC}/_manifest", lambda n: n.startswith("v"))
    _undo_last_commit(base)
    jobs.run_until_done(start(TP.read_topic_dir(spark, f"{base}/src", stream=True)), 120)
    assert {n: table(n) for n in want} == want


def test_log_intake_job_fans_out_once(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    base = scratch_path(spark, "t_intake")
    t = dt.datetime(2024, 1, 1, 12)
    lines = ['{"logType":"startup","mid":"m1","ts":1}', '{"logType":"event","mid":"m2","itemId":7}', "broken", None]
    slices = [[(None, v, "raw", t)] for v in lines]

    def start(src):
        return jobs.log_intake_job(src, f"{base}/out", f"{base}/ck", NOW)
    _feed(spark, base, slices, start)
    _undo_last_commit(base)
    jobs.run_until_done(start(TP.read_topic_dir(spark, f"{base}/src", stream=True)), 120)
    kind = "key string, value string, day string"
    table = lambda n: rows(sinks.read_table(spark, f"{base}/out/{n}", kind), "key", "value")
    assert table(C.STARTUP_TOPIC) == [("m1", '{"logType":"startup","mid":"m1","ts":1704110400000}')]
    assert table(C.EVENT_TOPIC) == [("m2", '{"itemId":7,"logType":"event","mid":"m2","ts":1704110400000}')]
    assert table(C.DEAD_TOPIC) == [(None, "broken"), (None, None)]
    assert sinks.read_table(spark, f"{base}/out/{jobs.ARCHIVE}", "value string, day string").count() == 4


def test_new_device_job_reads_only_the_dates_of_a_batch(spark, monkeypatch):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    base = scratch_path(spark, "t_new")
    day = 86_400_000
    start = lambda m, u, ts: json.dumps({"mid": m, "uid": u, "logType": "startup", "ts": ts})
    t0, t = 1704067200000, dt.datetime(2024, 1, 1)
    slices = [[(None, start("m1", "1", t0 + 5000), "s", t), (None, start("m2", "1", t0 + day), "s", t)],
              [(None, start("m1", "9", t0), "s", t)],  # earlier, but it comes later
              [(None, start("m1", "1", t0 + day + 7), "s", t), (None, start("m2", "2", t0 + day + 9), "s", t)]]
    asked, plain = [], sinks.read_table

    def noted(spark, path, schema, partitions=None):
        asked.append(sorted(partitions))
        return plain(spark, path, schema, partitions)
    monkeypatch.setattr(sinks, "read_table", noted)
    _feed(spark, base, slices, lambda src: jobs.new_device_job(src, f"{base}/dau", f"{base}/ck", NOW))
    assert asked == [["logdate=2024-01-01", "logdate=2024-01-02"], ["logdate=2024-01-01"], ["logdate=2024-01-02"]]
    got = rows(plain(spark, f"{base}/dau", "mid string, uid string, ts long, logdate string"), "mid", "uid", "ts")
    assert got == [("m1", "1", t0 + 5000), ("m1", "1", t0 + day + 7), ("m2", "1", t0 + day)]


def test_generated_ids_are_the_same_in_a_replay_and_keep_equal_documents_apart(spark):
    docs = spark.createDataFrame([(None, "a", 1), (None, "a", 1), (None, "a", None), ("given", "a", 1), (None, "b", 2)],
                                 "doc_id string, text string, n int")
    ids = lambda df, batch=0, writer="w": rows(documents.with_ids(df, "doc_id", writer, batch), "doc_id", "text", "n")
    got = ids(docs)
    assert len(got) == 5 and len({r[0] for r in got}) == 5 and ("given", "a", 1) in got
    assert ids(docs.repartition(4)) == got
    assert not {r[0] for r in ids(docs, 1)} & {r[0] for r in got} - {"given"}
    assert not {r[0] for r in ids(docs, 0, "v")} & {r[0] for r in got} - {"given"}
    assert ids(docs.limit(0)) == []


def test_versioned_dimension_is_reloaded_only_for_a_new_version(spark):
    base = scratch_path(spark, "t_dim")
    users = lambda level: spark.createDataFrame([("u1", level)], "id string, user_level string")
    dim = Dimension(spark, base, "id string, user_level string, valid_from_ms long")
    assert dim.current()[0].count() == 0 and dim.current()[1] == []
    add_version(users("1"), base, 100)
    assert dim.current()[1] == [100] and dim.current()[0].count() == 1 and dim.loads == 2
    add_version(users("1"), base, 100)  # known already
    dim.current()
    assert dim.loads == 2
    add_version(users("2"), base, 200)
    assert rows(dim.current()[0], "user_level", "valid_from_ms") == [("1", 100), ("2", 200)]
    assert dim.current()[1] == [100, 200] and dim.loads == 3



def test_hot_order_is_split_by_both_outer_joins(spark, hot=4000):
    """One order on a third of the lines: its lines are dealt to several tasks."""
    from shopstream.operators import joins
    small = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
             "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in small}
    t = F.lit("2024-01-01 00:00:00").cast("timestamp")
    info = spark.range(2 * hot).select(
        F.col("id").cast("string").alias("id"), F.lit("1").alias("order_status"), F.lit("2024-01-01").alias("create_time"),
        F.lit("u").alias("user_id"), F.lit("b").alias("batch"), t.alias("timestamp"))
    # several map outputs, so that a reducer's share can be cut between them
    detail = spark.range(0, 3 * hot, 1, 16).select(
        F.col("id").cast("string").alias("id"), F.when(F.col("id") % 3 == 0, "7").otherwise(
            (F.col("id") + 10).cast("string")).alias("order_id"), F.lit("s").alias("sku_id"), F.lit("n").alias("sku_name"),
        F.lit("1").alias("order_price"), F.lit("b").alias("batch"), t.alias("timestamp"))
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        both = joins.full_outer_by_batch(info, detail)
        lone = joins.orphans(info, detail)
        got, alone = rows(both), rows(lone)
        for df in (both, lone):
            assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    heads = {str(i) for i in range(2 * hot)}
    lines = [(str(i), "7" if i % 3 == 0 else str(i + 10)) for i in range(3 * hot)]
    want = [(o, d, "b", o in heads, True) for d, o in lines]
    want += [(h, None, "b", True, False) for h in heads - {o for _, o in lines}]
    key = lambda r: [(v is None, "" if v is None else v) for v in r]
    assert got == sorted(want, key=key)
    assert alone == sorted([("order_detail", d, o) for d, o in lines if o not in heads]
                           + [("order_info", h, h) for h in heads - {o for _, o in lines}])


def test_a_batch_writes_few_files(spark):
    """A partition's rows meet in one task, whatever tasks reduced the keys."""
    base, coalesce = scratch_path(spark, "t_files"), "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(coalesce)
    spark.conf.set(coalesce, "false")
    try:
        put(spark, base, 0, *[(f"k{i}", i, [None, "d1", "d2"][i % 3]) for i in range(60)])
    finally:
        spark.conf.set(coalesce, old)
    files = [f for s in M.children(spark, f"{base}/data") for p in M.children(spark, s.getPath().toString())
             if p.isDirectory() for f in M.children(spark, p.getPath().toString()) if f.getPath().getName().endswith(".parquet")]
    assert len(files) == 3
    assert len(read(spark, base)) == 60
