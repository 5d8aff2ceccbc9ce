"""Replayed topics and the append sink make their rows once; the buffer's
joins run on any state store."""

import datetime as dt
import json

from pyspark.sql import functions as F

from shopstream import schemas as S
from shopstream.operators import cdc, joins
from shopstream.plans import queries as Q
from shopstream.plans import streamed
from shopstream.session import scratch_path
from shopstream.sources import topic as TP
from shopstream.streaming import jobs

from .conftest import rows

T0 = dt.datetime(2024, 1, 1)
TOPIC = "key string, value string, topic string, timestamp timestamp"


def _counted(spark, df, col):
    """The frame with a column that counts how often a row is made."""
    made = spark.sparkContext.accumulator(0)

    def once(v):
        made.add(1)
        return v

    return df.withColumn(col, F.udf(once, "string")(col)), made


def test_replay_makes_each_topic_row_once(spark):
    at = [T0 + dt.timedelta(hours=h) for h in (0, 1, 30, 50, 99)] + [None]
    topic, made = _counted(spark, spark.createDataFrame([("k", str(i), "t", t) for i, t in enumerate(at)], TOPIC), "value")
    base, seen = scratch_path(spark, "t_replay"), []
    last = lambda us: streamed.heartbeat(spark, us, "1 hour", F.lit("end"))
    for k, (src,) in enumerate(streamed.replay(spark, base, {"src": topic}, last, 4)):
        q = (src.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/ck")
             .trigger(availableNow=True).start())
        jobs.run_until_done(q, 120)
        seen.append([r[0] for r in rows(spark.read.parquet(f"{base}/out"), "value")])
    assert seen == [["0", "1", "5"], ["0", "1", "2", "5"], ["0", "1", "2", "3", "5"], ["0", "1", "2", "3", "4", "5"],
                    ["0", "1", "2", "3", "4", "5", "end"]]
    assert made.value == len(at)


def test_change_lines_are_parsed_once(spark):
    line = json.dumps({"database": "shop", "table": "order_info", "type": "INSERT", "entry_type": "ROWDATA",
                       "data": [{"id": "1"}]})
    lines = spark.createDataFrame([(line, T0), ("no json", T0), (None, T0)], "value string, timestamp timestamp")
    wanted = cdc.wanted_changes(cdc.parse_changes(lines))
    assert rows(wanted, "table", "type") == [("order_info", "INSERT")]
    plan = wanted._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") + plan.count("jsontostructs") == 1


def test_upsert_roundtrip_parses_once(spark, monkeypatch):
    whole = [c for c in S.ORDER_INFO_FIELDS if c not in ("id", "create_time")]
    infos, made = _counted(spark, spark.createDataFrame(
        [(str(i), f"1997-0{m}-01 {h}:00:00", f"1997-0{m}-01", f"1997-0{m}", h, dt.datetime(1997, m, 1))
         for i, (m, h) in enumerate([(1, "07"), (1, "09"), (2, "15"), (2, "17")])],
        "id string, create_time string, create_date string, create_month string, create_hour string, timestamp timestamp"),
        "create_date")
    infos = infos.select("*", *[F.lit(None).cast("string").alias(c) for c in whole])
    monkeypatch.setattr(Q, "order_infos", lambda *a: infos)
    got = rows(Q.q_sink_upsert_roundtrip(spark, ""), "id", "create_hour")
    assert made.value == 4
    assert got == [("0", "07"), ("1", "09"), ("2", "15"), ("3", "17")]


def test_append_roundtrip_joins_once(spark, monkeypatch):
    infos = spark.createDataFrame(
        [(str(i), "1001", f"{y}-01-01 00:00:00", "u", dt.datetime(y, 1, 1)) for i, y in enumerate((1997, 1998, 1999))],
        "id string, order_status string, create_time string, user_id string, timestamp timestamp")
    details, made = _counted(spark, spark.createDataFrame(
        [(f"{i}-{n}", str(i), "s", "n", "2.5", dt.datetime(y, 1, 2)) for i, y in enumerate((1997, 1998, 1999)) for n in (1, 2)],
        "id string, order_id string, sku_id string, sku_name string, order_price string, timestamp timestamp"), "sku_name")
    monkeypatch.setattr(Q, "order_infos", lambda *a: infos)
    monkeypatch.setattr(Q, "order_details", lambda *a: details)
    got = rows(Q.q_sink_append_roundtrip(spark, ""))
    assert made.value == 6
    assert got == rows(joins.interval_join(infos, details, interval="30 days")) and len(got) == 6


def test_drain_runs_on_the_default_state_store(spark):
    """A line sent twice is emitted twice, a header sent twice drains a line
    once; null ids and rows without a time are alone."""
    conf = "spark.sql.streaming.stateStore.providerClass"
    old, m = spark.conf.get(conf), dt.timedelta(minutes=1)
    spark.conf.set(conf, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    info = [("o1", T0), ("o1", T0), ("o1", T0 + 5 * m), ("o2", T0 + m), (None, T0), ("o3", None), ("end", T0 + 600 * m)]
    line = [("a", "o1", T0 + m), ("a", "o1", T0 + m), ("b", "o1", T0 + 40 * m), ("c", None, T0), ("d", "o3", T0),
            ("e", "o1", T0 + 30 * m), ("z", "last", T0 + 600 * m)]
    topics = [[(None, json.dumps({"id": i}), "t", t) for i, t in info],
              [(None, json.dumps({"id": i, "order_id": o}), "t", t) for i, o, t in line]]
    want = [("sale", "o1", "a"), ("sale", "o1", "a"), ("sale", "o1", "e"), ("order_detail", "o1", "b"),
            ("order_detail", None, "c"), ("order_detail", "o3", "d"), ("order_info", "o2", "o2"),
            ("order_info", None, None), ("order_info", "o3", "o3")]
    try:
        for cuts in ([7], [2, 3, 2]):
            base, at = scratch_path(spark, "t_drain_store"), 0
            for n in cuts:
                for name, recs in zip(("info", "detail"), topics):
                    TP.write_topic_dir(spark.createDataFrame(recs[at:at + n], TOPIC), f"{base}/{name}")
                at += n
                jobs.run_until_done(jobs.drain_job(
                    TP.read_topic_dir(spark, f"{base}/info", stream=True),
                    TP.read_topic_dir(spark, f"{base}/detail", stream=True),
                    f"{base}/out", f"{base}/ck", 30 * 60_000, "1 hour", {"availableNow": True}), 120)
            got = spark.read.schema("kind string, order_id string, id string").parquet(f"{base}/out").collect()
            assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    finally:
        spark.conf.set(conf, old)
