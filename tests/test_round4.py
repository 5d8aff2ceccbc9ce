"""State that holds rows is cut into partitions by its rows, and executors keep
only the partitions at work; a join's slices arrive in parts."""

import datetime as dt
import json
import os

import pyarrow as pa
from pyspark.sql import functions as F

from shopstream.llm import suffix_dedup
from shopstream.operators import joins, parse
from shopstream.plans import streamed
from shopstream.streaming import jobs
from shopstream.streaming.ttl_buffer import ttl_buffer

from .conftest import rows

T0 = dt.datetime(2024, 1, 1)
TOPIC = "key string, value string, topic string, timestamp timestamp"
UNLOAD = "spark.sql.streaming.stateStore.unloadOnCommit"


def test_state_partitions_follow_the_rows(spark, monkeypatch):
    topic = spark.range(200).select(F.concat(F.lit("k"), F.col("id") % 90).alias("key"), F.col("id").cast("string").alias("value"),
                                    F.lit("t").alias("topic"), (F.lit(T0) + F.make_dt_interval(days="id")).alias("timestamp"))
    bases, old = [], {c: spark.conf.get(c, None) for c in (UNLOAD, "spark.sql.shuffle.partitions")}
    path = streamed.scratch_path
    monkeypatch.setattr(streamed, "scratch_path", lambda s, name: bases.append(path(s, name)) or bases[-1])
    monkeypatch.setattr(streamed, "STATE_ROWS", 5)
    monkeypatch.setattr(streamed.TB, "table", lambda *a: topic)
    monkeypatch.setattr(streamed.TB, "order_line_puts", lambda t: t)
    got = streamed.q_ttl_cache_state(spark, "")
    assert len([d for d in os.listdir(bases[0].removeprefix("file://") + "/ck/state/0") if d.isdigit()]) == 10
    assert {c: spark.conf.get(c, None) for c in old} == old
    assert rows(got) == rows(ttl_buffer(topic, "key", "value", "timestamp", streamed.P.JOIN_INTERVAL_MS)) and got.count() == 200


def test_row_state_settings_hold_inside_only(spark):
    topics = {"src": spark.createDataFrame([("k", "v", "t", None)], TOPIC)}
    with streamed.row_state(spark, topics):
        assert spark.conf.get(UNLOAD) == "true"
    assert spark.conf.get(UNLOAD, "false") == "false"


def test_parts_are_bounded_and_in_order():
    counts = {0: 5, 1: 5, 2: 9, 2000: 30, 4095: 1}
    parts = streamed._parts(counts, 4, 10)
    assert [p for p, _ in parts] == sorted(p for p, _ in parts) and [s for _, s in parts] == sorted(s for _, s in parts)
    assert {s for _, s in parts} == {0, 1, 2, 3}
    ends = [p for p, _ in parts[1:]] + [streamed.STEPS]
    held = [[c for s, c in counts.items() if a <= s < b] for (a, _), b in zip(parts, ends)]
    assert sum(map(len, held)) == len(counts) and all(sum(h) <= 10 or len(h) == 1 for h in held)


def test_a_joins_slice_arrives_in_parts(spark, monkeypatch):
    """Lines that meet an earlier header, a later one, none, and without a
    time; more rows than a batch takes, so that several parts make a slice."""
    day = dt.timedelta(days=1)
    info = [(None, json.dumps({"id": f"o{k}"}), "t", T0 + k * day) for k in range(0, 200, 2)] + [(None, '{"id":"n"}', "t", None)]
    line = [(None, json.dumps({"id": f"l{k}", "order_id": f"o{k}"}), "t", T0 + (k + (k % 80) - 40) * day) for k in range(200)]
    topics = {"info": spark.createDataFrame(info, TOPIC), "detail": spark.createDataFrame(line, TOPIC)}
    sides = (parse.parse_order_info(topics["info"]), parse.parse_order_detail(topics["detail"]))
    batches, wait = [], jobs.run_until_done
    monkeypatch.setattr(streamed, "CORE_ROWS", 5)
    monkeypatch.setattr(streamed, "_order_topics", lambda *a: topics)
    monkeypatch.setattr(streamed.jobs, "run_until_done", lambda q: batches.append(
        [p.numInputRows for p in q.recentProgress if p.numInputRows]) or wait(q))
    got = streamed.q_sale_join_stream(spark, "").select("order_detail_id", "order_id")
    assert rows(got) == rows(joins.interval_join(*sides, streamed.P.JOIN_INTERVAL).select("order_detail_id", "order_id"))
    assert len(batches) == streamed.P.SLICES and all(len(b) > 1 for b in batches) and max(map(max, batches)) <= 25
    alone = rows(streamed.q_sale_unmatched_stream(spark, ""), "side", "id", "order_id")
    assert alone == rows(joins.orphans(*sides, streamed.P.JOIN_INTERVAL).where("id != 'n'"), "side", "id", "order_id")


def test_a_worker_gets_a_few_shards_at_once(spark):
    """A partition of 24 MB comes in batches of a few MB, not as one."""
    shards = spark.range(24, numPartitions=1).select(F.repeat(F.lit("x"), 1 << 20).cast("binary").alias("blob"))

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.nbytes]})

    with suffix_dedup._small_batches(spark):
        got = [r["n"] for r in shards.mapInArrow(sizes, "n long").collect()]
    assert sum(got) >= 24 << 20 and max(got) <= 6 << 20
