"""Registered queries of the streaming jobs.

Each replays a topic derived from the driver tables as a stream: the topic
is cut into time-ordered slices, the job sees one slice more at a time and is
restarted from its checkpoint with ``availableNow``, so every slice is one
micro-batch and every batch after the first is a restart. The query returns
the job's sink table, which must equal the batch twin.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import ExitStack, contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import constants as C
from .. import schemas as S
from ..operators import alerts, dedupe, parse
from ..session import pin_utc, scratch_path
from ..sinks import tables as sinks
from ..sources import tables as TB
from ..sources import topic as TP
from ..sources.dimension import Dimension, add_version
from ..streaming import jobs
from ..streaming.ttl_buffer import ttl_buffer
from . import params as P
from .feeds import raw_lines
from .queries import users

SALE_SCHEMA = ("order_detail_id string, order_id string, order_status string, create_time string, user_id string, "
               "sku_id string, sku_price double, sku_name string, dt string")
AVAILABLE_NOW = {"availableNow": True}
AS_IT_COMES = {"processingTime": "0 seconds"}
#: Rows that one partition of a state takes in a batch, about 1 KB of heap each.
STATE_ROWS = 100_000
#: A task loads its partition of the state, and leaves it to the checkpoint
#: when it is done; every second version is written as a whole.
STATE_SETTINGS = {"spark.sql.streaming.stateStore.unloadOnCommit": "true",
                  "spark.sql.streaming.stateStore.minDeltasForSnapshot": "2",
                  "spark.sql.streaming.maxBatchesToRetainInMemory": "1"}


@contextmanager
def state_partitions(spark, count: int | None = P.STATE_PARTITIONS):
    """Size the state store (``count``, or one partition per core of the
    cluster) while a job's checkpoint is created; the count is fixed in the
    checkpoint from then on. The session's own setting is restored afterwards."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(count or spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


@contextmanager
def _setting(spark, name: str, value: str):
    old = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if old is None else spark.conf.set(name, old)


def heartbeat(spark, us: int, after: str, value: Column) -> DataFrame:
    """One topic row later than all others (the last is at ``us``) by ``after``:
    it moves the watermark past every open window. Its own window stays open
    and is never emitted. ``value`` may use ``t``, the time of the last row."""
    return spark.range(1).select(F.timestamp_micros(F.lit(us)).alias("t")).select(
        F.lit(None).cast("string").alias("key"), value.alias("value"), F.lit("heartbeat").alias("topic"),
        (F.col("t") + F.expr(f"INTERVAL {after}")).alias("timestamp"))


def _slice_at(lo: int, hi: int, n: int, time_col: str) -> Column:
    """The slice of a row; null for a row without a time."""
    return F.floor((F.unix_micros(time_col) - F.lit(lo)) / F.lit((hi - lo) // n + 1)).cast("int")


def _times(topics: dict[str, DataFrame], time_col: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [f.select(F.col(time_col).alias("t")) for f in topics.values()])


def _span(times: DataFrame) -> tuple[int | None, int | None]:
    return times.agg(F.min(F.unix_micros("t")), F.max(F.unix_micros("t"))).first()


@contextmanager
def row_state(spark, topics: dict[str, DataFrame], n: int = P.SLICES, count: int | None = P.STATE_PARTITIONS,
              time_col: str = "timestamp"):
    """``state_partitions`` for a job whose state holds the rows themselves:
    so many partitions that each gets ``STATE_ROWS`` rows of the largest slice,
    of which an executor holds only those that its tasks are at work on."""
    times = _times(topics, time_col)
    lo, hi = _span(times)
    if count is None and lo is not None:
        most = times.groupBy(_slice_at(lo, hi, n, "t").alias("k")).count().agg(F.max("count")).first()[0]
        count = max(spark.sparkContext.defaultParallelism, -(-most // STATE_ROWS))
    with ExitStack() as held:
        held.enter_context(state_partitions(spark, count))
        for name, value in STATE_SETTINGS.items():
            held.enter_context(_setting(spark, name, value))
        yield


def replay(spark, base: str, topics: dict[str, DataFrame], last: Callable[[int], DataFrame] | None = None,
           n: int = P.SLICES, time_col: str = "timestamp"):
    """Topics cut into ``n`` slices of equal time span over their common range;
    yields, slice by slice, the streams of what has arrived so far. Each topic
    is made once and dealt to one folder per slice. ``last`` gives, from the
    microseconds of the last row, the row that every topic ends with."""
    lo, hi = _span(_times(topics, time_col))
    # rows without a time come with the first slice
    at = F.lit(0) if lo is None else F.coalesce(_slice_at(lo, hi, n, time_col), F.lit(0))
    with _setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(n)):
        for name, topic in topics.items():
            TP.write_topic_slices(topic, f"{base}/{name}", at, n)
            if last and hi is not None:
                TP.write_topic_dir(last(hi), TP.slice_dir(f"{base}/{name}", n))
    for k in range(n + bool(last)):
        yield [TP.read_topic_slices(spark, f"{base}/{name}", k) for name in topics]


#: Rows for each core that a join's state takes in a batch, about 0.5 KB of
#: heap each, and the parts of a topic's span whose rows are counted for that.
CORE_ROWS, STEPS = 250_000, 4096
#: An executor keeps the newest version of a join's state; older ones are in the
#: checkpoint. After a restart, the stores of the stopped run may still write the
#: same version as the new ones, in another order: both are right, but Spark
#: would take the second for a damaged file.
JOIN_SETTINGS = {"spark.sql.streaming.maxBatchesToRetainInMemory": "1",
                 "spark.sql.streaming.checkpoint.fileChecksum.enabled": "false"}


def _parts(counts: dict[int, int], n: int, most: int) -> list[tuple[int, int]]:
    """(first step, slice) of the parts of ``n`` slices, the steps of equal
    spans: a part ends before it would have more than ``most`` rows."""
    out, rows = [(0, 0)], 0
    for step in range(STEPS):
        now, count = step * n // STEPS, counts.get(step, 0)
        if now != out[-1][1] or rows and rows + count > most:
            out.append((step, now))
            rows = 0
        rows += count
    return out


def paced(spark, base: str, topics: dict[str, DataFrame], last: Callable[[int], DataFrame] | None = None,
          n: int = P.SLICES, time_col: str = "timestamp") -> Iterator[tuple[list[DataFrame], Callable[[StreamingQuery], None]]]:
    """``replay`` for joins, whose state holds the rows of a batch: a slice
    arrives in parts, in the order of time, that have ``CORE_ROWS`` rows for
    each core. Yields, slice by slice, the streams and a function that feeds the
    started query part by part and stops it; so every slice is still a restart.
    A part is moved to the watched folder as a whole."""
    times = _times(topics, time_col)
    lo, hi = _span(times)
    parts, at = [(0, k) for k in range(n)], F.lit(0)
    if lo is not None:
        steps = times.groupBy(_slice_at(lo, hi, STEPS, "t").alias("k")).count().where("k is not null").collect()
        parts = _parts(dict(steps), n, CORE_ROWS * spark.sparkContext.defaultParallelism)
        of_step = [k for k, (a, b) in enumerate(zip(parts, [*parts[1:], (STEPS, n)])) for _ in range(b[0] - a[0])]
        at = F.coalesce(F.element_at(F.array(*map(F.lit, of_step)), _slice_at(lo, hi, STEPS, time_col) + 1), at)
    with _setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(len(parts))):
        for name, topic in topics.items():
            TP.write_topic_slices(topic, f"{base}/{name}/waiting", at, len(parts))
            if last and hi is not None:
                TP.write_topic_dir(last(hi), TP.slice_dir(f"{base}/{name}/waiting", len(parts)))
    if last:
        parts = [*parts, (STEPS, n)]
    for k in range(n + bool(last)):
        mine = [p for p, (_, slice_) in enumerate(parts) if slice_ == k]

        def arrive(part: int) -> None:
            for name in topics:
                TP.move_slice(spark, f"{base}/{name}/waiting", f"{base}/{name}", part)

        def feed(q: StreamingQuery, mine=mine) -> None:
            for part in mine[1:]:
                q.processAllAvailable()
                arrive(part)
            q.processAllAvailable()
            q.stop()
            jobs.run_until_done(q)

        arrive(mine[0])
        yield [TP.read_topic_slices(spark, f"{base}/{name}") for name in topics], feed


@contextmanager
def join_state(spark):
    """``state_partitions`` of a join, with its settings."""
    with ExitStack() as held:
        held.enter_context(state_partitions(spark))
        for name, value in JOIN_SETTINGS.items():
            held.enter_context(_setting(spark, name, value))
        yield


def q_dau_stream(spark, sf):
    pin_utc(spark)
    base = scratch_path(spark, "dau_stream")
    topic = TB.startup_topic(TB.table(spark, sf, "events"))
    with state_partitions(spark):
        for (src,) in replay(spark, base, {"src": topic}):
            jobs.run_until_done(jobs.dau_job(src, f"{base}/dau", f"{base}/ck", AVAILABLE_NOW))
    schema = dedupe.dau_rows(spark.createDataFrame([], _startup_schema(spark))).schema
    return sinks.read_keyed(spark, f"{base}/dau", schema, dedupe.DAU_KEY, dedupe.DAU_ORDER, "first").select(
        *S.DAU_COLUMNS)


def _startup_schema(spark):
    empty = spark.createDataFrame([], "value string, timestamp timestamp")
    return parse.parse_startup(empty).schema


def _order_topics(spark, sf):
    return {"info": TB.order_info_topic(TB.table(spark, sf, "orders")),
            "detail": TB.order_detail_topic(TB.table(spark, sf, "lineitem"))}


def q_sale_join_stream(spark, sf):
    pin_utc(spark)
    base = scratch_path(spark, "sale_join_stream")
    with join_state(spark):
        for (info, detail), feed in paced(spark, base, _order_topics(spark, sf)):
            q = jobs.sale_join_job(info, detail,
                                   f"{base}/out", f"{base}/ck", P.JOIN_INTERVAL, "1 day", AS_IT_COMES)
            feed(q)
    return spark.read.schema(SALE_SCHEMA).parquet(f"{base}/out")


def q_sale_enriched_stream(spark, sf):
    pin_utc(spark)
    base = scratch_path(spark, "sale_enriched_stream")
    with join_state(spark):
        for (info, detail), feed in paced(spark, base, _order_topics(spark, sf)):
            q = jobs.sale_detail_job(info, detail,
                                     lambda: users(spark, sf), f"{base}/out", f"{base}/ck",
                                     P.JOIN_INTERVAL, "1 day", P.AS_OF, AS_IT_COMES)
            feed(q)
    schema = T._parse_datatype_string(SALE_SCHEMA + ", user_gender string, user_age int, user_level string")
    return sinks.read_table(spark, f"{base}/out", schema)


DOC_SCHEMA = ("doc_id string, mid string, uids array<string>, item_ids array<string>, events array<string>, "
              "ts long, doc_date string")


def q_alert_stream(spark, sf):
    pin_utc(spark)
    base = scratch_path(spark, "alert_stream")
    topic = TB.event_topic(TB.table(spark, sf, "events"))
    after = "2 days"
    late = F.to_json(F.struct(F.lit("").alias("mid"), F.unix_millis(F.col("t") + F.expr(f"INTERVAL {after}")).alias("ts")))

    def stored(lo: int, hi: int) -> DataFrame:
        span = TP.read_topic_slices(spark, f"{base}/src", stream=False).where(
            (F.col("timestamp") >= F.timestamp_millis(F.lit(lo))) & (F.col("timestamp") < F.timestamp_millis(F.lit(hi))))
        return parse.parse_event(span)

    with state_partitions(spark):
        for (src,) in replay(spark, base, {"src": topic}, lambda us: heartbeat(spark, us, after, late)):
            q = jobs.alert_job(src, stored, f"{base}/docs",
                               f"{base}/ck", P.WINDOW, P.SLIDE, "1 minute", bucket_ms=P.DOC_BUCKET_MS,
                               trigger=AVAILABLE_NOW)
            jobs.run_until_done(q)
    docs = sinks.read_keyed(spark, f"{base}/docs", T._parse_datatype_string(DOC_SCHEMA), ["doc_id"], ["ts"])
    return alerts.as_text(docs.select("doc_id", "mid", "uids", "item_ids", "events", "ts"),
                          ["uids", "item_ids", "events"])


def q_ttl_cache_state(spark, sf):
    """Order lines buffered per key ``order_id:id`` with a 30-day
    expiry (scaled from 30 min); a re-sent line renews the buffered one.
    Returns every entry that the replay expires, which is all of them: a
    heartbeat moves the watermark past the last."""
    pin_utc(spark)
    base = scratch_path(spark, "ttl_cache_state")
    topics = {"src": TB.order_line_puts(TB.table(spark, sf, "lineitem"))}
    with row_state(spark, topics):
        for (src,) in replay(spark, base, topics, lambda us: heartbeat(spark, us, "90 days", F.lit(""))):
            q = (ttl_buffer(src, "key", "value", "timestamp", P.JOIN_INTERVAL_MS, "1 day").writeStream
                 .format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/ck")
                 .outputMode("append").trigger(availableNow=True).start())
            jobs.run_until_done(q)
    return spark.read.schema("key string, value string, put_ms long, expired_ms long").parquet(f"{base}/out")


def q_order_stream(spark, sf):
    """K2: the order job over a replayed topic, read back one row per id."""
    pin_utc(spark)
    base = scratch_path(spark, "order_stream")
    topic = TB.order_info_topic(TB.table(spark, sf, "orders"))
    with state_partitions(spark):
        for (src,) in replay(spark, base, {"src": topic}):
            jobs.run_until_done(jobs.order_job(src, f"{base}/orders", f"{base}/ck", AVAILABLE_NOW))
    schema = parse.parse_order_info(spark.createDataFrame([], "value string")).schema.add("ingest_ms", "long")
    back = sinks.read_keyed(spark, f"{base}/orders", schema, ["id"], ["ingest_ms"])
    return back.select(*S.ORDER_INFO_FIELDS, "create_date", "create_hour")


def _lone_heartbeat(spark, us: int, after: str = "90 days") -> DataFrame:
    """A last header or line of an order of its own, behind the later of both
    topics by more than the interval; it stays open itself."""
    return heartbeat(spark, us, after, F.to_json(F.struct(F.lit("heartbeat").alias("id"),
                                                      F.concat(F.lit("of-"), F.col("t").cast("string")).alias("order_id"))))


def q_sale_unmatched_stream(spark, sf):
    """J6 as a stream: headers and lines without a partner, as they expire."""
    pin_utc(spark)
    base = scratch_path(spark, "sale_unmatched_stream")
    with join_state(spark):
        for (info, detail), feed in paced(spark, base, _order_topics(spark, sf), lambda us: _lone_heartbeat(spark, us)):
            q = jobs.unmatched_job(info, detail,
                                   f"{base}/out", f"{base}/ck", P.JOIN_INTERVAL, "1 day", AS_IT_COMES)
            feed(q)
    return spark.read.schema("side string, id string, order_id string").parquet(f"{base}/out")


def q_buffer_drain_stream(spark, sf):
    """The consume-once buffer: lines that met their header within the
    lifetime, and headers and lines that expired alone."""
    pin_utc(spark)
    base = scratch_path(spark, "buffer_drain_stream")
    with join_state(spark):
        for (info, detail), feed in paced(spark, base, _order_topics(spark, sf), lambda us: _lone_heartbeat(spark, us)):
            feed(jobs.drain_job(
                info, detail,
                f"{base}/out", f"{base}/ck", P.JOIN_INTERVAL_MS, "1 day", AS_IT_COMES))
    return spark.read.schema("kind string, order_id string, id string").parquet(f"{base}/out")


MESSAGE_SCHEMA = "key string, value string, topic string, timestamp timestamp"


def q_cdc_stream(spark, sf):
    """The change feed through the streaming job: statements of
    other databases, transaction markers, other types, statements without rows
    and with many."""
    pin_utc(spark)
    base = scratch_path(spark, "cdc_stream")
    feed = TB.change_log(TB.table(spark, sf, "orders"), TB.table(spark, sf, "lineitem"), TB.table(spark, sf, "customer"))
    for (src,) in replay(spark, base, {"src": feed}):
        jobs.run_until_done(jobs.cdc_job(src, f"{base}/out", f"{base}/ck", AVAILABLE_NOW))
    tables = [sinks.read_table(spark, f"{base}/out/{t}", MESSAGE_SCHEMA + ", month string") for t in sorted(C.CDC_TABLE_TOPICS.values())]
    return tables[0].unionByName(tables[1]).select("topic", "key", "value")


def q_log_intake_stream(spark, sf):
    """Raw lines, good and bad, through the intake job: every
    topic's table and the archive, row by row."""
    pin_utc(spark)
    base = scratch_path(spark, "log_intake_stream")
    lines = raw_lines(spark, sf).select(F.lit(None).cast("string").alias("key"), "value",
                                        F.lit("raw").alias("topic"), "timestamp")
    for (src,) in replay(spark, base, {"src": lines}):
        jobs.run_until_done(jobs.log_intake_job(src, f"{base}/out", f"{base}/ck", AVAILABLE_NOW))
    topics = [sinks.read_table(spark, f"{base}/out/{t}", MESSAGE_SCHEMA + ", day string").select(
        F.lit(t).alias("sink"), "key", "value", "day") for t in jobs.LOG_TABLES]
    archive = sinks.read_table(spark, f"{base}/out/{jobs.ARCHIVE}", "value string, day string").select(
        F.lit(jobs.ARCHIVE).alias("sink"), F.lit(None).cast("string").alias("key"), "value", "day")
    return topics[0].unionByName(topics[1]).unionByName(topics[2]).unionByName(archive)


def q_dau_new_devices_stream(spark, sf):
    """First arrivals, judged by the stored table. The afternoons
    arrive before the mornings, so an earlier start that comes later is not new."""
    pin_utc(spark)
    base = scratch_path(spark, "dau_new_devices_stream")
    topic = TB.startup_topic(TB.table(spark, sf, "events"))
    late = F.date_format("timestamp", "HH") >= P.SEEN_BEFORE_HOUR
    for name, part in (("late", topic.where(late)), ("early", topic.where(~late))):
        for (src,) in replay(spark, base, {name: part}, n=2):
            jobs.run_until_done(jobs.new_device_job(src, f"{base}/dau", f"{base}/ck", AVAILABLE_NOW))
    schema = dedupe.dau_rows(spark.createDataFrame([], _startup_schema(spark))).schema
    return sinks.read_keyed(spark, f"{base}/dau", schema, dedupe.DAU_KEY, dedupe.DAU_ORDER, "first").select(
        *S.DAU_COLUMNS)


USER_SCHEMA = "id string, login_name string, user_level string, birthday string, gender string, valid_from_ms long"


def q_sale_versions_stream(spark, sf):
    """The sale job with a versioned user dimension: two editions of the
    users arrive as JSON, and a sale gets the edition of its create time."""
    pin_utc(spark)
    base = scratch_path(spark, "sale_versions_stream")
    customer = TB.table(spark, sf, "customer")
    for edition, valid in enumerate((0, P.USERS_CHANGE_MS)):
        lines = parse.to_json_value(TB.user_info(customer, edition))
        add_version(parse.parse_user_info(lines), f"{base}/users", valid)
    dimension = Dimension(spark, f"{base}/users", USER_SCHEMA)
    with join_state(spark):
        for (info, detail), feed in paced(spark, base, _order_topics(spark, sf)):
            q = jobs.sale_detail_job(info, detail, dimension,
                                     f"{base}/out", f"{base}/ck", P.JOIN_INTERVAL, "1 day", P.AS_OF, AS_IT_COMES)
            feed(q)
    schema = T._parse_datatype_string(SALE_SCHEMA + ", user_gender string, user_age int, user_level string")
    return sinks.read_table(spark, f"{base}/out", schema)
