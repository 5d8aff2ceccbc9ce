"""Registered queries of the topic source, the change feed and the log collector."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import cdc, ingest, parse
from ..session import pin_utc, scratch_path
from ..sources import tables as TB
from ..sources import topic as TP


def _changes(spark, sf):
    return TB.change_feed(TB.table(spark, sf, "orders"), TB.table(spark, sf, "lineitem"),
                          TB.table(spark, sf, "customer"))


def q_topic_scan(spark, sf):
    """Event logs written as text lines, scanned back line by line."""
    pin_utc(spark)
    path = scratch_path(spark, "topic_scan")
    TP.write_lines(TB.event_topic(TB.table(spark, sf, "events")), path)
    lines = parse.parse_event(TP.read_lines(spark, path))
    return lines.select("mid", "uid", F.col("eventId").alias("eventid"), F.col("pageId").alias("pageid"),
                        F.col("nextPageId").alias("nextpageid"), F.col("itemId").alias("itemid"), "ts")


def q_cdc_insert_only(spark, sf):
    pin_utc(spark)
    return cdc.wanted_changes(_changes(spark, sf)).select(
        "database", "table", "type", F.size("data").alias("n_rows"), "change_key")


def q_cdc_rows(spark, sf):
    pin_utc(spark)
    return cdc.to_topics(_changes(spark, sf))


def q_cdc_route(spark, sf):
    pin_utc(spark)
    return cdc.to_topics(_changes(spark, sf)).groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


def _stamped(spark, sf):
    logs = TB.raw_app_logs(TB.table(spark, sf, "events"))
    arrival = F.col("client_time") + F.expr("INTERVAL 1 SECOND")
    return ingest.stamp(logs.withColumn("timestamp", arrival), now=F.col("timestamp"))


def _dirty_logs(spark, sf):
    """Raw logs in which error events came as malformed, blank or repeated-key lines."""
    ev = TB.table(spark, sf, "events")
    raw = F.when(F.col("event_type") == "error", F.element_at(F.array(
        F.concat(F.lit("not json "), F.col("event_id").cast("string")), F.lit("  "), F.lit('{"a":1,"a":2}')),
        (F.col("event_id") % 3 + 1).cast("int"))).otherwise(F.to_json(TB.event_struct(ev)))
    return ev.select(F.col("event_id"), raw.alias("value"), F.col("ts").cast("timestamp").alias("timestamp"))


def raw_lines(spark, sf):
    """What clients post: startup and event logs, and malformed lines in place
    of error events."""
    ev = TB.table(spark, sf, "events")
    good = F.when(F.col("event_type") == "signup", F.to_json(TB.startup_struct(ev))).otherwise(
        F.to_json(TB.event_struct(ev)))
    dirty = _dirty_logs(spark, sf).select("event_id", F.col("value").alias("bad"))
    return (ev.select("event_id", "event_type", good.alias("good"), F.col("ts").cast("timestamp").alias("timestamp"))
            .join(dirty, "event_id")
            .select(F.when(F.col("event_type") == "error", F.col("bad")).otherwise(F.col("good")).alias("value"),
                    "timestamp"))


def q_event_quarantine(spark, sf):
    """The dead-letter output of a topic with bad lines, whole texts."""
    pin_utc(spark)
    logs = _dirty_logs(spark, sf)
    bad = parse.dead_letters(logs, S.EVENT_FIELDS, keep=("event_id",))
    return bad.select("event_id", "value")


def q_log_stamp_rows(spark, sf):
    """P18/F9 row by row: untouched fields keep their types, bad lines their
    text, and every line its topic."""
    pin_utc(spark)
    r = ingest.route(ingest.stamp(_dirty_logs(spark, sf), now=F.col("timestamp")))
    ok = ~F.col("malformed")
    return r.select("event_id", "topic", "malformed", F.when(~ok, F.col("value")).alias("raw"),
                    F.when(ok, F.get_json_object("value", "$.ts")).alias("ts"),
                    F.when(ok, F.get_json_object("value", "$.mid")).alias("mid"),
                    F.when(ok, F.get_json_object("value", "$.pageId")).alias("page"),
                    F.when(ok, F.col("value").contains('"pageId":"')).alias("page_is_text"))


def q_log_stamp_route(spark, sf):
    """P18 + F9: server time replaces the client's ts, then each log is routed."""
    pin_utc(spark)
    r = ingest.route(_stamped(spark, sf))
    ts = F.get_json_object("value", "$.ts").cast("bigint")
    return r.groupBy("topic").agg(F.count(F.lit(1)).alias("n_logs"), F.min(ts).alias("min_ts"),
                                  F.max(ts).alias("max_ts"), F.sum(ts).alias("sum_ts"))


def q_log_archive_daily(spark, sf):
    """Raw logs rolled into one folder per day, read back per day."""
    pin_utc(spark)
    path = scratch_path(spark, "log_archive")
    (ingest.archive_columns(_stamped(spark, sf)).write.mode("overwrite")
           .partitionBy("logdate").text(path))
    back = spark.read.schema("value string, logdate string").text(path)
    return ingest.route(back).select("logdate", F.get_json_object("value", "$.ts").cast("bigint").alias("ts"), "topic")
