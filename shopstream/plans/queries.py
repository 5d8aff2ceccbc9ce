"""Registered batch queries: each reads the driver tables, derives the
reference's records from them and runs the operators end to end.

Every callable is ``(spark, sf_dir) -> DataFrame`` and reads whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import columns as X
from ..operators import dedupe, documents, joins, kpi, parse
from ..session import materialise, pin_utc, scratch_path
from ..sinks import tables as sinks
from ..sources import tables as TB
from . import params as P


# ------------------------------------------------------------ inputs

def startup_logs(spark: SparkSession, sf: str) -> DataFrame:
    return parse.parse_startup(TB.startup_topic(TB.table(spark, sf, "events")))


def event_logs(spark: SparkSession, sf: str) -> DataFrame:
    return parse.parse_event(TB.event_topic(TB.table(spark, sf, "events")))


def order_infos(spark: SparkSession, sf: str, fields: list[str] | None = None) -> DataFrame:
    return parse.parse_order_info(TB.order_info_topic(TB.table(spark, sf, "orders")), fields=fields)


def order_details(spark: SparkSession, sf: str, fields: list[str] | None = None) -> DataFrame:
    return parse.parse_order_detail(TB.order_detail_topic(TB.table(spark, sf, "lineitem")), fields=fields)


def users(spark: SparkSession, sf: str) -> DataFrame:
    return TB.user_info(TB.table(spark, sf, "customer"))


def dau_table(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe.first_start_per_day(startup_logs(spark, sf))


def stored_dau(spark: SparkSession, sf: str) -> DataFrame:
    """The DAU table as its sink wrote it, one row per (mid, logdate)."""
    path = scratch_path(spark, "dau_table")
    rows = dedupe.dau_rows(startup_logs(spark, sf))
    sinks.upsert(rows, path, dedupe.DAU_KEY, dedupe.DAU_ORDER, "logdate", 0, keep="first")
    return sinks.read_keyed(spark, path, rows.schema, dedupe.DAU_KEY, dedupe.DAU_ORDER, "first")


def stored_orders(spark: SparkSession, sf: str) -> DataFrame:
    """The order table as its sink wrote it, one row per id. An order's create
    time never changes, so its month and date are part of the key and a filter
    on them reaches the scan."""
    path = scratch_path(spark, "order_table")
    rows = order_infos(spark, sf).withColumn("ingest_ms", F.unix_millis("timestamp")).drop("timestamp")
    sinks.upsert(rows, path, ["id"], ["ingest_ms"], "create_month", 0, cluster_by=["create_date"])
    return sinks.read_keyed(spark, path, rows.schema, ["id", "create_month", "create_date"], ["ingest_ms"])


# ------------------------------------------------------------ parsing

def q_startup_parse(spark, sf):
    pin_utc(spark)
    return dedupe.dau_rows(startup_logs(spark, sf))


def _event_columns(events: DataFrame) -> DataFrame:
    return events.select(
        "mid", "uid", F.col("appId").alias("appid"), "area", "os",
        F.col("logType").alias("logtype"), F.col("eventId").alias("eventid"),
        F.col("pageId").alias("pageid"), F.col("nextPageId").alias("nextpageid"),
        F.col("itemId").alias("itemid"), "ts", F.col("log_date").alias("logdate"),
        F.col("log_hour").alias("loghour"))


def q_event_parse(spark, sf):
    pin_utc(spark)
    return _event_columns(event_logs(spark, sf))


def q_order_parse(spark, sf):
    pin_utc(spark)
    return order_infos(spark, sf).select(*S.ORDER_INFO_FIELDS, "create_date", "create_hour")


def q_detail_parse(spark, sf):
    pin_utc(spark)
    return order_details(spark, sf).select(
        *S.ORDER_DETAIL_FIELDS, F.unix_millis("timestamp").alias("arrival_ms"))


def q_json_roundtrip(spark, sf):
    """Typed record -> JSON -> typed record again (P6 then P1), of all events."""
    pin_utc(spark)
    again = parse.parse_event(parse.to_json_value(event_logs(spark, sf), S.EVENT_FIELDS), keep=())
    return _event_columns(again)


def q_log_time_parts(spark, sf):
    pin_utc(spark)
    return event_logs(spark, sf).select(
        "ts", F.col("log_date").alias("logdate"), F.col("log_hour").alias("loghour"))


def q_order_time_parts(spark, sf):
    pin_utc(spark)
    return order_infos(spark, sf).select("id", "create_time", "create_date", "create_hour")


def q_mask_name(spark, sf):
    pin_utc(spark)
    return order_infos(spark, sf).select("id", "consignee")


def q_mask_phone(spark, sf):
    pin_utc(spark)
    return order_infos(spark, sf).select("id", "consignee_tel")


def q_user_age(spark, sf):
    """Ages of all customers."""
    pin_utc(spark)
    return TB.user_info(TB.table(spark, sf, "customer"), segment=None).select("id", "birthday", X.user_age("birthday", P.AS_OF).alias("user_age"))


# --------------------------------------------------------------- DAU

def q_dau_first_start(spark, sf):
    pin_utc(spark)
    return dau_table(spark, sf)


def q_dau_new_devices(spark, sf):
    """Two batches per day: the morning's DAU rows are the seen set; the
    afternoon's logs keep only devices not yet seen that day."""
    pin_utc(spark)
    logs = startup_logs(spark, sf)
    seen = dedupe.first_start_per_day(logs.filter(F.col("log_hour") < P.SEEN_BEFORE_HOUR))
    return dedupe.new_devices(logs.filter(F.col("log_hour") >= P.SEEN_BEFORE_HOUR), seen)


def q_dau_total(spark, sf):
    pin_utc(spark)
    return kpi.dau_total(stored_dau(spark, sf), P.DAU_DATE)


def q_dau_by_hour(spark, sf):
    pin_utc(spark)
    return kpi.dau_by_hour(stored_dau(spark, sf), P.DAU_DATE)


def q_dau_hour_map(spark, sf):
    pin_utc(spark)
    m = kpi.as_map(kpi.dau_by_hour(stored_dau(spark, sf), P.DAU_DATE), "loghour", "dau")
    return m.select(kpi.map_text("hour_map").alias("hour_map"))


# --------------------------------------------------------------- KPI

def q_amount_total(spark, sf):
    pin_utc(spark)
    return kpi.amount_total(stored_orders(spark, sf), P.ORDER_DATE)


def q_amount_total_empty(spark, sf):
    """A date without orders gives 0.0, not null."""
    pin_utc(spark)
    return kpi.amount_total(stored_orders(spark, sf), P.EMPTY_ORDER_DATE)


def q_amount_by_hour(spark, sf):
    pin_utc(spark)
    return kpi.amount_by_hour(stored_orders(spark, sf), P.ORDER_DATE)


def q_amount_hour_map(spark, sf):
    pin_utc(spark)
    m = kpi.as_map(kpi.amount_by_hour(stored_orders(spark, sf), P.ORDER_DATE),
                   "create_hour", "order_amount")
    return m.select(kpi.map_text("hour_map").alias("hour_map"))


def _kpis(spark, sf):
    """DAU and order tables. In the driver data DAU dates (2024) and order
    dates (1995-2001) do not overlap, so the list for the DAU date has amount
    0.0 and the list for the order date has DAU 0: both empty cases."""
    return stored_dau(spark, sf), stored_orders(spark, sf)


def q_kpi_total(spark, sf):
    pin_utc(spark)
    dau, orders = _kpis(spark, sf)
    return kpi.kpi_lists(dau, orders, [P.DAU_DATE, P.ORDER_DATE]).drop("date")


def q_kpi_total_json(spark, sf):
    pin_utc(spark)
    dau, orders = _kpis(spark, sf)
    return kpi.kpi_json(kpi.kpi_lists(dau, orders, [P.DAU_DATE, P.ORDER_DATE]), "date")


# ------------------------------------------------------------- sinks

def q_sink_upsert_roundtrip(spark, sf):
    """Order headers upserted in two overlapping batches (the second
    re-sends a third of the headers), read back: one row per id."""
    pin_utc(spark)
    path = scratch_path(spark, "orders_table")
    # both batches are cut from headers that are parsed once
    rows = materialise(order_infos(spark, sf).withColumn("ingest_ms", F.unix_millis("timestamp")).drop("timestamp"),
                       "order_rows")
    first = rows.filter(F.col("create_hour") < "16")
    second = rows.filter(F.col("create_hour") >= "08")
    for i, batch in enumerate((first, second)):
        sinks.upsert(batch, path, ["id"], ["ingest_ms"], "create_month", i, cluster_by=["create_date"])
    back = sinks.read_keyed(spark, path, rows.schema, ["id"], ["ingest_ms"])
    return back.select(*S.ORDER_INFO_FIELDS, "create_date", "create_hour")


def q_sink_append_roundtrip(spark, sf):
    """K3: sale rows appended per batch id; batch 1 is replayed and must
    not duplicate (each batch owns its folder)."""
    pin_utc(spark)
    path = scratch_path(spark, "sale_detail_table")
    # both batches are cut from one join, which is made once
    sale = materialise(joins.interval_join(order_infos(spark, sf, S.JOIN_INFO_FIELDS),
                                           order_details(spark, sf, S.JOIN_DETAIL_FIELDS), interval=P.JOIN_INTERVAL),
                       "sale_rows")
    a = sale.filter(F.col("dt") < "1998-01-01")
    b = sale.filter(F.col("dt") >= "1998-01-01")
    sinks.append_batch(a, path, 0)
    sinks.append_batch(b, path, 1)
    sinks.append_batch(b, path, 1)
    return sinks.read_table(spark, path, sale.schema)


def q_doc_generated_ids(spark, sf):
    """K5: documents with and without an id in two batches; the second is
    replayed and must not double. Without an id they get one by writer, batch,
    content and occurrence, so equal documents stay apart."""
    pin_utc(spark)
    path = scratch_path(spark, "documents_table")
    docs = TB.table(spark, sf, "events").select(
        F.when(F.col("event_type") == "purchase", F.concat(F.lit("evt_"), F.col("event_id").cast("string"))).alias("doc_id"),
        F.concat(F.lit("mid_"), (F.col("user_id") % TB.EVENT_DEVICES).cast("string")).alias("mid"),
        F.col("event_type").alias("kind"), F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.pmod(F.col("event_id"), F.lit(2)).alias("b"))
    for batch in (0, 1, 1):
        rows = documents.with_ids(docs.where(F.col("b") == batch).drop("b"), "doc_id", P.DOC_WRITER, batch)
        sinks.upsert(rows, path, ["doc_id"], ["day"], "day", batch, writer=P.DOC_WRITER)
    return sinks.read_keyed(spark, path, "doc_id string, mid string, kind string, day string", ["doc_id"], ["day"])
