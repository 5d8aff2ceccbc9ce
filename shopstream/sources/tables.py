"""Adapters: driver tables -> the reference's wire records.

The reference consumes JSON strings from four topics and a user dimension.
These adapters derive those records deterministically from the driver's
TPC-H-like tables, so every query's work grows with the tables:

* startup log  = ``events`` with event_type 'signup'; device = user
* event log    = all ``events``; device = user_id % 10, item = props.k;
  purchase plays 'coupon', click plays 'clickItem'
* order header = ``orders``; create_time carries a synthetic hour/minute/second
  (order dates are all midnight); phone and name are derived from the customer
* order line   = ``lineitem``; arrival time = ship date; id = orderkey-linenumber
* user         = ``customer`` of segment BUILDING, so the inner join drops rows
* change feed  = orders / lineitem / customer rows as row-change records

Each topic frame has the Kafka source shape (key, value, topic, timestamp).
All expressions are built-ins, so the adapters stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C

# Adapter parameters (ours, not the reference's).
EVENT_ID_OF_TYPE = {"purchase": C.COUPON, "click": C.CLICK_ITEM, "view": "addFavor",
                    "signup": "addComment", "error": "addCart"}
EVENT_DEVICES = 10
USER_SEGMENT = "BUILDING"
BIRTHDAY_BASE = "1960-01-01"
BIRTHDAY_SPAN_DAYS = 15000
EDITION_DAYS = 400
OTHER_DATABASE = "archive"
CHANGE_TOPIC = "change_feed"
CHANGE_TYPES = ["INSERT", "UPDATE", "DELETE"]
CDC_DATABASE = "shop"
#: Distinct values of the descriptive log fields, named by number.
NAMED_VALUES = {"area": 25, "os": 3, "channel": 7, "version": 5}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, read as its files are split."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def epoch_ms(ts: str | Column) -> Column:
    """Epoch milliseconds of a driver timestamp (NTZ, read in the session
    zone, which registered queries pin to UTC)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_millis(c.cast("timestamp"))


def _pick(values: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx % len(values) + 1).cast("int"))


def _named(field: str, idx: Column) -> Column:
    return F.concat(F.lit(f"{field}_"), (idx % NAMED_VALUES[field]).cast("string"))


def _prop_k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _topic(df: DataFrame, topic: str, key: Column, value: Column, ts: Column) -> DataFrame:
    return df.select(key.cast("string").alias("key"), value.alias("value"),
                     F.lit(topic).alias("topic"), ts.cast("timestamp").alias("timestamp"))


# ---------------------------------------------------------------- logs

def startup_struct(ev: DataFrame) -> Column:
    mid = F.concat(F.lit("mid_"), F.col("user_id").cast("string"))
    return F.struct(
        mid.alias("mid"), F.col("user_id").cast("string").alias("uid"),
        F.lit(C.APP_ID).alias("appId"), _named("area", F.col("user_id")).alias("area"),
        _named("os", F.col("user_id")).alias("os"),
        _named("channel", F.col("event_id")).alias("channel"),
        F.lit("startup").alias("logType"), _named("version", F.col("event_id")).alias("version"),
        epoch_ms("ts").alias("ts"))


def event_struct(ev: DataFrame) -> Column:
    mid = F.concat(F.lit("mid_"), (F.col("user_id") % EVENT_DEVICES).cast("string"))
    eid = F.lit(None).cast("string")
    for src, dst in EVENT_ID_OF_TYPE.items():
        eid = F.when(F.col("event_type") == src, F.lit(dst)).otherwise(eid)
    k = _prop_k()
    return F.struct(
        mid.alias("mid"), F.col("user_id").cast("string").alias("uid"),
        F.lit(C.APP_ID).alias("appId"), _named("area", F.col("user_id")).alias("area"),
        _named("os", F.col("user_id")).alias("os"), F.lit("event").alias("logType"),
        eid.alias("eventId"), k.alias("pageId"), (k % 50 + 1).alias("nextPageId"),
        k.alias("itemId"), epoch_ms("ts").alias("ts"))


def startup_topic(events: DataFrame) -> DataFrame:
    """Startup logs as JSON lines (one per signup event)."""
    ev = events.filter(F.col("event_type") == "signup")
    s = startup_struct(ev)
    return _topic(ev, C.STARTUP_TOPIC, s["mid"], F.to_json(s), F.col("ts"))


def event_topic(events: DataFrame) -> DataFrame:
    """Event logs as JSON lines (one per event; numbers stay JSON numbers)."""
    s = event_struct(events)
    return _topic(events, C.EVENT_TOPIC, s["mid"], F.to_json(s), F.col("ts"))


def raw_app_logs(events: DataFrame) -> DataFrame:
    """What clients post to the collector: a startup log for a signup, an
    event log otherwise; value only, the topic is not known yet."""
    value = F.when(F.col("event_type") == "signup", F.to_json(startup_struct(events))) \
        .otherwise(F.to_json(event_struct(events)))
    return events.select(value.alias("value"), F.col("ts").cast("timestamp").alias("client_time"))


# -------------------------------------------------------------- orders

def order_create_ms(orders: DataFrame) -> Column:
    k = F.col("o_orderkey")
    return (epoch_ms("o_orderdate") + (k % 24) * 3_600_000 + (k % 60) * 60_000
            + (k % 59) * 1_000)


def order_info_struct() -> Column:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    create_time = F.date_format(F.timestamp_millis(order_create_ms(None)), "yyyy-MM-dd HH:mm:ss")
    return F.struct(
        k.cast("string").alias("id"), (c % 34 + 1).cast("string").alias("province_id"),
        F.concat(F.lit("Customer#"), F.lpad(c.cast("string"), 9, "0")).alias("consignee"),
        F.col("o_orderpriority").alias("order_comment"),
        F.concat(F.lit("138"), F.lpad(c.cast("string"), 8, "0")).alias("consignee_tel"),
        F.col("o_orderstatus").alias("order_status"),
        (k % 3 + 1).cast("string").alias("payment_way"), c.cast("string").alias("user_id"),
        F.col("o_totalprice").cast("decimal(16,2)").cast("string").alias("total_amount"),
        create_time.alias("create_time"))


def order_info_topic(orders: DataFrame) -> DataFrame:
    """Order headers; money arrives as a quoted number, as from the change feed."""
    s = order_info_struct()
    return _topic(orders, C.ORDER_INFO_TOPIC, s["id"], F.to_json(s),
                  F.timestamp_millis(order_create_ms(orders)))


def order_detail_struct() -> Column:
    return F.struct(
        F.concat_ws("-", F.col("l_orderkey").cast("string"),
                    F.col("l_linenumber").cast("string")).alias("id"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.concat(F.lit("sku_"), F.col("l_partkey").cast("string")).alias("sku_name"),
        F.col("l_partkey").cast("string").alias("sku_id"),
        F.col("l_extendedprice").cast("decimal(16,2)").cast("string").alias("order_price"),
        F.col("l_quantity").cast("int").cast("string").alias("sku_num"))


def order_detail_topic(lineitem: DataFrame) -> DataFrame:
    """Order lines; they carry no time, so arrival time is the ship date."""
    s = order_detail_struct()
    return _topic(lineitem, C.ORDER_DETAIL_TOPIC, s["order_id"], F.to_json(s),
                  F.col("l_shipdate"))


def order_line_puts(lineitem: DataFrame) -> DataFrame:
    """The order lines under the buffer's key ``order_id:id``."""
    s = order_detail_struct()
    return _topic(lineitem, C.ORDER_DETAIL_TOPIC, F.concat_ws(":", s["order_id"], s["id"]), F.to_json(s),
                  F.col("l_shipdate"))


def user_info(customer: DataFrame, edition: int = 0, segment: str | None = USER_SEGMENT) -> DataFrame:
    """The user dimension (what the reference reads over JDBC). Later editions
    have other levels and birthdays; segment None takes every customer."""
    c = F.col("c_custkey")
    bday = F.date_add(F.lit(BIRTHDAY_BASE).cast("date"),
                      ((c + EDITION_DAYS * edition) % BIRTHDAY_SPAN_DAYS).cast("int"))
    rows = customer if segment is None else customer.filter(F.col("c_mktsegment") == segment)
    return (rows
            .select(c.cast("string").alias("id"), F.col("c_name").alias("login_name"),
                    ((F.col("c_nationkey") + edition) % 5 + 1).cast("string").alias("user_level"),
                    F.date_format(bday, "yyyy-MM-dd").alias("birthday"),
                    _pick(["M", "F"], c).alias("gender")))


# --------------------------------------------------------- change feed

def _row_map(struct_fields: list[tuple[str, Column]]) -> Column:
    """After-image of one row: every column as a string, SQL NULL as ''."""
    args = []
    for name, col in struct_fields:
        args += [F.lit(name), F.coalesce(col.cast("string"), F.lit(""))]
    return F.create_map(*args)


def _order_image(orders: DataFrame) -> Column:
    """After-image of an order row."""
    return _row_map([("id", F.col("o_orderkey")), ("user_id", F.col("o_custkey")),
                     ("order_status", F.col("o_orderstatus")),
                     ("total_amount", F.col("o_totalprice").cast("decimal(16,2)")),
                     ("create_time", F.date_format(F.timestamp_millis(order_create_ms(orders)),
                                                   "yyyy-MM-dd HH:mm:ss")),
                     ("operate_time", F.lit(None))])


def _line_image() -> Column:
    """After-image of an order line."""
    return _row_map([("id", F.concat_ws("-", F.col("l_orderkey").cast("string"),
                                        F.col("l_linenumber").cast("string"))),
                     ("order_id", F.col("l_orderkey")), ("sku_id", F.col("l_partkey")),
                     ("order_price", F.col("l_extendedprice").cast("decimal(16,2)")),
                     ("sku_num", F.col("l_quantity").cast("int"))])


def change_feed(orders: DataFrame, lineitem: DataFrame, customer: DataFrame) -> DataFrame:
    """Row-change records of three tables of the shop database.

    Statement type cycles INSERT/UPDATE/DELETE by key; customer rows come from
    a table nobody subscribes to.
    """
    k = F.col("o_orderkey")
    o_rows = _order_image(orders)
    o = orders.select(F.lit(CDC_DATABASE).alias("database"), F.lit("order_info").alias("table"),
                      _pick(CHANGE_TYPES, k).alias("type"), F.lit(C.CDC_ROWDATA).alias("entry_type"),
                      F.array(o_rows).alias("data"), k.alias("change_key"))
    lk = F.col("l_orderkey") + F.col("l_linenumber")
    l_rows = _line_image()
    li = lineitem.select(F.lit(CDC_DATABASE).alias("database"), F.lit("order_detail").alias("table"),
                         _pick(CHANGE_TYPES, lk).alias("type"), F.lit(C.CDC_ROWDATA).alias("entry_type"),
                         F.array(l_rows).alias("data"), lk.alias("change_key"))
    cu_rows = _row_map([("id", F.col("c_custkey")), ("login_name", F.col("c_name"))])
    cu = customer.select(F.lit(CDC_DATABASE).alias("database"), F.lit("user_info").alias("table"),
                         F.lit("INSERT").alias("type"), F.lit(C.CDC_ROWDATA).alias("entry_type"),
                         F.array(cu_rows).alias("data"), F.col("c_custkey").alias("change_key"))
    return o.unionByName(li).unionByName(cu)


def _statement(key: Column, at: Column, table_name: str, data: Column, shift: int) -> list[Column]:
    """Columns of one statement: every fifth key is of another database, every
    eleventh is a transaction marker, the types cycle."""
    k = key + shift
    return [F.when(k % 5 == 0, OTHER_DATABASE).otherwise(CDC_DATABASE).alias("database"),
            F.lit(table_name).alias("table"), _pick(CHANGE_TYPES, k).alias("type"),
            F.when(k % 11 == 0, "TRANSACTIONBEGIN").otherwise(C.CDC_ROWDATA).alias("entry_type"),
            data.alias("data"), at.alias("at")]


def change_log(orders: DataFrame, lineitem: DataFrame, customer: DataFrame) -> DataFrame:
    """The change feed as a topic of JSON lines: one statement per order (every
    seventh without a row), one per order for all its lines, and customers;
    with transaction markers and a second database in between."""
    k, lk = F.col("o_orderkey"), F.col("l_orderkey")
    data = F.when(k % 7 == 0, F.array().cast("array<map<string,string>>")).otherwise(F.array(_order_image(orders)))
    o = orders.select(*_statement(k, F.timestamp_millis(order_create_ms(orders)), "order_info", data, 0))
    by_order = (lineitem.select(lk.alias("k"), F.col("l_linenumber").alias("n"),
                                F.to_json(_line_image()).alias("row"), F.col("l_shipdate").cast("timestamp").alias("t"))
                .groupBy("k").agg(F.min("t").alias("t"), F.array_sort(F.collect_list(F.struct("n", "row"))).alias("rows")))
    images = F.transform("rows", lambda r: F.from_json(r["row"], "map<string,string>"))
    li = by_order.select(*_statement(F.col("k"), F.col("t"), "order_detail", images, 1))
    cu = customer.select(*_statement(F.col("c_custkey"), F.timestamp_millis(F.col("c_custkey") * 1000), "user_info",
                                     F.array(_row_map([("id", F.col("c_custkey")), ("login_name", F.col("c_name"))])), 0))
    feed = o.unionByName(li).unionByName(cu)
    value = F.to_json(F.struct("database", "table", "type", "entry_type", "data"))
    return _topic(feed, CHANGE_TOPIC, F.lit(None), value, F.col("at"))
