"""Wire and typed schemas.

On the wire every field is a string (JSON numbers are accepted by a string
field, while a double field turns a quoted number into NULL); fields are cast
with ``try_cast`` after parsing.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Field names and order of the reference's records.
STARTUP_FIELDS = ["mid", "uid", "appId", "area", "os", "channel", "logType", "version", "ts"]
EVENT_FIELDS = ["mid", "uid", "appId", "area", "os", "logType", "eventId", "pageId",
                "nextPageId", "itemId", "ts"]
ORDER_INFO_FIELDS = ["id", "province_id", "consignee", "order_comment", "consignee_tel",
                     "order_status", "payment_way", "user_id", "img_url", "total_amount",
                     "expire_time", "delivery_address", "create_time", "operate_time",
                     "tracking_no", "parent_order_id", "out_trade_no", "trade_body"]
ORDER_DETAIL_FIELDS = ["id", "order_id", "sku_name", "sku_id", "order_price", "img_url", "sku_num"]
USER_INFO_FIELDS = ["id", "login_name", "user_level", "birthday", "gender"]

# Output columns of the keyed tables (names, in the reference's order).
DAU_COLUMNS = ["mid", "uid", "appid", "area", "os", "channel", "logtype", "version", "ts",
               "logdate", "loghour"]
SALE_DETAIL_COLUMNS = ["order_detail_id", "order_id", "order_status", "create_time", "user_id",
                       "sku_id", "user_gender", "user_age", "user_level", "sku_price",
                       "sku_name", "dt"]

# What the header x line joins read of them.
JOIN_INFO_FIELDS = ["id", "order_status", "user_id", "create_time"]
JOIN_DETAIL_FIELDS = ["id", "order_id", "sku_name", "sku_id", "order_price"]
# What the joins read that return ids only.
ID_INFO_FIELDS = ["id"]
ID_DETAIL_FIELDS = ["id", "order_id"]

CORRUPT = "_corrupt_record"


def wire_schema(fields: list[str]) -> T.StructType:
    """All-string schema plus the corrupt-record column used for quarantine."""
    return T.StructType([T.StructField(f, T.StringType()) for f in fields]
                        + [T.StructField(CORRUPT, T.StringType())])


# Casts applied after parsing; fields not listed stay strings.
STARTUP_CASTS = {"ts": "bigint"}
EVENT_CASTS = {"ts": "bigint"}
ORDER_INFO_CASTS = {"total_amount": "double"}
ORDER_DETAIL_CASTS: dict[str, str] = {}
USER_INFO_CASTS: dict[str, str] = {}

# A topic row, shaped like the Kafka source.
TOPIC_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
])

# Change-feed record (after-image rows of one statement).
CHANGE_SCHEMA = T.StructType([
    T.StructField("database", T.StringType()),
    T.StructField("table", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("entry_type", T.StringType()),
    T.StructField("data", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
])
