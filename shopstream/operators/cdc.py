"""Database change feed -> topic rows.

A change record is one statement's after-images:
``database, table, type, entry_type, data: array<map<string,string>>``.
Only row-data entries of subscribed schemas pass; by default only INSERTs of
the two order tables with at least one row, one output message per row
(SQL NULL arrives as '' as in the binlog reader; ``null_empty`` drops such
fields instead).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from .. import schemas as S


def subscribed(changes: DataFrame, pattern: str = C.CDC_SUBSCRIPTION) -> DataFrame:
    """keep changes whose 'database.table' matches the subscription regex."""
    return changes.filter(F.concat_ws(".", "database", "table").rlike("^(?:" + pattern + ")$"))


def row_data(changes: DataFrame) -> DataFrame:
    """only row-data entries (no transaction markers)."""
    return changes.filter(F.col("entry_type") == C.CDC_ROWDATA)


def inserts_of(changes: DataFrame, tables=tuple(C.CDC_TABLE_TOPICS), types=(C.CDC_INSERT,)) -> DataFrame:
    """statement type and table wanted, and at least one row."""
    return changes.filter(F.col("type").isin(*types) & F.col("table").isin(*tables)
                          & (F.size("data") > 0))


def wanted_changes(changes: DataFrame, pattern: str = C.CDC_SUBSCRIPTION,
                   tables=tuple(C.CDC_TABLE_TOPICS), types=(C.CDC_INSERT,)) -> DataFrame:
    return inserts_of(row_data(subscribed(changes, pattern)), tables, types)


def rows_of(changes: DataFrame, null_empty: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per after-image, as a flat JSON object in ``value``;
    ``keep`` names further columns that stay."""
    r = changes.select("table", "type", *keep, F.posexplode("data").alias("row_pos", "row"))
    if null_empty:
        r = r.withColumn("row", F.map_filter("row", lambda k, v: v != F.lit("")))
    return r.select("table", "type", *keep, "row_pos", "row", F.to_json("row").alias("value"))


def route(rows: DataFrame, table_topics: dict[str, str] = C.CDC_TABLE_TOPICS,
          keep: tuple[str, ...] = ()) -> DataFrame:
    """Topic per table; key = the row's order id (header: id, line:
    order_id) so one order's messages stay in one Kafka partition (Q20)."""
    topic = F.lit(None).cast("string")
    for t, name in table_topics.items():
        topic = F.when(F.col("table") == t, F.lit(name)).otherwise(topic)
    key = F.when(F.col("table") == "order_info", F.col("row")["id"]).otherwise(F.col("row")["order_id"])
    return rows.select(key.alias("key"), "value", topic.alias("topic"), *keep)


def to_topics(changes: DataFrame, **kw) -> DataFrame:
    """The whole change-feed client: filter, explode, route."""
    null_empty, keep = kw.pop("null_empty", False), tuple(kw.pop("keep", ()))
    return route(rows_of(wanted_changes(changes, **kw), null_empty, keep), keep=keep)


def parse_changes(lines: DataFrame) -> DataFrame:
    """Change records from the JSON lines of a feed, with the arrival time. A
    line that is no record has no table and passes no filter. A generator emits
    the record, so the filters stay above it and each line is parsed once."""
    record = F.from_json("value", S.CHANGE_SCHEMA)
    return lines.select("timestamp", F.inline(F.array(F.struct(record.alias("c"))))).select("c.*", "timestamp")
