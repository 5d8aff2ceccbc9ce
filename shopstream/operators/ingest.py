"""Log collector logic (S8, P18, F9, K9, K10) without the HTTP server.

``stamp`` replaces any client ``ts`` with the server's clock; ``route``
sends startup logs to the startup topic and everything else to the event
topic. The reference routes on the word 'startup' anywhere in the text;
``compat=True`` keeps that, the default routes on the ``logType`` field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C


def stamp(logs: DataFrame, now: Column | None = None, value_col: str = "value") -> DataFrame:
    """Set ``ts`` (epoch ms) to ``now`` (default: current time; a file or
    Kafka source passes its arrival timestamp). All other fields keep their
    JSON types. A line that is not a JSON object, or repeats a key, keeps its
    raw text and is marked ``malformed``."""
    now_ms = F.unix_millis(now if now is not None else F.current_timestamp())
    fields = F.expr(f"try_cast(try_parse_json(`{value_col}`) as map<string,variant>)")
    stamped = F.to_json(F.map_concat(F.map_filter(fields, lambda k, v: k != F.lit("ts")),
                                     F.create_map(F.lit("ts"), F.parse_json(now_ms.cast("string")))))
    return (logs.withColumn("malformed", fields.isNull())
            .withColumn(value_col, F.when(F.col("malformed"), F.col(value_col)).otherwise(stamped)))


def route(logs: DataFrame, compat: bool = False, value_col: str = "value") -> DataFrame:
    """Add ``topic``; key = mid so a device's logs stay ordered. Lines
    marked ``malformed`` go to the dead-letter topic."""
    if compat:
        is_startup = F.col(value_col).contains("startup")
    else:
        is_startup = F.get_json_object(F.col(value_col), "$.logType") == F.lit("startup")
    topic = F.when(is_startup, F.lit(C.STARTUP_TOPIC)).otherwise(F.lit(C.EVENT_TOPIC))
    if "malformed" in logs.columns:
        topic = F.when(F.col("malformed"), F.lit(C.DEAD_TOPIC)).otherwise(topic)
    return logs.select("*", topic.alias("topic"), F.get_json_object(F.col(value_col), "$.mid").alias("key"))


def archive_columns(logs: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """The raw line plus its daily roll key (log date of arrival)."""
    return logs.select(F.col("value"), F.date_format(F.col(time_col), "yyyy-MM-dd").alias("logdate"))
