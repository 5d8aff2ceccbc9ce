"""JSON wire records -> typed records (P1-P6), with a quarantine for bad lines.

Every wire field is read as a string (a JSON number fits a string field; a
double field would turn a quoted number into NULL) and cast afterwards with
``try_cast``. Missing fields become null, extra fields are ignored. A null,
blank or malformed line lands in ``_corrupt_record`` instead of failing the
task, and ``quarantine`` returns those lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import columns as X


def parse_json(df: DataFrame, fields: list[str], casts: dict[str, str] | None = None,
               value_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse ``value_col`` into one column per field; keeps ``keep`` columns
    and the corrupt-record column (null for good lines).

    The parsed struct is emitted by a generator (``inline`` of a one-element
    array), so each line is parsed exactly once: filters on parsed fields
    (``valid``, a join's inferred ``isnotnull(key)``) stay above the generator
    instead of being pushed below it with a copy of ``from_json`` each."""
    j = F.from_json(F.col(value_col), S.wire_schema(fields),
                    {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": S.CORRUPT})
    rows = df.select(*keep, F.inline(F.array(F.struct(
        j.alias("_parsed"), F.coalesce(F.col(value_col), F.lit("")).alias("_raw")))))
    corrupt = F.when(F.col("_parsed").isNull() | F.col(f"_parsed.{S.CORRUPT}").isNotNull(), F.col("_raw"))
    out = rows.select(*keep, *[F.col(f"_parsed.`{f}`").alias(f) for f in fields], corrupt.alias(S.CORRUPT))
    for name, typ in (casts or {}).items():
        out = out.withColumn(name, F.expr(f"try_cast(`{name}` as {typ})"))
    return out


def valid(df: DataFrame) -> DataFrame:
    """Rows that parsed as a JSON object."""
    return df.filter(F.col(S.CORRUPT).isNull()).drop(S.CORRUPT)


def quarantine(df: DataFrame) -> DataFrame:
    """Raw text of lines that did not parse."""
    return df.filter(F.col(S.CORRUPT).isNotNull()).select(F.col(S.CORRUPT).alias("value"))


def dead_letters(topic: DataFrame, fields: list[str], keep: tuple[str, ...] = ("timestamp",)) -> DataFrame:
    """Lines of a topic that the parser of ``fields`` does not take, with
    their arrival: the jobs' dead-letter output."""
    bad = parse_json(topic, fields, keep=_keep(topic, keep)).filter(F.col(S.CORRUPT).isNotNull())
    return bad.select(*_keep(topic, keep), F.col(S.CORRUPT).alias("value"))


def _keep(df: DataFrame, candidates: tuple[str, ...]) -> tuple[str, ...]:
    return tuple(c for c in candidates if c in df.columns)


def with_log_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    """event_time, log_date, log_hour from epoch-ms ``ts``."""
    return df.select("*", X.event_time(ts).alias("event_time"),
                     X.log_date(ts).alias("log_date"), X.log_hour(ts).alias("log_hour"))


def parse_startup(topic: DataFrame, keep: tuple[str, ...] = ("timestamp",)) -> DataFrame:
    """Startup log JSON -> typed StartupLog + time parts."""
    p = valid(parse_json(topic, S.STARTUP_FIELDS, S.STARTUP_CASTS, keep=_keep(topic, keep)))
    return with_log_time(p)


def parse_event(topic: DataFrame, keep: tuple[str, ...] = ("timestamp",)) -> DataFrame:
    """Event log JSON -> typed EventLog + time parts."""
    p = valid(parse_json(topic, S.EVENT_FIELDS, S.EVENT_CASTS, keep=_keep(topic, keep)))
    return with_log_time(p)


def order_columns(df: DataFrame) -> DataFrame:
    """create_date/create_hour (+ create_month, the table's partition key)
    and masks of an order header (P9-P12).

    Applied once at ingest; masks are not idempotent (a second pass turns
    '**' into '***' and re-masks long digit runs). Columns whose field was not
    parsed are left out."""
    if "create_time" in df.columns:
        df = (df.withColumn("create_date", X.create_date("create_time"))
                .withColumn("create_month", F.substring(X.create_date("create_time"), 1, 7))
                .withColumn("create_hour", X.create_hour("create_time")))
    masks = {"consignee": X.mask_name, "consignee_tel": X.mask_phone}
    return df.withColumns({c: mask(c) for c, mask in masks.items() if c in df.columns})


def _casts(casts: dict[str, str], fields: list[str]) -> dict[str, str]:
    return {f: t for f, t in casts.items() if f in fields}


def parse_order_info(topic: DataFrame, keep: tuple[str, ...] = ("timestamp",),
                     fields: list[str] | None = None) -> DataFrame:
    """Order header JSON -> typed OrderInfo, masked, with date/hour (P3). The
    parser reads only ``fields`` (default: all): the generator that keeps a
    line from being parsed twice also keeps Spark from pruning them."""
    wanted = fields or S.ORDER_INFO_FIELDS
    return order_columns(valid(parse_json(topic, wanted, _casts(S.ORDER_INFO_CASTS, wanted), keep=_keep(topic, keep))))


def parse_order_detail(topic: DataFrame, keep: tuple[str, ...] = ("timestamp",),
                       fields: list[str] | None = None) -> DataFrame:
    """Order line JSON -> typed OrderDetail (P4), only ``fields`` of it if
    given; ``timestamp`` is its arrival time."""
    wanted = fields or S.ORDER_DETAIL_FIELDS
    return valid(parse_json(topic, wanted, _casts(S.ORDER_DETAIL_CASTS, wanted), keep=_keep(topic, keep)))


def parse_user_info(df: DataFrame, value_col: str = "value") -> DataFrame:
    """User JSON -> UserInfo (P5)."""
    return valid(parse_json(df, S.USER_INFO_FIELDS, S.USER_INFO_CASTS, value_col=value_col))


def to_json_value(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Record -> one JSON object per row in ``value`` (P6); nulls are omitted."""
    cols = columns or df.columns
    return df.select(F.to_json(F.struct(*[F.col(c) for c in cols])).alias("value"))
