"""Column expressions (all built-ins: JVM-side, inside whole-stage codegen).

Day and hour parts follow the session time zone (the reference used the JVM
default zone); set ``spark.sql.session.timeZone`` explicitly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def event_time(ts_ms: str | Column) -> Column:
    """Epoch milliseconds -> timestamp."""
    return F.timestamp_millis(_c(ts_ms))


def log_date(ts_ms: str | Column) -> Column:
    """'yyyy-MM-dd' of an epoch-ms value."""
    return F.date_format(event_time(ts_ms), "yyyy-MM-dd")


def log_hour(ts_ms: str | Column) -> Column:
    """'HH' of an epoch-ms value."""
    return F.date_format(event_time(ts_ms), "HH")


def create_date(create_time: str | Column) -> Column:
    """Characters 1-10 of 'yyyy-MM-dd HH:mm:ss'; null-safe, short text stays short."""
    return F.substring(_c(create_time), 1, 10)


def create_hour(create_time: str | Column) -> Column:
    """Characters 12-13 of 'yyyy-MM-dd HH:mm:ss'."""
    return F.substring(_c(create_time), 12, 2)


def mask_name(name: str | Column) -> Column:
    """First character + '**'; null stays null, '' becomes '**'.

    Substring counts code points (the JVM counted UTF-16 units; differs only
    beyond the BMP).
    """
    n = _c(name)
    return F.when(n.isNull(), F.lit(None).cast("string")) \
        .otherwise(F.concat(F.substring(n, 1, 1), F.lit("**")))


# Phone mask pattern and replacement (all matches, not anchored).
PHONE_PATTERN = r"(\d{3})\d{4}(\d{4})"
PHONE_REPLACEMENT = "$1****$2"


def mask_phone(tel: str | Column) -> Column:
    return F.regexp_replace(_c(tel), PHONE_PATTERN, PHONE_REPLACEMENT)


def as_of_ts(as_of: str | Column | None) -> Column:
    """The 'now' of an age computation; a parameter so results are repeatable."""
    if as_of is None:
        return F.current_timestamp()
    return F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of


def user_age(birthday: str | Column, as_of: str | Column | None = None) -> Column:
    """Whole 365-day years between birthday (yyyy-MM-dd) and as_of,
    truncated toward zero; an unparseable birthday gives null."""
    bday = F.call_function("try_to_date", _c(birthday), F.lit("yyyy-MM-dd"))
    diff = F.unix_millis(as_of_ts(as_of)) - F.unix_millis(bday.cast("timestamp"))
    return div_trunc(diff, C.MS_PER_YEAR).cast("int")


def div_trunc(num: Column, den: int) -> Column:
    """Integer division truncating toward zero, in longs."""
    return F.call_function("div", num, F.lit(den)).cast("bigint")


def doc_id(mid: str | Column, ts_ms: str | Column, bucket_ms: int = C.ALERT_DOC_BUCKET_MS) -> Column:
    """Document id ``mid + "_" + ts / bucket`` (the reference: per minute)."""
    return F.concat(_c(mid), F.lit("_"), F.floor(_c(ts_ms) / bucket_ms).cast("bigint").cast("string"))
