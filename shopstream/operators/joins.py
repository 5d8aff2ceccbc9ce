"""Order header x order line joins and user enrichment.

The reference buffers both sides in an external cache for 30 minutes and
matches them across micro-batches. Its net effect is an inner equi-join on
order id whose two arrivals are at most the buffer lifetime apart; here that
is one declarative join (equi-key + time range), which Spark runs as a
sort-merge join on order id in batch and as a watermarked stream-stream join
in streaming (state is dropped once the watermark passes the interval).
Every matching pair is emitted, including pairs that arrive in the same
batch (the reference loses those).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import columns as X


def _info(info: DataFrame, time_col: str) -> DataFrame:
    return info.select(F.col("id").alias("i_id"), F.col("order_status"), F.col("create_time"),
                       F.col("user_id"), F.col(time_col).alias("i_time"))


def _detail(detail: DataFrame, time_col: str) -> DataFrame:
    return detail.select(F.col("id").alias("d_id"), F.col("order_id").alias("d_order_id"),
                         F.col("sku_id"), F.col("sku_name"), F.col("order_price"),
                         F.col(time_col).alias("d_time"))


def _sale_columns() -> list[Column]:
    """Header part (P13) and line part (P14) of a SaleDetail."""
    return [F.col("d_id").alias("order_detail_id"), F.col("i_id").alias("order_id"),
            F.col("order_status"), F.col("create_time"), F.col("user_id"), F.col("sku_id"),
            F.expr("try_cast(order_price as double)").alias("sku_price"), F.col("sku_name"),
            X.create_date("create_time").alias("dt")]


def full_outer_by_batch(info: DataFrame, detail: DataFrame, batch_col: str = "batch") -> DataFrame:
    """The per-batch full outer join of one micro-batch's headers and
    lines on order id; ``batch_col`` names the batch of each row. A null side
    is a row that waits for (or never gets) its partner.

    Spark splits a hot key of a left join but not of a full outer one, so this
    is lines left join headers (the lines of a hot order are dealt to several
    tasks, each with the header), and the headers without lines by an anti
    join with the distinct orders of the lines, which combine before they are
    shuffled."""
    i = info.select(F.col("id").alias("i_id"), F.col(batch_col).alias("i_batch"))
    d = detail.select(F.col("id").alias("d_id"), F.col("order_id").alias("d_order_id"),
                      F.col(batch_col).alias("d_batch"))
    cond = (F.col("i_id") == F.col("d_order_id")) & (F.col("i_batch") == F.col("d_batch"))
    lines = d.join(i, cond, "left").select(
        F.col("d_order_id").alias("order_id"), F.col("d_id").alias("order_detail_id"),
        F.col("d_batch").alias("batch"), F.col("i_id").isNotNull().alias("has_info"),
        F.lit(True).alias("has_detail"))
    lone = i.join(d.select("d_order_id", "d_batch").distinct(), cond, "left_anti").select(
        F.col("i_id").alias("order_id"), F.lit(None).cast("string").alias("order_detail_id"),
        F.col("i_batch").alias("batch"), F.lit(True).alias("has_info"), F.lit(False).alias("has_detail"))
    return lines.unionByName(lone)


def sale_join(info: DataFrame, detail: DataFrame, info_time: str = "timestamp",
              detail_time: str = "timestamp") -> DataFrame:
    """Inner join header x line on order id, no time bound."""
    j = _info(info, info_time).join(_detail(detail, detail_time),
                                    F.col("i_id") == F.col("d_order_id"), "inner")
    return j.select(*_sale_columns())


def within(interval: str) -> Column:
    """Line arrival within +-interval of header arrival (both ends inclusive)."""
    iv = F.expr(f"INTERVAL {interval}")
    return F.col("d_time").between(F.col("i_time") - iv, F.col("i_time") + iv)


def interval_join(info: DataFrame, detail: DataFrame, interval: str = C.JOIN_TTL,
                  info_time: str = "timestamp", detail_time: str = "timestamp") -> DataFrame:
    """Header x line on order id, arrivals at most ``interval`` apart.

    Works on batch frames and on two streaming frames; for streams, give each
    side a watermark on its time column first (``with_watermarks``)."""
    cond = (F.col("i_id") == F.col("d_order_id")) & within(interval)
    j = _info(info, info_time).join(_detail(detail, detail_time), cond, "inner")
    return j.select(*_sale_columns())


def _lone(side: str, id_: str, order_id: str) -> list[Column]:
    return [F.lit(side).alias("side"), F.col(id_).alias("id"), F.col(order_id).alias("order_id")]


def orphans(info: DataFrame, detail: DataFrame, interval: str = C.JOIN_TTL,
            info_time: str = "timestamp", detail_time: str = "timestamp") -> DataFrame:
    """Headers with no line and lines with no header within ``interval``
    (the rows the reference's buffer lets expire silently).

    Lines are the left side of their anti join, so a hot order's lines are
    dealt to several tasks; the headers that do have a line come from the inner
    join, combined to distinct headers in each task."""
    i, d = _info(info, info_time), _detail(detail, detail_time)
    cond = (F.col("i_id") == F.col("d_order_id")) & within(interval)
    lines = d.join(i.select("i_id", "i_time"), cond, "left_anti").select(*_lone("order_detail", "d_id", "d_order_id"))
    met = (d.select("d_order_id", "d_time").join(i.select("i_id", "i_time"), cond)
           .select(F.col("i_id").alias("m_id"), F.col("i_time").alias("m_time")).distinct())
    heads = i.join(met, (F.col("i_id") == F.col("m_id")) & F.col("i_time").eqNullSafe(F.col("m_time")), "left_anti")
    return heads.select(*_lone("order_info", "i_id", "i_id")).unionByName(lines)


def expired(info: DataFrame, detail: DataFrame, interval: str = C.JOIN_TTL,
            info_time: str = "timestamp", detail_time: str = "timestamp") -> DataFrame:
    """J6 on two watermarked streams: an outer join, whose rows without a
    partner come when the watermark passes their interval."""
    i = info.select(F.col("id").alias("i_id"), F.col(info_time).alias("i_time"), F.lit(True).alias("has_info"))
    d = detail.select(F.col("id").alias("d_id"), F.col("order_id").alias("d_order_id"), F.col(detail_time).alias("d_time"),
                      F.lit(True).alias("has_detail"))
    cond = (F.col("i_id") == F.col("d_order_id")) & within(interval)
    lone = i.join(d, cond, "full_outer").where(F.col("has_info").isNull() | F.col("has_detail").isNull())
    is_info = F.col("has_info").isNotNull()
    return lone.select(F.when(is_info, "order_info").otherwise("order_detail").alias("side"),
                       F.when(is_info, F.col("i_id")).otherwise(F.col("d_id")).alias("id"),
                       F.when(is_info, F.col("i_id")).otherwise(F.col("d_order_id")).alias("order_id"))


def with_user(sale: DataFrame, users: DataFrame, as_of: str | Column | None = None) -> DataFrame:
    """Inner join with users on user_id; unknown users are dropped.
    Spark picks the strategy from measured sizes."""
    u = users.select(F.col("id").alias("u_id"), F.col("gender").alias("user_gender"),
                     F.col("user_level"), X.user_age("birthday", as_of).alias("user_age"))
    j = sale.join(u, sale["user_id"] == u["u_id"], "inner")
    return j.select("order_detail_id", "order_id", "order_status", "create_time", "user_id",
                    "sku_id", "user_gender", "user_age", "user_level", "sku_price", "sku_name", "dt")


def with_user_version(sale: DataFrame, users: DataFrame, versions: list[int], time_ms: Column,
                      as_of: str | Column | None = None) -> DataFrame:
    """The user join with the dimension as it was at a row's time: the
    newest of ``versions`` (their first milliseconds) that is not later. A row
    older than every version has no user. ``users`` has ``valid_from_ms``."""
    known = F.filter(F.array(*[F.lit(v).cast("long") for v in versions]), lambda v: v <= time_ms)
    dated = sale.withColumn("_version", F.array_max(known))
    u = users.select(F.col("id").alias("u_id"), F.col("gender").alias("user_gender"), "user_level",
                     X.user_age("birthday", as_of).alias("user_age"), F.col("valid_from_ms").alias("u_version"))
    j = dated.join(u, (dated["user_id"] == u["u_id"]) & (F.col("_version") == F.col("u_version")), "inner")
    return j.select("order_detail_id", "order_id", "order_status", "create_time", "user_id", "sku_id", "user_gender",
                    "user_age", "user_level", "sku_price", "sku_name", "dt")


def distinct_users(sale: DataFrame) -> DataFrame:
    """Distinct user ids of the sale rows, kept distributed."""
    return sale.select("user_id").distinct()


def users_for(users: DataFrame, sale: DataFrame) -> DataFrame:
    """The users referenced by the sale rows (semi join)."""
    return users.join(distinct_users(sale), users["id"] == F.col("user_id"), "left_semi")


def with_watermarks(info: DataFrame, detail: DataFrame, delay: str,
                    info_time: str = "timestamp", detail_time: str = "timestamp"):
    """Watermark both stream sides so join state is bounded by the interval."""
    return info.withWatermark(info_time, delay), detail.withWatermark(detail_time, delay)
