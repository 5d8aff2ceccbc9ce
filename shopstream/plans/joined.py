"""Registered queries of the order-header x order-line joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import dedupe, joins
from ..session import pin_utc
from . import params as P
from .queries import order_details, order_infos, users


def _sides(spark, sf):
    return order_infos(spark, sf, S.JOIN_INFO_FIELDS), order_details(spark, sf, S.JOIN_DETAIL_FIELDS)


def q_order_detail_full_outer(spark, sf):
    """J1 with one batch per arrival day."""
    pin_utc(spark)
    info, detail = _sides(spark, sf)
    info = info.withColumn("batch", F.col("create_date"))
    detail = detail.withColumn("batch", F.date_format("timestamp", "yyyy-MM-dd"))
    return joins.full_outer_by_batch(info, detail, "batch")


def q_sale_join(spark, sf):
    pin_utc(spark)
    return joins.sale_join(*_sides(spark, sf))


def q_sale_join_interval(spark, sf):
    pin_utc(spark)
    return joins.interval_join(*_sides(spark, sf), interval=P.JOIN_INTERVAL)


def q_sale_unmatched(spark, sf):
    pin_utc(spark)
    return joins.orphans(*_sides(spark, sf), interval=P.JOIN_INTERVAL)


def sale_rows(spark, sf):
    return joins.interval_join(*_sides(spark, sf), interval=P.JOIN_INTERVAL)


def q_sale_enriched(spark, sf):
    pin_utc(spark)
    return joins.with_user(sale_rows(spark, sf), users(spark, sf), as_of=P.AS_OF)


def q_distinct_users(spark, sf):
    pin_utc(spark)
    return joins.distinct_users(sale_rows(spark, sf))


def q_user_cache_semi(spark, sf):
    pin_utc(spark)
    return joins.users_for(users(spark, sf), sale_rows(spark, sf))


def q_detail_latest_by_key(spark, sf):
    """A later write of the same buffered key replaces the earlier one."""
    pin_utc(spark)
    d = order_details(spark, sf).select(
        "id", "order_id", "sku_name", "sku_id", "order_price", "img_url", "sku_num",
        F.unix_millis("timestamp").alias("arrival_ms"))
    return dedupe.latest_per_key(d, ["order_id", "id"], ["arrival_ms"])
