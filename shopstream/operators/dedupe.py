"""First / latest row per key (A2, A14), seen-set filter (F1, J8), DAU rows.

``first_per_key`` is an aggregation, not a window: ``min(struct(order...,
rest...))`` combines map-side, so a device holding a third of all rows is
reduced to one row per map task before the shuffle (a ``row_number`` window
would shuffle and sort every row of that device into one task). The struct
carries every column, so ties are broken deterministically by the remaining
columns in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def _pick_per_key(df: DataFrame, keys: list[str], order: list[str], latest: bool) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest])
    agg = F.max(packed) if latest else F.min(packed)
    return (df.groupBy(*keys).agg(agg.alias("_row"))
              .select(*[F.col(k) for k in keys], *[F.col("_row." + c).alias(c) for c in order + rest])
              .select(*df.columns))


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the smallest ``order`` tuple per key (``minBy``)."""
    return _pick_per_key(df, keys, order, latest=False)


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the largest ``order`` tuple per key (last write wins)."""
    return _pick_per_key(df, keys, order, latest=True)


def dau_rows(startup: DataFrame) -> DataFrame:
    """Parsed startup logs -> rows of the DAU table (11 named columns)."""
    return startup.select(
        "mid", "uid", F.col("appId").alias("appid"), "area", "os", "channel",
        F.col("logType").alias("logtype"), "version", "ts",
        F.col("log_date").alias("logdate"), F.col("log_hour").alias("loghour"))


# Key and order of the DAU table: one row per device and day, the earliest
# start; ties broken by uid then the remaining columns.
DAU_KEY = ["mid", "logdate"]
DAU_ORDER = ["ts", "uid"]


def first_start_per_day(startup: DataFrame) -> DataFrame:
    """Each device's first start of each day (A2, W3 batch form); keyed by
    (mid, logdate), so a device crossing midnight has two rows (Q8)."""
    return first_per_key(dau_rows(startup), DAU_KEY, DAU_ORDER)


def not_seen(rows: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not in the seen set (F1). A plain anti join: Spark
    (AQE) broadcasts the seen set only when its measured size is small."""
    return rows.join(seen.select(*keys).distinct(), on=keys, how="left_anti")


def new_devices(startup_batch: DataFrame, seen_dau: DataFrame) -> DataFrame:
    """DAU rows of devices not yet in the table for that day (F1 + A2).

    Seen set and batch are matched on the log's own date (the reference read
    the seen set under the processing date, Q6)."""
    return first_per_key(not_seen(dau_rows(startup_batch), seen_dau, DAU_KEY), DAU_KEY, DAU_ORDER)
