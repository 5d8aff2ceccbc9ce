"""KPIs served to dashboards.

Each takes the keyed table and a date; the date filter is on the partition
column of the written tables, so it prunes partitions at the scan.
Money is summed as decimal(16,2) and cast to double at the end, so the
result does not depend on summation order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C

MONEY = "decimal(16,2)"


def _orders_of(orders: DataFrame, date: str) -> DataFrame:
    """Orders of one day; on the month-partitioned table the month predicate
    prunes partitions and the date predicate prunes row groups."""
    if "create_month" in orders.columns:
        orders = orders.filter(F.col("create_month") == date[:7])
    return orders.filter(F.col("create_date") == date)


def dau_total(dau: DataFrame, date: str) -> DataFrame:
    """count(*) of DAU rows of ``date`` (A9): one row, ``dau``."""
    return dau.filter(F.col("logdate") == date).agg(F.count(F.lit(1)).alias("dau"))


def dau_by_hour(dau: DataFrame, date: str) -> DataFrame:
    """DAU per hour of ``date`` (A10): (loghour, dau)."""
    return (dau.filter(F.col("logdate") == date).groupBy("loghour")
               .agg(F.count(F.lit(1)).alias("dau")))


def amount_total(orders: DataFrame, date: str) -> DataFrame:
    """Sum of total_amount of ``date`` (A11), 0.0 when there are no orders."""
    s = F.sum(F.col("total_amount").cast(MONEY))
    return (_orders_of(orders, date)
                  .agg(F.coalesce(s, F.lit(0).cast(MONEY)).cast("double").alias("order_amount")))


def amount_by_hour(orders: DataFrame, date: str) -> DataFrame:
    """Sum of total_amount per create_hour of ``date``."""
    return (_orders_of(orders, date).groupBy("create_hour")
                  .agg(F.sum(F.col("total_amount").cast(MONEY)).cast("double").alias("order_amount")))


def as_map(series: DataFrame, key: str, value: str, name: str = "hour_map") -> DataFrame:
    """Rows -> one map key -> value (P24). At most 24 entries for hours."""
    return series.agg(F.map_from_entries(F.collect_list(F.struct(F.col(key), F.col(value))))
                      .alias(name))


def map_text(m: str = "hour_map") -> F.Column:
    """Map -> 'k:v,k:v' sorted by key, to compare maps as text."""
    entries = F.transform(F.array_sort(F.map_entries(F.col(m))),
                          lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string")))
    return F.array_join(entries, ",")


def kpi_list(dau: DataFrame, orders: DataFrame, date: str) -> DataFrame:
    """The three KPI rows (U1): (pos, id, name, value) as text (P25)."""
    return kpi_lists(dau, orders, [date]).drop("date")


def kpi_lists(dau: DataFrame, orders: DataFrame, dates: list[str]) -> DataFrame:
    """The KPI rows of several days, (date, pos, id, name, value), from one
    scan of each table; the days prune its partitions."""
    if "create_month" in orders.columns:
        orders = orders.filter(F.col("create_month").isin(sorted({d[:7] for d in dates})))
    day, money = F.col("create_date"), F.col("total_amount").cast(MONEY)
    counts = dau.filter(F.col("logdate").isin(dates)).agg(
        *[F.count_if(F.col("logdate") == d).alias(f"v{i}") for i, d in enumerate(dates)])
    sums = orders.filter(day.isin(dates)).agg(
        *[F.coalesce(F.sum(F.when(day == d, money)), F.lit(0).cast(MONEY)).cast("double").alias(f"v{i}")
          for i, d in enumerate(dates)])

    def rows(pos: int, kpi: tuple[str, str], value: F.Column | None = None) -> list[F.Column]:
        return [F.struct(F.lit(d).alias("date"), F.lit(pos).alias("pos"), F.lit(kpi[0]).alias("id"),
                         F.lit(kpi[1]).alias("name"),
                         (F.col(f"v{i}").cast("string") if value is None else value).alias("value"))
                for i, d in enumerate(dates)]

    devices = rows(1, C.KPI_DAU) + rows(2, C.KPI_NEW_MID, F.lit(C.KPI_NEW_MID_VALUE))
    return counts.select(F.inline(F.array(*devices))).unionByName(
        sums.select(F.inline(F.array(*rows(3, C.KPI_ORDER_AMOUNT)))))


def kpi_json(kpis: DataFrame, *by: str) -> DataFrame:
    """The KPI list as one JSON array document (K12), in list order; one for
    each value of ``by``."""
    items = F.array_sort(F.collect_list(F.struct("pos", "id", "name", "value")))
    doc = F.to_json(F.transform(items, lambda r: F.struct(r["id"].alias("id"), r["name"].alias("name"),
                                                          r["value"].alias("value"))))
    return kpis.groupBy(*by).agg(doc.alias("json"))
