"""JDBC dimension scan.

The reference reads the whole user table on one connection. Here the read
is split into ``num_partitions`` ranges of a numeric key, columns are pruned
to the record's fields and filters are pushed to the database. No database
ships with this repository, so this source is not exercised by the tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S


def read_users(spark: SparkSession, url: str, lower_bound: int, upper_bound: int, num_partitions: int,
               table: str = "user_info", properties: dict[str, str] | None = None,
               partition_column: str = "id") -> DataFrame:
    """``lower_bound`` and ``upper_bound`` are the real key range, which the
    caller knows or reads first; rows outside it still come, in the end ranges."""
    df = spark.read.jdbc(url, table, column=partition_column, lowerBound=lower_bound,
                         upperBound=upper_bound, numPartitions=num_partitions,
                         properties=properties or {})
    return df.select(*[F.col(c).cast("string").alias(c) for c in S.USER_INFO_FIELDS])
