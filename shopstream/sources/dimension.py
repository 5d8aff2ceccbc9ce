"""Versions of a dimension table.

The reference reads its user dimension anew for every batch and joins whatever
it finds. Here every snapshot is stored with the time from which it holds, and
rows are joined with the snapshot of their own time, so a batch that runs late
gives the same answer. A reader looks at the table's version number and reads
the snapshots again only if it has changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks import manifest as M
from ..sinks import tables as sinks

VALID = "valid_from_ms"


def add_version(users: DataFrame, path: str, valid_from_ms: int, writer: str = "dimension") -> None:
    """Store a snapshot that holds from a time on. Snapshots come in the order
    of their times; a repeated one changes nothing."""
    dated = users.withColumn(VALID, F.lit(valid_from_ms).cast("long"))
    sinks.append_rows(dated, path, valid_from_ms, VALID, writer)


class Dimension:
    """All snapshots of a dimension, reloaded when a new version exists."""

    def __init__(self, spark: SparkSession, path: str, schema):
        self.spark, self.path, self.schema = spark, path, schema
        self.version, self.loads = -1, 0
        self._rows: DataFrame | None = None
        self._valid: list[int] = []

    def current(self) -> tuple[DataFrame, list[int]]:
        """(rows with valid_from_ms, the times from which versions hold)."""
        known = M.versions(self.spark, self.path)
        newest = known[-1] if known else 0
        if newest != self.version or self._rows is None:
            self._rows = sinks.read_table(self.spark, self.path, self.schema)
            self._valid = sorted(int(p.split("=")[1]) for p in sinks.part_counts(self.spark, self.path))
            self.version, self.loads = newest, self.loads + 1
        return self._rows, self._valid
