"""Keyed and append sinks on Parquet.

Parquet has no MERGE. A sink writes each batch once, as its own data folder
partitioned by the date column, and publishes it by a new version of the
table's manifest (``sinks.manifest``); readers resolve the key (first or latest
row by an order). So a batch costs its own rows, whatever the table holds, and
it is there as a whole or not at all.

A batch is named by its writer and number: the writer is the streaming query's
id, which its checkpoint keeps, so a replayed batch is recognised and changes
nothing, while a job started on a new checkpoint is another writer and adds to
the table. Rows carry the sequence number of their batch (``_seq``), the last
tie-break of the key: of equal rows by the order the later write wins (for
``keep='first'`` the earlier one).

``compact`` folds the batches of chosen partitions into one folder. Rows keep
their sequence numbers, so the answer is the same; readers that started before
keep reading the old folders, which ``manifest.vacuum`` removes later.

Partition values are dates or months. Rows without one stay, in the null
partition.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import dedupe
from . import manifest as M

SEQ = "_seq"
FOLDER = "_w"


def writer_of(spark: SparkSession, checkpoint: str) -> str:
    """The id that a started streaming query has for as long as its checkpoint
    lives."""
    return json.loads(M.read_text(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]


def _write(rows: DataFrame, path: str, partition_col: str) -> M.Entry:
    """Write one data folder (not part of the table yet)."""
    name = f"{FOLDER}={uuid.uuid4().hex}"
    where = f"{path.rstrip('/')}/data/{name}"
    rows.write.partitionBy(partition_col).parquet(where)
    names = [s.getPath().getName() for s in M.children(rows.sparkSession, where) if s.isDirectory()]
    return M.Entry(name, sorted(n for n in names if n.startswith(f"{partition_col}=")))


def _commit(rows: DataFrame, path: str, partition_col: str, writer: str, batch_id: int) -> None:
    """Publish a batch once. A batch that this writer has published is a replay;
    where another writer was faster, its version is built upon."""
    spark, entry, seq = rows.sparkSession, None, -1
    while True:
        now = M.load(spark, path)
        if now.last.get(writer, -1) >= batch_id:
            return
        if entry is None or seq != now.next_seq:
            seq = now.next_seq
            entry = _write(rows.withColumn(SEQ, F.lit(seq).cast("long")), path, partition_col)
            if not entry.parts:
                return
        new = now.next()
        new.entries.append(entry)
        new.last[writer], new.next_seq = batch_id, seq + 1
        if M.publish(spark, path, new):
            return


def _pick(rows: DataFrame, keys: list[str], order: list[str], keep: str) -> DataFrame:
    return (dedupe.latest_per_key if keep == "latest" else dedupe.first_per_key)(rows, keys, [*order, SEQ])


def upsert(incoming: DataFrame, path: str, keys: list[str], order: list[str], partition_col: str,
           batch_id: int, keep: str = "latest", cluster_by: list[str] | None = None, writer: str = "batch",
           compact_after: int | None = None) -> None:
    """K1/K2/K4: one batch of a keyed table. The batch is reduced to one row
    per key before it is written; columns are written by name (P26).
    ``cluster_by`` sorts rows inside files so that row-group statistics prune
    finer than the partition (e.g. month partitions, day lookups). Partitions
    that more than ``compact_after`` batches have written to are folded."""
    pick = dedupe.latest_per_key if keep == "latest" else dedupe.first_per_key
    # a partition's rows meet in few tasks: else each task of the reduction writes a file to every partition
    rows = pick(incoming, keys, order).hint("rebalance", partition_col)
    if cluster_by:
        rows = rows.sortWithinPartitions(partition_col, *cluster_by)
    _commit(rows, path, partition_col, writer, batch_id)
    if compact_after:
        spark = incoming.sparkSession
        many = [p for p, n in part_counts(spark, path).items() if n > compact_after]
        if many:
            compact(spark, path, incoming.schema, keys, order, partition_col, keep, many)


def part_counts(spark: SparkSession, path: str) -> dict[str, int]:
    """How many data folders each partition folder name is in."""
    return dict(Counter(p for e in M.load(spark, path).entries for p in e.parts))


def _read(spark: SparkSession, path: str, schema: T.StructType, parts: list[tuple[str, str]]) -> DataFrame:
    """Rows of some partition folders, with their sequence numbers."""
    full = T.StructType([*schema.fields, T.StructField(SEQ, T.LongType())])
    if not parts:
        return spark.createDataFrame([], full)
    base = f"{path.rstrip('/')}/data"
    rows = spark.read.schema(full).option("basePath", base).parquet(*[f"{base}/{f}/{p}" for f, p in parts])
    return rows.select(*[f"`{f.name}`" for f in full.fields])


def _chosen(now: M.Manifest, partitions: Iterable[str] | None) -> list[tuple[str, str]]:
    wanted = None if partitions is None else set(partitions)
    return [(e.folder, p) for e in now.entries for p in e.parts if wanted is None or p in wanted]


def _as_schema(schema: T.StructType | str) -> T.StructType:
    return T._parse_datatype_string(schema) if isinstance(schema, str) else schema


def read_table(spark: SparkSession, path: str, schema, partitions: Iterable[str] | None = None) -> DataFrame:
    """All rows of the newest version; ``partitions`` (folder names such as
    ``logdate=2024-01-01``) reads only these. An unwritten table has no rows."""
    schema = _as_schema(schema)
    return _read(spark, path, schema, _chosen(M.load(spark, path), partitions)).drop(SEQ)


def read_keyed(spark: SparkSession, path: str, schema, keys: list[str], order: list[str],
               keep: str = "latest") -> DataFrame:
    """A keyed table with one row per key. A filter on a key that is also the
    partition column prunes folders."""
    schema = _as_schema(schema)
    rows = _read(spark, path, schema, _chosen(M.load(spark, path), None))
    return _pick(rows, keys, order, keep).drop(SEQ)


def compact(spark: SparkSession, path: str, schema, keys: list[str], order: list[str], partition_col: str,
            keep: str = "latest", partitions: Iterable[str] | None = None) -> None:
    """Fold the batches of some partitions (all by default) into one folder.
    Batches may be published meanwhile: they stay as they are."""
    schema, seen = _as_schema(schema), M.load(spark, path)
    parts = _chosen(seen, partitions)
    if len({f for f, _ in parts}) < 2:
        return
    rows = _pick(_read(spark, path, schema, parts), keys, order, keep)
    entry, folded = _write(rows.hint("rebalance", partition_col), path, partition_col), set(parts)
    while True:
        new = M.load(spark, path).next()
        left = [M.Entry(e.folder, [p for p in e.parts if (e.folder, p) not in folded]) for e in new.entries]
        if {(e.folder, p) for e in new.entries for p in e.parts} >= folded:
            new.entries = [*(e for e in left if e.parts), entry]
            if M.publish(spark, path, new):
                return
        else:
            return  # another compaction took them; its folder has the rows


def append_batch(df: DataFrame, path: str, batch_id: int, date_col: str = "dt", writer: str = "batch") -> None:
    """K3 for ``foreachBatch``: one batch of an append table, partitioned by
    the month of ``date_col``; a replayed batch changes nothing (the
    reference's id-less bulk append duplicated it, Q18)."""
    month = f"{date_col}_month"
    rows = (df.withColumn(month, F.substring(date_col, 1, 7)).hint("rebalance", month)
            .sortWithinPartitions(month, date_col))
    _commit(rows, path, month, writer, batch_id)


def append_rows(df: DataFrame, path: str, batch_id: int, partition_col: str, writer: str = "batch") -> None:
    """One batch of an append table, partitioned by a column as it is."""
    _commit(df, path, partition_col, writer, batch_id)
