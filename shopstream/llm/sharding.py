"""Sharding by sampled splitters.

1. Every record gets a sort key (text hash, id, row number of the scan), so
   equal texts are neighbours and no two records tie.
2. A size-weighted sample of keys is drawn: a record of weight w is taken with
   probability ``sample * w / total``, decided by a hash of its key. Weighted
   quantiles of the sample are the splitters of ``ranges`` key ranges.
3. Records are range-partitioned. Weight is the size plus the mean size, so a
   range is bounded in bytes and in rows. Exact range totals give every range
   its offset in the global order, and the running size inside a range places
   each record: shard ``floor(position * shards / total)``. An overfull range,
   also one that a single hot text fills, is thus subdivided between shards.
4. A group of equal texts no larger than ``whole_group`` of a shard goes by
   the group's middle, so it is not torn apart by a shard border inside one
   range; a larger one (or one that spans ranges) is split.

Law: ``bytes`` - shard sizes are near equal: up to a record, or half a small
group, at each border. Only the sample (a bounded number of keys, whatever the
input) and one row per range reach the driver or a broadcast.

Defined results: a null text has no bytes; null ids sort first; repeated rows
are records of their own; extra columns are not read. An empty table gives no
rows.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

KEY = ("k1", "k2", "k3")


def record_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                overhead: int = 16) -> DataFrame:
    """(id, size, text_crc32, k1, k2, k3) of every record."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.select(
        F.col(f"`{id_col}`").alias("id"),
        (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(F.encode(text, "utf-8")).cast("long").alias("text_crc32"),
        F.xxhash64(text).alias("k1"),
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(-2**63)).alias("k2"),
        F.monotonically_increasing_id().alias("k3"))


def splitters(keys: DataFrame, ranges: int, sample: int) -> list[tuple]:
    """At most ranges - 1 ascending keys, weighted quantiles of the sample."""
    total, n = keys.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    if not n:
        return []
    weight = (F.col("size") + F.lit(total / n)) / F.lit(2 * total / sample)
    chance = (F.xxhash64(F.lit("sample"), *KEY).bitwiseAND(F.lit(2**53 - 1))) / F.lit(float(2**53))
    drawn = keys.select(*KEY, weight.alias("w")).where(chance < F.col("w"))
    points = sorted((r["k1"], r["k2"], r["k3"], max(1.0, r["w"])) for r in drawn.collect())
    step = sum(p[3] for p in points) / ranges
    out, run = [], 0.0
    for *key, w in points:
        if run >= step * (len(out) + 1) and len(out) < ranges - 1:
            out.append(tuple(key))
        run += w
    return out


def _range_of(bounds: list[tuple]) -> Column:
    """Number of bounds at or below the record's key: a search in two steps
    over a literal array, about twice the square root of its length."""
    if not bounds:
        return F.lit(0)
    kind = "struct<k1:bigint,k2:bigint,k3:bigint>"
    width = max(1, round(len(bounds) ** 0.5))
    blocks = [bounds[i:i + width] for i in range(0, len(bounds), width)]

    def literal(value, schema: str) -> Column:
        return F.from_json(F.lit(json.dumps(value)), schema)

    def as_dicts(keys):
        return [dict(zip(KEY, k)) for k in keys]

    key = F.struct(*KEY)
    heads = literal(as_dicts(b[0] for b in blocks), f"array<{kind}>")
    fine = literal([as_dicts(b) for b in blocks], f"array<array<{kind}>>")
    block = F.size(F.filter(heads, lambda b: b <= key)) - 1
    inside = F.size(F.filter(F.get(fine, block), lambda b: b <= key))
    return F.when(block < 0, F.lit(0)).otherwise(block * width + inside)


def assign_shards(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text",
                  ranges_per_shard: int = 16, sample_per_range: int = 32,
                  whole_group: float = 0.02) -> DataFrame:
    """(id, size, text_crc32, k3, shard, slot) for every record of docs."""
    keys = materialise(record_keys(docs, id_col, text_col), "shard-keys")
    ranges = shards * ranges_per_shard
    placed = keys.withColumn("rng", _range_of(splitters(keys, ranges, ranges * sample_per_range)))

    totals = placed.groupBy("rng").agg(F.sum("size").alias("bytes"))
    before = Window.orderBy("rng").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    offsets = totals.select("rng", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("offset"),
                            F.sum("bytes").over(whole).alias("total"))

    order = Window.partitionBy("rng").orderBy(*KEY).rowsBetween(Window.unboundedPreceding, 0)
    group = Window.partitionBy("rng", "k1")
    running = (placed.withColumn("end", F.sum("size").over(order))
               .withColumn("g_end", F.max("end").over(group))
               .withColumn("g_size", F.sum("size").over(group)))
    small = F.col("g_size") * shards <= F.col("total") * F.lit(whole_group)
    middle = F.when(small, F.col("g_end") - (F.col("g_size") / 2).cast("long")).otherwise(
        F.col("end") - (F.col("size") / 2).cast("long"))
    shard = F.least(F.floor((F.col("offset") + middle).cast("decimal(38,0)") * shards
                            / F.col("total")).cast("int"), F.lit(shards - 1))
    sharded = materialise(running.join(offsets, "rng").select(
        "id", "size", "text_crc32", *KEY, "rng", shard.alias("shard")), "shard-assigned")

    counts = sharded.groupBy("rng", "shard").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("shard").orderBy("rng").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("rng", "shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    inside = Window.partitionBy("rng", "shard").orderBy(*KEY)
    return (sharded.withColumn("nth", F.row_number().over(inside))
            .join(starts, ["rng", "shard"])
            .select("id", "size", "text_crc32", "k3", "shard",
                    (F.col("first") + F.col("nth") - 1).cast("long").alias("slot")))
