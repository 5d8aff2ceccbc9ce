"""Centroid clustering on bit planes (Lloyd's rounds in exact integers).

Each component x becomes the integer floor(scale * x). A vector of 64 integers
is stored as bit planes: bit i of plane b is bit b of component i, so a plane
is one uint64 and the top plane has the weight of a sign bit. A dot product is
then a weighted sum of AND-popcounts,

    x . c = sum over planes a, b of w_a w_b popcount(x_a & c_b),

and a squared distance is x.x - 2 x.c + c.c; component sums of a cluster are
the weighted counts of its set bits. Every number is an exact integer.

The planes are written once to the shared folder; a round is one scan of them
that sends k partial sums per task (bounded by k and 64), so hot clusters do
not matter and nothing of a vector is shuffled. Only the centroids (k x 64
integers) reach the driver. A round that changes no centroid is the last: all
further rounds would repeat it.

Defined results: vectors that are null, have another number of components, or
hold a null, NaN or infinite component are not kept and give no row. A kept
vector with a component beyond +-2^27 after scaling has distances that a long
cannot hold: it gets a row with nulls and takes no part in the centroids. A
null id hashes like an empty one. Rows that share an id are vectors of their
own; among equal seed hashes the smaller vector comes first. Fewer than k
vectors give fewer centroids, an empty table no rows. Other columns are not
read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise

DIMS = 64
LIMIT = 1 << 27
PACKED = "id long, planes binary"
ASSIGNED = "id long, cluster int, distance long"


def width_of(ints: np.ndarray) -> int:
    """Planes that two's complement needs for these integers."""
    if not ints.size:
        return 1
    return max(int(ints.max()).bit_length(), int(~ints.min()).bit_length() if ints.min() < 0 else 0) + 1


def to_planes(ints: np.ndarray, width: int) -> np.ndarray:
    """(n, 64) integers -> (n, width) planes."""
    out = np.empty((len(ints), width), np.uint64)
    for b in range(width):
        bits = ((ints >> b) & 1).astype(np.uint8)
        out[:, b] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64).reshape(-1)
    return out


def weights(width: int) -> np.ndarray:
    """Weight of each plane; the top one carries the sign."""
    w = np.int64(1) << np.arange(width, dtype=np.int64)
    w[-1] = -w[-1]
    return w


def dots(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """(n, k) exact dot products of planes x (n, w) and c (k, v)."""
    wx, wc = weights(x.shape[1]).astype(np.float64), weights(c.shape[1])
    out = np.zeros((len(x), len(c)), np.int64)
    for k in range(len(c)):
        for b in range(c.shape[1]):
            # at most 64 * 2^28, exact in a double
            part = np.bitwise_count(x & c[k, b]).astype(np.float64) @ wx
            out[:, k] += wc[b] * part.astype(np.int64)
    return out


def norms(x: np.ndarray) -> np.ndarray:
    """Exact squared lengths, by popcounts of each row's own planes."""
    w = weights(x.shape[1])
    out = np.zeros(len(x), np.int64)
    for a in range(x.shape[1]):
        for b in range(x.shape[1]):
            out += w[a] * w[b] * np.bitwise_count(x[:, a] & x[:, b]).astype(np.int64)
    return out


def bit_sums(x: np.ndarray) -> np.ndarray:
    """Component sums (64,) of planes x, from the counts of set bits."""
    bits = np.unpackbits(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.shape[1], 8), axis=2,
                         bitorder="little").reshape(len(x), x.shape[1], DIMS)
    return weights(x.shape[1]) @ bits.sum(axis=0, dtype=np.int64)


def unpack_rows(column: pa.Array) -> np.ndarray:
    """Binary planes of rows of several widths as one array: narrower rows
    repeat their sign plane, which leaves their integers as they are."""
    rows = column.to_pylist()
    width = max(len(r) for r in rows) // 8
    return np.frombuffer(b"".join(r if len(r) == 8 * width else r + r[-8:] * (width - len(r) // 8) for r in rows),
                         np.uint64).reshape(len(rows), width)


def _assign(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, distance) of each row of planes; ties go to the smaller number."""
    c = to_planes(centroids, width_of(centroids))
    d = norms(x)[:, None] - 2 * dots(x, c) + norms(c)[None, :]
    cluster = d.argmin(axis=1)
    return cluster, d[np.arange(len(x)), cluster]


def pack(vectors: DataFrame, scale: float) -> DataFrame:
    """Written planes (null where out of range) of vectors (id, vec)."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, DIMS)
            with np.errstate(over="ignore"):  # beyond the range, found by the next line
                x = np.floor(x * scale)
            ok = (np.abs(x) <= LIMIT).all(axis=1)
            ints = np.where(ok[:, None], x, 0).astype(np.int64)
            planes = to_planes(ints, width_of(ints))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([p.tobytes() if keep else None for p, keep in zip(planes, ok)], pa.binary())],
                names=["id", "planes"])

    return materialise(vectors.mapInArrow(step, PACKED), "planes")


def _kept(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    vec = F.col(f"`{vec_col}`").cast("array<double>")
    finite = F.forall(vec, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(math.inf)), F.lit(False)))
    return vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), vec.alias("vec")).where(
        vec.isNotNull() & (F.size(vec) == DIMS) & finite)


def _seeds(kept: DataFrame, k: int, seed: str, scale: float) -> np.ndarray:
    """The k vectors with the smallest hashes, as integers."""
    inside = F.forall("vec", lambda x: F.abs(F.floor(x * F.lit(scale))) <= LIMIT)
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    rows = kept.where(inside).orderBy(F.sha2(name, 256), "vec").limit(k).collect()
    return np.array([[math.floor(scale * x) for x in r["vec"]] for r in rows], np.int64).reshape(len(rows), DIMS)


def _round(packed: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round."""
    k = len(centroids)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(k, np.int64), np.zeros((k, DIMS), np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            x = unpack_rows(b.column(0))
            cluster, _ = _assign(x, centroids)
            for j in np.unique(cluster):
                mine = x[cluster == j]
                n[j] += len(mine)
                sums[j] += bit_sums(mine)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(k), pa.int32()), pa.array(n), pa.array(sums.tolist(), pa.list_(pa.int64()))],
            names=["cluster", "n", "sums"])

    parts = packed.select("planes").mapInArrow(step, "cluster int, n long, sums array<long>").where("n > 0")
    wide = parts.select("cluster", "n", F.posexplode("sums").alias("i", "s"))
    total = wide.groupBy("cluster", "i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    out = centroids.copy()
    for r in total.collect():  # at most k x 64 rows
        out[r["cluster"], r["i"]] = int(r["s"]) // r["n"]
    return out


def clustered(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 8,
              rounds: int = 10, seed: str = "3", scale: float = 1024.0) -> DataFrame:
    """One row per kept vector: id, cluster, distance (squared),
    cluster_inertia, inertia and centroid_sha256."""
    kept = _kept(vectors, id_col, vec_col)
    centroids = _seeds(kept, k, seed, scale)
    packed = pack(kept, scale)
    spark, inside = packed.sparkSession, packed.where("planes is not null")
    for _ in range(rounds if len(centroids) else 0):
        moved = _round(inside, centroids)
        if np.array_equal(moved, centroids):
            break
        centroids = moved

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            at = np.flatnonzero(b.column(1).is_valid().to_numpy(zero_copy_only=False))
            cluster, distance = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64)
            none = np.ones(b.num_rows, bool)
            if len(at):
                cluster[at], distance[at] = _assign(unpack_rows(b.column(1).take(pa.array(at))), centroids)
                none[at] = False
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(cluster.astype(np.int32), mask=none), pa.array(distance, mask=none)],
                names=["id", "cluster", "distance"])

    assigned = materialise(packed.mapInArrow(final, ASSIGNED), "assigned")
    whole = F.sum(F.col("distance").cast("decimal(38,0)"))
    per = {r["cluster"]: r["s"] for r in assigned.where("cluster is not null")
           .groupBy("cluster").agg(whole.alias("s")).collect()}  # at most k rows
    total = sum(per.values())
    names = [(j, per.get(j, 0), total, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
             for j, c in enumerate(centroids.tolist())]
    info = spark.createDataFrame(names, "cluster int, a decimal(38,0), b decimal(38,0), centroid_sha256 string")
    return (assigned.join(F.broadcast(info), "cluster", "left")
            .select("id", "cluster", "distance", F.expr("try_cast(a as bigint)").alias("cluster_inertia"),
                    F.expr("try_cast(b as bigint)").alias("inertia"), "centroid_sha256"))
