"""Shards of documents and the exchange of hashed keys between them.

``shard_table`` turns documents into shards: at most a few MB of consecutive
texts each, compressed, one row per shard, written once. Later steps work on a
whole shard in numpy and name documents by their place in it, so repeated ids
and repeated rows need no care, and every step can be recomputed from the
written shards after an executor loss.

``ask`` is the exchange. Every shard sends the sorted distinct keys it holds,
cut by binary search into key ranges and packed as small deltas; each range is
merged in one task, which answers every shard with two bits per key. A key
that a third of all documents hold is sent once per shard, so a hot passage
adds one entry per shard to its range, and ranges are sized by the total number
of keys. Only packed keys move, never windows or texts.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .grams import BLOCK_BYTES, blocks

#: Keys that one merge task holds on average.
RANGE_KEYS = 1 << 18
NO_ID = -2**63

SHARD = "shard long, ids array<long>, sizes array<int>, blob binary"
SENT = "shard long, range int, n int, keys binary, more binary"
REPLY = "shard long, range int, n int, bits binary"


def squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def expand(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def pack(a: np.ndarray) -> bytes:
    """An integer array as compressed byte planes."""
    a = np.ascontiguousarray(a)
    return squeeze(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()) if len(a) else b""


def unpack(data: bytes, dtype, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, dtype)
    planes = np.frombuffer(expand(data), np.uint8).reshape(np.dtype(dtype).itemsize, n)
    return np.ascontiguousarray(planes.T).view(dtype).reshape(n)


def pack_key(second: np.ndarray, ids: np.ndarray) -> bytes:
    """The second parts of some keys, with their ids."""
    a, b = second.tobytes(), pack(ids)
    return len(a).to_bytes(8, "little") + a + b


def unpack_keys(more: list[bytes], n: np.ndarray, dtype=np.uint32) -> tuple[np.ndarray, np.ndarray]:
    """All second parts and ids of rows that ``pack_key`` made."""
    second, ids = [], []
    for m, k in zip(more, n):
        size = int.from_bytes(m[:8], "little")
        second.append(np.frombuffer(m[8:8 + size], dtype))
        ids.append(unpack(m[8 + size:], np.int64, int(k)))
    return np.concatenate(second), np.concatenate(ids)


def pack_all(*arrays: np.ndarray) -> bytes:
    """Several arrays in one value: an Arrow stream of one-row columns."""
    cols = [pa.array([a.tobytes()], pa.binary()) for a in arrays]
    meta = {f"t{i}": str(a.dtype) for i, a in enumerate(arrays)}
    batch = pa.RecordBatch.from_arrays(cols, schema=pa.schema(
        [pa.field(f"c{i}", pa.binary()) for i in range(len(cols))], metadata=meta))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return squeeze(sink.getvalue().to_pybytes())


def unpack_all(data: bytes) -> list[np.ndarray]:
    with pa.ipc.open_stream(expand(data)) as stream:
        meta, batch = stream.schema.metadata, stream.read_next_batch()
        return [np.frombuffer(batch.column(i)[0].as_py(), dtype=meta[f"t{i}".encode()].decode())
                for i in range(batch.num_columns)]


class Shard:
    """The documents of one shard: bytes, offsets, ids (null: smallest)."""

    def __init__(self, ids: list[int | None], sizes: list[int], blob: bytes):
        self.raw_ids = ids
        self.ids = np.array([NO_ID if i is None else i for i in ids], dtype=np.int64)
        self.offsets = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
        self.data = np.frombuffer(expand(blob), np.uint8) if self.offsets[-1] else np.zeros(0, np.uint8)

    def text(self, d: int) -> bytes:
        return self.data[self.offsets[d]:self.offsets[d + 1]].tobytes()


def shard_table(docs: DataFrame, id_col: str, text_col: str, limit: int = BLOCK_BYTES) -> DataFrame:
    """The written shards of docs. Splits of a scan depend on the cores there
    are when it is planned, so a shard's name holds only for written rows."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, part = 0, TaskContext.get().partitionId()
        for b in batches:
            ids = b.column(0).to_pylist()
            for first, end, data, off in blocks(b.column(1), limit):
                yield pa.RecordBatch.from_arrays([
                    pa.array([part << 32 | n], pa.int64()), pa.array([ids[first:end]], pa.list_(pa.int64())),
                    pa.array([np.diff(off).astype(np.int32)], pa.list_(pa.int32())),
                    pa.array([squeeze(data.tobytes())], pa.binary())], names=["shard", "ids", "sizes", "blob"])
                n += 1

    spark = docs.sparkSession
    path = scratch_path(spark, "shards")
    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    slim.mapInArrow(step, SHARD).write.option("compression", "none").parquet(path)
    return spark.read.schema(SHARD).parquet(path)


def shards_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Shard]]:
    """(row, shard) of each row of a shard table."""
    for b in batches:
        for row in b.to_pylist():
            yield row, Shard(row["ids"], row["sizes"], row["blob"])


class Ranges:
    """Key ranges for about n keys: how many, and how many bits keys need so
    that unequal keys rarely meet (a few in 10,000)."""

    def __init__(self, n: float):
        self.count = max(1, math.ceil(n / RANGE_KEYS))
        self.bits = min(62, max(32, math.ceil(math.log2(max(n, 2))) + 12))
        self.made: dict[int, np.ndarray] = {}

    def short(self, h: np.ndarray) -> np.ndarray:
        """Hashes cut to the key size."""
        return h >> np.uint64(64 - self.bits)

    def cuts(self, keys: np.ndarray, bits: int) -> np.ndarray:
        """Places in sorted keys where the next range begins."""
        return np.concatenate(([0], np.searchsorted(keys, self._bounds(bits)), [len(keys)]))

    def _bounds(self, bits: int) -> np.ndarray:
        """First key of each range but the first; made once in a process."""
        if bits not in self.made:
            self.made[bits] = np.array([(i << bits) // self.count for i in range(1, self.count)], dtype=np.uint64)
        return self.made[bits]


def send(shard: int, ranges: Ranges, bits: int, keys: np.ndarray,
         more: Callable[[slice], bytes] | None = None) -> Iterator[tuple[int, int, int, bytes, bytes]]:
    """The rows of SENT for one shard's sorted keys."""
    cuts = ranges.cuts(keys, bits)
    for r in np.flatnonzero(np.diff(cuts)):
        part = slice(cuts[r], cuts[r + 1])
        deltas = np.diff(keys[part], prepend=np.uint64(0))
        yield shard, int(r), int(cuts[r + 1] - cuts[r]), pack(deltas), more(part) if more else b""


def sent_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * 5
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                      names=["shard", "range", "n", "keys", "more"])


def ask(sent: DataFrame, answer: Callable[[np.ndarray, np.ndarray, list[bytes], np.ndarray], tuple]) -> DataFrame:
    """(shard, replies): for each shard the answers of all ranges. ``answer``
    gets the keys of a range, the row each came from, the rows' ``more`` and
    their sizes; it returns two boolean arrays over the keys."""
    def merge(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        n = np.array([r["n"] for r in rows])
        keys = [np.cumsum(unpack(r["keys"], np.uint64, r["n"]), dtype=np.uint64) for r in rows]
        a, b = answer(np.concatenate(keys), np.repeat(np.arange(len(rows)), n), [r["more"] for r in rows], n)
        ends = np.cumsum(n)
        bits = [np.packbits(np.concatenate([a[e - k:e], b[e - k:e]])).tobytes() for e, k in zip(ends, n)]
        return pa.table([pa.array([r["shard"] for r in rows], pa.int64()),
                         pa.array([r["range"] for r in rows], pa.int32()),
                         pa.array(n, pa.int32()), pa.array([squeeze(x) for x in bits], pa.binary())],
                        names=["shard", "range", "n", "bits"])

    replies = sent.groupBy("range").applyInArrow(merge, REPLY)
    return replies.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("range", "n", "bits"))).alias("replies"))


def answers(replies: list[dict] | None) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each sent key, in key order."""
    a, b = [np.zeros(0, bool)], [np.zeros(0, bool)]
    for r in replies or []:
        bits = np.unpackbits(np.frombuffer(expand(r["bits"]), np.uint8), count=2 * r["n"]).astype(bool)
        a.append(bits[:r["n"]])
        b.append(bits[r["n"]:])
    return np.concatenate(a), np.concatenate(b)


def smaller_elsewhere(first: np.ndarray, second: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each key pair, whether an equal pair has a smaller id."""
    order = np.lexsort((second, first))
    a, b = first[order], second[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    at = np.flatnonzero(new)
    least = np.minimum.reduceat(ids[order], at) if len(at) else ids
    out = np.empty(len(a), bool)
    out[order] = ids[order] > np.repeat(least, np.diff(np.append(at, len(a))))
    return out


def distinct_pairs(first: np.ndarray, second: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted distinct (first, second), the smallest id of each, and for every
    input the place of its pair."""
    order = np.lexsort((second, first))
    a, b = first[order], second[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    at = np.flatnonzero(new)
    place = np.empty(len(a), np.int64)
    place[order] = np.cumsum(new) - 1
    least = np.minimum.reduceat(ids[order], at) if len(at) else ids
    return a[at], b[at], least, place
