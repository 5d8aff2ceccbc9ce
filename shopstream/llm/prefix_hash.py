"""Document fingerprints from prefix polynomial hashes.

The prefix array of a text c_0 c_1 ... is P[i] = sum over j < i of c_j B^j mod
M. It answers whether any two spans are equal, also of different texts:
[a, a + n) of one and [b, b + n) of the other are equal if
(P[a + n] - P[a]) B^b = (Q[b + n] - Q[b]) B^a, and a longest common extension is
found by binary search over its length. Two 31-bit moduli are used, 62 bits
together.

A fingerprint is the prefix array sampled: the length, the hash of the whole
text, and P at up to ``CELLS`` multiples of a step (the smallest power of two
that gives no more), from the front and, of the reversed text, from the back.
Steps of two texts divide one another, so their arrays meet on the longer
step's grid. ``likeness`` locates the longest common extensions from both ends
by binary search over those arrays, and compares the cells of the two grids as
spans; it is the larger share of the longer text that they cover: 1 for equal
texts, 0 if no cell agrees.

``edited`` gives every document the next one in descending id order: rows are
range-partitioned once by id quantiles and sorted; a task streams its ranges,
and the first document of every range is sent along to the range before it, so
no neighbour is missed and nothing is collected. Texts are read in pieces, so a
long text needs memory for itself, not for its arrays.

Defined results: null text is empty; two empty texts have equal fingerprints
and likeness 1, an empty and another one likeness 0. A null id is smaller than
any other; rows that share an id follow the order of their text hashes; a
single row is its own next one. Other columns are not read. An empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELLS = 32
MODS = (np.uint64(2147483647), np.uint64(2147483629))
BASES = (np.uint64(1103515245), np.uint64(1640531527))
PIECE = 1 << 18
#: Code points of text of one range of ids, and the most ranges: beyond them
#: ranges grow (a range is sorted and streamed, never held). Ranges are dealt to
#: tasks by hash, so many small ones even out.
RANGE_CHARS, MOST_RANGES = 2 << 20, 20_000
_NONE = np.uint64(0)


class Powers:
    """Powers of the bases, grown by doubling; positions beyond the table are
    products of a table entry and a power of its last one."""

    def __init__(self):
        self.table = [np.ones(1, np.uint64) for _ in MODS]

    def upto(self, n: int) -> list[np.ndarray]:
        n = min(n, PIECE + 1)
        while len(self.table[0]) < n:
            for k, m in enumerate(MODS):
                t = self.table[k]
                step = t[-1] * BASES[k] % m
                self.table[k] = np.concatenate([t, t * step % m])
        return self.table

    def at(self, k: int, i: int) -> int:
        return pow(int(BASES[k]), i, int(MODS[k]))


_POWERS = Powers()


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def prefix_array(points: np.ndarray, k: int) -> np.ndarray:
    """P[0..n] of up to PIECE code points, modulus k. Code points count from 1,
    so that a leading U+0000 changes the hash."""
    power = _POWERS.upto(len(points) + 1)[k]
    terms = (points.astype(np.uint64) + np.uint64(1)) * power[:len(points)] % MODS[k]
    return np.concatenate([[_NONE], np.cumsum(terms) % MODS[k]])


def sampled(points: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(2, len(at)) values of the prefix arrays at the sorted places ``at``,
    a piece of the text at a time."""
    out = np.zeros((2, len(at)), np.uint64)
    base, carry = 0, [0, 0]
    while True:
        piece = points[base:base + PIECE]
        here = np.flatnonzero((at >= base) & (at <= base + len(piece)))
        for k, m in enumerate(MODS):
            p = prefix_array(piece, k)
            scale = np.uint64(_POWERS.at(k, base))
            out[k, here] = (np.uint64(carry[k]) + scale * p[at[here] - base]) % m
            carry[k] = int((np.uint64(carry[k]) + scale * p[-1]) % m)
        base += PIECE
        if base >= len(points):
            return out


class Prefixes:
    """Whole prefix arrays of a text (of at most PIECE code points)."""

    def __init__(self, text: str):
        points = code_points(text)
        if len(points) > PIECE:
            raise ValueError(f"{len(points)} code points; take pieces of {PIECE}")
        self.n, self.p = len(points), [prefix_array(points, k) for k in range(2)]

    def same_span(self, a: int, other: Prefixes, b: int, n: int) -> bool:
        """Whether n code points from a equal those of the other from b."""
        if a + n > self.n or b + n > other.n:
            return False
        power = _POWERS.upto(max(a, b) + 1)
        for k, m in enumerate(MODS):
            mine = (self.p[k][a + n] + m - self.p[k][a]) % m
            theirs = (other.p[k][b + n] + m - other.p[k][b]) % m
            if mine * power[k][b] % m != theirs * power[k][a] % m:
                return False
        return True

    def extension(self, a: int, other: Prefixes, b: int) -> int:
        """Length of the longest common extension from a and b."""
        low, high = 0, min(self.n - a, other.n - b)
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if self.same_span(a, other, b, mid) else (low, mid - 1)
        return low


def common_prefix(x: str, y: str) -> int:
    """Code points that two texts share from their starts, piece by piece."""
    at = 0
    while True:
        a, b = x[at:at + PIECE], y[at:at + PIECE]
        n = Prefixes(a).extension(0, Prefixes(b), 0)
        at += n
        if n < PIECE or n < min(len(a), len(b)):
            return at


def step_of(n: int) -> int:
    """Smallest power of two with at most CELLS whole steps in n."""
    step = 1
    while n // step > CELLS:
        step *= 2
    return step


def fingerprint(text: str) -> str:
    """Length, hash of the whole text, and the sampled prefix arrays of the
    text and of its reversal (8 hex digits a value)."""
    points = code_points(text)
    n, step = len(points), step_of(len(points))
    at = np.append(np.arange(1, n // step + 1) * step, n)
    front, back = sampled(points, at), sampled(points[::-1], at[:-1])
    values = [n, *front[:, -1].tolist(), *front[0, :-1].tolist(), *back[0].tolist()]
    return "".join(f"{v:08x}" for v in values)


def _parts(fp: str) -> tuple[int, int, str, np.ndarray, np.ndarray]:
    """(n, step, whole hash, front, back) of a fingerprint."""
    n = int(fp[:8], 16)
    cells = (len(fp) // 8 - 3) // 2
    values = np.frombuffer(bytes.fromhex(fp[24:]), ">u4").astype(np.uint64)
    return n, step_of(n), fp[8:24], values[:cells], values[cells:]


def _extent(p: np.ndarray, q: np.ndarray) -> int:
    """Cells shared from the start, by binary search: equal prefixes of a
    length have equal shorter ones."""
    low, high = 0, min(len(p), len(q))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if p[mid - 1] == q[mid - 1] else (low, mid - 1)
    return low


def _cells(p: np.ndarray, q: np.ndarray) -> int:
    """Cells of two grids that are equal as spans (same places, so the powers
    cancel)."""
    k, m = min(len(p), len(q)), MODS[0]
    a, b = np.concatenate([[_NONE], p[:k]]), np.concatenate([[_NONE], q[:k]])
    return int(np.count_nonzero((a[1:] + m - a[:-1]) % m == (b[1:] + m - b[:-1]) % m))


def likeness(x: str, y: str) -> float:
    """Likeness of two fingerprints, 0 to 1."""
    if x == y:
        return 1.0
    n, s, _, xf, xb = _parts(x)
    m, t, _, yf, yb = _parts(y)
    step = max(s, t)
    xf, xb, yf, yb = (v[step // u - 1::step // u] for v, u in ((xf, s), (xb, s), (yf, t), (yb, t)))
    ends = min((_extent(xf, yf) + _extent(xb, yb)) * step, n, m)
    best = max(ends, _cells(xf, yf) * step, _cells(xb, yb) * step)
    return min(best, max(n, m) - 1) / max(n, m, 1)


EDITED = ("id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double, common_edited long, common_next long")


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (range, tail, id, text) in stream order -> EDITED rows: each row
    but the tails is followed by its next one."""
    rows, held, size = [], None, 0

    def out() -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), *(pa.string(),) * 3, *(pa.float64(),) * 2, *(pa.int64(),) * 2)
        names = [c.split()[0] for c in EDITED.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    for b in batches:
        for i in range(b.num_rows):  # one text at a time, whatever the batch holds
            tail, doc, text = b.column(1)[i].as_py(), b.column(2)[i].as_py(), b.column(3)[i].as_py()
            fp = fingerprint(text)
            if held is not None:
                old, before, fp_before = held
                n = len(before)
                cut = n - n // 3
                new = before[:cut] + text[:n // 3]
                fp_new = fingerprint(new)
                # the edit keeps the first cut code points: search behind them
                kept = cut + common_prefix(before[cut:], new[cut:])
                rows.append((old, n, hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), fp_before,
                             fp_new, likeness(fp_before, fp_new), likeness(fp_before, fp), kept,
                             common_prefix(before, text)))
                size += 1
            held = None if tail else (doc, text, fp)
            if size >= 1000:
                yield out()
                rows, size = [], 0
    if rows:
        yield out()


def edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, n_chars, the digest of its edited text
    (the last third replaced by the start of the next document), both
    fingerprints, the likeness to the edited and to the next text, and the code
    points it shares with them from the start."""
    spark = docs.sparkSession
    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    slim = slim.select("id", "text", F.xxhash64("text").alias("h"))
    n, total = slim.agg(F.count(F.lit(1)), F.sum(F.length("text").cast("long"))).first()
    count = int(min(MOST_RANGES, max(16 * spark.sparkContext.defaultParallelism, (total or 0) // RANGE_CHARS)))
    shares = [(i + 1) / count for i in range(count - 1)]
    cuts = slim.agg(F.percentile_approx("id", shares, max(10_000, 10 * count))).first()[0] if shares and n else None
    # ranges in descending id order; null ids are the last
    bounds = np.unique(np.array(cuts or [], np.int64))

    def ranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            at = len(bounds) - np.searchsorted(bounds, ids, side="left")
            at[~b.column(0).is_valid().to_numpy(zero_copy_only=False)] = len(bounds) + 1
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *b.columns],
                                             names=["rng", "id", "text", "h"])

    rows = slim.mapInArrow(ranged, "rng int, id long, text string, h long")
    ids = slim.select("id", "h").withColumn("text", F.lit("")).select("id", "text", "h").mapInArrow(
        ranged, "rng int, id long, text string, h long")
    # the first key of every range goes to the range before it, the very first to the last
    first = {r["rng"]: r["k"] for r in ids.groupBy("rng").agg(
        F.max(F.struct(F.col("id").isNotNull().alias("known"), "id", "h")).alias("k")).collect()}  # one row a range
    order = sorted(first)
    tails = [(before, first[r]["id"], first[r]["h"]) for before, r in zip([order[-1], *order[:-1]], order)] if order else []
    named = spark.createDataFrame(tails, "to int, first_id long, first_h long")
    found = (slim.join(F.broadcast(named), F.col("id").eqNullSafe(F.col("first_id")) & (F.col("h") == F.col("first_h")))
             .groupBy("to").agg(F.first("id").alias("id"), F.first("text").alias("text"), F.first("h").alias("h")))
    # equal keys mean equal texts, so any of them will do
    stream = (rows.select("rng", F.lit(0).alias("tail"), "id", "text", "h")
              .unionByName(found.select(F.col("to").alias("rng"), F.lit(1).alias("tail"), "id", "text", "h"))
              .repartition("rng").sortWithinPartitions("rng", "tail", F.col("id").desc_nulls_last(), F.col("h").desc())
              .select("rng", "tail", "id", "text"))
    return stream.mapInArrow(_edits, EDITED)
