"""SimHash near-duplicates by Golay-code fuzzy hashing.

A text's fingerprint has a bit for each of 64 positions: 1 if more than half
of the XXH64 values of its word shingles have it. Fingerprints that differ in
at most two bits are linked.

Candidate keys. The 64 bits are cut into three segments. Of at most two
errors some segment has none, and the next one has at most two (pigeonhole).
The next segment, padded to 23 bits, is decoded in the binary Golay code
(23, 12): a word within 2 of a codeword gets that codeword's index; a word at
distance 3 also gets the five codewords at distance 4. Two words that differ
in at most two bits always share an index. So a fingerprint has, for each of
three cases, 1 or 6 keys (exact segment, index), 18 at most, and linked
fingerprints share at least one.

Links. Only distinct fingerprints are joined, so copies cost nothing. Buckets
of up to ``small_bucket`` fingerprints are self-joined on the key and verified
by their bit distance. A fingerprint that sits in a larger bucket instead
emits its 65 ball points (itself and every one-bit change): two fingerprints
share a ball point exactly if they differ in at most two bits, and a ball
point has at most 65 owners, each of which links to the smallest. That is
exact and linear however large the bucket is; no pair list of a group is made.

Components of the links are found by star contractions, and each component is
named by the smallest id among its documents.

Defined results: null and empty texts have no shingles and fingerprint zero,
linked like any other; texts of fewer words than a shingle are one shingle;
repeated rows share a fingerprint and a component; null ids are never a
component's name unless a component has no other. Extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .components import components

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
#: Generator polynomial of the binary Golay code, x^11+x^10+x^6+x^5+x^4+x^2+1.
GOLAY_POLY = 0b110001110101
#: (shift, bits) of the three segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
_CHUNK = 100_000


def fingerprint(text: str | None, size: int = 3, seed: int = 42) -> int:
    """The 64-bit fingerprint of one text (A-Z lower-cased)."""
    ws = WORD.findall((text or "").encode().lower())
    if not ws:
        return 0
    if len(ws) < size:
        return xxhash.xxh64_intdigest(b" ".join(ws), seed)
    digest, ones, n = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(ws) - size + 1
    for at in range(0, n, _CHUNK):  # long texts in pieces of bounded memory
        end = min(n, at + _CHUNK)
        cols = [ws[at + t:end + t] for t in range(size)]
        h = np.array([digest(b" ".join(s), seed) for s in zip(*cols)], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text_col: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """All columns of docs but the text, and ``fp`` (the fingerprint as a
    signed long)."""
    kept = [c for c in docs.columns if c not in (text_col, "fp")]
    schema = docs.select(*[F.col(f"`{c}`") for c in kept], F.lit(0).cast("long").alias("fp")).schema

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = b.schema.names
            fps = np.array([fingerprint(t.as_py(), shingle, seed) for t in b.column(names.index(text_col))],
                           dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(names.index(c)) for c in kept] + [
                pa.array(fps.view(np.int64))], names=[*kept, "fp"])

    return docs.select(*[F.col(f"`{c}`") for c in [*kept, text_col]]).mapInArrow(step, schema)


def _syndrome(v: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit polynomials by the generator."""
    v = v.astype(np.int64).copy()
    for bit in range(22, 10, -1):
        v ^= np.where(v >> bit & 1, GOLAY_POLY << (bit - 11), 0)
    return v


def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """For each of the 2,048 syndromes: the error of weight at most 3, and the
    errors of weight 4 (five of them if the first has weight 3, else none)."""
    near = np.zeros(2048, np.int64)
    for weight in (1, 2, 3):
        errors = np.array([sum(1 << b for b in c) for c in combinations(range(23), weight)])
        near[_syndrome(errors)] = errors
    fours = np.array([sum(1 << b for b in c) for c in combinations(range(23), 4)])
    syn = _syndrome(fours)
    order = np.argsort(syn, kind="stable")
    far = np.full((2048, 5), -1, np.int64)
    groups, starts = np.unique(syn[order], return_index=True)
    far[groups] = fours[order][starts[:, None] + np.arange(5)]
    return near, far


_TABLES: list[tuple[np.ndarray, np.ndarray]] = []


def golay_indices(v: np.ndarray) -> np.ndarray:
    """(n, 6) indices of the codewords near 23-bit words; -1: none."""
    if not _TABLES:
        _TABLES.append(golay_tables())
    near, far = _TABLES[0]
    syn = _syndrome(v)
    first = (v ^ near[syn]) >> 11
    rest = np.where(far[syn] >= 0, (v[:, None] ^ far[syn]) >> 11, -1)
    return np.concatenate([first[:, None], rest], axis=1)


def candidate_keys(fps: np.ndarray) -> np.ndarray:
    """(n, 18) keys of fingerprints (uint64); -1: no key."""
    seg = [((fps >> np.uint64(s)) & np.uint64((1 << b) - 1)).astype(np.int64) for s, b in SEGMENTS]
    out = []
    for case in range(3):
        index = golay_indices(seg[(case + 1) % 3])
        key = (np.int64(case) << 34 | seg[case] << 12)[:, None] | index
        out.append(np.where(index >= 0, key, -1))
    return np.concatenate(out, axis=1)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fps = np.asarray(b.column(0).to_numpy(zero_copy_only=False), dtype=np.int64)
        keys = candidate_keys(fps.view(np.uint64))
        row, col = np.nonzero(keys >= 0)
        yield pa.RecordBatch.from_arrays([pa.array(fps[row]), pa.array(keys[row, col])], names=["fp", "key"])


def _balls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    flips = np.concatenate([[np.uint64(0)], np.uint64(1) << np.arange(64, dtype=np.uint64)])
    for b in batches:
        fps = np.asarray(b.column(0).to_numpy(zero_copy_only=False), dtype=np.int64)
        for at in range(0, len(fps), 10_000):
            some = fps[at:at + 10_000]
            points = some.view(np.uint64)[:, None] ^ flips
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(some, 65)),
                                              pa.array(points.reshape(-1).view(np.int64))], names=["fp", "point"])


def links(fps: DataFrame, small_bucket: int = 16) -> DataFrame:
    """Links (u, v), u > v, between distinct fingerprints fp that connect
    exactly what the links of at most two differing bits connect: every pair
    of a small bucket, and in large ones every owner of a ball point with the
    smallest owner."""
    keyed = materialise(fps.select("fp").distinct().mapInArrow(_keyed, "fp long, key long"), "golay-keys")
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    crowded = keyed.join(sizes.where(F.col("n") > small_bucket), "key")
    small = keyed.join(sizes.where(F.col("n") <= small_bucket), "key").select("key", "fp")
    a, b = small.select("key", F.col("fp").alias("u")), small.select("key", F.col("fp").alias("v"))
    close = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= 2
    pairs = a.join(b, "key").where((F.col("u") > F.col("v")) & close).select("u", "v").distinct()
    points = crowded.select("fp").distinct().mapInArrow(_balls, "fp long, point long")
    least = points.groupBy("point").agg(F.min("fp").alias("v"), F.count(F.lit(1)).alias("n")).where("n > 1")
    balls = (points.join(least, "point").where(F.col("fp") > F.col("v"))
             .select(F.col("fp").alias("u"), "v").distinct())
    return pairs.union(balls)


def grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
            seed: int = 42, small_bucket: int = 16) -> DataFrame:
    """All columns of docs but the text, ``fp`` and ``component``: the smallest
    id of the documents reachable over links."""
    marked = materialise(fingerprints(docs, text_col, shingle, seed), "fingerprints")
    per_fp = marked.groupBy("fp").agg(F.min(F.col(f"`{id_col}`")).alias("least"))
    roots = components(links(per_fp, small_bucket))
    rooted = (per_fp.join(roots, per_fp["fp"] == roots["node"], "left")
              .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    names = rooted.groupBy("root").agg(F.min("least").alias("component"))
    of_fp = rooted.join(names, "root").select("fp", "component")
    return marked.drop("component").join(of_fp, "fp")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """docs with one document of each component: the smallest id, and of rows
    that share it the first of the scan. Columns as in docs. Rows are written
    with their number once: a second scan may be split in another way."""
    wide = materialise(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                                   F.monotonically_increasing_id().alias("_nth")), "numbered")
    slim = wide.select(F.col(f"_row.`{id_col}`").alias("doc"), F.col(f"_row.`{text_col}`").alias("text"), "_nth")
    members = grouped(slim, "doc", "text", **kw)
    order = F.struct(F.col("doc").isNull(), "doc", "_nth")
    stay = (members.groupBy("component").agg(F.min(order).alias("first"))
            .select(F.col("first._nth").alias("_nth")))
    return wide.join(stay, "_nth").select("_row.*")
