"""Benchmark decontamination by winnowing.

Texts and test items become lower-cased words and k-gram hashes. Of every
``w`` consecutive grams the smallest hash is kept (winnowing), with
``k + w - 1 = n``: any n words that a text shares with an item contain one
whole winnowing window, so both sides keep the same gram there. Kept grams are
the fingerprints; texts are joined with items on them, and each hit is
extended word by word to the longest shared span, so a span counts only if it
really holds n shared words and none is missed. An item of fewer than n words
is one window of its own length and gets its own winnowing of that length.

The items are the bounded side: they are dealt into blocks of about
``block_words`` words by a hash of their words (equal items count once), each
block is shared with all tasks, and the documents pass through one narrow step
per block. Nothing of the documents is shuffled or collected, so a hot source
or passage changes nothing, and a lost executor costs its own tasks.

Defined results: null and empty texts have no words, no hits and are clean; an
item without words is ignored; items that share an id are one item; an item
with a null id marks words but is not listed. Rows are judged one by one, so
repeated rows repeat their result. Result columns replace columns of the same
name. Empty tables give an empty or a clean result.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import lower_ascii
from .grams import ALNUM, Words, blocks, gram_hashes, window_minima

WORD = r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"


class ItemIndex:
    """Fingerprints of one block of items: for each window length the sorted
    hashes and, per hash, the (item, position) pairs that keep it."""

    def __init__(self, items: list[tuple[list[str], list[str]]], n: int, k: int):
        self.words = [[w.encode() for w in ws] for ws, _ in items]
        self.ids = [ids for _, ids in items]
        found: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for item, ws in enumerate(self.words):
            size = min(n, len(ws))
            text = b" ".join(ws)
            block = Words(np.frombuffer(text, np.uint8), np.array([0, len(text)]), ALNUM, True)
            for pos, h in zip(*winnow(block.hashes(), block.doc_end(), size, k)):
                found.setdefault(size, {}).setdefault(int(h), []).append((item, int(pos)))
        self.by_size = {size: (np.array(sorted(hs), dtype=np.uint64), hs) for size, hs in found.items()}


def winnow(h: np.ndarray, doc_end: np.ndarray, size: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the grams kept for shared spans of ``size``."""
    k = min(k, size)
    g = gram_hashes(h, k)
    w = size - k + 1
    starts = np.arange(max(0, len(g) - w + 1))
    valid = starts + size <= doc_end[:len(starts)]
    pos = window_minima(g, w, valid)
    return pos, g[pos] if len(pos) else np.zeros(0, np.uint64)


def _extend(block: Words, lo: int, hi: int, j: int, item: list[bytes], p: int) -> tuple[int, int]:
    """The longest span [a, b) of words lo..hi around j equal to item's words
    around p; empty if the words at j and p differ."""
    a, q = j, p
    while a > lo and q > 0 and block.word(a - 1) == item[q - 1]:
        a, q = a - 1, q - 1
    b, q = j, p
    while b < hi and q < len(item) and block.word(b) == item[q]:
        b, q = b + 1, q + 1
    return a, b


def block_hits(block: Words, index: ItemIndex, k: int) -> dict[int, tuple[list[tuple[int, int]], set[int]]]:
    """For each document of the block with hits: spans of words and items."""
    h, doc_end = block.hashes(), block.doc_end()
    out: dict[int, tuple[list[tuple[int, int]], set[int]]] = {}
    for size, (keys, places) in index.by_size.items():
        pos, hashes = winnow(h, doc_end, size, k)
        at = np.searchsorted(keys, hashes)
        at[at == len(keys)] = 0
        same = np.flatnonzero(keys[at] == hashes)
        docs = np.searchsorted(block.first, pos[same], side="right") - 1
        done: dict[tuple[int, int], int] = {}
        for s, d in zip(same, docs):
            j = int(pos[s])
            lo, hi = int(block.first[d]), int(block.first[d + 1])
            for item, p in places[int(hashes[s])]:
                if done.get((item, j - p), -1) > j:
                    continue
                a, b = _extend(block, lo, hi, j, index.words[item], p)
                done[item, j - p] = max(b, j + 1)
                if b - a >= size:
                    spans, items = out.setdefault(int(d), ([], set()))
                    spans.append((a - lo, b - lo))
                    items.add(item)
    return out


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_INDEX: dict[str, ItemIndex] = {}


def _index_of(name: str, shared: Broadcast, n: int, k: int) -> ItemIndex:
    """The index of the block of that name, built once per Python worker."""
    if name not in _INDEX:
        _INDEX.clear()
        _INDEX[name] = ItemIndex(shared.value, n, k)
    return _INDEX[name]


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_words: int) -> Iterator[list]:
    """The items' distinct word sequences with their ids, block by block."""
    seqs = (items.select(F.regexp_extract_all(lower_ascii(F.col(f"`{text_col}`")), F.lit(WORD), F.lit(1)).alias("ws"),
                         F.col(f"`{id_col}`").cast("string").alias("id"))
            .where(F.size("ws") > 0).groupBy("ws").agg(F.collect_set("id").alias("ids")))
    total = seqs.agg(F.sum(F.size("ws"))).first()[0] or 0
    n_blocks = max(1, math.ceil(total / block_words))
    for b in range(n_blocks):
        part = seqs.where(F.pmod(F.xxhash64("ws"), F.lit(n_blocks)) == b)
        yield [(r["ws"], r["ids"]) for r in part.collect()]


def contamination(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
                  item_text_col: str = "text", n: int = 13, k: int = 5, block_words: int = 2_000_000) -> DataFrame:
    """docs plus n_words, hit_spans (word positions) and hit_items (ids)."""
    spark = docs.sparkSession
    out_cols = ["n_words", "hit_spans", "hit_items"]
    kept = [c for c in docs.columns if c.lower() not in out_cols]
    schema = T.StructType([docs.schema[c] for c in kept] + [
        T.StructField("n_words", T.LongType()), T.StructField("hit_spans", SPANS),
        T.StructField("hit_items", T.ArrayType(T.StringType()))])
    state = docs.select(*[F.col(f"`{c}`") for c in kept], F.lit(0).cast("long").alias("n_words"),
                        F.array().cast(SPANS).alias("hit_spans"), F.array().cast("array<string>").alias("hit_items"))
    for rows in item_blocks(items, item_id_col, item_text_col, block_words):
        shared = spark.sparkContext.broadcast(rows)

        name = uuid.uuid4().hex

        def step(batches: Iterator[pa.RecordBatch], shared: Broadcast = shared,
                 name: str = name) -> Iterator[pa.RecordBatch]:
            index = _index_of(name, shared, n, k)
            for batch in batches:
                names = batch.schema.names
                old_spans, old_items = batch.column(names.index("hit_spans")).to_pylist(), batch.column(
                    names.index("hit_items")).to_pylist()
                counts: list[int] = []
                for first, end, data, off in blocks(batch.column(names.index(text_col))):
                    block = Words(data, off, ALNUM, True)
                    counts += np.diff(block.first).tolist()
                    for d, (spans, hits) in block_hits(block, index, k).items():
                        spans += [(s["start"], s["end"]) for s in old_spans[first + d]]
                        old_spans[first + d] = [{"start": a, "end": b} for a, b in merge_spans(spans)]
                        ids = {i for x in hits for i in index.ids[x]}
                        old_items[first + d] = sorted(ids | set(old_items[first + d]))
                cols = [batch.column(i) for i in range(len(names) - 3)]
                yield pa.RecordBatch.from_arrays(cols + [
                    pa.array(counts, pa.int64()),
                    pa.array(old_spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                    pa.array(old_items, pa.list_(pa.string()))], names=names)

        state = state.mapInArrow(step, schema)
    return state


def judged(docs: DataFrame, items: DataFrame, per_hit: int = 20, **kw) -> DataFrame:
    """contamination() plus n_hit, n_items, items_sha256 and contaminated:
    at least one word in ``per_hit`` words is hit."""
    found = contamination(docs, items, **kw)
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return (found.withColumn("n_hit", n_hit)
            .withColumn("n_items", F.size("hit_items").cast("long"))
            .withColumn("items_sha256", F.sha2(F.array_join("hit_items", ","), 256))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * per_hit >= F.col("n_words"))))


def clean(docs: DataFrame, items: DataFrame, **kw) -> DataFrame:
    """The rows of docs that are not contaminated, with the columns of docs
    (also those named like a result column)."""
    text_col = kw.pop("text_col", "text")
    wide = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       F.col(f"`{text_col}`").alias("_text"))
    return judged(wide, items, text_col="_text", **kw).where(~F.col("contaminated")).select("_row.*")
