"""Substring dedup by fixed-block anchors.

A word is cut if a window of ``size`` words over it also starts earlier: in a
document with a smaller id, or earlier in the same row. Windows are judged on
the input.

1. Index and probe. Every document is cut into non-overlapping reference
   blocks of ``size // 2`` words; any window of ``size`` words contains a whole
   block. Every rolling window of a block's length is a probe. Shards exchange
   the hashes (short keys; a false meeting only costs a later check): a shard
   learns which of its probes meet a reference block elsewhere, and which of
   its blocks are probed elsewhere.
2. Extend. Only windows around a hit can repeat: windows that contain a
   probe with a hit, and windows whose first block was probed. Each gets a
   96-bit key of its words, and a second exchange tells whether a smaller id
   holds the same window. Runs of repeated windows are the maximal exact
   repeats; their words go.

Bounded work per task: a shard is a few MB of text, a key range a bounded
number of keys plus one per shard for a hot window. No pair of occurrences is
ever formed, so a passage in a third of all documents costs its length once
per document.

Defined results: null and empty texts have no words; a null id is smaller than
any other; rows that share an id are documents of their own that do not make
each other's windows "earlier". Every row gets a result. Other columns are not
read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from . import exchange as X
from .grams import NON_SPACE, Words, gram_hashes


def _any_in_window(hit: np.ndarray, w: int) -> np.ndarray:
    """For each start s: is any of hit[s .. s + w) true (shorter at the end)?"""
    total = np.concatenate(([0], np.cumsum(hit)))
    end = np.minimum(np.arange(len(hit)) + w, len(hit))
    return total[end] > total[:-1]


class _Windows:
    """Rolling probes and reference blocks of one shard."""

    def __init__(self, shard: X.Shard, size: int):
        self.size, self.block = size, size // 2
        self.words = Words(shard.data, shard.offsets, NON_SPACE, False)
        self.h = self.words.hashes()
        n = len(self.words)
        self.doc_end = self.words.doc_end()
        self.doc = np.repeat(np.arange(len(shard.ids)), np.diff(self.words.first))
        self.in_doc = np.arange(n) - self.words.first[self.doc] if n else np.zeros(0, np.int64)
        g = gram_hashes(self.h, self.block)
        self.probes = np.flatnonzero(np.arange(len(g)) + self.block <= self.doc_end[:len(g)])
        self.hash = g[self.probes]
        self.is_block = self.in_doc[self.probes] % self.block == 0

    def keys(self, ranges: X.Ranges) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(distinct short keys, which of them are blocks, place of each probe)."""
        short, place = np.unique(ranges.short(self.hash), return_inverse=True)
        block = np.zeros(len(short), bool)
        block[place[self.is_block]] = True
        return short, block, place

    def candidates(self, ranges: X.Ranges, hit: np.ndarray, probed: np.ndarray) -> np.ndarray:
        """First words of the windows that may repeat."""
        n = len(self.words)
        short, block, place = self.keys(ranges)
        times = np.bincount(place, minlength=len(short))
        blocks = np.bincount(place[self.is_block], minlength=len(short))
        # a probe meets another block of this shard, or one elsewhere
        met = hit[place] | (blocks[place] - self.is_block > 0)
        # a block is probed from another place of this shard, or from elsewhere
        used = self.is_block & (probed[place] | (times[place] > 1))
        word_met, word_used = np.zeros(n, bool), np.zeros(n, bool)
        word_met[self.probes[met]] = True
        word_used[self.probes[used]] = True
        start = np.arange(n)
        first_block = np.minimum(start + (-self.in_doc) % self.block, n - 1) if n else start
        fits = start + self.size <= self.doc_end
        return np.flatnonzero(fits & (_any_in_window(word_met, self.size - self.block + 1) | word_used[first_block]))

    def judged(self, ranges: X.Ranges, replies: list[dict] | None, ids: np.ndarray) -> tuple[np.ndarray, ...]:
        """Distinct window keys (first 64 bits, last 32 bits, least id), then
        for every candidate window its start, the place of its key, and
        whether it repeats inside the shard: a smaller id, or this row earlier."""
        starts = self.candidates(ranges, *X.answers(replies))
        if len(starts):
            a = gram_hashes(self.h, self.size)[starts]
            b = gram_hashes(self.words.hashes(seed=0x5BD1E995), self.size)[starts] >> np.uint64(32)
        else:
            a = b = np.zeros(0, np.uint64)
        owner = self.doc[starts]
        ka, kb, least, place = X.distinct_pairs(a, b.astype(np.uint32), ids[owner])
        order = np.lexsort((starts, place))
        again = np.zeros(len(starts), bool)
        again[order[1:]] = ((place[order][1:] == place[order][:-1]) & (owner[order][1:] == owner[order][:-1]))
        return ka, kb, least, starts, place, again | (ids[owner] > least[place])


def _merge_blocks(keys: np.ndarray, row: np.ndarray, more: list[bytes], n: np.ndarray) -> tuple:
    """Bits of a probe key: another row has it as a block; it is a block here
    and another row has it at all."""
    block = np.concatenate([np.unpackbits(np.frombuffer(m, np.uint8), count=k) for m, k in zip(more, n)]).astype(bool)
    _, place = np.unique(keys, return_inverse=True)
    holders, blocks = np.bincount(place), np.bincount(place[block], minlength=place.max(initial=-1) + 1)
    return blocks[place] - block > 0, block & (holders[place] > 1)


def _merge_least(keys: np.ndarray, row: np.ndarray, more: list[bytes], n: np.ndarray) -> tuple:
    second, ids = X.unpack_keys(more, n)
    out = X.smaller_elsewhere(keys, second, ids)
    return out, np.zeros(len(out), bool)


def repeated_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   size: int = 20) -> DataFrame:
    """One row per row of docs: id, n_words, n_removed, kept_sha256 and the
    removed runs (first word, number of words)."""
    shards = X.shard_table(docs, id_col, text_col)
    total = shards.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, s: a + s))).first()[0] or 0
    ranges = X.Ranges(total / 6)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, shard in X.shards_of(batches):
            short, block, _ = _Windows(shard, size).keys(ranges)
            yield X.sent_batch(list(X.send(row["shard"], ranges, ranges.bits, short,
                                           lambda p: np.packbits(block[p]).tobytes())))

    met = materialise(X.ask(shards.mapInArrow(probe, X.SENT), _merge_blocks), "probe-replies")
    asked = shards.join(met.withColumnRenamed("replies", "probed"), "shard", "left")
    wide = X.Ranges(total / 60)

    def publish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, shard in X.shards_of(batches):
            ka, kb, least, _, _, _ = _Windows(shard, size).judged(ranges, row["probed"], shard.ids)
            yield X.sent_batch(list(X.send(row["shard"], wide, 64, ka, lambda p: X.pack_key(kb[p], least[p]))))

    told = X.ask(asked.select("shard", "ids", "sizes", "blob", "probed").mapInArrow(publish, X.SENT), _merge_least)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, shard in X.shards_of(batches):
            windows = _Windows(shard, size)
            _, _, _, starts, place, gone = windows.judged(ranges, row["probed"], shard.ids)
            elsewhere, _ = X.answers(row["replies"])
            starts = starts[gone | elsewhere[place]] if len(starts) else starts
            words = windows.words
            cover = np.zeros(len(words) + 1, np.int64)
            np.add.at(cover, starts, 1)
            np.add.at(cover, np.minimum(starts + size, len(words)), -1)
            removed = np.cumsum(cover[:-1]) > 0
            counts, shas, runs = [], [], []
            for d in range(len(shard.ids)):
                lo, hi = words.first[d], words.first[d + 1]
                out = removed[lo:hi]
                kept = b" ".join([words.word(i) for i in np.flatnonzero(~out) + lo])
                edge = np.flatnonzero(np.diff(np.concatenate(([0], out.astype(np.int8), [0]))))
                counts.append((int(hi - lo), int(out.sum())))
                shas.append(hashlib.sha256(kept).hexdigest())
                runs.append([{"first": int(a), "words": int(z - a)} for a, z in zip(edge[::2], edge[1::2])])
            yield pa.RecordBatch.from_arrays([
                pa.array(shard.raw_ids, pa.int64()), pa.array([c[0] for c in counts], pa.int64()),
                pa.array([c[1] for c in counts], pa.int64()), pa.array(shas, pa.string()),
                pa.array(runs, pa.list_(pa.struct([("first", pa.int32()), ("words", pa.int32())])))],
                names=["id", "n_words", "n_removed", "kept_sha256", "runs"])

    return asked.join(told, "shard", "left").select("shard", "ids", "sizes", "blob", "probed", "replies").mapInArrow(
        cut, "id long, n_words long, n_removed long, kept_sha256 string, runs array<struct<first:int,words:int>>")
