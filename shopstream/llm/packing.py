"""Packing: concatenate all documents, cut at fixed windows.

Pass 1 tokenises every document once and writes its ids with the input
partition it came from and its token offset inside that partition. The
partition totals (one row per partition) become global offsets by a prefix
sum. Pass 2 adds the partition's offset and cuts each document at multiples of
the window: window w holds global tokens [w * size, (w + 1) * size), so every
window but the last is full and a document lies in consecutive windows. A
window at a partition border takes pieces from both sides (boundary records);
pieces name their window and place in it, so any reader joins them.

Only the partition totals move between the passes. They are broadcast: one
row of 24 bytes per input partition. Pass 2 is a narrow scan, so neither a hot
source nor a very long document moves rows to one task.

A byte-level BPE file whose merges are numbered in merge order is run by the
faster of the two installed engines, built from the same file; any other file
by its own library. Both give the same ids, which tests compare.

Defined results: strings of the file's added tokens in a text become their
ids; a text that the faster engine gives up on (a million blanks in a row) is
encoded by the file's own library; a null or empty text is the end id alone; repeated rows and
equal ids are packed as documents of their own; result columns replace columns
of the same name, other columns pass through.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .common import spare

# Fixed value: the pre-token pattern of byte-level BPE.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Encoder:
    """Token ids of texts. With ``added`` the strings of the file's added
    tokens become their ids, as in the file's own library; without, they are
    ordinary text."""

    def __init__(self, path: str, added: bool = False):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.path, self.added, self.tokenizer = path, added, None
        tokens = [t for t in spec.get("added_tokens") or [] if t["content"]]
        ranks = self._byte_ranks(spec) if not added or self._plain_added(tokens, spec["model"]) else None
        if ranks:
            import tiktoken
            self.fast = tiktoken.Encoding("from-file", pat_str=PATTERN, mergeable_ranks=ranks,
                                          special_tokens={t["content"]: t["id"] for t in tokens if added})
        else:
            self.fast = None

    @staticmethod
    def _plain_added(tokens: list[dict], model: dict) -> bool:
        """Whether both engines find the same added tokens: exact strings of
        one kind, none of which begins another or is made by merges."""
        names = [t["content"] for t in tokens]
        merged = {"".join(m.split(" ") if isinstance(m, str) else m) for m in model.get("merges", ())}
        return (not any(t.get(k) for t in tokens for k in ("single_word", "lstrip", "rstrip"))
                and len({bool(t.get("normalized")) for t in tokens}) <= 1
                and not any(a != b and b.startswith(a) for a in names for b in names)
                and not any(len(n) == 1 or n in merged for n in names))

    @staticmethod
    def _byte_ranks(spec: dict) -> dict[bytes, int] | None:
        """Bytes of each token to its id, if the file is plain byte-level BPE
        with ids in merge order; else None."""
        split, model = spec.get("pre_tokenizer") or {}, spec["model"]
        plain = (model.get("type") == "BPE" and split.get("type") == "ByteLevel" and split.get("use_regex", True)
                 and not split.get("add_prefix_space") and not spec.get("normalizer")
                 and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix",
                                                    "end_of_word_suffix", "byte_fallback", "ignore_merges")))
        if not plain:
            return None
        merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if merged != sorted(merged):
            return None
        # byte-level files write printable bytes as themselves, the others from U+0100 on
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [b for b in range(256) if b not in printable]
        byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
        added = {t["content"] for t in spec.get("added_tokens", [])}
        return {bytes(byte[c] for c in t): i for t, i in model["vocab"].items() if t not in added}

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        if self.fast:
            try:
                return self.fast.encode_to_numpy(text, allowed_special="all").astype(np.int32)
            except ValueError:  # its pattern gives up on about a million blanks in a row
                pass
        return np.array(self._own().encode(text, add_special_tokens=False).ids, np.int32)

    def _own(self):
        """The file's own library, loaded when it is needed."""
        if self.tokenizer is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread per task
            from tokenizers import Tokenizer
            self.tokenizer = Tokenizer.from_file(self.path)
            self.tokenizer.encode_special_tokens = not self.added
        return self.tokenizer


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path, added=True)
    return _ENCODERS[path]


def tokenised(docs: DataFrame, tokenizer_path: str, text_col: str = "text", end_id: int = 1,
              rows_at_once: int = 200) -> DataFrame:
    """docs without the text, plus part, part_start (token offset in the
    partition) and ids (array)."""
    new = ("part", "part_start", "ids")
    kept = [c for c in docs.columns if c != text_col and c.lower() not in new]
    schema = T.StructType([docs.schema[c] for c in kept] + [
        T.StructField("part", T.IntegerType()), T.StructField("part_start", T.LongType()),
        T.StructField("ids", T.ArrayType(T.IntegerType()))])
    end = np.array([end_id], np.int32)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, done = _encoder(tokenizer_path), TaskContext.get().partitionId(), 0
        for whole in batches:
            for at in range(0, whole.num_rows, rows_at_once):
                b = whole.slice(at, rows_at_once)
                names = b.schema.names
                encoded = [encoder.encode(t.as_py()) for t in b.column(names.index(text_col))]
                sizes = np.array([len(x) + 1 for x in encoded], dtype=np.int64)
                ends = np.cumsum(sizes)
                flat = np.concatenate([ids for x in encoded for ids in (x, end)])
                ids = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays(
                    [b.column(names.index(c)) for c in kept] + [
                        pa.array(np.full(len(sizes), part, np.int32)), pa.array(done + ends - sizes), ids],
                    names=[*kept, *new])
                done += int(ends[-1])

    return docs.select(*[F.col(f"`{c}`") for c in [*kept, text_col]]).mapInArrow(step, schema)


def pieces(docs: DataFrame, tokenizer_path: str, text_col: str = "text", end_id: int = 1,
           window: int = 2048, with_ids: bool = True) -> DataFrame:
    """One row per document and window it touches: the columns of docs without
    the text, start, length, ids_crc32, doc_tokens, sequence_id, offset and,
    if asked, the ids."""
    spark = docs.sparkSession
    path = scratch_path(spark, "token-ids")
    first = tokenised(docs, tokenizer_path, text_col, end_id)
    first.write.option("compression", "zstd").parquet(path)
    stored = spark.read.schema(first.schema).parquet(path)

    totals = stored.groupBy("part").agg(F.max(F.col("part_start") + F.size("ids")).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_offset"))

    new = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    kept = [c for c in stored.columns[:-3] if c.lower() not in new]
    at_col, offset_col = spare(stored.columns, "at", "part_offset")
    offsets = offsets.withColumnRenamed("part_offset", offset_col)
    placed = stored.join(F.broadcast(offsets), "part").select(
        *[F.col(f"`{c}`") for c in kept], (F.col(offset_col) + F.col("part_start")).alias(at_col), "ids")
    schema = T.StructType([stored.schema[c] for c in kept] + [T.StructField(c, T.LongType()) for c in new[:6]]
                          + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = b.schema.names
            col = b.column(names.index("ids"))
            off = col.offsets.to_numpy().astype(np.int64)
            flat = col.values.to_numpy(zero_copy_only=False).astype("<u4")
            at, size = b.column(names.index(at_col)).to_numpy(), np.diff(off)
            w0, w1 = at // window, (at + size - 1) // window
            count = w1 - w0 + 1
            row = np.repeat(np.arange(len(at)), count)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            seq = w0[row] + nth
            begin = np.maximum(seq * window, at[row])
            stop = np.minimum((seq + 1) * window, at[row] + size[row])
            lo = off[row] + begin - at[row]
            hi = lo + stop - begin
            crc = np.array([zlib.crc32(flat[a:z].tobytes()) for a, z in zip(lo, hi)], dtype=np.int64)
            cols = [b.column(names.index(c)).take(pa.array(row)) for c in kept]
            cols += [pa.array(x) for x in (begin - at[row], stop - begin, crc, size[row], seq, begin - seq * window)]
            if with_ids:
                parts = [flat[a:z] for a, z in zip(lo, hi)]
                cols.append(pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], np.cumsum(hi - lo))), pa.int32()),
                    pa.array(np.concatenate(parts).astype(np.int32) if parts else np.zeros(0, np.int32))))
            yield pa.RecordBatch.from_arrays(cols, names=[*kept, *new])

    return placed.mapInArrow(cut, schema)


def sequences(parts: DataFrame, window: int = 2048, pad_id: int = 0) -> DataFrame:
    """(sequence_id, ids, n_tokens) of pieces with ids: the pieces of a window,
    at most ``window`` ids, in order; the last window is padded."""
    joined = (parts.groupBy("sequence_id")
              .agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("ps"))
              .select("sequence_id", F.flatten(F.transform("ps", lambda p: p["ids"])).alias("ids")))
    pad = F.array_repeat(F.lit(pad_id), F.lit(window) - F.size("ids"))
    return joined.select("sequence_id", F.concat("ids", pad).alias("ids"), F.size("ids").cast("long").alias("n_tokens"))
