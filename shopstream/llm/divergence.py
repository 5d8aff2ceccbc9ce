"""Audit of how sources of a language differ in their words.

Terms are counted per (lang, source) group. Each language keeps the terms
found in at least ``min_docs`` of its documents (V of them); a group's price
of a term is p = 1 + floor(10^9 (count + 1) / (N + V)), N being the group's
total over kept terms, so p depends on the count level alone. The divergence of
a group from another is the sum over kept terms of f = floor((p - q)^2 / q).

One-hot level products. For a block of terms the indicator matrix X has one
column per (group, count level), level 0 included; X'X, an exact matrix
product of zeros and ones, holds every joint table of every pair of groups at
once. The tables are priced cell by cell (joint count x f of the two levels)
and the cells of each pair summed; blocks add up in Spark as exact integers. A
block whose columns exceed ``COLUMNS`` is halved, so frequent terms (a level of
their own each) come in small blocks and rare terms in large ones.

Terms are spread over blocks by hash, groups over blocks of ``GROUPS``; a task
holds one block of terms for one pair of group blocks, whatever a source or
language weighs. A term that both group blocks lack is not sent; such terms are
counted and priced at level 0 for both. Counting combines inside each task
before anything is shuffled.

Defined results: null text, lang and source read as ''. A document without
terms still makes its group occur. A language without kept terms gives value 0
for its pairs. Repeated rows are documents of their own. Long texts are counted
in pieces. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .grams import byte_class

SCALE = 1_000_000_000
#: Term blocks, group blocks, and columns of one matrix product.
TERMS, GROUPS, COLUMNS = 8192, 64, 768
#: Counters are sent on when they hold this many entries.
ENTRIES = 200_000
PIECE = 1 << 20

_TERM = ~byte_class((0x00, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
#: Byte table: letters lower-cased, everything that is no term byte a blank.
_TABLE = bytes(0x20 if not _TERM[b] else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
COUNTS = "lang string, source string, term string, n long, docs long"


def term_pieces(text: str) -> Iterator[list[bytes]]:
    """The terms of a text, a bounded number of bytes at a time."""
    for at in range(0, max(len(text), 1), PIECE):
        data = text[at:at + PIECE].encode("utf-8", "replace").translate(_TABLE)
        if at:
            data = rest + data
        cut = data.rfind(b" ") if at + PIECE < len(text) else len(data)
        rest = data[cut:] if cut >= 0 else data
        if cut > 0:
            yield data[:cut].split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (lang, source, term), combined inside the task; the term of
    a null is the group itself."""
    def out(counts: dict, docs: dict) -> pa.RecordBatch:
        rows = [(g[0], g[1], t.decode("utf-8", "replace"), n, docs[g][t]) for g, c in counts.items()
                for t, n in c.items()]
        rows += [(*g, None, 0, 0) for g in counts]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(),) * 3 + (pa.int64(),) * 2)],
            names=["lang", "source", "term", "n", "docs"])

    counts, docs, size = {}, {}, 0
    for b in batches:
        for lang, source, text in zip(*(c.to_pylist() for c in b.columns)):
            n, d = counts.setdefault((lang, source), Counter()), docs.setdefault((lang, source), Counter())
            size -= len(n)
            pieces = term_pieces(text)
            first = next(pieces, [])
            seen = set(first)
            n.update(first)
            for more in pieces:
                n.update(more)
                seen.update(more)
            d.update(seen)
            size += len(n)
            if size > ENTRIES:
                yield out(counts, docs)
                counts, docs, size = {}, {}, 0
    if counts:
        yield out(counts, docs)


def term_counts(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """Written counts: one row per (lang, source, term), and one per group with
    a null term."""
    slim = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (lang_col, source_col, text_col)])
    parts = slim.toDF("lang", "source", "text").mapInArrow(_count, COUNTS)
    return materialise(parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")),
                       "term-counts")


def price(count, total, terms):
    """p of a count, as SQL text over three integer columns."""
    return (f"1 + (cast({SCALE} as decimal(19,0)) * cast({count} + 1 as decimal(19,0)))"
            f" div cast({total} + {terms} as decimal(38,0))")


def _prices(levels: np.ndarray, total: int, terms: int) -> np.ndarray:
    """p of some counts; Python integers, so that no product overflows."""
    return np.array([1 + SCALE * (n + 1) // (total + terms) for n in levels.tolist()], np.int64)


def joint_prices(counts: np.ndarray, totals: list[int], terms: int) -> np.ndarray:
    """(g, g) sums of f over the rows of counts (terms x groups): one product
    of the one-hot matrix with its transpose, or of each half."""
    columns, names, owner, cost = 0, [], [], []
    for g in range(counts.shape[1]):
        levels, at = np.unique(counts[:, g], return_inverse=True)
        names.append(at + columns)
        owner.append(columns)
        cost.append((levels, g))
        columns += len(levels)
    if columns > max(COLUMNS, 4 * counts.shape[1]) and len(counts) > 8:
        half = len(counts) // 2
        return joint_prices(counts[:half], totals, terms) + joint_prices(counts[half:], totals, terms)
    hot = np.zeros((len(counts), columns), np.float32)
    for at in names:
        hot[np.arange(len(counts)), at] = 1
    joint = (hot.T @ hot).astype(np.int64)  # at most TERMS ones: exact in a float
    p = np.concatenate([_prices(levels, totals[g], terms) for levels, g in cost])
    gap = p[:, None] - p[None, :]
    cells = joint * (gap * gap // p[None, :])
    return np.add.reduceat(np.add.reduceat(cells, owner, axis=0), owner, axis=1)


def _block(table: pa.Table, group_block: int) -> pa.Table:
    """Priced pairs of one block: a header row names the groups and totals, the
    other rows are terms with their counts."""
    heads, rows = table.column("heads").to_pylist(), table.column("counts")
    head = next(h for h in heads if h is not None)
    at = {h["g"]: k for k, h in enumerate(head)}
    lists = rows.combine_chunks() if isinstance(rows, pa.ChunkedArray) else rows
    lists = lists.filter(lists.is_valid())
    flat = lists.flatten()
    line = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
    g = np.array([at[x] for x in flat.field("g").to_pylist()], np.int64)
    counts = np.zeros((len(lists), len(head)), np.int64)
    counts[line, g] = flat.field("n").to_numpy(zero_copy_only=False)
    counts = counts[np.argsort(counts.max(axis=1), kind="stable")]  # rare terms share their levels
    n, k = table.num_rows, len(head)
    value = joint_prices(counts, [h["total"] for h in head], head[0]["terms"]) if len(counts) else np.zeros((k, k), np.int64)
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    names = np.array([h["g"] for h in head])
    x, y = np.meshgrid(np.arange(k), np.arange(k), indexing="ij")
    side = names // group_block
    wanted = (x != y) & ((side[x] != side[y]) | (i == j))
    return pa.table([pa.array([table.column("lang")[0].as_py()] * int(wanted.sum()), pa.string()),
                     pa.array(names[x[wanted]], pa.int32()), pa.array(names[y[wanted]], pa.int32()),
                     pa.array(value[wanted]), pa.array(np.full(int(wanted.sum()), len(counts)), pa.int64())],
                    names=["lang", "g", "h", "value", "seen"])


def _pairs(kept: DataFrame, groups: DataFrame, term_block: int, group_block: int) -> DataFrame:
    """(lang, g, h, value, seen): priced sums of the terms that g's or h's
    block holds, and how many those are."""
    entry = F.struct("g", "n")
    by_term = (kept.groupBy("lang", "term", "terms", F.floor(F.col("g") / group_block).cast("int").alias("i"))
               .agg(F.collect_list(entry).alias("counts")))
    blocks = groups.groupBy("lang", F.floor(F.col("g") / group_block).cast("int").alias("i")).agg(
        F.first("terms").alias("terms"), F.first("n_groups").alias("n_groups"),
        F.sort_array(F.collect_list(F.struct("g", "total", "terms"))).alias("heads"))
    tiles = F.ceil(F.col("terms") / term_block).cast("int")
    sent = by_term.join(groups.where("g = 0").select("lang", F.col("n_groups")), "lang")
    # a term goes to every pair of group blocks that holds its block
    last = F.floor((F.col("n_groups") - 1) / group_block).cast("int")
    others = F.sequence(F.lit(0), last)
    sent = (sent.withColumn("o", F.explode(others))
            .select("lang", "term", F.least("i", "o").alias("i"), F.greatest("i", "o").alias("j"),
                    F.pmod(F.xxhash64("term"), tiles).cast("int").alias("tile"), "counts"))
    # both blocks of a pair may hold the term: one row for it
    sent = sent.groupBy("lang", "i", "j", "tile", "term").agg(F.flatten(F.collect_list("counts")).alias("counts"))
    right = blocks.select("lang", F.col("i").alias("j"), F.col("heads").alias("more"))
    heads = (blocks.join(right, "lang").where("i <= j")
             .select("lang", "i", "j", F.explode(F.sequence(F.lit(0), tiles - 1)).alias("tile"),
                     F.when(F.col("i") == F.col("j"), F.col("heads"))
                     .otherwise(F.concat("heads", "more")).alias("heads")))
    rows = sent.select("lang", "i", "j", "tile", "counts", F.lit(None).cast(
        "array<struct<g:int,total:bigint,terms:bigint>>").alias("heads")).unionByName(
        heads.withColumn("counts", F.lit(None).cast("array<struct<g:int,n:bigint>>")))
    out = rows.groupBy("lang", "i", "j", "tile").applyInArrow(
        lambda block: _block(block, group_block), "lang string, g int, h int, value long, seen long")
    return out.groupBy("lang", "g", "h").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"),
                                             F.sum("seen").alias("seen"))


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          min_docs: int = 3, top: int = 200, term_block: int = TERMS, group_block: int = GROUPS) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): the divergence of each
    group from every other source of its language (``pair``), and its most
    overused terms against the language (``term``, ranks to ``top``)."""
    counts = term_counts(docs, text_col, lang_col, source_col)
    words = counts.where("term is not null")
    vocabulary = words.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).where(
        F.col("docs") >= min_docs).select("lang", "term", "lang_n")
    kept = materialise(words.select("lang", "source", "term", "n").join(vocabulary, ["lang", "term"]), "kept-terms")
    sizes = (kept.select("lang", "term", "lang_n").distinct().groupBy("lang")
             .agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total")))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    by_lang = Window.partitionBy("lang")
    groups = materialise(
        counts.where("term is null").select("lang", "source").join(totals, ["lang", "source"], "left")
        .join(sizes, "lang", "left").fillna(0, ["total", "terms", "lang_total"])
        .select("lang", "source", "total", "terms", "lang_total",
                (F.row_number().over(by_lang.orderBy("source")) - 1).alias("g"),
                F.count(F.lit(1)).over(by_lang).cast("int").alias("n_groups")), "groups")
    with_group = kept.join(groups.select("lang", "source", "g", "total", "terms", "lang_total"), ["lang", "source"])

    pairs = _pairs(with_group.select("lang", "term", "g", "n", "terms"), groups.where("terms > 0"), term_block, group_block)
    mine = groups.select("lang", "source", "g", "total", "terms")
    other = groups.select("lang", F.col("source").alias("item"), F.col("g").alias("h"), F.col("total").alias("item_total"))
    zero = "terms > 0", price("0L", "total", "terms"), price("0L", "item_total", "terms")
    # the output itself: every other source of the language
    priced = (mine.join(other, "lang").where("g <> h").join(pairs, ["lang", "g", "h"], "left")
              .withColumn("p", F.expr(f"case when {zero[0]} then {zero[1]} end"))
              .withColumn("q", F.expr(f"case when {zero[0]} then {zero[2]} end")))
    rest = F.expr("cast(terms - coalesce(seen, 0) as decimal(19,0)) * cast((p - q) * (p - q) div q as decimal(19,0))")
    value = F.coalesce(F.col("value"), F.lit(0)) + F.coalesce(rest, F.lit(0))
    pair_rows = priced.select("lang", "source", F.lit("pair").alias("part"), "item", value.cast("long").alias("value"))

    term_rows = (with_group.withColumn("p", F.expr(price("n", "total", "terms")))
                 .withColumn("q", F.expr(price("lang_n", "lang_total", "terms"))).where("p > q")
                 .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                         F.expr("(p - q) * (p - q) div q").alias("value")))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = F.row_number().over(order).alias("rank")
    return (pair_rows.select("*", ranked)
            .unionByName(term_rows.select("*", ranked).where(F.col("rank") <= top)))
