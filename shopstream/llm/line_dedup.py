"""Line dedup: lines that recur across documents are cut from all but one.

Method: every line becomes a 128-bit hash of its key. The hashes are
range-partitioned; each range is sorted by (hash, document from the largest id
down, position) and read as a stream: a row whose predecessor has another hash
is its line's first occurrence, which stays, and one whose predecessor has
another document adds to the line's documents. The result is one run-length
encoded keep bitmap per document, not text; ``apply_bitmaps`` cuts the lines.

Ranges are equal parts of the hash space, so they hold about ``rows_per_range``
lines each but for hot lines. Those are found in a sample (a line that would
fill over a quarter of a range): their rows spread over as many sub-ranges as
their sampled count asks for, each sub-range reduces them to one row per
document, and their totals, one row per hot line, are joined back. Which lines
the sample calls hot changes where rows go, not what is kept. Other lines lie
in one range and are decided there; only rows to drop leave it.

A line's key is the line with whitespace stripped at both ends and A-Z
lower-cased. Keys of at least ``min_chars`` code points found in at least
``min_docs`` documents (distinct ids) lose their lines in all documents but
the largest id holding them.

Defined results: a null or empty text is one empty line and stays as it is.
Rows that share an id are one document when documents are counted; each row
keeps its own lines, and equal rows get equal bitmaps. A null id counts as one
document, smaller than any other. Extra columns pass through ``apply_bitmaps``
unchanged. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .common import SPACE_CHARS, lower_ascii, same, spare


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(SPACE_CHARS)))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def keyed_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(doc, tid, n_lines, pos, h1, h2) of every line with a long enough key.
    tid is a hash of the text, which tells rows of one id apart."""
    text = F.col(f"`{text_col}`")
    lines = docs.select(F.col(f"`{id_col}`").alias("doc"), F.xxhash64(text).alias("tid"),
                        _lines(text).alias("lines"))
    out = lines.select("doc", "tid", F.size("lines").alias("n_lines"),
                       F.posexplode("lines").alias("pos", "line"))
    out = out.where(F.length("line") >= min_chars).withColumn("key", line_key(F.col("line")))
    return (out.where(F.length("key") >= min_chars)
            .select("doc", "tid", "n_lines", "pos", F.xxhash64("key").alias("h1"),
                    F.xxhash64(F.lit("second"), F.col("key")).alias("h2")))


def _spread(lines: DataFrame, rows_per_range: int) -> DataFrame:
    """lines with the range of each row: (rng, sub), and whether its line is
    hot. A sub-range depends on the whole row, so that neither a hot line nor
    a hot document fills one."""
    ranges = max(1, -(-lines.count() // rows_per_range))
    share = min(1.0, 1024 / rows_per_range)
    quarter = share * rows_per_range / 4
    row_hash = F.xxhash64(F.lit("row"), "h1", "h2", "doc", "tid", "pos")
    drawn = lines if share == 1.0 else lines.where(F.pmod(row_hash, F.lit(2**40)) < F.lit(int(share * 2**40)))
    hot = materialise(
        drawn.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > quarter)
        .select("h1", "h2", F.ceil(F.col("n") / F.lit(quarter)).alias("subs")), "hot-lines")
    # the upper 32 bits of h1, moved to 0 .. 2^32 - 1, times the ranges
    part = F.shiftright((F.shiftright("h1", 32) + F.lit(2**31)) * F.lit(ranges), 32)
    return (lines.join(hot, ["h1", "h2"], "left")
            .select(*lines.columns, part.alias("rng"), F.col("subs").isNotNull().alias("hot"),
                    F.coalesce(F.pmod(F.xxhash64("doc", "tid", "pos"), "subs"), F.lit(0)).alias("sub")))


def line_stream(lines: DataFrame, rows_per_range: int) -> DataFrame:
    """The rows of lines as their sorted range shows them: with new_doc (the
    row is the first of its line and document there), n_docs and first (the
    line's documents and its first document there)."""
    order = [F.col("doc").desc_nulls_last(), F.col("tid"), F.col("pos")]
    stream = Window.partitionBy("rng", "sub").orderBy("h1", "h2", *order)
    line = Window.partitionBy("rng", "sub", "h1", "h2").orderBy(*order)

    def as_before(c: str) -> Column:
        return F.lag(c).over(stream).eqNullSafe(F.col(c))

    ranged = _spread(lines, rows_per_range).repartitionByRange("rng", "sub")
    marked = ranged.withColumn("new_doc", ~(as_before("h1") & as_before("h2") & as_before("doc")))
    all_rows = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (marked.withColumn("n_docs", F.sum(F.col("new_doc").cast("long")).over(all_rows))
            .withColumn("first", F.first("doc").over(all_rows)))


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_chars: int = 20, min_docs: int = 3, rows_per_range: int = 20_000) -> DataFrame:
    """(doc, tid, n_dropped, keep) for each document that loses lines; keep is
    the run-length encoded bitmap: runs (start, len) of lines that stay."""
    lines = materialise(keyed_lines(docs, id_col, text_col, min_chars), "line-hashes")
    later = ~F.col("doc").eqNullSafe(F.col("first"))
    # a hot line is decided by the totals of its sub-ranges
    found = materialise(
        line_stream(lines, rows_per_range).where(F.col("hot") | ((F.col("n_docs") >= min_docs) & later))
        .select("doc", "tid", "n_lines", "pos", "h1", "h2", "hot", "new_doc"), "line-stream")
    hot = found.where("hot")
    totals = materialise(
        hot.where("new_doc").groupBy("h1", "h2", "doc").agg(F.lit(1).alias("one"))
        .groupBy("h1", "h2").agg(F.count("one").alias("n_docs"), F.max("doc").alias("first"))
        .where(F.col("n_docs") >= min_docs).select("h1", "h2", "first"), "hot-totals")
    cut = ["doc", "tid", "n_lines", "pos"]
    dropped = found.where("not hot").select(*cut).unionByName(
        hot.join(totals, ["h1", "h2"]).where(later).select(*cut))
    gaps = dropped.groupBy("doc", "tid", "n_lines").agg(F.sort_array(F.collect_set("pos")).alias("drop"))
    runs = F.transform(
        F.arrays_zip(F.concat(F.array(F.lit(-1)), F.col("drop")).alias("a"),
                     F.concat(F.col("drop"), F.array(F.col("n_lines"))).alias("b")),
        lambda g: F.struct((g["a"] + 1).alias("start"), (g["b"] - g["a"] - 1).alias("len")))
    return gaps.select("doc", "tid", F.size("drop").cast("long").alias("n_dropped"),
                       F.filter(runs, lambda r: r["len"] > 0).alias("keep"))


def kept_text(text: Column, keep: Column) -> Column:
    """The lines of the keep bitmap, joined again; no bitmap keeps the text."""
    pieces = F.flatten(F.transform(keep, lambda r: F.slice(_lines(text), r["start"] + 1, r["len"])))
    return F.when(keep.isNull(), text).otherwise(F.array_join(pieces, "\n"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  n_dropped: str | None = None) -> DataFrame:
    """docs with the dropped lines cut out of text_col; all other columns as
    they are. ``n_dropped`` names an extra column for the count."""
    tid, doc, cut, keep = spare(docs.columns, "tid", "doc", "n_dropped", "keep")
    text = F.col(f"`{text_col}`")
    left = docs.withColumn(tid, F.xxhash64(text)).withColumn(doc, F.col(f"`{id_col}`"))
    right = bitmaps.select(F.col("doc").alias(doc), F.col("tid").alias(tid),
                           F.col("n_dropped").alias(cut), F.col("keep").alias(keep))
    out = left.join(right, same(left, right, doc, tid), "left")
    cols = [kept_text(left[f"`{c}`"], right[keep]).alias(c) if c == text_col else left[f"`{c}`"]
            for c in docs.columns]
    if n_dropped:
        cols.append(F.coalesce(right[cut], F.lit(0)).cast("long").alias(n_dropped))
    return out.select(*cols)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20,
                min_docs: int = 3, n_dropped: str | None = None, rows_per_range: int = 20_000) -> DataFrame:
    """Both steps: bitmaps of all documents, then the cut."""
    bitmaps = keep_bitmaps(docs, id_col, text_col, min_chars, min_docs, rows_per_range)
    return apply_bitmaps(docs, bitmaps, id_col, text_col, n_dropped)
