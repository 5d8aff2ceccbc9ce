"""Document ids (K5): given, or generated so that a replay makes the same ones.

The reference lets the store make up an id for a document without one, so a
retried bulk write stores it twice. Here a generated id is a digest of the
writer, the batch, the document's content and its occurrence among equal
documents of the batch: a replayed batch gives the same ids, and two equal
documents stay two. Equal documents are counted before they are shuffled and
listed from their count, so many copies of one document are no hot group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_ids(docs: DataFrame, id_col: str, writer: str, batch_id: int) -> DataFrame:
    """Every row of docs with an id: its own, or a generated one where it is
    null. Content is all other columns (any type that has a JSON form)."""
    rest = [c for c in docs.columns if c != id_col]
    packed = F.struct(*[F.col(f"`{c}`") for c in rest])
    lone = docs.where(F.col(f"`{id_col}`").isNull()).select(packed.alias("doc"))
    counted = (lone.groupBy(F.to_json("doc", {"ignoreNullFields": "false"}).alias("content"))
               .agg(F.first("doc").alias("doc"), F.count(F.lit(1)).alias("n")))
    each = counted.select("content", "doc", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("nth"))
    name = F.concat_ws("|", F.lit(writer), F.lit(str(batch_id)), F.col("nth").cast("string"), F.col("content"))
    made = each.select(F.sha2(name, 256).alias(id_col), *[F.col(f"doc.`{c}`").alias(c) for c in rest])
    given = docs.where(F.col(f"`{id_col}`").isNotNull())
    return given.select(*docs.columns).unionByName(made.select(*docs.columns))
