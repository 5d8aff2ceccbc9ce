"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Code points that separate words, as the inside of a character class.
SPACE = r"\x20\x09-\x0D"
SPACE_CHARS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with value computed once, however often body uses it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Whitespace-separated words of a text as an array (null: no words)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), lambda w: w != "")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, everything else unchanged."""
    return F.translate(text, UPPER, UPPER.lower())


def same(left: DataFrame, right: DataFrame, *cols: str) -> Column:
    """Null-safe equality of columns that both sides have."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & left[c].eqNullSafe(right[c])
    return cond


def join_safe(left: DataFrame, right: DataFrame, cols: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``cols`` in which null equals null; the columns of right
    other than ``cols`` must not clash with those of left."""
    theirs = right.select(*[F.col(f"`{c}`").alias(f"_right_{c}" if c in cols else c) for c in right.columns])
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(f"`{c}`").eqNullSafe(F.col(f"`_right_{c}`"))
    return left.join(theirs, cond, how).drop(*[f"_right_{c}" for c in cols])


def spare(taken: list[str], *names: str) -> list[str]:
    """Column names like ``names`` that clash with none of ``taken``
    (Spark compares names without case)."""
    used, out = {c.lower() for c in taken}, []
    for n in names:
        while n.lower() in used:
            n = "_" + n
        used.add(n.lower())
        out.append(n)
    return out
