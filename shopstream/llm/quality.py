"""Quality rules: a threshold table compiled into one Spark projection.

``METRICS`` names every measure of a text as a Spark expression over its
words, lines and characters; ``RULES`` is a table of (metric, least, most).
``score`` turns both into columns of one projection of built-in expressions:
no shuffle, no join and no user function, so it runs at scan speed and a lost
executor costs its own tasks only.

Base measures (words are runs without [\\x20\\x09-\\x0D]):

* ``n_words``, ``word_chars`` (code points inside words),
* ``n_symbols``: characters of ``#*$%&|<>``,
* ``n_dup_lines``: \\n-split lines holding a word that equal an earlier line,
* ``n_repeat_words``: words inside a 3-word window found twice or more in the
  text, the first occurrence included.

Defined results: null and empty text have no words, all counts 0, fail the
base rule and are not kept. Rows are judged one by one, so repeated rows, null
ids and extra columns pass through unchanged; an extra column whose name
clashes with an output column is replaced by the output column.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, let, words

SYMBOLS = "#*$%&|<>"

# Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to in a is that for it was on are as with by this be at from "
    "de la que el en y los del se las por un para con no una su al lo como es o "
    "le et les des du une est dans qui pas sur au plus par avec il ou ne ce "
    "der die und den von zu das mit sich auf dem nicht ein ist im eine als auch"
).split()


@dataclass(frozen=True)
class Rule:
    """Keep a text only if least <= metric <= most (None: open end)."""
    metric: str
    least: float | None = None
    most: float | None = None


#: The production table. Bounds are per word or per line, so long texts are
#: judged like short ones.
RULES = (
    Rule("mean_word_chars", 2.0, 15.0),
    Rule("symbol_ratio", None, 0.25),
    Rule("stop_ratio", 0.02, 0.9),
    Rule("dup_line_ratio", None, 0.5),
    Rule("exclaim_ratio", None, 0.25),
)


def _ratio(a: Column, b: Column) -> Column:
    return a / F.greatest(b, F.lit(1))


#: Ratios over the base columns and the two helper counts.
METRICS = {
    "mean_word_chars": lambda c: _ratio(c["word_chars"], c["n_words"]),
    "symbol_ratio": lambda c: _ratio(c["n_symbols"], c["n_words"]),
    "stop_ratio": lambda c: _ratio(c["n_stop_words"], c["n_words"]),
    "dup_line_ratio": lambda c: _ratio(c["n_dup_lines"], c["n_lines"]),
    "exclaim_ratio": lambda c: _ratio(c["n_exclaims"], c["n_words"]),
    "n_words": lambda c: c["n_words"],
}


def _chars_of(text: Column, chars: str) -> Column:
    """Number of characters of the class in a text."""
    return F.length(F.regexp_replace(text, f"[^{chars}]+", ""))


def _repeated_words(ws: Column) -> Column:
    """Words covered by 3-word windows that occur at least twice.

    Each window becomes one long, 33 hash bits above its position, and the
    sorted longs put windows of equal hash next to each other. Only those are
    spelled out and compared by their words, so the count is exact.
    """
    n = F.size(ws)

    def packed(i: Column) -> Column:
        h = F.xxhash64(F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2))
        return F.shiftleft(h, 31).bitwiseOR(i.cast("long"))

    def twins(p: Column) -> Column:
        """Positions of neighbours with equal hash bits."""
        pairs = F.filter(F.sequence(F.lit(1), F.size(p) - 1), lambda j: F.shiftright(
            F.get(p, j).bitwiseXOR(F.get(p, j - 1)), 31) == 0)
        both = F.flatten(F.transform(pairs, lambda j: F.array(F.get(p, j - 1), F.get(p, j))))
        return F.array_distinct(F.transform(both, lambda x: x.bitwiseAND(F.lit(2**31 - 1)).cast("int")))

    def spelled(i: Column) -> Column:
        return F.struct(F.concat_ws(" ", F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2)).alias("k"),
                        i.alias("i"))

    def starts(s: Column) -> Column:
        def twin(x: Column, j: Column) -> Column:
            return (F.get(s, j - 1)["k"] == x["k"]) | (F.get(s, j + 1)["k"] == x["k"])
        return F.sort_array(F.transform(F.filter(s, twin), lambda x: x["i"]))

    def covered(p: Column) -> Column:
        reach = F.transform(p, lambda x, j: F.least(F.coalesce(F.get(p, j + 1) - x, F.lit(3)), F.lit(3)))
        return F.aggregate(reach, F.lit(0), lambda a, x: a + x)

    windows = F.sort_array(F.transform(F.sequence(F.lit(0), n - 3), packed))
    found = let(let(F.sort_array(F.transform(let(windows, twins), spelled)), starts), covered)
    return F.when(n >= 4, found).otherwise(F.lit(0))


def base_columns(text: Column) -> dict[str, Column]:
    """Every base measure of a text as a Spark expression over the helper
    columns ``_words`` and ``_lines``."""
    ws, lines = F.col("_words"), F.col("_lines")
    return {
        "n_words": F.size(ws).cast("long"),
        "word_chars": F.length(F.concat_ws("", ws)).cast("long"),
        "n_symbols": _chars_of(text, "#*$%&|<>").cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": _repeated_words(ws).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_exclaims": _chars_of(text, "!").cast("long"),
        "n_stop_words": F.size(F.filter(ws, lambda w: w.isin(STOP_WORDS))).cast("long"),
    }


def verdict(rules: tuple[Rule, ...]) -> Column:
    """The threshold table as an array of the names of broken rules."""
    cols = {c: F.col(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines",
                                  "n_exclaims", "n_stop_words")}
    broken = []
    for r in rules:
        m = METRICS[r.metric](cols)
        bad = F.lit(False)
        if r.least is not None:
            bad = bad | (m < F.lit(r.least))
        if r.most is not None:
            bad = bad | (m > F.lit(r.most))
        broken.append(F.when(bad, F.lit(r.metric)))
    return F.filter(F.array(*broken), lambda x: x.isNotNull())


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def score(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES,
          min_words: int = 50) -> DataFrame:
    """docs plus base measures, ``base_failed``, ``broken_rules`` and ``kept``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    out = ("_words", "_lines", "_nth", *BASE, "n_lines", "n_exclaims", "n_stop_words", "base_failed",
           "broken_rules", "kept")
    keep = [c for c in docs.columns if c.lower() not in out]
    measured = (docs.select(*[F.col(f"`{c}`") for c in keep], words(text).alias("_words"),
                            F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE}]")).alias("_lines"))
                .select(*[F.col(f"`{c}`") for c in keep], F.monotonically_increasing_id().alias("_nth"),
                        *[v.alias(k) for k, v in base_columns(text).items()]))
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return (measured.withColumn("base_failed", failed)
            .withColumn("broken_rules", verdict(rules))
            # _nth keeps a filter on kept above the measures: pushed below, it would repeat them
            .withColumn("kept", ~F.col("base_failed") & (F.size("broken_rules") == 0) & (F.col("_nth") >= 0))
            .drop("_nth", "n_lines", "n_exclaims", "n_stop_words"))


def keep_good(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows that pass, with the columns of docs only. Measures are taken
    from the text in a nested column, so no column of docs is touched."""
    one = F.col(f"`{text_col}`")
    judged = score(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                               one.alias("_text")), "_text", rules)
    return judged.where("kept").select("_row.*")
