"""Quality rules: a table of thresholds compiled into one projection, without user functions and without a shuffle.

Counts inside a text use sorting, not look-ups, so a text of n words costs n log n: the 64-bit hashes of its 3-word
windows are sorted with their places, and equal neighbours are repeats.

Null and empty texts have all counts 0 and fail the base test.  Each row is judged alone, so repeated rows agree.
Columns of ``docs`` named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE

WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = ("the of and to in a is that for on with as was at by an be or are from this it he not his "
              "der die und das den von zu mit ist des im für auf ein eine dem nicht sich auch es "
              "le la les de et un une du que des en est pour dans qui sur au par pas "
              "el los las y del se con una por no su lo como más").split()
#: (measure, least, most); None: no bound.
THRESHOLDS = (
    ("mean_word_length", 2.0, 14.0),
    ("symbol_ratio", None, 0.1),
    ("stop_word_ratio", 0.02, None),
    ("duplicate_line_ratio", None, 0.5),
    ("mean_line_words", 2.0, None),
)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_lines")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def _repeats(words: Column, n: Column) -> Column:
    """Words in 3-word windows found twice or more."""
    windows = F.transform(F.slice(words, 1, n - 2), lambda w, i: F.struct(F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")))
    again = let(F.sort_array(windows), lambda s: F.filter(
        s, lambda x, k: F.coalesce(x.h == F.get(s, k - 1).h, F.lit(False)) | F.coalesce(x.h == F.get(s, k + 1).h, F.lit(False))))
    return F.size(F.array_distinct(F.flatten(F.transform(again, lambda x: F.array(x.i, x.i + 1, x.i + 2)))))


def counts(text: Column) -> dict[str, Column]:
    text = F.coalesce(text, F.lit(""))
    bare = F.length(F.translate(text, WHITE, ""))
    words = F.split(F.btrim(text, F.lit(WHITE)), f"[{SPACE}]+")
    # one struct, so that the words are split once
    of_words = let(words, lambda w: let(F.size(w), lambda n: F.struct(
        n.alias("n_words"),
        F.when(n >= 4, _repeats(w, n)).otherwise(0).alias("n_repeat_words"),
        F.size(F.filter(w, lambda x: x.isin(*STOP_WORDS))).alias("n_stop_words"))))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, WHITE, "")) > 0)
    of_lines = let(lines, lambda x: F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    return {
        "_words": of_words, "_lines": of_lines, "word_chars": bare.cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
    }


def verdict(thresholds: Sequence[tuple[str, float | None, float | None]] = THRESHOLDS) -> Column:
    """The table as one condition on the counts."""
    words = F.col("n_words").cast("double")
    measures = {
        "mean_word_length": F.try_divide("word_chars", words),
        "symbol_ratio": F.try_divide("n_symbols", words),
        "stop_word_ratio": F.try_divide("n_stop_words", words),
        "duplicate_line_ratio": F.try_divide("n_dup_lines", F.col("n_lines").cast("double")),
        "mean_line_words": F.try_divide(words, "n_lines"),
        "repeated_word_ratio": F.try_divide("n_repeat_words", words),
    }
    out = F.lit(True)
    for name, least, most in thresholds:
        if least is not None:
            out = out & (measures[name] >= least)
        if most is not None:
            out = out & (measures[name] <= most)
    return F.coalesce(out, F.lit(False))


def quality_rules(docs: DataFrame, thresholds: Sequence[tuple[str, float | None, float | None]] = THRESHOLDS) -> DataFrame:
    """``docs`` with the counts, base_failed and kept."""
    mine = (*COUNTS, "base_failed", "kept")
    rows = docs.drop(*mine).withColumns(counts(F.col("text")))
    none = F.col("word_chars") == 0
    rows = rows.withColumns({
        **{c: F.when(none, F.lit(0)).otherwise(F.col("_words")[c]).cast("long") for c in ("n_words", "n_repeat_words", "n_stop_words")},
        **{c: F.col("_lines")[c].cast("long") for c in ("n_lines", "n_dup_lines")},
    })
    rows = rows.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    return rows.withColumn("kept", ~F.col("base_failed") & verdict(thresholds)).select(*(c for c in docs.columns if c not in mine), *mine)
