"""Quality rules: a threshold table compiled into one projection.

Every measure is a Spark expression over the text; ``RULES`` names measures with the
range they must keep, and ``verdict`` turns the table into one boolean column.  No
user function runs and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Frequent function words of the languages that the corpus holds.
STOP_WORDS = (
    "the", "be", "to", "of", "and", "that", "have", "with", "a", "in", "is", "it", "for", "on", "was", "this",
    "der", "die", "das", "und", "ist", "nicht", "mit", "von", "den", "ein", "eine", "zu", "im", "sich",
    "le", "la", "les", "et", "de", "des", "un", "une", "est", "que", "qui", "dans", "pour", "pas",
    "el", "los", "las", "y", "en", "es", "por", "con", "para", "una", "lo", "del", "se", "no",
)


@dataclass(frozen=True)
class Rule:
    """A measure must lie in [low, high]; it counts for texts of at least ``words`` words."""

    measure: str
    low: float = float("-inf")
    high: float = float("inf")
    words: int = 0


RULES = (
    Rule("mean_word_chars", low=2.0, high=20.0),
    Rule("symbol_ratio", high=0.1),
    Rule("stop_words", low=1, words=100),
    Rule("bullet_line_ratio", high=0.9, words=50),
    Rule("ellipsis_line_ratio", high=0.3, words=50),
    Rule("dup_line_ratio", high=0.5, words=50),
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, also where a lambda uses it often."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_words(words: Column, size: int = 5) -> Column:
    """How many words lie in a window of ``size`` consecutive words that occurs twice or more.

    Windows are compared by 64-bit hashes.  Where some repeat, (hash, position) pairs are
    sorted, neighbours of equal hash are the repeats, and one pass adds up what their
    windows cover: n log n steps at most."""

    def windows(h: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(h) - size)
        return F.transform(at, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(size)]))

    def repeats(pairs: Column) -> Column:
        def position(p: Column, i: Column) -> Column:
            same = (F.get(pairs, i - 1)["h"] == p["h"]) | (F.get(pairs, i + 1)["h"] == p["h"])
            return F.when(F.coalesce(same, F.lit(False)), p["i"])
        return F.sort_array(F.filter(F.transform(pairs, position), lambda p: p.isNotNull()))

    def covered(positions: Column) -> Column:
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        return F.aggregate(positions, start, lambda acc, p: F.struct(
            (acc["n"] + p + size - F.greatest(acc["end"], p)).alias("n"), (p + size).alias("end")), lambda acc: acc["n"])

    def count(w: Column) -> Column:
        pairs = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(let(pairs, lambda p: covered(repeats(p))))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    some = let(hashes, lambda h: let(windows(h), count))
    return F.when(F.size(words) >= size, some).otherwise(F.lit(0)).cast("long")


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the ratios
    that the rules name)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    split = docs.select(
        F.col(id_col).alias("doc_id"), text.alias("text"),
        F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)).alias("words"),
        F.filter(F.split(text, "\n", -1), lambda x: F.length(F.translate(x, SPACE, "")) > 0).alias("lines"))
    words, lines = F.col("words"), F.col("lines")

    def share(of: Column, among: Column) -> Column:
        return F.when(among > 0, of / among).otherwise(F.lit(0.0))

    trimmed = F.transform(lines, lambda x: F.trim(x))
    counted = split.select(
        "doc_id",
        F.size(words).cast("long").alias("n_words"),
        F.length(F.translate("text", SPACE, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        repeated_words(words).alias("n_repeat_words"),
        F.size(F.array_intersect(words, F.array(*map(F.lit, STOP_WORDS)))).cast("long").alias("stop_words"),
        F.size(F.filter(trimmed, lambda x: x.startswith("- ") | x.startswith("* ") | x.startswith("•"))).alias("_bullets"),
        F.size(F.filter(trimmed, lambda x: x.endswith("...") | x.endswith("…"))).alias("_ellipses"))
    return counted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "stop_words",
        share(F.col("word_chars"), F.col("n_words")).alias("mean_word_chars"),
        share(F.col("n_symbols"), F.col("word_chars")).alias("symbol_ratio"),
        share(F.col("_bullets"), F.col("n_lines")).alias("bullet_line_ratio"),
        share(F.col("_ellipses"), F.col("n_lines")).alias("ellipsis_line_ratio"),
        share(F.col("n_dup_lines"), F.col("n_lines")).alias("dup_line_ratio"))


def verdict(rules=RULES) -> Column:
    """The rule table as one boolean expression over the measures."""
    out = F.lit(True)
    for r in rules:
        m = F.col(r.measure)
        bad = (m < F.lit(r.low)) | (m > F.lit(r.high))
        out = out & ~(bad & (F.col("n_words") >= r.words) if r.words else bad)
    return out


def quality(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, ...),
    one row per row of ``docs``.

    base_failed: fewer than 10 words, or more than 20 % of the words in repeated 5-word
    windows.  kept: not base_failed, and every rule of the table holds.

    * Null and empty texts have no words and fail the base rule.
    * Whole texts count, however long; repeated rows get the same result; an empty table gives
      an empty one.  Only the id and the text are read.
    """
    m = measures(docs, id_col, text_col)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return m.select(*m.columns[:6], failed.alias("base_failed"), (~failed & verdict(rules)).alias("kept"), *m.columns[6:])
