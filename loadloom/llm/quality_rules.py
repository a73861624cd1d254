"""Quality rules: one threshold table compiled into one projection of built-in functions.

Every measure is a Spark expression of the text; every rule is a row (name, measure, least,
most). ``measured`` computes the measures in one projection, ``verdicts`` turns the table
into one boolean column per rule and their conjunction. No row leaves its partition.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, SPACES, documents, shown_id

SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Frequent words of the corpus languages (English, French, German, Spanish); fixed values.
STOP_WORDS = (
    "the of and to in that is for with on as are be this by "
    "le la les de des et un une du en que pour dans sur qui au avec par "
    "der die das und den von zu mit ist auf ein eine nicht im für dem als "
    "el los las y del se por con para una su lo al más como es"
).split()


class Rule(NamedTuple):
    """A text passes if ``least <= measure <= most``; None leaves a side open."""

    name: str
    measure: str
    least: float | None = None
    most: float | None = None


#: The base: too short, or more than half repetition.
BASE = (Rule("enough_words", "n_words", least=50), Rule("not_repeated", "repeat_share", most=0.5))
#: Production thresholds of the other rules.
RULES = (
    Rule("not_endless", "n_words", most=1_000_000),
    Rule("word_length", "mean_word_chars", least=2, most=14),
    Rule("few_symbols", "symbols_per_word", most=0.2),
    Rule("few_capitals", "capital_share", most=0.5),
    Rule("few_exclamations", "exclamations_per_word", most=0.25),
    Rule("stop_words", "n_stop_words", least=2),
    Rule("few_double_lines", "dup_line_share", most=0.5),
    Rule("few_bullets", "bullet_line_share", most=0.9),
    Rule("few_ellipses", "ellipsis_line_share", most=0.3),
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once: a lambda variable, not a repeated expression."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS + "+"))


def count_of(text: Column, chars: str) -> Column:
    return (F.char_length(text) - F.char_length(F.translate(text, chars, ""))).cast("long")


def repeated_words(words: Column, size: int = 3) -> Column:
    """Words inside any run of ``size`` words that the text has twice or more.

    Runs are compared by 64-bit hashes, sorted with their places: equal neighbours repeat.
    The places of repeated runs, in order, cover ``min(size, gap)`` new words each.
    """

    def of_sorted(s: Column) -> Column:
        def again(x: Column, i: Column) -> Column:
            return F.coalesce(x["h"] == F.get(s, i - 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get(s, i + 1)["h"], F.lit(False))

        places = F.sort_array(F.transform(F.filter(s, again), lambda x: x["i"]))
        return let(places, lambda p: F.aggregate(
            F.transform(p, lambda x, i: F.least(F.lit(size), x - F.coalesce(F.get(p, i - 1), x - size))),
            F.lit(0).cast("long"), lambda a, x: a + x,
        ))

    runs = F.transform(
        F.sequence(F.lit(0), F.size(words) - size),
        lambda i: F.struct(F.xxhash64(*[F.get(words, i + k) for k in range(size)]).alias("h"), i.alias("i")),
    )
    return F.when(F.size(words) <= size, F.lit(0).cast("long")).otherwise(let(F.sort_array(runs), of_sorted))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, text_key and one column per measure; one row per input row.

    A null or blank text has no word: its counts are 0 and its ratios 0.
    """
    text = F.col("text")
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")

    def by_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"), repeated_words(w).alias("n_repeat_words"),
            F.size(F.array_intersect(w, F.array(*[F.lit(s) for s in STOP_WORDS]))).cast("long").alias("n_stop_words"),
        )

    def by_lines(x: Column) -> Column:
        return F.struct(
            F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            F.size(F.filter(x, lambda v: F.ltrim(v).rlike("^[-*•]"))).alias("bullets"),
            F.size(F.filter(x, lambda v: F.rtrim(v).rlike(r"(\.\.\.|…)$"))).alias("ellipses"),
        )

    counts = documents(docs, id_col, text_col).select(
        "id", "text_key", let(words_of(text), by_words).alias("w"), let(lines, by_lines).alias("l"),
        F.char_length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
        count_of(text, SYMBOLS).alias("n_symbols"), count_of(text, CAPITALS).alias("n_capitals"), count_of(text, "!").alias("n_exclamations"),
    )
    n, m = F.greatest("w.n_words", F.lit(1)), F.greatest("l.n_lines", F.lit(1))
    return counts.select(
        "id", "text_key", "w.n_words", "word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words", "w.n_stop_words",
        (F.col("w.n_repeat_words") / n).alias("repeat_share"), (F.col("word_chars") / n).alias("mean_word_chars"),
        (F.col("n_symbols") / n).alias("symbols_per_word"), (F.col("n_exclamations") / n).alias("exclamations_per_word"),
        (F.col("n_capitals") / F.greatest("word_chars", F.lit(1))).alias("capital_share"),
        (F.col("l.n_dup_lines") / m).alias("dup_line_share"), (F.col("l.bullets") / m).alias("bullet_line_share"),
        (F.col("l.ellipses") / m).alias("ellipsis_line_share"),
    )


def passes(rule: Rule) -> Column:
    ok = F.lit(True)
    if rule.least is not None:
        ok = ok & (F.col(rule.measure) >= rule.least)
    if rule.most is not None:
        ok = ok & (F.col(rule.measure) <= rule.most)
    return ok


def verdicts(measures: DataFrame, base: tuple[Rule, ...] = BASE, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The measures with ``base_failed``, ``kept`` and the names of the rules that failed."""
    failed = F.filter(F.array(*[F.when(~passes(r), r.name) for r in (*base, *rules)]), lambda x: x.isNotNull())
    base_ok = F.lit(True)
    for r in base:
        base_ok = base_ok & passes(r)
    return measures.select("*", (~base_ok).alias("base_failed"), failed.alias("failed"), (F.size(failed) == 0).alias("kept"))


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id (null stays null), the five counts, base_failed and kept."""
    return verdicts(measured(docs, id_col, text_col)).select(
        shown_id().alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed"
    )
