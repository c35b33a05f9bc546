"""Quality rules: a threshold table compiled into one projection (no user functions).

``apply_rules`` adds the measured ratios, one boolean per rule and the verdict.
Nulls and empty texts have no words, so they fail the length rule. Repeated
rows are judged each on its own; other columns are carried through untouched
unless they bear the name of a measure, in which case the measure replaces them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = [
    "the", "of", "and", "to", "in", "is", "that", "for", "it", "with", "as", "was", "on", "be", "by", "are", "this", "at", "from", "or", "an", "he", "not", "which",
    "der", "die", "das", "und", "den", "von", "zu", "mit", "ist", "ein", "eine", "dem", "nicht", "für", "auf", "sich", "des", "im", "als", "auch",
    "de", "la", "le", "les", "et", "du", "un", "une", "que", "est", "pour", "qui", "dans", "par", "au", "sur", "pas", "avec", "ne", "ou",
    "el", "los", "las", "y", "en", "del", "se", "por", "con", "para", "una", "su", "al", "lo", "es", "no",
]


@dataclass(frozen=True)
class Rule:
    """``measure`` must lie in [low, high]; ``None`` leaves a side open."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


RULES = (
    Rule("mean_word_length", "mean_word_chars", 2.0, 14.0),
    Rule("symbol_ratio", "symbol_ratio", None, 0.1),
    Rule("stop_word_ratio", "stop_ratio", 0.05, None),
    Rule("duplicate_lines", "dup_line_ratio", None, 0.4),
    Rule("bullet_lines", "bullet_line_ratio", None, 0.9),
    Rule("ellipsis_lines", "ellipsis_line_ratio", None, 0.3),
)


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once a row and hand it to ``body``, inside one expression."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def repeat_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside a ``window``-word sequence that occurs twice or more in the text."""

    def covered(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def total(s: Column) -> Column:
            twice = F.filter(s, lambda x, j: F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False)))
            return bind(
                F.sort_array(F.transform(twice, lambda x: x["i"])),
                lambda at: F.aggregate(
                    F.transform(at, lambda p, j: F.least(F.lit(window), F.coalesce(F.get(at, j + 1) - p, F.lit(window))).cast("long")),
                    F.lit(0).cast("long"),
                    lambda a, b: a + b,
                ),
            )

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(bind(pairs, total))

    count = F.size(words)
    starts = F.when(count >= window, F.sequence(F.lit(0), count - window)).otherwise(F.array().cast("array<int>"))
    each = bind(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda hs: F.transform(starts, lambda i: F.xxhash64(*[F.get(hs, i + k) for k in range(window)])),
    )
    return bind(each, covered)


def measures(text: Column) -> Column:
    """All measures of a text as one struct."""
    whole = F.coalesce(text, F.lit(""))

    def of(words: Column, lines: Column) -> Column:
        n, n_lines = F.size(words), F.size(lines)
        per_line = F.greatest(n_lines, F.lit(1))
        return F.struct(
            n.cast("long").alias("n_words"),
            F.char_length(F.translate(whole, SPACE_CHARS, "")).cast("long").alias("word_chars"),
            (F.char_length(whole) - F.char_length(F.translate(whole, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            (n_lines - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            repeat_words(words).alias("n_repeat_words"),
            F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
            (F.size(F.filter(lines, lambda x: x.rlike(r"^\s*[-*•]"))) / per_line).alias("bullet_line_ratio"),
            (F.size(F.filter(lines, lambda x: x.rlike(r"(\.\.\.|…)\s*$"))) / per_line).alias("ellipsis_line_ratio"),
            n_lines.cast("long").alias("n_lines"),
        )

    return bind(words_of(whole), lambda w: bind(F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")), lambda ls: of(w, ls)))


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """Conjunction of the rules over columns named by their measures."""
    out = F.lit(True)
    for r in rules:
        if r.low is not None:
            out = out & (F.col(r.measure) >= r.low)
        if r.high is not None:
            out = out & (F.col(r.measure) <= r.high)
    return out


def apply_rules(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, min_words: int = 20, max_repeat_percent: int = 30) -> DataFrame:
    """``docs`` with the measures, ``base_failed`` and ``kept``."""
    own = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stop_words", "bullet_line_ratio", "ellipsis_line_ratio", "n_lines"]
    out = docs.withColumn("__measures", measures(F.col(f"`{text}`"))).withColumns({c: F.col("__measures")[c] for c in own}).drop("__measures")
    words = F.greatest(F.col("n_words"), F.lit(1))
    out = out.withColumns(
        {
            "mean_word_chars": F.col("word_chars") / words,
            "symbol_ratio": F.col("n_symbols") / words,
            "stop_ratio": F.col("n_stop_words") / words,
            "dup_line_ratio": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
            "base_failed": (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_percent),
        }
    )
    return out.withColumn("kept", ~F.col("base_failed") & verdict(rules))
