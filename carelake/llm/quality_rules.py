"""Quality rules: a table of thresholds compiled into one projection."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

# Frequent function words of four languages.
STOP_WORDS = (
    "the of and to in is that for with as on by it this are at or from an be not was "
    "de la le et les des en un une que qui pour dans du est sur au aux par pas avec elle il "
    "der die und das ein eine von zu den ist mit für auf im dem nicht sich auch es "
    "el y los las del se por con para como lo al su"
).split()


class Rule(NamedTuple):
    """``low * per <= measure + slack`` and ``measure <= high * per`` must hold; a bound of None is open."""

    name: str
    measure: str
    per: str
    low: float | None
    high: float | None
    slack: int = 0


# The base rules are part of the base failure; the others form the verdict.
BASE = (
    Rule("length", "n_words", "one", 20, None),
    Rule("repeated_words", "n_repeat_words", "n_words", None, 0.30),
)
VERDICT = (
    Rule("word_length", "word_chars", "n_words", 2, 20),
    Rule("symbols", "n_symbols", "n_words", None, 0.20),
    # A short text may have none by chance.
    Rule("stop_words", "n_stop_words", "n_words", 0.03, None, slack=3),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", None, 0.50),
)


def paired(df: DataFrame, source: str, by: int, out: str) -> DataFrame:
    """Adds a hash of each value of an array and the one ``by`` places on."""
    values = F.col(source)
    n = F.greatest(F.size(values) - by, F.lit(0))
    return df.withColumn(out, F.zip_with(F.slice(values, F.lit(1), n), F.slice(values, F.lit(by + 1), n),
                                         lambda a, b: F.xxhash64(a, b)))


def repeated_words(df: DataFrame, windows: str, out: str) -> DataFrame:
    """Adds the number of words inside windows that occur twice or more, each word once.

    Equal windows are neighbours after sorting (hash, place); the places of those
    with an equal neighbour, in order, cover eight words each less what the next
    one covers as well. Texts without a repeated window skip the sort. Every step
    is a column of its own, so none is computed twice.
    """
    found, none = F.col(windows), F.lit(None).cast("bigint")
    size = F.size("_placed")
    covered = F.aggregate(
        "_places", F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda s, i: F.struct((s["n"] + F.least(i - s["last"], F.lit(WINDOW))).alias("n"), i.alias("last")),
        lambda s: s["n"])
    return (
        df.withColumn("_placed", F.when(
            F.size(F.array_distinct(found)) < F.size(found),
            F.array_sort(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
        .withColumn("_sorted", F.transform("_placed", lambda p: p["h"]))
        .withColumn("_places", F.zip_with(
            "_placed",
            F.zip_with(F.concat(F.array(none), F.slice("_sorted", F.lit(1), size - 1)),
                       F.concat(F.slice("_sorted", F.lit(2), size - 1), F.array(none)),
                       lambda a, b: F.struct(a.alias("a"), b.alias("b"))),
            lambda p, s: F.when(p["h"].eqNullSafe(s["a"]) | p["h"].eqNullSafe(s["b"]), p["i"])))
        .withColumn("_places", F.array_sort(F.filter("_places", lambda i: i.isNotNull())))
        .withColumn(out, F.coalesce(covered, F.lit(0))))


def _holds(rule: Rule) -> Column:
    """The rule in hundredths, as whole numbers where the bound allows it."""
    per = F.lit(1) if rule.per == "one" else F.col(rule.per)
    checks = []
    if rule.low is not None:
        checks.append((F.col(rule.measure) + rule.slack) * 100 >= per * round(rule.low * 100))
    if rule.high is not None:
        checks.append(F.col(rule.measure) * 100 <= per * round(rule.high * 100))
    out = checks[0]
    for check in checks[1:]:
        out = out & check
    return out


def measure(documents: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` and the measures of the rules."""
    value = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(value, SPACE), lambda w: w != "")
    lines = F.filter(F.split(value, "\n", -1), lambda line: line.rlike(WORD))
    kept = [F.col(f"`{name}`") for name in keep]
    parts = documents.select(*kept, words.alias("_words"), lines.alias("_lines"),
                             F.char_length(F.regexp_replace(value, SPACE, "")).alias("word_chars"),
                             (F.char_length(value) - F.char_length(F.translate(value, SYMBOLS, ""))).alias("n_symbols"))
    parts = parts.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    parts = paired(paired(paired(parts, "_hashes", 1, "_twos"), "_twos", 2, "_fours"), "_fours", 4, "_windows")
    parts = repeated_words(parts, "_windows", "_repeated")
    measures = F.struct(
        F.size("_words").cast("long").alias("n_words"), F.col("word_chars").cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.col("_repeated").cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.size(F.filter("_words", lambda w: F.lower(w).isin(STOP_WORDS))).cast("long").alias("n_stop_words"))
    # A one-row generator: the optimizer would repeat all of the above in a later filter on the verdict.
    return parts.select(*kept, F.inline(F.array(measures)))


def apply_rules(documents: DataFrame, keep: list[str], text: str = "text",
                base: tuple[Rule, ...] = BASE, verdict: tuple[Rule, ...] = VERDICT) -> DataFrame:
    """Columns ``keep``, the measures, base_failed and kept, in one projection without a shuffle.

    Words are runs of characters other than space and U+0009-U+000D. A null or
    empty text has no words, so it fails the base rules. Lines without a word
    count for nothing. A document stays when it passes the base rules and every
    threshold of the verdict. Equal texts get equal verdicts; rows are neither
    added nor lost, and columns outside ``keep`` are ignored.
    """
    measured = measure(documents, keep, text)
    passes_base, passes_all = F.lit(True), F.lit(True)
    for rule in base:
        passes_base = passes_base & _holds(rule)
    for rule in verdict:
        passes_all = passes_all & _holds(rule)
    return (measured.withColumn("base_failed", ~passes_base)
            .withColumn("kept", ~F.col("base_failed") & passes_all))
