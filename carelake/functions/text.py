"""Text classification, names, phones and display strings."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from carelake.functions.privacy import mask_pii

# Labels, thresholds and display prefixes.
MIN_SUMMARY_CHARS = 50
UNIDENTIFIED = "Not identified"
DEFAULT_FIRST_NAME = "Patient"
DEFAULT_LAST_NAME = "."
MONEY_PREFIX = "\U0001f680 Potential: R$ "
VISITS_PREFIX = "\U0001f3e5 Visits: "

# Code-point ranges of pictographs, with their joiners and modifiers.
EMOJI_CLASS = (
    r"[\x{1F000}-\x{1FAFF}\x{2600}-\x{27BF}\x{2B00}-\x{2BFF}\x{2300}-\x{23FF}"
    r"\x{FE0F}\x{200D}\x{20E3}]"
)


def is_nonblank(text: Column) -> Column:
    """Not NULL and not only spaces."""
    return text.isNotNull() & (F.length(F.trim(text)) > 0)


def summary_quality(text: Column) -> Column:
    """missing, empty, too_short or ok."""
    return (
        F.when(text.isNull(), "missing")
        .when(F.length(F.trim(text)) == 0, "empty")
        .when(F.length(text) < MIN_SUMMARY_CHARS, "too_short")
        .otherwise("ok")
    )


def blank_to_null(text: Column) -> Column:
    """NULL for text that holds only whitespace of any kind."""
    return F.when(~text.rlike(r"(?U)^\s*$"), text)


def chosen_message(audio: Column, text: Column) -> Column:
    """Audio transcription first, else the text; NULL when both are blank."""
    return F.coalesce(blank_to_null(audio), blank_to_null(text))


def clean_phone(phone: Column) -> Column:
    """Drop plus signs and spaces; other punctuation stays."""
    return F.trim(F.translate(phone, "+ ", ""))


def money_display(value: Column) -> Column:
    """1234.5 as a card string with dot thousands and comma decimals."""
    return F.concat(F.lit(MONEY_PREFIX), F.translate(F.format_number(value, 2), ",.", ".,"))


def money_plain(value: Column) -> Column:
    """Two decimals without grouping."""
    return F.replace(F.format_number(value, 2), F.lit(","), F.lit(""))


def visits_display(visits: Column) -> Column:
    return F.concat(F.lit(VISITS_PREFIX), visits.cast("string"))


def is_identified(name: Column) -> Column:
    """A usable client name."""
    return name.isNotNull() & (name != "") & (name != UNIDENTIFIED)


def first_name(name: Column) -> Column:
    """The text before the first space of an identified name, else NULL."""
    return F.when(is_identified(name), F.element_at(F.split(name, " "), 1))


def last_name(name: Column) -> Column:
    """The text after the first space of an identified name, else NULL."""
    return F.when(
        is_identified(name) & F.contains(name, F.lit(" ")),
        F.substring(name, F.instr(name, " ") + 1, F.length(name)),
    )


def strip_emoji(text: Column) -> Column:
    return F.regexp_replace(text, EMOJI_CLASS, "")


def crm_summary(record: Column) -> Column:
    """The Markdown note for a validated summary record (a struct column)."""
    history = mask_pii(record["historico"])
    notes = mask_pii(record["obs"])
    return F.concat(
        F.lit("**AI Clinical Summary:**\n"),
        F.concat_ws(". ", record["cliente"], record["fobias_alergias"], history),
        F.lit("\n\n**Technical Note:**\n- Client: "),
        record["cliente"],
        F.lit("\n- Intent: "),
        record["intencao"],
        F.lit("\n- Request: "),
        record["solicitacao"],
        F.lit("\n- Notes: "),
        notes,
        F.lit("\n- Estimated potential: R$ "),
        money_plain(record["potencial"]),
        F.lit("\n- Visit count: "),
        record["qtd_consultas"].cast("string"),
    )


def relevance_line(score: Column, text: Column) -> Column:
    """One context line: a whole-percent score (half to even) and the text."""
    percent = F.bround(score * F.lit(100.0), 0).cast("int").cast("string")
    return F.concat(F.lit("  - ["), percent, F.lit("% relevant] "), text)
