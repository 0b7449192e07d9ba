"""Typed record contracts over JSON text, with quarantine.

A record is parsed into a variant, which knows the JSON type of each member,
and into the exact text of its members. Each field then yields a value and,
where it breaks its rule, a violation. A missing key takes its default; an
explicit null does not. Unknown keys are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from carelake.functions.text import blank_to_null, chosen_message

# Fields, defaults and allowed intents of the summary record.
INTENTS = ("Inquiry", "Scheduling", "Complaint", "Other")
TEXT_DEFAULTS = {
    "cliente": "Not identified",
    "intencao": "Other",
    "solicitacao": "Not identified",
    "obs": "No additional notes",
    "fobias_alergias": "None reported",
    "historico": "No history available",
}
NUMBER_FIELDS = {"ltv_pago": "double", "potencial": "double", "qtd_consultas": "int"}
SUMMARY_FIELDS = (*TEXT_DEFAULTS, *NUMBER_FIELDS)

_DOCUMENT = "__document"


@dataclass(frozen=True)
class Field:
    """A field's value when valid, and the condition under which it is not."""

    name: str
    value: Column
    broken: Column


def _kind(name: str) -> Column:
    """SQL type name of a JSON member; NULL when the key is missing."""
    return F.schema_of_variant(F.variant_get(_DOCUMENT, f"$.{name}", "variant"))


def _is_object() -> Column:
    document = F.col(_DOCUMENT)
    return document.isNotNull() & F.schema_of_variant(document).startswith("OBJECT")


def _text(name: str, default: str, allowed: tuple[str, ...] | None = None) -> Field:
    kind, value = F.col(f"__kind_{name}"), F.col(f"__raw_{name}")
    broken = kind.isNotNull() & (kind != "STRING")
    if allowed:
        broken = broken | (kind.isNotNull() & ~value.isin(*allowed))
    return Field(name, F.when(kind.isNull(), F.lit(default)).otherwise(value), broken)


def _number(name: str, kind_wanted: str) -> Field:
    """A non-negative number; an integer has no fraction and fits 32 bits."""
    kind, number = F.col(f"__kind_{name}"), F.col(f"__raw_{name}")
    value = F.when(kind.isNull(), F.lit(0.0)).otherwise(number)
    broken = kind.isNotNull() & (number.isNull() | F.isnan(number) | (number < 0))
    if kind_wanted == "int":
        value = value.try_cast("int")
        broken = broken | (kind.isNotNull() & ((number != F.floor(number)) | value.isNull()))
    return Field(name, value, broken)


def _as_number(kind: Column, raw: Column) -> Column:
    """Exact member text as a double; numeric text and booleans convert."""
    text = F.trim(raw)
    # The cast alone would read "1d" and "1f" as numbers.
    suffixed = text.rlike(r"(?i)[0-9.][df]$")
    truth = F.when(kind == "BOOLEAN", F.when(text == "true", 1.0).otherwise(0.0))
    return F.coalesce(F.when(~suffixed, text.try_cast("double")), truth)


def _parsed(records: DataFrame, json_column: str, names: tuple[str, ...]) -> DataFrame:
    """Adds ``__readable`` and, per member, ``__kind_*`` and ``__raw_*``."""
    texts = F.from_json(json_column, ", ".join(f"{name} string" for name in names))
    helpers = {"__readable": _is_object()}
    for name in names:
        helpers[f"__kind_{name}"] = _kind(name)
        helpers[f"__raw_{name}"] = F.col("__texts")[name]
    opened = records.withColumns({_DOCUMENT: F.try_parse_json(json_column), "__texts": texts})
    return opened.withColumns(helpers)


def _violations(rules: dict[str, Column]) -> Column:
    """Names of the broken rules, joined by commas; empty for a valid record."""
    names = [F.when(F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]
    return F.when(F.col("__readable"), F.concat_ws(",", *names)).otherwise(F.lit("json"))


def _behind_generator(rows: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns through a one-row generator.

    The optimizer substitutes an ordinary column into later filters and would
    check each record again there.
    """
    return rows.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def _without_helpers(rows: DataFrame) -> DataFrame:
    return rows.drop(*[c for c in rows.columns if c.startswith("__")])


def check_summaries(records: DataFrame, json_column: str) -> DataFrame:
    """Adds ``summary`` (a struct) and ``violations`` (broken fields, as text).

    Text that is not a JSON object has the single violation ``json``.
    """
    parsed = _parsed(records, json_column, SUMMARY_FIELDS)
    numbers = {f"__raw_{n}": _as_number(F.col(f"__kind_{n}"), F.col(f"__raw_{n}")) for n in NUMBER_FIELDS}
    fields = [
        _text(name, default, INTENTS if name == "intencao" else None) for name, default in TEXT_DEFAULTS.items()
    ] + [_number(name, kind) for name, kind in NUMBER_FIELDS.items()]
    checked = _behind_generator(
        parsed.withColumns(numbers),
        violations=_violations({f.name: f.broken for f in fields}),
        summary=F.struct(*[f.value.alias(f.name) for f in fields]),
    )
    return _without_helpers(checked)


def check_payloads(records: DataFrame, json_column: str) -> DataFrame:
    """Adds ``record`` (blank texts as NULL), ``message`` and ``violations``.

    The phone is required; the other fields are text or null. A payload without
    any usable message is rejected as well.
    """
    names = ("phone", "patient_name", "message_text", "audio_transcription")
    parsed = _parsed(records, json_column, names)
    kinds = {name: F.col(f"__kind_{name}") for name in names}
    values = {name: F.col(f"__raw_{name}") for name in names}
    message = chosen_message(values["audio_transcription"], values["message_text"])
    rules = {"phone": kinds["phone"].isNull() | (kinds["phone"] != "STRING")}
    for name in names[1:]:
        rules[name] = kinds[name].isNotNull() & ~kinds[name].isin("STRING", "VOID")
    rules["message"] = message.isNull()
    record = F.struct(
        values["phone"].alias("phone"),
        values["patient_name"].alias("patient_name"),
        blank_to_null(values["message_text"]).alias("message_text"),
        blank_to_null(values["audio_transcription"]).alias("audio_transcription"),
    )
    checked = _behind_generator(parsed, violations=_violations(rules), record=record, message=message)
    return _without_helpers(checked)


def valid(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("violations") == "").drop("violations")


def quarantined(checked: DataFrame) -> DataFrame:
    """Rejected rows with the reason as text."""
    return checked.where(F.col("violations") != "").withColumnRenamed("violations", "reason")


def reject_empty(messages: DataFrame, audio: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a ``message``, rejected rows with a ``reason``)."""
    chosen = messages.withColumn("message", chosen_message(F.col(audio), F.col(text)))
    rejected = chosen.where(F.col("message").isNull()).withColumn("reason", F.lit("message"))
    return chosen.where(F.col("message").isNotNull()), rejected
