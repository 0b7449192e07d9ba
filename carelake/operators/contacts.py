"""Finding contacts by phone, and merging summaries into the contact table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from carelake.functions.text import (
    DEFAULT_FIRST_NAME,
    DEFAULT_LAST_NAME,
    clean_phone,
    crm_summary,
    first_name,
    last_name,
    money_display,
    visits_display,
)
from carelake.session import stored

# Fixed value: the care status of a contact created from a message.
NEW_STATUS = "Novo Lead"

# Which writer owns which contact column. The merge only writes AI-owned ones.
AI_OWNED = (
    "c_aisummary",
    "c_potencial_venda",
    "c_potencial_venda_currency",
    "c_qtd_consultas",
    "c_display_potencial",
    "c_display_visitas",
)
BILLING_OWNED = ("c_lifetime_value", "c_c_kanban_card", "c_c_ultimo_recebimento")


def match_by_equal_phone(messages: DataFrame, contacts: DataFrame) -> DataFrame:
    """(clean, contact_id): the smallest contact id whose normalised phone is equal."""
    wanted = _wanted(messages)
    known = (
        contacts.select(clean_phone(F.col("phone_number")).alias("clean"), "id")
        .groupBy("clean")
        .agg(F.min("id").alias("contact_id"))
    )
    return wanted.join(known, "clean", "left")


def match_by_contained_phone(messages: DataFrame, contacts: DataFrame) -> DataFrame:
    """(clean, contact_id): the smallest id whose stored phone contains the number.

    The stored phone is searched as it is; only the number looked for is cleaned.
    """
    return _match_pieces(messages, contacts, F.col("phone_number"), F.min("id"))


def match_phones(messages: DataFrame, contacts: DataFrame) -> DataFrame:
    """(clean, contact_id): an equal phone if there is one, else a containing one.

    Both sides are cleaned. Differs from the pure substring search when one
    number contains another: the contact with exactly this number is preferred.
    """
    equal = F.length("clean") == F.length("stored")
    preferred = F.coalesce(F.min(F.when(equal, F.col("id"))), F.min("id"))
    return _match_pieces(messages, contacts, clean_phone(F.col("phone_number")), preferred)


def _match_pieces(messages: DataFrame, contacts: DataFrame, phone: Column, choice: Column) -> DataFrame:
    """A substring search as an equality join.

    Stored numbers are short, so each yields its substrings, but only of lengths
    that are looked for. Substrings meet the wanted numbers before anything is
    grouped: where Spark's size check lets those be broadcast, only hits are
    shuffled, and else the join and the grouping share one shuffle. No pair of
    message and contact is built, even if all contacts hold the number. An empty
    number matches nothing.
    """
    wanted = _wanted(messages)
    lengths = wanted.agg(F.collect_set(F.length("clean"))).scalar()
    width, start = F.col("width"), F.col("start")
    pieces = (
        contacts.where(F.col("phone_number").isNotNull())
        .select("id", phone.alias("stored"), F.explode(lengths).alias("width"))
        .where(F.length("stored") >= width)
        .select("id", "stored", "width", F.explode(F.sequence(F.lit(1), F.length("stored") - width + 1)).alias("start"))
        .select("id", "stored", F.substring("stored", start, width).alias("clean"))
    )
    hits = pieces.join(wanted, "clean").groupBy("clean").agg(choice.alias("contact_id"))
    return wanted.join(hits, "clean", "left")


def _wanted(messages: DataFrame) -> DataFrame:
    return (
        messages.select(clean_phone(F.col("phone")).alias("clean"))
        .where(F.length("clean") > 0)
        .distinct()
    )


def without_number(updates: DataFrame) -> DataFrame:
    """Updates that belong to no contact, as their cleaned phone is empty or null, with the ``reason`` phone."""
    clean = clean_phone(F.col("phone"))
    return updates.where(clean.isNull() | (F.length(clean) == 0)).withColumn("reason", F.lit("phone"))


def fold_updates(updates: DataFrame) -> DataFrame:
    """The net effect of many summaries per number: one row per cleaned phone.

    ``updates`` has phone, ts, event_id and a validated ``summary`` struct.
    Every output piece is a maximum or minimum of (position, value), so a busy
    number is combined before the shuffle and folds can be folded again. Updates
    without a number are in ``without_number``.
    """
    position = F.struct("ts", "event_id")
    summary = F.col("summary")
    first, last = first_name(summary["cliente"]), last_name(summary["cliente"])
    pieces = updates.select(
        clean_phone(F.col("phone")).alias("clean"),
        F.when(first.isNotNull(), F.struct(position.alias("at"), first.alias("value"))).alias("first_name"),
        F.when(last.isNotNull(), F.struct(position.alias("at"), last.alias("value"))).alias("last_name"),
        F.struct(position.alias("at"), F.col("phone"), summary["cliente"].alias("cliente")).alias("opening"),
        F.struct(position.alias("at"), summary.alias("value")).alias("latest"),
    )
    return refold(pieces.where(F.length("clean") > 0), "clean")


def refold(pieces: DataFrame, key: str) -> DataFrame:
    """Combine partial folds of the same key."""
    return pieces.groupBy(key).agg(
        F.max("first_name").alias("first_name"),
        F.max("last_name").alias("last_name"),
        F.min("opening").alias("opening"),
        F.max("latest").alias("latest"),
    )


def ai_columns(summary: Column) -> dict[str, Column]:
    """The AI-owned contact columns for a summary."""
    columns = {
        "c_aisummary": crm_summary(summary),
        "c_potencial_venda": summary["potencial"].cast("decimal(13,4)"),
        "c_potencial_venda_currency": F.lit("BRL"),
        "c_qtd_consultas": summary["qtd_consultas"],
        "c_display_potencial": money_display(summary["potencial"]),
        "c_display_visitas": visits_display(summary["qtd_consultas"]),
    }
    if not set(columns).isdisjoint(BILLING_OWNED):
        raise ValueError("a summary may not write a column that billing owns")
    return columns


def merge_contacts(contacts: DataFrame, folded: DataFrame) -> DataFrame:
    """Contacts after the updates, with a ``merge_action`` per row.

    A matched contact gets AI-owned columns, and the name parts that were
    given. An unmatched number becomes a new contact. Columns owned by billing
    are never written. ``folded`` is used several times, so pass a stored
    table (``stored`` or the update log) rather than a long plan.
    """
    matches = match_phones(folded.select(F.col("clean").alias("phone")), contacts)
    new_key = F.concat(F.lit("new:"), F.col("clean"))
    keyed = folded.join(matches, "clean").withColumn("__key", F.coalesce("contact_id", new_key))
    changes = refold(keyed, "__key").select(
        "__key",
        F.col("first_name.value").alias("__first"),
        F.col("last_name.value").alias("__last"),
        F.col("opening.phone").alias("__phone"),
        F.col("opening.cliente").alias("__opening_name"),
        F.col("latest.value").alias("__summary"),
    )
    # A new key is never a contact id, so both join sides have unique keys.
    joined = contacts.withColumn("__id", F.col("id")).join(changes, F.col("__id") == F.col("__key"), "full_outer")

    inserted = F.col("__id").isNull()
    touched = F.col("__key").isNotNull()
    new_id = F.left(F.sha2(F.col("__key"), 256), F.lit(17))
    new_first = F.when(F.col("__opening_name") == "", "").otherwise(DEFAULT_FIRST_NAME)
    result = {c: F.col(c) for c in contacts.columns}
    for column in ("first_name", "last_name", *AI_OWNED):
        result.setdefault(column, F.lit(None))
    result["id"] = F.coalesce("id", new_id)
    result["first_name"] = F.coalesce("__first", F.when(inserted, new_first).otherwise(result["first_name"]))
    result["last_name"] = F.coalesce("__last", F.when(inserted, DEFAULT_LAST_NAME).otherwise(result["last_name"]))
    result["phone_number"] = F.when(inserted, F.col("__phone")).otherwise(F.col("phone_number"))
    result["c_status_atendimento"] = F.when(inserted, NEW_STATUS).otherwise(F.col("c_status_atendimento"))
    for column, value in ai_columns(F.col("__summary")).items():
        result[column] = F.when(touched, value).otherwise(result[column])
    result["merge_action"] = F.when(inserted, "inserted").when(touched, "updated").otherwise("unchanged")
    return joined.select(*[value.alias(name) for name, value in result.items()])


def upsert_contacts(contacts: DataFrame, updates: DataFrame) -> DataFrame:
    """Contacts after a batch of validated summaries; the fold is stored once."""
    return merge_contacts(contacts, stored(fold_updates(updates), "folded_updates"))
