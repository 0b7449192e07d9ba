"""From webhook payloads to contacts: contract, message, summary, contract, merge; what fails is set aside with its reason."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from carelake.operators.contacts import upsert_contacts, without_number
from carelake.operators.contracts import check_payloads, check_summaries, quarantined, valid
from carelake.session import stored

# Adds ``summary_json`` to rows that have a message: a model's answer, say, through predict_batch_udf.
Summariser = Callable[[DataFrame], DataFrame]


class Intake(NamedTuple):
    contacts: DataFrame
    quarantine: DataFrame


def take_in(payloads: DataFrame, contacts: DataFrame, summarise: Summariser, column: str = "payload") -> Intake:
    """Contacts after all payloads, and (event_id, stage, reason) of each that did not get there.

    ``payloads`` has event_id, ts and the payload as JSON text; they are merged
    in the order of (ts, event_id). ``summarise`` sees phone, patient_name and
    message, and is asked once for each valid payload: its answers are stored
    before both the merge and the quarantine read them. Stages are payload,
    summary and contact; a payload is in the quarantine at most once.
    """
    checked = stored(check_payloads(payloads.select("event_id", "ts", column), column).drop(column), "payloads")
    messages = valid(checked).select("event_id", "ts", F.col("record.phone").alias("phone"), F.col("record.patient_name").alias("patient_name"), "message")
    answers = stored(check_summaries(summarise(messages).select("event_id", "ts", "phone", "summary_json"), "summary_json"), "summaries")
    updates = valid(answers)
    rejected = [rows.select("event_id", F.lit(stage).alias("stage"), "reason") for stage, rows in (
        ("payload", quarantined(checked)), ("summary", quarantined(answers)), ("contact", without_number(updates)))]
    return Intake(upsert_contacts(contacts, updates), rejected[0].unionByName(rejected[1]).unionByName(rejected[2]))
