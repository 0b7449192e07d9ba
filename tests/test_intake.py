"""Payloads either change a contact or are set aside, once each, with the stage that refused them."""

import datetime as dt
import json

from pyspark.sql import functions as F

from carelake.plans import intake

AT = dt.datetime(2024, 1, 1)


def payload(**fields):
    return json.dumps({"phone": "+55 81 91", "patient_name": "Ana", "message_text": "hello", **fields})


def test_every_payload_is_accounted_for(spark):
    payloads = [
        (1, payload()), (2, payload(message_text=" ")), (3, payload(phone=None)), (4, "no json"), (5, payload(message_text="bad answer")),
        (6, payload(phone=" + ")), (7, payload(phone="+55 81 99", audio_transcription="from audio", message_text="typed")), (8, None),
    ]
    frame = spark.createDataFrame([(i, AT + dt.timedelta(minutes=i), p, "x") for i, p in payloads], "event_id long, ts timestamp_ntz, payload string, summary string")
    contacts = spark.createDataFrame([("c1", "First", "Last", "5581 91", "Ativo", None)],
                                     "id string, first_name string, last_name string, phone_number string, c_status_atendimento string, c_aisummary string")
    asked = spark.sparkContext.accumulator(0)

    def summarise(messages):
        def count(batches):
            for batch in batches:
                asked.add(batch.num_rows)
                yield batch

        seen = messages.mapInArrow(count, messages.schema)
        return seen.withColumn("summary_json", F.when(F.col("message") == "bad answer", F.lit('{"potencial": -1}')).otherwise(
            F.concat(F.lit('{"cliente": "Ana Maria", "solicitacao": "'), "message", F.lit('"}'))))

    merged, quarantine = intake.take_in(frame, contacts, summarise)
    got = {r.event_id: (r.stage, r.reason) for r in quarantine.collect()}
    assert got == {2: ("payload", "message"), 3: ("payload", "phone"), 4: ("payload", got[4][1]), 5: ("summary", "potencial"),
                   6: ("contact", "phone"), 8: ("payload", got[8][1])}
    rows = {r.phone_number: r for r in merged.collect()}
    assert rows.keys() == {"5581 91", "+55 81 99"} and rows["5581 91"].merge_action == "updated" and rows["5581 91"].last_name == "Maria"
    assert "from audio" in rows["+55 81 99"].c_aisummary and rows["+55 81 99"].merge_action == "inserted"
    # Each valid payload is summarised once, though both results were read.
    assert asked.value == 4
    assert quarantine.count() + 2 == len(payloads)


def test_nothing_comes_in(spark):
    empty = spark.createDataFrame([], "event_id long, ts timestamp_ntz, payload string")
    contacts = spark.createDataFrame([("c1", "F", "L", "1", "Ativo")], "id string, first_name string, last_name string, phone_number string, c_status_atendimento string")
    merged, quarantine = intake.take_in(empty, contacts, lambda rows: rows.withColumn("summary_json", F.lit("{}")))
    assert merged.count() == 1 and quarantine.count() == 0
