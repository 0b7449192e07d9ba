"""Contracts, phone matching, merging and conversations against plain Python."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from carelake.operators import contacts as crm, contracts, sessions
from carelake.streaming import sessions as session_stream, upsert

START = dt.datetime(2024, 1, 1)

# -- contracts ------------------------------------------------------------------

CONTRACT_CASES = [
    ("{}", ""),
    ('{"ltv_pago": 100, "potencial": 500, "qtd_consultas": 3}', ""),
    *[(json.dumps({"intencao": i}), "") for i in contracts.INTENTS],
    ('{"intencao": "InvalidValue"}', "intencao"),
    ('{"potencial": -1}', "potencial"),
    ('{"cliente": null}', "cliente"),
    ('{"cliente": 5}', "cliente"),
    ('{"obs": ["a"]}', "obs"),
    ('{"unknown": 1}', ""),
    ('{"potencial": "12.5"}', ""),
    ('{"potencial": "1d"}', "potencial"),
    ('{"potencial": "true"}', "potencial"),
    ('{"potencial": true}', ""),
    ('{"potencial": {"a": 1}}', "potencial"),
    ('{"ltv_pago": null}', "ltv_pago"),
    ('{"qtd_consultas": 2.5}', "qtd_consultas"),
    ('{"qtd_consultas": 2.0}', ""),
    ('{"qtd_consultas": 99999999999}', "qtd_consultas"),
    ('{"intencao": "Sale", "potencial": "high"}', "intencao,potencial"),
    ("not json", "json"),
    ("[1]", "json"),
    (None, "json"),
]


def test_summary_contract(spark):
    frame = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CONTRACT_CASES)], "i int, j string")
    rows = contracts.check_summaries(frame, "j").orderBy("i").collect()
    assert [r.violations for r in rows] == [c[1] for c in CONTRACT_CASES]
    assert rows[0].summary.asDict() == {**contracts.TEXT_DEFAULTS, "ltv_pago": 0.0, "potencial": 0.0, "qtd_consultas": 0}
    assert (rows[1].summary.ltv_pago, rows[1].summary.potencial, rows[1].summary.qtd_consultas) == (100.0, 500.0, 3)
    checked = contracts.check_summaries(frame, "j")
    assert contracts.valid(checked).count() + contracts.quarantined(checked).count() == len(CONTRACT_CASES)
    assert "reason" in contracts.quarantined(checked).columns


def test_crm_text(spark):
    from carelake.functions.text import crm_summary

    record = {"cliente": "John Smith", "intencao": "Inquiry", "solicitacao": "Implant pricing", "potencial": 3000,
              "qtd_consultas": 2, "obs": "CPF 123.456.789-00"}
    frame = spark.createDataFrame([(json.dumps(record),)], "j string")
    note = contracts.check_summaries(frame, "j").select(crm_summary(F.col("summary")).alias("n")).first().n
    assert note == (
        "**AI Clinical Summary:**\nJohn Smith. None reported. No history available\n\n**Technical Note:**\n"
        "- Client: John Smith\n- Intent: Inquiry\n- Request: Implant pricing\n- Notes: CPF ***.***.***-**\n"
        "- Estimated potential: R$ 3000.00\n- Visit count: 2"
    )


PAYLOADS = [
    ({"phone": "+55", "patient_name": "A", "message_text": "hi"}, "", "hi"),
    ({"phone": "+55", "message_text": ""}, "message", None),
    ({"phone": "+55", "message_text": "hi", "audio_transcription": "spoken"}, "", "spoken"),
    ({"phone": "+55", "message_text": "hi", "audio_transcription": "  "}, "", "hi"),
    ({"message_text": "hi"}, "phone", "hi"),
    ({"phone": None, "message_text": "hi"}, "phone", "hi"),
    ({"phone": "+55", "patient_name": None, "message_text": "hi"}, "", "hi"),
    ({"phone": "+55", "patient_name": 3, "message_text": "hi"}, "patient_name", "hi"),
]


def test_payload_contract(spark):
    frame = spark.createDataFrame([(i, json.dumps(p[0])) for i, p in enumerate(PAYLOADS)], "i int, j string")
    rows = contracts.check_payloads(frame, "j").orderBy("i").collect()
    assert [(r.violations, r.message) for r in rows] == [(p[1], p[2]) for p in PAYLOADS]


# -- phones and merge --------------------------------------------------------------


def contact_frame(spark, rows):
    return spark.createDataFrame(
        rows, "id string, first_name string, last_name string, phone_number string, c_status_atendimento string, "
        "c_lifetime_value double, c_aisummary string, c_potencial_venda decimal(13,4), "
        "c_potencial_venda_currency string, c_qtd_consultas int",
    )


def test_contained_phone_equals_brute_force(spark):
    rng = random.Random(5)
    stored = [(f"c{i:03d}", "".join(rng.choice("0123") for _ in range(rng.randint(0, 6)))) for i in range(200)]
    stored.append(("c900", None))
    wanted = ["".join(rng.choice("0123") for _ in range(rng.randint(0, 5))) for _ in range(80)] + ["+0 1", "", None]
    contacts = spark.createDataFrame(stored, "id string, phone_number string")
    messages = spark.createDataFrame([(w,) for w in wanted], "phone string")
    got = {r.clean: r.contact_id for r in crm.match_by_contained_phone(messages, contacts).collect()}
    cleaned = {w.replace("+", "").replace(" ", "") for w in wanted if w} - {""}
    assert got == {w: min((i for i, p in stored if p and w in p), default=None) for w in cleaned}
    preferred = {r.clean: r.contact_id for r in crm.match_phones(messages, contacts).collect()}
    for w in cleaned:
        equal = [i for i, p in stored if p == w]
        assert preferred[w] == (min(equal) if equal else got[w])


NAMES = ["Ana Maria", "Bia", "Not identified", "Carla Dias Reis", ""]


def apply_in_order(contacts, updates):
    """One update after the other, as a service would."""
    state = {c[0]: list(c[1:]) for c in contacts}
    new = {}
    for phone, ts, event, record in sorted(updates, key=lambda u: (u[1], u[2])):
        clean = phone.replace("+", "").replace(" ", "")
        hits = [i for i, c in sorted(state.items()) if c[2].replace("+", "").replace(" ", "") == clean]
        name = record["cliente"]
        parts = name.split(" ")
        if hits:
            row = state[hits[0]]
        elif clean in new:
            row = new[clean]
        else:
            first, last = ("Patient", ".") if name == "Not identified" else (parts[0], " ".join(parts[1:]) or ".")
            row = new[clean] = [first, last, phone, "Novo Lead", None, None, None, None, None]
        if name and name != "Not identified":
            row[0] = parts[0]
            if len(parts) > 1:
                row[1] = " ".join(parts[1:])
        row[6], row[7], row[8] = record["potencial"], "BRL", record["qtd_consultas"]
    return {(*[str(v) if v is not None else None for v in (*r[:5], *r[7:])], float(r[6]) if r[6] is not None else None)
            for r in [*state.values(), *new.values()]}


def merge_case(seed):
    rng = random.Random(seed)
    contacts = [(f"c{i}", f"First{i}", f"Last{i}", f"+55 81 9{i:03d}", "Ativo", 10.0 * i, None, None, None, None) for i in range(6)]
    updates = []
    for event in range(60):
        number = rng.randint(0, 11)
        phone = rng.choice(["+55 81 9{:03d}", "55819{:03d}"]).format(number)
        record = {"cliente": rng.choice(NAMES), "potencial": float(rng.randint(0, 900)), "qtd_consultas": rng.randint(0, 9)}
        updates.append((phone, START + dt.timedelta(seconds=rng.randint(0, 30)), event, record))
    return contacts, updates


def merged_rows(frame):
    return {
        (r.first_name, r.last_name, r.phone_number, r.c_status_atendimento,
         str(r.c_lifetime_value) if r.c_lifetime_value is not None else None, r.c_potencial_venda_currency,
         str(r.c_qtd_consultas) if r.c_qtd_consultas is not None else None,
         float(r.c_potencial_venda) if r.c_potencial_venda is not None else None)
        for r in frame.collect()
    }


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_merge_equals_one_after_the_other(spark, seed):
    contacts, updates = merge_case(seed)
    frame = spark.createDataFrame(
        [(p, t, e, json.dumps(r)) for p, t, e, r in updates], "phone string, ts timestamp_ntz, event_id long, j string"
    )
    valid = contracts.valid(contracts.check_summaries(frame, "j"))
    merged = crm.upsert_contacts(contact_frame(spark, contacts), valid)
    assert merged_rows(merged) == apply_in_order(contacts, updates)
    assert merged.select("id").distinct().count() == merged.count()
    assert {r.merge_action for r in merged.collect()} == {"inserted", "updated"} | (
        {"unchanged"} if merged.where("merge_action = 'unchanged'").count() else set()
    )


def test_streamed_updates_equal_the_batch(spark, tmp_path):
    """Several micro-batches give what one batch gives."""
    contacts, updates = merge_case(9)
    schema = "phone string, ts timestamp_ntz, event_id long, summary_json string"
    rows = [(p, t, e, json.dumps(r)) for p, t, e, r in updates] + [("+55", START, 99, "broken")]
    source = tmp_path / "in"
    for part in range(3):
        spark.createDataFrame(rows[part::3], schema).coalesce(1).write.mode("append").parquet(str(source))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(source))
    root = str(tmp_path / "contacts")
    upsert.create(contact_frame(spark, contacts), root)
    upsert.stream_upsert(stream, root).awaitTermination()
    expected = apply_in_order(contacts, updates)
    assert merged_rows(upsert.current_contacts(spark, root)) == expected
    assert upsert.last_batch(spark, root) == 2
    assert spark.read.parquet(f"{root}/quarantine").where("reason = 'json'").count() == 1
    assert upsert.compact(spark, root) == 1
    assert merged_rows(upsert.current_contacts(spark, root)) == expected
    assert {r.merge_action for r in upsert.current_contacts(spark, root).collect()} == {"unchanged"}


UPDATE = "phone string, ts timestamp_ntz, event_id long, summary_json string"


def update_batch(spark, updates):
    return spark.createDataFrame([(p, t, e, json.dumps(r)) for p, t, e, r in updates], UPDATE)


def logged(spark, root):
    return sorted(map(str, spark.read.parquet(f"{root}/log").where("clean is not null").collect()))


def test_a_version_holds_what_its_merge_did(spark, tmp_path):
    """As written, after older versions are gone; the next merge starts from unchanged contacts."""
    contacts, updates = merge_case(7)
    root = str(tmp_path)
    actions = lambda rows: {r.id: r.merge_action for r in rows.collect()}
    upsert.create(contact_frame(spark, contacts), root)
    assert set(actions(upsert.newest_version(spark, root)).values()) == {"unchanged"}
    upsert.write_batch(update_batch(spark, updates[:6]), 0, root)
    expected = actions(upsert.current_contacts(spark, root))
    upsert.compact(spark, root)
    upsert.prune(spark, root, versions=1)
    assert actions(upsert.newest_version(spark, root)) == expected and len(set(expected.values())) == 3
    assert set(actions(upsert.current_contacts(spark, root)).values()) == {"unchanged"}


def test_contacts_before_any_batch(spark, tmp_path):
    contacts, _ = merge_case(1)
    root = str(tmp_path)
    upsert.create(contact_frame(spark, contacts), root)
    assert merged_rows(upsert.current_contacts(spark, root)) == apply_in_order(contacts, [])
    assert upsert.compact(spark, root) == 0
    upsert.prune(spark, root)
    with pytest.raises(Exception, match="EXISTS"):
        upsert.create(contact_frame(spark, contacts), root)


def test_repeated_batch_leaves_the_same_log(spark, tmp_path, monkeypatch):
    """A batch that failed before its end is done again; one that was finished is left alone."""
    contacts, updates = merge_case(4)
    root = str(tmp_path)
    upsert.create(contact_frame(spark, contacts), root)
    with monkeypatch.context() as patch:
        patch.setattr(upsert, "_finish", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            upsert.write_batch(update_batch(spark, updates[:30]), 0, root)
    assert merged_rows(upsert.current_contacts(spark, root)) == apply_in_order(contacts, [])
    upsert.write_batch(update_batch(spark, updates), 0, root)
    once = logged(spark, root)
    upsert.write_batch(update_batch(spark, updates[:5]), 0, root)
    assert logged(spark, root) == once
    assert merged_rows(upsert.current_contacts(spark, root)) == apply_in_order(contacts, updates)


def test_a_batch_during_compaction_is_kept(spark, tmp_path, monkeypatch):
    contacts, updates = merge_case(6)
    updates.sort(key=lambda u: (u[1], u[2]))
    root = str(tmp_path)
    upsert.create(contact_frame(spark, contacts), root)
    upsert.write_batch(update_batch(spark, updates[:20]), 0, root)
    merge = upsert.merge_contacts

    def merge_slowly(*parts):
        upsert.write_batch(update_batch(spark, updates[20:40]), 1, root)
        return merge(*parts)

    with monkeypatch.context() as patch:
        patch.setattr(upsert, "merge_contacts", merge_slowly)
        assert upsert.compact(spark, root) == 1
    assert tuple(upsert.newest(spark, root)) == (1, 0) and upsert.last_batch(spark, root) == 1
    assert merged_rows(upsert.current_contacts(spark, root)) == apply_in_order(contacts, updates[:40])
    upsert.prune(spark, root, versions=1)
    upsert.write_batch(update_batch(spark, updates[40:]), 2, root)
    assert upsert.compact(spark, root) == 2
    upsert.prune(spark, root, versions=1)
    assert logged(spark, root) == [] and spark.read.parquet(f"{root}/base").where("version < 2 and id is not null").count() == 0
    assert merged_rows(upsert.current_contacts(spark, root)) == apply_in_order(contacts, updates)


def test_a_failed_compaction_leaves_the_old_version(spark, tmp_path, monkeypatch):
    contacts, updates = merge_case(7)
    root = str(tmp_path)
    upsert.create(contact_frame(spark, contacts), root)
    upsert.write_batch(update_batch(spark, updates), 0, root)
    with monkeypatch.context() as patch:
        patch.setattr(upsert, "_commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            upsert.compact(spark, root)
    assert upsert.newest(spark, root).version == 0
    assert merged_rows(upsert.current_contacts(spark, root)) == apply_in_order(contacts, updates)
    assert upsert.compact(spark, root) == 1


def test_updates_without_a_number_are_set_aside(spark, tmp_path):
    contacts, updates = merge_case(8)
    root = str(tmp_path)
    upsert.create(contact_frame(spark, contacts), root)
    odd = [(phone, START, 1000 + i, updates[0][3]) for i, phone in enumerate([None, "", " + "])]
    upsert.write_batch(update_batch(spark, updates + odd), 0, root)
    rejected = spark.read.parquet(f"{root}/quarantine").collect()
    assert sorted((r.event_id, r.reason) for r in rejected) == [(1000, "phone"), (1001, "phone"), (1002, "phone")]
    assert merged_rows(upsert.current_contacts(spark, root)) == apply_in_order(contacts, updates)


# -- conversations --------------------------------------------------------------------


def sessions_by_hand(events, gap):
    """{(user, start): [texts]} with events sorted by time, then id."""
    found, last = {}, {}
    for user, us, event, text in sorted(events, key=lambda e: (e[0], e[1], e[2])):
        if user not in last or us - last[user][1] > gap:
            last[user] = (us, us)
        last[user] = (last[user][0], us)
        found.setdefault((user, last[user][0]), []).append(text)
    return found


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_sessions_equal_by_hand(spark, seed):
    """Small buckets, so that sessions cross many of them; one busy user."""
    rng = random.Random(seed)
    gap = 15_000_000
    events = []
    for event in range(600):
        user = 0 if rng.random() < 0.4 else rng.randint(1, 8)
        events.append((user, rng.randint(0, 900) * 1_000_000 + rng.choice([0, 0, 1]), event, f"m{event}"))
    frame = spark.createDataFrame(
        [(u, START + dt.timedelta(microseconds=us), e, t) for u, us, e, t in events],
        "user_id int, ts timestamp_ntz, event_id int, text string",
    )
    expected = {}
    for (user, start), texts in sessions_by_hand(events, gap).items():
        expected[(user, START + dt.timedelta(microseconds=start))] = texts
    for bucket in (7, 60, 3600):
        placed = sessions.assign_sessions(frame, "user_id", "ts", 15, bucket)
        got = {}
        for r in placed.orderBy("user_id", "ts", "event_id").collect():
            got.setdefault((r.user_id, r.session_start.replace(tzinfo=None)), []).append(r.text)
        assert got == expected
    whole = sessions.conversation_sessions(frame, "user_id", "ts", "event_id", "text", 15)
    joined = {(r.user_id, r.session_start.replace(tzinfo=None)): r.text.split("\n") for r in whole.collect()}
    assert joined == expected
    single = {}
    for r in sessions.session_messages(frame, "user_id", "ts", "event_id", "text", 15).orderBy("position").collect():
        single.setdefault((r.user_id, r.session_start.replace(tzinfo=None)), []).append(r.text)
    assert single == expected


def test_messages_without_key_or_time_are_set_aside(spark):
    rows = [(1, START, 1, "a"), (None, START, 2, "b"), (1, None, 3, "c"), (None, None, 4, "d")]
    frame = spark.createDataFrame(rows, "user_id int, ts timestamp_ntz, event_id int, text string")
    aside = {r.event_id: r.reason for r in sessions.unplaced_messages(frame, "user_id", "ts").collect()}
    assert aside == {2: "user_id", 3: "ts", 4: "user_id"}
    placed = sessions.conversation_sessions(frame, "user_id", "ts", "event_id", "text", 15).collect()
    assert [(r.n_messages, r.text) for r in placed] == [(1, "a")]


def test_session_gap_is_inclusive(spark):
    def count(seconds):
        rows = [(1, START, 1, "a"), (1, START + dt.timedelta(seconds=seconds), 2, "b"), (None, START, 3, "c")]
        frame = spark.createDataFrame(rows, "user_id int, ts timestamp_ntz, event_id int, text string")
        return sessions.conversation_sessions(frame, "user_id", "ts", "event_id", "text", 15).count()

    assert count(15) == 1
    assert count(15.000001) == 2


def test_stream_emits_closed_sessions(spark, tmp_path):
    rows = [(1, START, 1, "a"), (1, START + dt.timedelta(seconds=10), 2, "b"), (2, START, 3, "c"),
            (9, START + dt.timedelta(hours=1), 4, "closing")]
    schema = "user_id int, ts timestamp_ntz, event_id int, text string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    out = session_stream.conversation_sessions_stream(stream, "user_id", "ts", "event_id", "text")
    session_stream.run_to_parquet(out, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = {(r.user_id, r.n_messages, r.text) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {(1, 2, "a\nb"), (2, 1, "c")}


def test_long_conversation_keeps_all_turns(spark):
    turns = spark.range(25).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.concat(F.lit("t"), "id").alias("text"))
    row = sessions.conversation_concat(turns).first()
    assert row.n_turns == 25
    assert row.text == "\n".join(f"t{i}" for i in range(25))


@pytest.fixture
def rocks(spark):
    with session_stream.rocks_state(spark):
        yield


def run_messages(spark, tmp_path, batches, gap, lateness):
    """The rows of a message stream that gets the given batches one after the other, and its state rows after each."""
    schema = "user string, ts timestamp, event long, text string"
    source, out = tmp_path / "in", str(tmp_path / "out")
    states = []
    for number, batch in enumerate(batches):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(schema).parquet(str(source))
        placed = session_stream.session_messages_stream(stream, "user", "ts", "event", "text", gap, lateness)
        query = session_stream.run_to_parquet(placed, out, str(tmp_path / "cp"))
        query.awaitTermination()
        states.append(max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress[-1:]))
    return spark.read.parquet(out).collect(), states


def test_message_stream_equals_the_batch(spark, tmp_path, rocks):
    rng = random.Random(12)
    at = lambda s: START + dt.timedelta(seconds=s)
    events = [(rng.choice("abc"), at(rng.randrange(0, 4000) + i * 600 // 200 * 20), i, f"t{i}") for i in range(150)]
    events.sort(key=lambda e: e[1])
    # Each batch is shuffled inside; nothing comes later than the lateness.
    batches = [rng.sample(events[i:i + 50], 50) for i in (0, 50, 100)]
    batches[1] += [(None, at(1), 500, "nobody"), ("a", None, 501, "never")]
    batches.append([("z", at(10**6), 502, "last")])
    rows, _ = run_messages(spark, tmp_path, batches, 60, "2 hours")
    frame = spark.createDataFrame(events, "user string, ts timestamp, event long, text string")
    expected = {(r.user, r.text, r.session_start, r.position)
                for r in sessions.session_messages(frame, "user", "ts", "event", "text", 60).collect()}
    assert {(r.user, r.text, r.session_start, r.position) for r in rows if r.reason is None} == expected
    assert {(r.text, r.reason) for r in rows if r.reason} == {("nobody", "user"), ("never", "ts")}


def test_message_stream_orders_equal_messages_without_text(spark, tmp_path, rocks):
    """The same time and number twice, once without text; what waits beside it comes in order."""
    at = lambda s: START + dt.timedelta(seconds=s)
    batch = [("a", at(5), 1, "x"), ("a", at(5), 1, None), ("a", at(9), 2, None), ("a", at(4), 3, "first"), ("b", at(5), 4, "other")]
    rows, _ = run_messages(spark, tmp_path, [batch, [("z", at(10**6), 502, "last")]], 60, "10 seconds")
    placed = sorted((r.user, r.position, r.text) for r in rows)
    assert placed == [("a", 1, "first"), ("a", 2, None), ("a", 3, "x"), ("a", 4, None), ("b", 1, "other")]
    assert {r.session_start for r in rows if r.user == "a"} == {at(4)}


def test_endless_session_keeps_constant_state(spark, tmp_path, rocks):
    at = lambda s: START + dt.timedelta(seconds=s)
    batches = [[("a", at(100 * b + i), 100 * b + i, "m") for i in range(100)] for b in range(4)] + [[("a", at(5), 1000, "late"), ("a", at(400), 400, "m")]]
    rows, states = run_messages(spark, tmp_path, batches, 15, "10 seconds")
    placed = [r for r in rows if r.reason is None]
    assert sorted(r.position for r in placed) == list(range(1, len(placed) + 1)) and len(placed) > 380
    assert len({r.session_start for r in placed}) == 1
    assert [(r.text, r.reason) for r in rows if r.reason] == [("late", "late")]
    assert max(states) == min(states[:-1]) and max(states) < 20
