"""Privacy, contracts, phone matching, merging and data quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from carelake.functions import privacy, text
from carelake.operators import contacts as crm, contracts, quality
from carelake.plans import intake, marts, publish, staging
from carelake.session import scratch_path, stored
from carelake.sources import jdbc, tables, written
from verification.prelude import with_tables
from verification.queries_models import RUN_DATE, contacts_raw, stg_billing, stg_contacts
from verification.registry import query

# -- redaction ---------------------------------------------------------------


def _scrub_sql(column: str) -> str:
    """Nested replacements in pattern order; case folding becomes an option."""
    sql = column
    for _, pattern, tag in privacy.PII_PATTERNS:
        options = "gi" if pattern.startswith("(?i)") else "g"
        sql = f"regexp_replace({sql}, '{pattern.removeprefix('(?i)')}', '{tag}', '{options}')"
    return sql


SCRUBBED_SQL = f"select doc_id, lang, {_scrub_sql('text')} as scrubbed from documents"


def scrubbed(spark, d) -> DataFrame:
    documents = tables.table(spark, d, "documents")
    return documents.select("doc_id", "lang", privacy.scrub_pii(F.col("text")).alias("scrubbed"))


query("scrub_pii", SCRUBBED_SQL)(scrubbed)


@query("src_jdbc_contacts", with_tables("contacts") + f"""
select id, c_status_atendimento, cast(c_lifetime_value as double) as c_lifetime_value, c_lifetime_value_currency,
       cast(c_potencial_venda as double) as c_potencial_venda, c_potencial_venda_currency,
       cast(c_qtd_consultas as bigint) as c_qtd_consultas, cast(c_ultima_visita as varchar) as c_ultima_visita,
       {_scrub_sql('c_aisummary')} as c_aisummary,
       strftime(created_at, '%Y-%m-%d %H:%M:%S.%f') as created_at,
       strftime(modified_at, '%Y-%m-%d %H:%M:%S.%f') as modified_at from contacts""")
def src_jdbc_contacts(spark, d):
    return jdbc.export_contacts(tables.contact_source(spark, d))


@query("pii_redaction_counts", "with s as (" + SCRUBBED_SQL + """)
select lang, tag, sum(len(regexp_extract_all(scrubbed, '\\[' || tag || '_REDACTED\\]'))) :: bigint as redactions,
       count(*) filter (contains(scrubbed, '[' || tag || '_REDACTED]')) as documents
from s cross join (select unnest(['PIX', 'CARD', 'PHONE', 'CPF', 'RG', 'EMAIL', 'ACCOUNT']) as tag)
group by lang, tag""")
def pii_redaction_counts(spark, d):
    counts = [privacy.redaction_count(F.col("scrubbed"), tag).alias(tag) for tag in privacy.PII_TAGS]
    per_document = scrubbed(spark, d).select("lang", *counts)
    totals = [f(F.col(t)).alias(f"{t}_{n}") for t in privacy.PII_TAGS for n, f in (("sum", F.sum), ("docs", lambda c: F.count_if(c > 0)))]
    per_language = per_document.groupBy("lang").agg(*totals)
    rows = F.array(*[
        F.struct(F.lit(t).alias("tag"), F.col(f"{t}_sum").alias("redactions"), F.col(f"{t}_docs").alias("documents"))
        for t in privacy.PII_TAGS
    ])
    return per_language.select("lang", F.inline(rows))


@query("pii_leak_check", "with s as (" + SCRUBBED_SQL + r""")
select lang, count(*) as documents,
       count(*) filter (regexp_matches(scrubbed, '\d{3}\.\d{3}\.\d{3}-\d{2}|\+?\d{10,13}')) as leaks from s group by lang""")
def pii_leak_check(spark, d):
    leaking = F.coalesce(privacy.has_leak(F.col("scrubbed")), F.lit(False))
    return scrubbed(spark, d).groupBy("lang").agg(F.count("*").alias("documents"), F.count_if(leaking).alias("leaks"))


@query("mask_pii_crm", r"""
select doc_id, regexp_replace(regexp_replace(text, '\d{3}\.\d{3}\.\d{3}-\d{2}', '***.***.***-**', 'g'),
       '\d{2}\.\d{3}\.\d{3}/\d{4}-\d{2}', '**.***.***/****-**', 'g') as masked from documents""")
def mask_pii_crm(spark, d):
    return tables.table(spark, d, "documents").select("doc_id", privacy.mask_pii(F.col("text")).alias("masked"))


@query("mask_phone_for_logs", with_tables("messages") + "select event_id, right(phone, 4) as shown from messages")
def mask_phone_for_logs(spark, d):
    return tables.chat_messages(spark, d).select("event_id", privacy.mask_phone_for_logs(F.col("phone")).alias("shown"))


# Bounds of the pictograph ranges, as in the expression under test.
_EMOJI_SQL = r"[\x{1F000}-\x{1FAFF}\x{2600}-\x{27BF}\x{2B00}-\x{2BFF}\x{2300}-\x{23FF}\x{FE0F}\x{200D}\x{20E3}]"


@query("opt_strip_emoji", f"""
select doc_id, regexp_replace('🦷 ' || text || ' ✨', '{_EMOJI_SQL}', '', 'g') as plain from documents""")
def opt_strip_emoji(spark, d):
    decorated = F.concat(F.lit("🦷 "), F.col("text"), F.lit(" ✨"))
    return tables.table(spark, d, "documents").select("doc_id", text.strip_emoji(decorated).alias("plain"))


# -- contracts ---------------------------------------------------------------


def checked(spark, d) -> DataFrame:
    return contracts.check_summaries(tables.summary_json(spark, d), "summary_json")


def valid_summaries(spark, d) -> DataFrame:
    return contracts.valid(checked(spark, d))


@query("contract_summary", with_tables("checked") + """
select event_id, violations,
       case when violations = '' then cliente end as cliente, case when violations = '' then intencao end as intencao,
       case when violations = '' then solicitacao end as solicitacao, case when violations = '' then obs end as obs,
       case when violations = '' then fobias_alergias end as fobias_alergias,
       case when violations = '' then ltv_pago end as ltv_pago, case when violations = '' then potencial end as potencial,
       case when violations = '' then qtd_consultas end :: bigint as qtd_consultas,
       case when violations = '' then historico end as historico
from checked""")
def contract_summary(spark, d):
    fine = F.col("violations") == ""
    return checked(spark, d).select(
        "event_id",
        "violations",
        *[F.when(fine, F.col("summary")[name]).alias(name) for name in contracts.SUMMARY_FIELDS],
    )


@query("contract_payload", """
with p as (
    select conv_id, turn, case when role <> 'system' then '+55 81 9' || lpad(cast(conv_id as varchar), 8, '0') end as phone,
           role as patient_name, case when role = 'user' then text end as message_text,
           case when role = 'assistant' then text end as audio_transcription from conversations)
select conv_id, turn, phone, patient_name,
       case when regexp_matches(message_text, '[^\\s]') then message_text end as message_text,
       case when regexp_matches(audio_transcription, '[^\\s]') then audio_transcription end as audio_transcription,
       concat_ws(',', case when phone is null then 'phone' end,
                 case when not coalesce(regexp_matches(coalesce(audio_transcription, message_text), '[^\\s]'), false)
                      then 'message' end) as violations
from p""")
def contract_payload(spark, d):
    result = contracts.check_payloads(tables.payload_json(spark, d), "payload")
    return result.select("conv_id", "turn", "record.*", "violations")


_TURNS_SQL = """
with m as (select conv_id, turn, case when role = 'user' then text when role = 'assistant' then ' ' || chr(9) end as message_text,
                  case when role = 'assistant' then text when role = 'user' then '' end as audio from conversations),
chosen as (select conv_id, turn, coalesce(case when regexp_matches(audio, '[^\\s]') then audio end,
                  case when regexp_matches(message_text, '[^\\s]') then message_text end) as message from m)
"""


def _turns(spark, d) -> DataFrame:
    role, words = F.col("role"), F.col("text")
    return tables.table(spark, d, "conversations").select(
        "conv_id", "turn",
        F.when(role == "user", words).when(role == "assistant", F.lit(" \t")).alias("message_text"),
        F.when(role == "assistant", words).when(role == "user", F.lit("")).alias("audio"),
    )


@query("coalesce_message", _TURNS_SQL + "select * from chosen")
def coalesce_message(spark, d):
    return _turns(spark, d).select(
        "conv_id", "turn", text.chosen_message(F.col("audio"), F.col("message_text")).alias("message")
    )


@query("reject_empty_message", _TURNS_SQL + """
select conv_id, turn, message, case when message is null then 'message' end as reason from chosen""")
def reject_empty_message(spark, d):
    accepted, rejected = contracts.reject_empty(_turns(spark, d), "audio", "message_text")
    return accepted.withColumn("reason", F.lit(None).cast("string")).unionByName(rejected).select(
        "conv_id", "turn", "message", "reason"
    )


@query("fmt_crm_summary", with_tables("crm_notes") + "select * from crm_notes")
def fmt_crm_summary(spark, d):
    return valid_summaries(spark, d).select("event_id", text.crm_summary(F.col("summary")).alias("note"))


@query("fmt_money_display", """
select o_orderkey, '🚀 Potential: R$ ' || replace(replace(replace(
       format('{:,.2f}', o_totalprice), ',', 'X'), '.', ','), 'X', '.') as shown from orders""")
def fmt_money_display(spark, d):
    return tables.table(spark, d, "orders").select("o_orderkey", text.money_display(F.col("o_totalprice")).alias("shown"))


@query("fmt_visits_display", with_tables("contact_source")
       + "select id, '🏥 Visits: ' || coalesce(c_qtd_consultas, 0) as shown from contact_source")
def fmt_visits_display(spark, d):
    return tables.contact_source(spark, d).select(
        "id", text.visits_display(F.coalesce("c_qtd_consultas", F.lit(0))).alias("shown")
    )


@query("clean_phone", with_tables("messages", "contact_source") + """
select phone, trim(replace(replace(phone, '+', ''), ' ', '')) as clean, count(*) as uses from (
    select phone from messages union all select phone_number from contact_source) group by all""")
def clean_phone(spark, d):
    phones = tables.chat_messages(spark, d).select("phone").union(tables.contact_source(spark, d).select("phone_number"))
    return phones.groupBy("phone").agg(F.count("*").alias("uses")).withColumn("clean", text.clean_phone(F.col("phone")))


@query("merge_name_rule", """
select c_custkey, case when c_nationkey = 0 then 'Patient' else split_part(name, ' ', 1) end as first_name,
       case when c_nationkey = 0 then '.' when name like '% %' then substr(name, instr(name, ' ') + 1) else '.' end as last_name
from (select *, case when c_nationkey = 0 then 'Not identified' when c_nationkey = 1 then c_name
             else c_name || ' ' || c_mktsegment || ' ' || c_nationkey end as name from customer)""")
def merge_name_rule(spark, d):
    nation = F.col("c_nationkey")
    name = (
        F.when(nation == 0, F.lit(text.UNIDENTIFIED))
        .when(nation == 1, F.col("c_name"))
        .otherwise(F.concat_ws(" ", "c_name", "c_mktsegment", nation.cast("string")))
    )
    named = tables.table(spark, d, "customer").select("c_custkey", name.alias("name"))
    return named.select(
        "c_custkey",
        F.coalesce(text.first_name(F.col("name")), F.lit(text.DEFAULT_FIRST_NAME)).alias("first_name"),
        F.coalesce(text.last_name(F.col("name")), F.lit(text.DEFAULT_LAST_NAME)).alias("last_name"),
    )


# -- phone matching and merge -----------------------------------------------


def live_contacts(spark, d) -> DataFrame:
    return jdbc.live_rows(tables.contact_source(spark, d)).drop("deleted")


@query("match_phone_contains", with_tables("phones", "contacts") + """
select p.clean, (select min(c.id) from contacts c where contains(c.phone_number, p.clean)) as contact_id from phones p""")
def match_phone_contains(spark, d):
    return crm.match_by_contained_phone(tables.chat_messages(spark, d), live_contacts(spark, d))


@query("match_phone_equi", with_tables("phones", "contacts") + """
select p.clean, (select min(c.id) from contacts c
                 where replace(replace(c.phone_number, '+', ''), ' ', '') = p.clean) as contact_id from phones p""")
def match_phone_equi(spark, d):
    return crm.match_by_equal_phone(tables.chat_messages(spark, d), live_contacts(spark, d))


_MERGE_NEEDS = ("contacts", "contact_matches", "crm_notes", "valid_summaries")
_MERGE_SQL = """
, keyed as (
    select v.*, n.note, coalesce(m.contact_id, 'new:' || v.clean) as target
    from valid_summaries v join crm_notes n using (event_id) join contact_matches m on m.clean = v.clean),
ranked as (
    select *, row_number() over (partition by target order by ts desc, event_id desc) as newest,
           row_number() over (partition by target order by ts, event_id) as oldest from keyed),
named as (
    select target,
           max(case when cliente <> 'Not identified' then (ts, event_id, split_part(cliente, ' ', 1)) end) as f,
           max(case when cliente like '% %' and cliente <> 'Not identified'
                    then (ts, event_id, substr(cliente, instr(cliente, ' ') + 1)) end) as l
    from keyed group by target),
changes as (
    select r.target, f[3] as first_name, l[3] as last_name, r.note, r.potencial, r.qtd_consultas, o.phone
    from ranked r join named using (target) join ranked o on o.target = r.target and o.oldest = 1 where r.newest = 1)
select coalesce(c.id, left(sha256(ch.target), 17)) as id,
       coalesce(ch.first_name, case when c.id is null then 'Patient' else c.first_name end) as first_name,
       coalesce(ch.last_name, case when c.id is null then '.' end) as last_name,
       case when c.id is null then ch.phone else c.phone_number end as phone_number,
       case when c.id is null then 'Novo Lead' else c.c_status_atendimento end as c_status_atendimento,
       cast(c.c_lifetime_value as double) as c_lifetime_value,
       case when ch.target is null then c.c_aisummary else ch.note end as c_aisummary,
       cast(case when ch.target is null then c.c_potencial_venda else cast(ch.potencial as decimal(13,4)) end as double)
           as c_potencial_venda,
       case when ch.target is null then c.c_potencial_venda_currency else 'BRL' end as c_potencial_venda_currency,
       cast(case when ch.target is null then c.c_qtd_consultas else ch.qtd_consultas end as bigint) as c_qtd_consultas,
       case when c.id is null then 'inserted' when ch.target is null then 'unchanged' else 'updated' end as merge_action
from contacts c full outer join changes ch on c.id = ch.target"""
MERGED_SQL = with_tables(*_MERGE_NEEDS) + _MERGE_SQL
MERGED_COLUMNS = (
    "id", "first_name", "last_name", "phone_number", "c_status_atendimento", "c_lifetime_value", "c_aisummary",
    "c_potencial_venda", "c_potencial_venda_currency", "c_qtd_consultas", "merge_action",
)


@query("merge_contacts", MERGED_SQL)
def merge_contacts(spark, d):
    return crm.upsert_contacts(live_contacts(spark, d), valid_summaries(spark, d)).select(*MERGED_COLUMNS)


# -- from payloads to contacts ---------------------------------------------------

_ANSWERED = {
    "phones": "select distinct clean from valid_summaries",
    "summary_json": """
        select conv_id * 1000 + turn as event_id, '+55 81 9' || lpad(cast(conv_id as varchar), 8, '0') as phone,
               timestamp '2024-01-01' + to_seconds(conv_id * 1000 + turn) as ts,
               '{"cliente": "' || role || ' ' || length(text) || '", "intencao": "' || case length(text) % 4 when 0 then 'Inquiry'
               when 1 then 'Scheduling' when 2 then 'Complaint' else 'Sale' end || '", "potencial": ' || length(text)
               || ', "qtd_consultas": ' || length(text) % 20 || '}' as summary_json
        from conversations where role <> 'system' and regexp_matches(text, '[^\\s]')""",
}


def _payloads(spark, d) -> DataFrame:
    rows = tables.payload_json(spark, d).withColumn("event_id", F.col("conv_id") * 1000 + F.col("turn"))
    return rows.withColumn("ts", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, event_id)"))


def _answer(messages: DataFrame) -> DataFrame:
    """Stands for the model: a summary from the length of the message; every fourth breaks the contract."""
    size = F.length("message")
    intent = F.element_at(F.array(*map(F.lit, ("Inquiry", "Scheduling", "Complaint", "Sale"))), size % 4 + 1)
    return messages.withColumn("summary_json", F.concat(
        F.lit('{"cliente": "'), "patient_name", F.lit(" "), size.cast("string"), F.lit('", "intencao": "'), intent, F.lit('", "potencial": '),
        size.cast("string"), F.lit(', "qtd_consultas": '), (size % 20).cast("string"), F.lit("}")))


@query("intake_contacts", with_tables(*_MERGE_NEEDS, replaced=_ANSWERED) + _MERGE_SQL)
def intake_contacts(spark, d):
    """Webhook payloads checked, summarised, checked again and merged into the contacts."""
    return intake.take_in(_payloads(spark, d), live_contacts(spark, d), _answer).contacts.select(*MERGED_COLUMNS)


@query("intake_quarantine", with_tables("checked", replaced=_ANSWERED) + """
select event_id, 'summary' as stage, violations as reason from checked where violations <> ''
union all select conv_id * 1000 + turn, 'payload', concat_ws(',', case when role = 'system' then 'phone' end,
    case when role not in ('user', 'assistant') or not coalesce(regexp_matches(text, '[^\\s]'), false) then 'message' end)
from conversations where role not in ('user', 'assistant') or not coalesce(regexp_matches(text, '[^\\s]'), false)""")
def intake_quarantine(spark, d):
    return intake.take_in(_payloads(spark, d), live_contacts(spark, d), _answer).quarantine


# -- data quality --------------------------------------------------------------


@query("dq_not_null", with_tables("stg_contacts") + """
select column_name, cast(count(*) filter (missing) as bigint) as failures from (
    select unnest(['contato_hash', 'status_atendimento', 'lifetime_value', 'potencial_venda', 'qtd_consultas']) as column_name,
           unnest([contato_hash is null, status_atendimento is null, lifetime_value is null, potencial_venda is null,
                   qtd_consultas is null]) as missing from stg_contacts) group by column_name""")
def dq_not_null(spark, d):
    return quality.null_counts(stg_contacts(spark, d), quality.DECLARED["stg_contacts"].not_null)


@query("dq_unique", with_tables("stg_recebimentos") + """
select contato_hash as value, count(*) as n_records from stg_recebimentos group by 1 having count(*) > 1""")
def dq_unique(spark, d):
    return quality.duplicates(stg_billing(spark, d), "contato_hash")


@query("dq_accepted_values", with_tables("stg_contacts") + """
select status_atendimento as value, count(*) as n_records from stg_contacts
where status_atendimento not in ('finalizado', 'novo lead') group by 1""")
def dq_accepted_values(spark, d):
    return quality.unexpected_values(stg_contacts(spark, d), "status_atendimento", ("finalizado", "novo lead"))


def _report_sql() -> str:
    parts = []
    for name, wanted in quality.DECLARED.items():
        for column in wanted.not_null:
            parts.append(f"select '{name}' as table_name, '{column}' as column_name, 'not_null' as test, "
                         f"count(*) as failures from {name} where {column} is null")
        for column in wanted.unique:
            parts.append(f"select '{name}', '{column}', 'unique', count(*) from (select {column} from {name} "
                         f"where {column} is not null group by 1 having count(*) > 1)")
        for column, values in wanted.accepted.items():
            listed = ", ".join(f"'{v}'" for v in values)
            parts.append(f"select '{name}', '{column}', 'accepted_values', count(distinct {column}) from {name} "
                         f"where {column} not in ({listed})")
    return with_tables(*quality.DECLARED) + "\nunion all ".join(parts)


@query("dq_report", _report_sql())
def dq_report(spark, d):
    """Six models over two staging relations, which are written once and then
    read back with only the columns each model needs."""
    billing = stored(stg_billing(spark, d), "stg_recebimentos")
    people = stored(stg_contacts(spark, d), "stg_contacts")
    return quality.report({
        "stg_recebimentos": billing,
        "stg_contacts": people,
        "stg_ai_summaries": staging.stg_ai_summaries(people),
        "fct_ltv": marts.fct_ltv(billing, RUN_DATE),
        "fct_pipeline": marts.fct_pipeline(people, billing, RUN_DATE),
        "fct_ai_performance": marts.fct_ai_performance(people),
    })


@query("materialize_view", with_tables("stg_contacts") + """
select status_atendimento, count(*) as contacts from stg_contacts group by status_atendimento""")
def materialize_view(spark, d):
    name = written.materialize_view(stg_contacts(spark, d), "stg_contacts")
    return spark.sql(f"select status_atendimento, count(*) as contacts from {name} group by status_atendimento")


def _declared_models(tolerated: frozenset = frozenset()) -> list[publish.Model]:
    """The six models with their references and declared checks, listed out of order."""
    def model(name, build, *refs):
        return publish.Model(name, build, refs, quality.DECLARED[name], tolerated)

    return [
        model("fct_ai_performance", marts.fct_ai_performance, "stg_contacts"),
        model("fct_pipeline", lambda people, billing: marts.fct_pipeline(people, billing, RUN_DATE), "stg_contacts", "stg_recebimentos"),
        model("fct_ltv", lambda billing: marts.fct_ltv(billing, RUN_DATE), "stg_recebimentos"),
        model("stg_ai_summaries", staging.stg_ai_summaries, "stg_contacts"),
        model("stg_contacts", lambda rows: rows, "contacts"),
        model("stg_recebimentos", lambda rows: rows, "billing"),
    ]


# Checks that the given tables are known to break.
KNOWN = frozenset({("status_atendimento", "not_null"), ("qtd_consultas", "not_null")})


@query("ref_dependency_order", with_tables(*quality.DECLARED) + "\nunion all ".join(
    f"select '{name}' as model, count(*) as n_rows from {name}" for name in quality.DECLARED))
def ref_dependency_order(spark, d):
    """All models built in the order of their references and published; the rows counted as they were written."""
    root = scratch_path(spark, "models")
    publish.create(spark, root)
    run = publish.run_models(_declared_models(KNOWN), {"contacts": stg_contacts(spark, d), "billing": stg_billing(spark, d)}, root)
    return publish.audits(spark, root, [run]).select("model", "n_rows").distinct()


@query("publish_checked", f"""with report as ({_report_sql()}),
counts as ({with_tables(*quality.DECLARED)} {"""
union all """.join(f"select '{name}' as model, count(*) as n_rows from {name}" for name in quality.DECLARED)})
select 'first' as run, table_name as model, n_rows, column_name, test, failures from report join counts on model = table_name
union all select 'second', table_name, n_rows, column_name, test, failures from report join counts on model = table_name where table_name = 'stg_contacts'
union all select 'published', 'fct_pipeline', n_rows, null, null, null from counts where model = 'fct_pipeline'""")
def publish_checked(spark, d):
    """A run that passes but for known faults, and one that must not be published; readers still see the first."""
    root = scratch_path(spark, "checked-models")
    publish.create(spark, root)
    sources = {"contacts": stg_contacts(spark, d), "billing": stg_billing(spark, d)}
    publish.run_models(_declared_models(KNOWN), sources, root, "first")
    try:
        publish.run_models(_declared_models(), sources, root, "second")
    except publish.ChecksFailed:
        pass
    shown = publish.read_model(spark, root, "fct_pipeline").agg(
        F.lit("published").alias("run"), F.lit("fct_pipeline").alias("model"), F.count("*").alias("n_rows"),
        *[F.lit(None).cast(kind).alias(name) for name, kind in (("column_name", "string"), ("test", "string"), ("failures", "bigint"))])
    return publish.audits(spark, root, ["first", "second"]).drop("tolerated").unionByName(shown)


@query("params", with_tables("contacts") + """
select id, sha256(id || 'another-salt') as contato_hash, cast(date '2026-02-28' - c_ultima_visita as bigint) as days from contacts""")
def params(spark, d):
    """Salt and run date are arguments: the same model under other parameters."""
    import datetime as dt

    return contacts_raw(spark, d).select(
        "id",
        privacy.hash_id_salted(F.col("id"), "another-salt").alias("contato_hash"),
        marts.days_since(F.col("c_ultima_visita"), dt.date(2026, 2, 28)).alias("days"),
    )
