"""Star schema, its checks and reports, and conversations."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from carelake.operators import quality, sessions
from carelake.plans import gold
from carelake.sources import tables
from verification.prelude import SALT, with_tables
from verification.queries_models import stg_billing
from verification.registry import query, shown


def interactions(spark, d):
    return tables.interactions_source(spark, d)


def patients(spark, d):
    return gold.dim_patients(interactions(spark, d), SALT)


def services(spark, d):
    return gold.dim_services(tables.services_source(spark, d))


def dates(spark, d):
    return gold.dim_date(interactions(spark, d), "created_at")


def fact(spark, d):
    return gold.fact_interactions(
        interactions(spark, d), tables.services_source(spark, d), services(spark, d), stg_billing(spark, d), SALT
    )


query("dim_patients", with_tables("dim_patients") + shown("dim_patients", {
    "patient_key": "t", "intent_segment": "t", "fear_segment": "t", "first_contact": "t", "last_contact": "t",
    "total_visits": "i"}))(patients)
query("dim_services", with_tables("dim_services") + shown("dim_services", {
    "service_key": "i", "service_name": "t", "category": "t", "avg_price_brl": "d"}))(services)
query("dim_date", with_tables("dim_date") + shown("dim_date", {
    "date_key": "t", "year": "i", "month": "i", "quarter": "i", "day_of_week": "i", "is_weekend": "i"}))(dates)
query("fact_interactions", with_tables("fact_interactions") + shown("fact_interactions", {
    "interaction_id": "t", "patient_key": "t", "service_key": "i", "date_key": "t", "estimated_potential": "d",
    "ai_intent": "t", "visit_count": "i", "valor_pago": "d", "ltv_acumulado": "d", "created_at": "ts"}))(fact)


@query("join_inner_fact_dim", with_tables("fact_interactions", "dim_patients") + """
select interaction_id, patient_key, fear_segment, intent_segment, cast(valor_pago as double) as valor_pago
from fact_interactions join dim_patients using (patient_key)""")
def join_inner_fact_dim(spark, d):
    return gold.join_fact_patients(fact(spark, d), patients(spark, d)).select(
        "interaction_id", "patient_key", "fear_segment", "intent_segment", "valor_pago"
    )


@query("fk_orphans", with_tables("fact_interactions", "dim_services", "dim_patients", "stg_recebimentos") + """
select 'service_key' as foreign_key, cast(service_key as varchar) as value, count(*) as n_records
from fact_interactions where service_key is not null and service_key not in (select service_key from dim_services)
group by service_key
union all
select 'contato_hash', contato_hash, count(*) from stg_recebimentos
where contato_hash not in (select patient_key from dim_patients) group by contato_hash""")
def fk_orphans(spark, d):
    """Fact rows against their services, billing rows against the patients."""
    by_service = quality.fk_orphans(fact(spark, d), "service_key", services(spark, d), "service_key")
    by_patient = quality.fk_orphans(stg_billing(spark, d), "contato_hash", patients(spark, d), "patient_key")
    return (
        by_service.select(F.lit("service_key").alias("foreign_key"), F.col("value").cast("string").alias("value"), "n_records")
        .union(by_patient.select(F.lit("contato_hash"), "value", "n_records"))
    )


@query("pk_check", with_tables("fact_interactions", "dim_patients", "dim_services", "dim_date") + """
select 'dim_patients' as table_name, count(*) - count(distinct patient_key) as repeated from dim_patients
union all select 'dim_services', count(*) - count(distinct service_key) from dim_services
union all select 'dim_date', count(*) - count(distinct date_key) from dim_date
union all select 'fact_interactions', count(*) - count(distinct interaction_id) from fact_interactions""")
def pk_check(spark, d):
    return quality.repeated_keys({
        "dim_patients": (patients(spark, d), "patient_key"),
        "dim_services": (services(spark, d), "service_key"),
        "dim_date": (dates(spark, d), "date_key"),
        "fact_interactions": (fact(spark, d), "interaction_id"),
    })


_BY_INTENT = """
select ai_intent, count(*) as total_interactions, cast(sum(estimated_potential) as double) as total_potential_brl,
       cast(sum(valor_pago) as double) as total_revenue_brl,
       round(sum(ltv_acumulado)::double / count(*) * 100) / 100 as avg_ltv_brl,
       round(sum(valor_pago)::double / nullif(sum(estimated_potential)::double, 0) * 100 * 10) / 10 as conversion_rate_pct
from fact_interactions group by ai_intent"""


@query("vw_pipeline_by_intent", with_tables("fact_interactions") + _BY_INTENT)
def vw_pipeline_by_intent(spark, d):
    return gold.vw_pipeline_by_intent(fact(spark, d))


@query("order_desc_gold", with_tables("fact_interactions") + f"""
select ai_intent, row_number() over (order by total_potential_brl desc nulls first) as place from ({_BY_INTENT})""")
def order_desc_gold(spark, d):
    """The place of each row; there are as many rows as intents in the contract."""
    best_first = Window.orderBy(F.desc_nulls_first("total_potential_brl"))
    return gold.vw_pipeline_by_intent(fact(spark, d)).select(
        "ai_intent", F.row_number().over(best_first).alias("place")
    )


@query("opt_conversion_by_intent", with_tables("fact_interactions")
       + f"select ai_intent, conversion_rate_pct from ({_BY_INTENT})")
def opt_conversion_by_intent(spark, d):
    return gold.vw_pipeline_by_intent(fact(spark, d)).select("ai_intent", "conversion_rate_pct")


@query("vw_fear_vs_conversion", with_tables("fact_interactions", "dim_patients") + """
select fear_segment, count(interaction_id) as total_patients,
       round(sum(estimated_potential)::double / count(estimated_potential) * 100) / 100 as avg_potential,
       round(sum(valor_pago)::double / count(valor_pago) * 100) / 100 as avg_revenue,
       round((sum(valor_pago)::double / count(valor_pago))
             / nullif(sum(estimated_potential)::double / count(estimated_potential), 0) * 100 * 10) / 10 as conversion_pct
from fact_interactions join dim_patients using (patient_key) group by fear_segment""")
def vw_fear_vs_conversion(spark, d):
    return gold.vw_fear_vs_conversion(fact(spark, d), patients(spark, d))


@query("opt_monthly_complaints", with_tables("fact_interactions") + """
select cast(cast(date_trunc('month', date_key) as date) as varchar) as month, count(*) as complaints
from fact_interactions where ai_intent = 'Complaint' group by 1""")
def opt_monthly_complaints(spark, d):
    return gold.complaints_by_month(fact(spark, d))


# -- conversations ------------------------------------------------------------


def sessions_sql(gap_seconds: int) -> str:
    return with_tables("messages") + f""", flagged as (
    select *, case when ts - lag(ts) over (partition by user_id order by ts) <= interval {gap_seconds} second
                   then 0 else 1 end as opens from messages),
numbered as (select *, sum(opens) over (partition by user_id order by ts range unbounded preceding) as session from flagged),
started as (select *, min(ts) over (partition by user_id, session) as session_start from numbered)
select user_id, strftime(session_start, '%Y-%m-%d %H:%M:%S.%f') as session_start, count(*) as n_messages, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') as first_message,
       strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') as last_message,
       string_agg(text, chr(10) order by ts, event_id) as text
from started group by user_id, session_start"""


def _sessions(spark, d, gap):
    messages = tables.chat_messages(spark, d)
    return sessions.conversation_sessions(messages, "user_id", "ts", "event_id", "text", gap)


@query("conversation_sessions", sessions_sql(15))
def conversation_sessions(spark, d):
    return _sessions(spark, d, 15)


@query("conversation_sessions_hour_gap", sessions_sql(3600))
def conversation_sessions_hour_gap(spark, d):
    return _sessions(spark, d, 3600)


@query("conversation_concat", """
select conv_id, count(*) as n_turns, string_agg(text, chr(10) order by turn, text) as text
from conversations group by conv_id""")
def conversation_concat(spark, d):
    return sessions.conversation_concat(tables.table(spark, d, "conversations"))
