"""Staging, marts and features over the derived source tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from carelake.functions.privacy import hash_id_salted, hash_id_unsalted
from carelake.plans import marts, staging
from carelake.sources import jdbc, tables, written
from verification.prelude import AS_OF, SALT, with_tables
from verification.registry import query, shown

RUN_DATE = dt.date.fromisoformat(AS_OF)

BILLING_COLUMNS = {"id": "t", "contato_id": "t", "valor": "d", "valor_currency": "t", "data_recebimento": "t",
                   "status": "t", "created_at": "ts", "modified_at": "ts"}
CONTACT_COLUMNS = {"id": "t", "c_status_atendimento": "t", "c_lifetime_value": "d", "c_lifetime_value_currency": "t",
                   "c_potencial_venda": "d", "c_potencial_venda_currency": "t", "c_qtd_consultas": "i",
                   "c_ultima_visita": "t", "c_aisummary": "t", "created_at": "ts", "modified_at": "ts"}
STG_BILLING_COLUMNS = {"contato_hash": "t", "valor": "d", "moeda": "t", "data_recebimento": "t", "status": "t",
                       "created_at": "t", "modified_at": "t"}
STG_CONTACT_COLUMNS = {"contato_hash": "t", "status_atendimento": "t", "lifetime_value": "d",
                       "lifetime_value_moeda": "t", "potencial_venda": "d", "potencial_venda_moeda": "t",
                       "qtd_consultas": "i", "ultima_visita": "t", "ai_summary": "t", "created_at": "t",
                       "modified_at": "t"}
STG_SUMMARY_COLUMNS = {"contato_hash": "t", "ai_summary": "t", "summary_quality": "t", "summary_length": "i",
                       "created_at": "t", "modified_at": "t"}
LTV_COLUMNS = {"contato_hash": "t", "ltv_acumulado": "d", "ticket_medio": "d", "maior_pagamento": "d",
               "frequencia_visitas": "i", "primeira_visita": "t", "ultima_visita": "t",
               "dias_desde_ultima_visita": "i"}
PIPELINE_COLUMNS = {"contato_hash": "t", "status_atendimento": "t", "lifetime_value": "d",
                    "lifetime_value_moeda": "t", "potencial_venda": "d", "potencial_venda_moeda": "t",
                    "total_pago_recebimentos": "d", "total_pagamentos": "i", "qtd_consultas": "i",
                    "ultima_visita": "t", "primeiro_pagamento": "t", "ultimo_pagamento": "t",
                    "dias_desde_ultima_visita": "i", "pipeline_segment": "t", "created_at": "t", "modified_at": "t"}
PERFORMANCE_COLUMNS = {"summary_quality": "t", "total_contacts": "i", "avg_summary_length": "d", "total_ltv": "d",
                       "avg_ltv": "d", "total_potencial": "d", "avg_potencial": "d", "avg_consultas": "d",
                       "coverage_pct": "d"}


# -- bronze and staging inputs ---------------------------------------------


def billing(spark: SparkSession, d: str) -> DataFrame:
    return jdbc.export_billing(tables.billing_source(spark, d))


def contacts_raw(spark: SparkSession, d: str) -> DataFrame:
    """Live contacts with the free text as it is (scrubbing has its own queries)."""
    live = jdbc.live_rows(tables.contact_source(spark, d))
    return jdbc.project_allowlist(live, list(CONTACT_COLUMNS))


def stg_billing(spark: SparkSession, d: str) -> DataFrame:
    return staging.stg_recebimentos(billing(spark, d), SALT)


def stg_contacts(spark: SparkSession, d: str) -> DataFrame:
    return staging.stg_contacts(contacts_raw(spark, d), SALT)


def stg_summaries(spark: SparkSession, d: str) -> DataFrame:
    return staging.stg_ai_summaries(stg_contacts(spark, d))


def pipeline(spark: SparkSession, d: str) -> DataFrame:
    return marts.fct_pipeline(stg_contacts(spark, d), stg_billing(spark, d), RUN_DATE)


# -- filters and projections -----------------------------------------------

query("src_jdbc_billing", with_tables("billing") + shown("billing", BILLING_COLUMNS))(billing)


@query("filter_soft_delete", with_tables("contact_source", "billing_source") + """
select 'contact' as source, count(*) as live_rows from contact_source where deleted = 0
union all select 'c_recebimento', count(*) from billing_source where deleted = 0""")
def filter_soft_delete(spark, d):
    sources = {"contact": tables.contact_source(spark, d), "c_recebimento": tables.billing_source(spark, d)}
    counts = [
        jdbc.live_rows(source).agg(F.lit(name).alias("source"), F.count("*").alias("live_rows"))
        for name, source in sources.items()
    ]
    return counts[0].union(counts[1])


query("project_privacy_allowlist", with_tables("contacts") + shown("contacts", CONTACT_COLUMNS))(contacts_raw)


@query("filter_valid_billing", with_tables("billing")
       + shown("billing", BILLING_COLUMNS) + " where valor > 0 and contato_id is not null")
def filter_valid_billing(spark, d):
    return staging.valid_billing(billing(spark, d))


@query("filter_nonnull_key", with_tables("contacts") + "select id, c_aisummary from contacts where id is not null")
def filter_nonnull_key(spark, d):
    return contacts_raw(spark, d).where(F.col("id").isNotNull()).select("id", "c_aisummary")


@query("filter_nonblank_summary", with_tables("contacts")
       + "select id, c_aisummary from contacts where c_aisummary is not null and length(trim(c_aisummary)) > 0")
def filter_nonblank_summary(spark, d):
    from carelake.functions.text import is_nonblank

    return contacts_raw(spark, d).where(is_nonblank(F.col("c_aisummary"))).select("id", "c_aisummary")


query("stg_recebimentos", with_tables("stg_recebimentos") + shown("stg_recebimentos", STG_BILLING_COLUMNS))(stg_billing)
query("stg_contacts", with_tables("stg_contacts") + shown("stg_contacts", STG_CONTACT_COLUMNS))(stg_contacts)
query("stg_ai_summaries", with_tables("stg_ai_summaries")
      + shown("stg_ai_summaries", STG_SUMMARY_COLUMNS))(stg_summaries)


@query("case_summary_quality", with_tables("stg_contacts") + """
select contato_hash, case when ai_summary is null then 'missing' when length(trim(ai_summary)) = 0 then 'empty'
       when length(ai_summary) < 50 then 'too_short' else 'ok' end as summary_quality from stg_contacts""")
def case_summary_quality(spark, d):
    from carelake.functions.text import summary_quality

    return stg_contacts(spark, d).select("contato_hash", summary_quality(F.col("ai_summary")).alias("summary_quality"))


@query("case_pipeline_segment", with_tables("fct_pipeline")
       + "select contato_hash, pipeline_segment from fct_pipeline")
def case_pipeline_segment(spark, d):
    return pipeline(spark, d).select("contato_hash", "pipeline_segment")


@query("case_recency_nullsafe", with_tables("stg_contacts") + f"""
select contato_hash, case when ultima_visita is not null then cast(date '{AS_OF}' - ultima_visita as bigint) end as days
from stg_contacts""")
def case_recency_nullsafe(spark, d):
    return stg_contacts(spark, d).select(
        "contato_hash", marts.days_since(F.col("ultima_visita"), RUN_DATE).alias("days")
    )


@query("project_rename", with_tables("contacts") + """
select id, c_aisummary as ai_summary, c_lifetime_value_currency as lifetime_value_moeda,
       c_potencial_venda_currency as potencial_venda_moeda from contacts""")
def project_rename(spark, d):
    return staging.renamed(contacts_raw(spark, d), staging.SUMMARY_NAMES, "id")


@query("drop_identifier", with_tables("billing")
       + "select id, sha256(contato_id) as contato_id_hash, cast(valor as double) as valor from billing")
def drop_identifier(spark, d):
    return staging.replace_identifier(billing(spark, d), "contato_id").select("id", "contato_id_hash", "valor")


@query("with_run_date", with_tables("billing") + f"select id, '{AS_OF}' as silver_dt from billing")
def with_run_date(spark, d):
    return billing(spark, d).select("id").withColumn("silver_dt", F.lit(AS_OF))


@query("hash_id_salted", with_tables("contact_source")
       + f"select id, sha256(id || '{SALT}') as contato_hash from contact_source")
def hash_salted(spark, d):
    return tables.contact_source(spark, d).select("id", hash_id_salted(F.col("id"), SALT).alias("contato_hash"))


@query("hash_id_unsalted", with_tables("billing_source")
       + "select id, sha256(contato_id) as contato_id_hash from billing_source")
def hash_unsalted(spark, d):
    return tables.billing_source(spark, d).select("id", hash_id_unsalted(F.col("contato_id")).alias("contato_id_hash"))


# -- joins and marts -------------------------------------------------------


@query("join_left_contacts_billing", with_tables("fct_pipeline") + shown("fct_pipeline", {
    "contato_hash": "t", "total_pago_recebimentos": "d", "total_pagamentos": "i",
    "primeiro_pagamento": "t", "ultimo_pagamento": "t"}))
def join_left_contacts_billing(spark, d):
    return marts.contacts_with_billing(stg_contacts(spark, d), stg_billing(spark, d)).select(
        "contato_hash", F.col("total_pago").alias("total_pago_recebimentos"), "total_pagamentos",
        "primeiro_pagamento", "ultimo_pagamento",
    )


@query("join_inner_summaries_contacts", with_tables("stg_ai_summaries") + """
select s.contato_hash, s.summary_quality, cast(s.summary_length as bigint) as summary_length,
       cast(c.lifetime_value as double) as lifetime_value, cast(c.potencial_venda as double) as potencial_venda,
       cast(c.qtd_consultas as bigint) as qtd_consultas
from stg_ai_summaries s inner join stg_contacts c on s.contato_hash = c.contato_hash""")
def join_inner_summaries_contacts(spark, d):
    summaries = stg_summaries(spark, d).select("contato_hash", "summary_quality", "summary_length")
    return marts.summaries_with_contacts(summaries, stg_contacts(spark, d))


@query("summaries_with_contact_totals", with_tables("stg_ai_summaries") + """
select s.contato_hash, s.summary_quality, s.summary_length, c.n_rows,
       cast(c.sum_ltv as double) as sum_ltv, c.n_ltv, cast(c.sum_pot as double) as sum_pot, c.n_pot,
       cast(c.sum_vis as bigint) as sum_vis, c.n_vis
from stg_ai_summaries s join (
    select contato_hash, count(*) as n_rows, sum(lifetime_value) as sum_ltv, count(lifetime_value) as n_ltv,
           sum(potencial_venda) as sum_pot, count(potencial_venda) as n_pot,
           sum(qtd_consultas) as sum_vis, count(qtd_consultas) as n_vis
    from stg_contacts group by contato_hash) c on s.contato_hash = c.contato_hash""")
def summaries_with_contact_totals(spark, d):
    summaries = stg_summaries(spark, d).select("contato_hash", "summary_quality", "summary_length")
    return marts.summaries_with_contact_totals(summaries, stg_contacts(spark, d))


@query("fct_ltv", with_tables("fct_ltv") + shown("fct_ltv", LTV_COLUMNS))
def fct_ltv(spark, d):
    return marts.fct_ltv(stg_billing(spark, d), RUN_DATE)


@query("billing_agg", with_tables("billing_agg") + shown("billing_agg", {
    "contato_hash": "t", "total_pago": "d", "total_pagamentos": "i", "primeiro_pagamento": "t",
    "ultimo_pagamento": "t"}))
def billing_agg(spark, d):
    return marts.billing_agg(stg_billing(spark, d))


query("fct_pipeline", with_tables("fct_pipeline") + shown("fct_pipeline", PIPELINE_COLUMNS))(pipeline)


@query("fct_ai_performance", with_tables("fct_ai_performance") + shown("fct_ai_performance", PERFORMANCE_COLUMNS))
def fct_ai_performance(spark, d):
    return marts.fct_ai_performance(stg_contacts(spark, d))


@query("agg_coverage_pct", with_tables("fct_ai_performance")
       + "select summary_quality, coverage_pct from fct_ai_performance")
def agg_coverage_pct(spark, d):
    return marts.fct_ai_performance(stg_contacts(spark, d)).select("summary_quality", "coverage_pct")


@query("count_rows", with_tables("billing_source") + """
select 'source' as stage, count(*) as n_rows from billing_source
union all select 'live', count(*) from billing_source where deleted = 0
union all select 'valid', count(*) from billing_source where deleted = 0 and valor > 0 and contato_id is not null""")
def count_rows(spark, d):
    """Counted while the rows pass, by one run of the plan."""
    counts = written.StageCounts()
    source = counts.passing(tables.billing_source(spark, d), "source")
    live = counts.passing(jdbc.live_rows(source), "live")
    valid = counts.passing(live.where((F.col("valor") > 0) & F.col("contato_id").isNotNull()), "valid")
    valid.write.format("noop").mode("overwrite").save()
    return counts.table(spark)


# -- windowed features ------------------------------------------------------

FEATURES_SQL = with_tables("billing") + f"""
select id, cast(valor as double) as valor, valor_currency, cast(data_recebimento as varchar) as data_recebimento, status,
       strftime(created_at, '%Y-%m-%d %H:%M:%S.%f') as created_at,
       strftime(modified_at, '%Y-%m-%d %H:%M:%S.%f') as modified_at,
       sha256(contato_id) as contato_id_hash,
       cast(sum(valor) over w as double) as ltv_acumulado, count(id) over w as frequencia_visitas,
       cast(max(data_recebimento) over w as varchar) as ultima_visita,
       cast(date '{AS_OF}' - max(data_recebimento) over w as bigint) as dias_desde_ultima, '{AS_OF}' as silver_dt
from billing window w as (partition by contato_id)"""


@query("silver_features", FEATURES_SQL)
def silver_features(spark, d):
    return marts.silver_features(billing(spark, d), RUN_DATE)


def _feature(name: str, column: str) -> None:
    @query(name, f"select id, {column} from ({FEATURES_SQL})")
    def one(spark, d):
        return marts.silver_features(billing(spark, d), RUN_DATE).select("id", column)


_feature("win_ltv_acumulado", "ltv_acumulado")
_feature("win_frequencia", "frequencia_visitas")
_feature("win_ultima_visita", "ultima_visita")
_feature("win_dias_desde", "dias_desde_ultima")


# -- reports named in the documentation -------------------------------------


@query("opt_ltv_by_period", with_tables("stg_recebimentos") + """
select cast(cast(date_trunc('month', data_recebimento) as date) as varchar) as month, cast(sum(valor) as double) as total_ltv,
       count(*) as payments from stg_recebimentos group by 1""")
def opt_ltv_by_period(spark, d):
    return marts.ltv_by_month(stg_billing(spark, d))


@query("opt_reengagement", with_tables("fct_pipeline") + """
select contato_hash, pipeline_segment, cast(dias_desde_ultima_visita as bigint) as days from fct_pipeline
where dias_desde_ultima_visita >= 180 and pipeline_segment in ('churned', 'upsell_opportunity')""")
def opt_reengagement(spark, d):
    return marts.reengagement(pipeline(spark, d), 180).select(
        "contato_hash", "pipeline_segment", F.col("dias_desde_ultima_visita").alias("days")
    )
