"""Marts over staging, and the windowless form of the per-contact features."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from carelake.functions.numeric import round_half_away, rounded_mean
from carelake.functions.privacy import hash_id_unsalted
from carelake.functions.text import is_nonblank, summary_quality
from carelake.operators.grouping import attach_group_totals, join_lookup


def days_since(day: Column, as_of: dt.date) -> Column:
    """Days from a date to the run date; NULL stays NULL."""
    return F.datediff(F.lit(as_of), day)


def pipeline_segment(status: Column, paid: Column, potential: Column, lifetime: Column, visits: Column) -> Column:
    """First rule that holds wins; a comparison with NULL does not hold."""
    return (
        F.when((status == "finalizado") & (F.coalesce(paid, F.lit(0)) == 0), "churned")
        .when(potential > lifetime, "upsell_opportunity")
        .when(visits >= 3, "loyal")
        .otherwise("active")
    )


def fct_ltv(billing: DataFrame, as_of: dt.date) -> DataFrame:
    """Lifetime value and recency per patient."""
    total, payments = F.sum("valor"), F.count("*")
    return billing.groupBy("contato_hash").agg(
        F.round(total, 2).alias("ltv_acumulado"),
        rounded_mean(total, payments, 2).alias("ticket_medio"),
        F.round(F.max("valor"), 2).alias("maior_pagamento"),
        payments.alias("frequencia_visitas"),
        F.min("data_recebimento").alias("primeira_visita"),
        F.max("data_recebimento").alias("ultima_visita"),
        days_since(F.max("data_recebimento"), as_of).alias("dias_desde_ultima_visita"),
    )


def billing_agg(billing: DataFrame) -> DataFrame:
    return billing.groupBy("contato_hash").agg(
        F.round(F.sum("valor"), 2).alias("total_pago"),
        F.count("*").alias("total_pagamentos"),
        F.min("data_recebimento").alias("primeiro_pagamento"),
        F.max("data_recebimento").alias("ultimo_pagamento"),
    )


def contacts_with_billing(contacts: DataFrame, billing: DataFrame) -> DataFrame:
    """Contacts with their payments, aggregated before the join; no payment gives 0."""
    return join_lookup(contacts, billing_agg(billing), "contato_hash").withColumns(
        {
            "total_pago": F.coalesce("total_pago", F.lit(0).cast("decimal(20,2)")),
            "total_pagamentos": F.coalesce("total_pagamentos", F.lit(0)),
        }
    )


def fct_pipeline(contacts: DataFrame, billing: DataFrame, as_of: dt.date) -> DataFrame:
    """Contact profile, payments, recency and segment."""
    return contacts_with_billing(contacts, billing).select(
        "contato_hash",
        "status_atendimento",
        "lifetime_value",
        "lifetime_value_moeda",
        "potencial_venda",
        "potencial_venda_moeda",
        F.col("total_pago").alias("total_pago_recebimentos"),
        "total_pagamentos",
        "qtd_consultas",
        "ultima_visita",
        "primeiro_pagamento",
        "ultimo_pagamento",
        days_since(F.col("ultima_visita"), as_of).alias("dias_desde_ultima_visita"),
        pipeline_segment(
            F.col("status_atendimento"),
            F.col("total_pago"),
            F.col("potencial_venda"),
            F.col("lifetime_value"),
            F.col("qtd_consultas"),
        ).alias("pipeline_segment"),
        "created_at",
        "modified_at",
    )


_CONTACT_TOTALS = {
    "lifetime_value": ("sum_ltv", "n_ltv"),
    "potencial_venda": ("sum_pot", "n_pot"),
    "qtd_consultas": ("sum_vis", "n_vis"),
}


def contact_totals(contacts: DataFrame) -> DataFrame:
    """Row count and column totals per contact key."""
    totals = []
    for column, (total, present) in _CONTACT_TOTALS.items():
        totals += [F.sum(column).alias(total), F.count(column).alias(present)]
    return contacts.groupBy("contato_hash").agg(F.count("*").alias("n_rows"), *totals)


def summaries_with_contacts(summaries: DataFrame, contacts: DataFrame) -> DataFrame:
    """Each summary with each row of its contact: the summary's columns and the contact's value columns.

    The row-level join: where a key repeats on both sides (several snapshots), every
    pair is a row. NULL keys meet nothing. Pass sides that were not just aggregated by
    the key: then both are shuffled and adaptive execution splits a hot key. For totals use
    ``summaries_with_contact_totals`` or ``fct_ai_performance``, which build no pairs.
    """
    return summaries.join(contacts.select("contato_hash", *_CONTACT_TOTALS), "contato_hash")


def summaries_with_contact_totals(summaries: DataFrame, contacts: DataFrame) -> DataFrame:
    """Each summary with its contact's totals.

    One row per summary even when a key repeats on both sides: the contact side
    is reduced to one row per key first, so the output never grows with the
    product of the two group sizes.
    """
    return join_lookup(summaries, contact_totals(contacts), "contato_hash", "inner")


def fct_ai_performance(contacts: DataFrame) -> DataFrame:
    """Quality, value and coverage of summaries, by quality tier.

    Summaries come from the same contacts they are joined with. So one
    aggregation per contact key holds both sides: the contact totals, and the
    number and length of summaries in each tier. A key with s summaries in a
    tier and c contact rows stands for s * c joined rows; the sums are scaled
    accordingly, which equals joining row by row, without the join.
    """
    text = F.col("ai_summary")
    tier = summary_quality(text)
    tiers = ("too_short", "ok")
    slim = contacts.select(
        "contato_hash", *_CONTACT_TOTALS,
        F.when(is_nonblank(text), tier).alias("tier"), F.length(text).alias("chars"),
    )
    per_tier = []
    for name in tiers:
        in_tier = F.col("tier") == name
        per_tier += [
            F.count_if(in_tier).alias(f"n_{name}"),
            F.sum(F.when(in_tier, F.col("chars"))).alias(f"chars_{name}"),
        ]
    totals = [F.count("*").alias("n_rows")]
    for column, (total, present) in _CONTACT_TOTALS.items():
        totals += [F.sum(column).alias(total), F.count(column).alias(present)]
    per_key = slim.groupBy("contato_hash").agg(*totals, *per_tier)

    # One row per key and tier; the row with a NULL tier only counts contacts.
    sides = [
        F.struct(F.lit(t).alias("tier"), F.col(f"n_{t}").alias("n"), F.col(f"chars_{t}").alias("chars"))
        for t in tiers
    ]
    everyone = F.struct(
        F.lit(None).cast("string").alias("tier"), F.lit(1).cast("bigint").alias("n"), F.lit(None).cast("bigint").alias("chars")
    )
    rows = per_key.select("*", F.inline(F.array(*sides, everyone))).where(F.col("n") > 0)

    n = F.col("n")
    scaled = [
        F.sum(n * F.col("n_rows")).alias("pairs"),
        F.sum(F.col("chars") * F.col("n_rows")).alias("chars"),
    ]
    for total, present in _CONTACT_TOTALS.values():
        scaled += [F.sum(F.col(total) * n).alias(total), F.sum(F.col(present) * n).alias(present)]
    by_tier = rows.groupBy("tier").agg(*scaled)
    # At most three rows are left here, one of them the contact count.
    everyone_count = F.collect_list(F.when(F.col("tier").isNull(), F.col("pairs")))
    tiers_array = F.collect_list(F.struct(*by_tier.columns))
    return (
        by_tier.agg(F.get(everyone_count, F.lit(0)).alias("n_contacts"), tiers_array.alias("t"))
        .select("n_contacts", F.inline("t"))
        .where(F.col("tier").isNotNull())
        .select(
            F.col("tier").alias("summary_quality"),
            F.col("pairs").alias("total_contacts"),
            rounded_mean(F.col("chars"), F.col("pairs"), 0).alias("avg_summary_length"),
            F.round("sum_ltv", 2).alias("total_ltv"),
            rounded_mean(F.col("sum_ltv"), F.col("n_ltv"), 2).alias("avg_ltv"),
            F.round("sum_pot", 2).alias("total_potencial"),
            rounded_mean(F.col("sum_pot"), F.col("n_pot"), 2).alias("avg_potencial"),
            rounded_mean(F.col("sum_vis"), F.col("n_vis"), 1).alias("avg_consultas"),
            coverage_pct(F.col("pairs"), F.col("n_contacts")).alias("coverage_pct"),
        )
    )


def coverage_pct(rows: Column, everyone: Column) -> Column:
    """Share of all contacts in percent; no contacts give NULL."""
    return round_half_away(rows * F.lit(100.0) / F.nullif(everyone, F.lit(0)), 2)


def silver_features(bronze: DataFrame, as_of: dt.date) -> DataFrame:
    """Every billing row with its contact's totals; the raw id is dropped.

    "Accumulated" is the contact's whole total, not a running sum. Rows
    without a contact form one group of their own.
    """
    with_totals = attach_group_totals(
        bronze,
        "contato_id",
        [
            F.sum("valor").alias("ltv_acumulado"),
            F.count("id").alias("frequencia_visitas"),
            F.max("data_recebimento").alias("ultima_visita"),
        ],
    )
    return with_totals.select(
        *[c for c in bronze.columns if c != "contato_id"],
        hash_id_unsalted(F.col("contato_id")).alias("contato_id_hash"),
        "ltv_acumulado",
        "frequencia_visitas",
        "ultima_visita",
        days_since(F.col("ultima_visita"), as_of).alias("dias_desde_ultima"),
        F.lit(as_of.isoformat()).alias("silver_dt"),
    )


def ltv_by_month(billing: DataFrame) -> DataFrame:
    return billing.groupBy(F.trunc("data_recebimento", "month").alias("month")).agg(
        F.sum("valor").alias("total_ltv"), F.count("*").alias("payments")
    )


def reengagement(pipeline: DataFrame, min_days: int) -> DataFrame:
    """Contacts worth another approach: not seen for a while, and not merely active."""
    return pipeline.where(
        (F.col("dias_desde_ultima_visita") >= min_days)
        & F.col("pipeline_segment").isin("churned", "upsell_opportunity")
    )
