"""Staging models: typed, anonymised relations over bronze."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from carelake.functions.privacy import hash_id_salted, hash_id_unsalted
from carelake.functions.text import is_nonblank, summary_quality


def valid_billing(bronze: DataFrame) -> DataFrame:
    """Positive amounts with a contact."""
    return bronze.where((F.col("valor") > 0) & F.col("contato_id").isNotNull())


def stg_recebimentos(bronze: DataFrame, salt: str) -> DataFrame:
    return valid_billing(bronze).select(
        hash_id_salted(F.col("contato_id"), salt).alias("contato_hash"),
        F.col("valor").cast("decimal(10,2)").alias("valor"),
        F.lower("valor_currency").alias("moeda"),
        F.col("data_recebimento").cast("date").alias("data_recebimento"),
        F.lower("status").alias("status"),
        F.col("created_at").cast("date").alias("created_at"),
        F.col("modified_at").cast("date").alias("modified_at"),
    )


def stg_contacts(bronze: DataFrame, salt: str) -> DataFrame:
    return bronze.where(F.col("id").isNotNull()).select(
        hash_id_salted(F.col("id"), salt).alias("contato_hash"),
        F.lower(F.trim("c_status_atendimento")).alias("status_atendimento"),
        F.col("c_lifetime_value").cast("decimal(13,2)").alias("lifetime_value"),
        F.upper("c_lifetime_value_currency").alias("lifetime_value_moeda"),
        F.col("c_potencial_venda").cast("decimal(13,2)").alias("potencial_venda"),
        F.upper("c_potencial_venda_currency").alias("potencial_venda_moeda"),
        F.col("c_qtd_consultas").cast("int").alias("qtd_consultas"),
        F.col("c_ultima_visita").cast("date").alias("ultima_visita"),
        F.col("c_aisummary").alias("ai_summary"),
        F.col("created_at").cast("date").alias("created_at"),
        F.col("modified_at").cast("date").alias("modified_at"),
    )


def stg_ai_summaries(contacts: DataFrame) -> DataFrame:
    text = F.col("ai_summary")
    return contacts.where(is_nonblank(text)).select(
        "contato_hash",
        text,
        summary_quality(text).alias("summary_quality"),
        F.length(text).alias("summary_length"),
        "created_at",
        "modified_at",
    )


# The names that a contact's columns get.
SUMMARY_NAMES = {
    "c_aisummary": "ai_summary",
    "c_lifetime_value_currency": "lifetime_value_moeda",
    "c_potencial_venda_currency": "potencial_venda_moeda",
}


def renamed(rows: DataFrame, names: dict[str, str], *kept: str) -> DataFrame:
    """The kept columns as they are, then the named ones by their new names."""
    return rows.select(*kept, *[F.col(old).alias(new) for old, new in names.items()])


def replace_identifier(rows: DataFrame, column: str) -> DataFrame:
    """``<column>_hash``, its unsalted digest, in place of an identifying column."""
    return rows.withColumn(f"{column}_hash", hash_id_unsalted(F.col(column))).drop(column)
