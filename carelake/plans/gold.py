"""The star schema: three dimensions, one fact, two report views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from carelake import schemas
from carelake.functions.numeric import rounded_mean, rounded_pct, round_half_away
from carelake.functions.privacy import hash_id_salted
from carelake.operators.grouping import join_lookup, number_rows


def _declared(rows: DataFrame, schema: T.StructType) -> DataFrame:
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def natural_uuid(natural_key: Column) -> Column:
    """A 36-character id that depends only on the natural key."""
    digest = F.md5(natural_key.cast("string"))
    return F.regexp_replace(digest, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def dim_patients(interactions: DataFrame, salt: str) -> DataFrame:
    """One row per patient: latest intent and fear, contact span, visits."""
    position = F.struct("created_at", "interaction")
    rows = (
        interactions.where(F.col("contato_id").isNotNull())
        .groupBy("contato_id")
        .agg(
            F.max_by("ai_intent", position).alias("intent_segment"),
            F.max_by("fear", position).alias("fear_segment"),
            F.min("created_at").alias("first_contact"),
            F.max("created_at").alias("last_contact"),
            F.count_if(F.col("valor_pago").isNotNull()).alias("total_visits"),
        )
        .withColumn("patient_key", hash_id_salted(F.col("contato_id"), salt))
    )
    return _declared(rows, schemas.DIM_PATIENTS)


def dim_services(services: DataFrame) -> DataFrame:
    """One row per service name with a dense key and its mean price."""
    priced = (
        services.where(F.col("service_name").isNotNull())
        .groupBy("service_name")
        .agg(F.min("category").alias("category"), F.sum("price").alias("total"), F.count("price").alias("n"))
        .withColumn("avg_price_brl", rounded_mean(F.col("total"), F.col("n"), 2))
    )
    return _declared(number_rows(priced, F.col("service_name"), "service_key"), schemas.DIM_SERVICES)


def calendar(first: Column, last: Column) -> list[Column]:
    """The columns of the date dimension over a span, one row per day."""
    return [F.explode(F.sequence(first, last)).alias("date_key")]


def dim_date(spans: DataFrame, column: str) -> DataFrame:
    """Every day from the first to the last value of a date column; ISO weekdays."""
    span = spans.agg(F.min(column).cast("date").alias("first"), F.max(column).cast("date").alias("last"))
    day = F.col("date_key")
    weekday = F.weekday(day) + 1
    rows = span.select(*calendar(F.col("first"), F.col("last"))).select(
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.quarter(day).alias("quarter"),
        weekday.alias("day_of_week"),
        (weekday >= 6).alias("is_weekend"),
    )
    return _declared(rows, schemas.DIM_DATE)


def fact_interactions(
    interactions: DataFrame, services: DataFrame, service_dim: DataFrame, billing: DataFrame, salt: str
) -> DataFrame:
    """One row per interaction with its dimension keys; amounts default to 0.

    Both lookups are unique on their key, so the fact side keeps its row count;
    a hot patient or service is split by adaptive execution.
    """
    service_of_item = join_lookup(
        services.where(F.col("item_id").isNotNull()).select("item_id", "service_name"),
        service_dim.select("service_name", "service_key"),
        "service_name",
        "inner",
    )
    lifetime = billing.groupBy("contato_hash").agg(F.sum("valor").alias("ltv_acumulado"))
    hashed = interactions.withColumn("contato_hash", hash_id_salted(F.col("contato_id"), salt))
    with_service = join_lookup(hashed, service_of_item.select("item_id", "service_key"), "item_id")
    rows = (
        join_lookup(with_service, lifetime, "contato_hash")
        .select(
            natural_uuid(F.col("interaction")).alias("interaction_id"),
            F.col("contato_hash").alias("patient_key"),
            "service_key",
            F.col("created_at").cast("date").alias("date_key"),
            F.coalesce("estimated_potential", F.lit(0)).alias("estimated_potential"),
            "ai_intent",
            F.when(F.col("valor_pago").isNotNull(), 1).otherwise(0).alias("visit_count"),
            F.coalesce("valor_pago", F.lit(0)).alias("valor_pago"),
            F.coalesce("ltv_acumulado", F.lit(0)).alias("ltv_acumulado"),
            "created_at",
        )
    )
    return _declared(rows, schemas.FACT_INTERACTIONS)


def vw_pipeline_by_intent(fact: DataFrame) -> DataFrame:
    """Potential, revenue and conversion per intent, largest potential first."""
    rows = F.count("*")
    return (
        fact.groupBy("ai_intent")
        .agg(
            rows.alias("total_interactions"),
            F.round(F.sum("estimated_potential"), 2).alias("total_potential_brl"),
            F.round(F.sum("valor_pago"), 2).alias("total_revenue_brl"),
            rounded_mean(F.sum("ltv_acumulado"), F.count("ltv_acumulado"), 2).alias("avg_ltv_brl"),
            rounded_pct(F.sum("valor_pago"), F.sum("estimated_potential"), 1).alias("conversion_rate_pct"),
        )
        .orderBy(F.desc_nulls_first("total_potential_brl"))
    )


def join_fact_patients(fact: DataFrame, patients: DataFrame) -> DataFrame:
    """Interactions with their patient's row; unknown patients drop out."""
    return join_lookup(fact, patients, "patient_key", "inner")


def vw_fear_vs_conversion(fact: DataFrame, patients: DataFrame) -> DataFrame:
    """Mean potential and revenue per fear segment.

    The fact is reduced to one row per patient before the join. As the name
    ``total_patients`` has it, it counts interactions.
    """
    per_patient = fact.groupBy("patient_key").agg(
        F.count("interaction_id").alias("n"),
        F.sum("estimated_potential").alias("potential"),
        F.count("estimated_potential").alias("n_potential"),
        F.sum("valor_pago").alias("revenue"),
        F.count("valor_pago").alias("n_revenue"),
    )
    potential = F.sum("potential").cast("double") / F.nullif(F.sum("n_potential"), F.lit(0))
    revenue = F.sum("revenue").cast("double") / F.nullif(F.sum("n_revenue"), F.lit(0))
    return (
        join_lookup(per_patient, patients.select("patient_key", "fear_segment"), "patient_key", "inner")
        .groupBy("fear_segment")
        .agg(
            F.sum("n").alias("total_patients"),
            round_half_away(potential, 2).alias("avg_potential"),
            round_half_away(revenue, 2).alias("avg_revenue"),
            rounded_pct(revenue, potential, 1).alias("conversion_pct"),
        )
        .orderBy(F.desc_nulls_first("conversion_pct"))
    )


def complaints_by_month(fact: DataFrame) -> DataFrame:
    complaints = fact.where(F.col("ai_intent") == "Complaint")
    return complaints.groupBy(F.trunc("date_key", "month").alias("month")).agg(F.count("*").alias("complaints"))


