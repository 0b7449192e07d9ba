"""Operational tables derived from the TPC-H-like test tables.

Contacts are customers (with billing) and suppliers (without); billing rows are
orders; chat messages are events. Only columns are derived here: every row of
the given tables is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def billing_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The billing table as the operational database holds it."""
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.when(
            ~((priority == "5-LOW") & (status == "O")),
            F.concat(F.lit("C"), F.col("o_custkey").cast("string")),
        ).alias("contato_id"),
        F.when((priority == "1-URGENT") & (status == "P"), F.lit(0))
        .otherwise(F.col("o_totalprice"))
        .cast("decimal(13,4)")
        .alias("valor"),
        F.lit("BRL").alias("valor_currency"),
        F.col("o_orderdate").cast("date").alias("data_recebimento"),
        F.when(status == "F", "PAGO").when(status == "O", "Pendente").otherwise("Cancelado").alias("status"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderdate").alias("modified_at"),
        F.when((priority == "4-NOT SPECIFIED") & (status == "P"), 1).otherwise(0).alias("deleted"),
    )


def contact_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contact table as the operational database holds it, identifiers included."""
    visits = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(
            F.count_if(F.col("o_orderstatus") == "F").cast("int").alias("c_qtd_consultas"),
            F.max(F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate"))).cast("date").alias("c_ultima_visita"),
            F.min("o_orderdate").alias("created_at"),
            F.max("o_orderdate").alias("modified_at"),
        )
    )
    notes = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("c_aisummary"))
    segment = F.col("c_mktsegment")
    customers = (
        table(spark, sf_dir, "customer")
        .join(visits, F.col("c_custkey") == F.col("o_custkey"), "left")
        .join(notes, F.col("c_custkey") == F.col("doc_id"), "left")
        .select(
            F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("id"),
            F.when(segment == "BUILDING", "  Finalizado ")
            .when(segment == "MACHINERY", "Novo Lead")
            .when(F.col("c_acctbal") >= -900, segment)
            .alias("c_status_atendimento"),
            F.col("c_acctbal").cast("decimal(13,4)").alias("c_lifetime_value"),
            (F.col("c_nationkey") * 400).cast("decimal(13,4)").alias("c_potencial_venda"),
            "c_qtd_consultas",
            "c_ultima_visita",
            "c_aisummary",
            "created_at",
            "modified_at",
            F.col("c_name").alias("first_name"),
            F.concat(
                F.when(segment.isin("BUILDING", "MACHINERY"), "+55819").otherwise("+55 81 9"),
                F.lpad(F.col("c_custkey").cast("string"), 8, "0"),
            ).alias("phone_number"),
            F.when(F.col("c_acctbal") < -950, 1).otherwise(0).alias("deleted"),
        )
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("id"),
        F.lit("Finalizado").alias("c_status_atendimento"),
        F.col("s_acctbal").cast("decimal(13,4)").alias("c_lifetime_value"),
        (F.col("s_nationkey") * 400).cast("decimal(13,4)").alias("c_potencial_venda"),
        F.lit(None).cast("int").alias("c_qtd_consultas"),
        F.lit(None).cast("date").alias("c_ultima_visita"),
        F.lit("   ").alias("c_aisummary"),
        F.lit(None).cast("timestamp_ntz").alias("created_at"),
        F.lit(None).cast("timestamp_ntz").alias("modified_at"),
        F.col("s_name").alias("first_name"),
        F.concat(F.lit("5511"), F.lpad(F.col("s_suppkey").cast("string"), 8, "3")).alias("phone_number"),
        F.lit(0).alias("deleted"),
    )
    return customers.unionByName(suppliers).select(
        "*",
        F.lit("brl").alias("c_lifetime_value_currency"),
        F.lit("brl").alias("c_potencial_venda_currency"),
    )


def chat_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chat events: (event_id, user_id, phone, ts, text)."""
    return chat_columns(table(spark, sf_dir, "events"))


def chat_columns(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        "user_id",
        event_phone().alias("phone"),
        "ts",
        F.concat_ws(" ", "event_type", "props").alias("text"),
    )


def event_phone():
    """The sender's number as the chat channel writes it."""
    prefix = F.when(F.col("user_id") < 40, "+55 81 9").otherwise("81 9")
    return F.concat(prefix, F.lpad((F.col("user_id") * 17).cast("string"), 8, "0"))


def summary_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracted summaries as JSON text, one per event.

    Some records break the contract on purpose: unknown intents, negative
    amounts, explicit nulls, a text where a number belongs.
    """
    return summary_columns(table(spark, sf_dir, "events"))


def summary_columns(events: DataFrame) -> DataFrame:
    kind, value = F.col("event_type"), F.col("value")
    k = F.regexp_extract("props", r"(\d+)", 1)
    client = (
        F.when(kind == "signup", F.concat(F.lit('"cliente": "Ana Maria U'), F.col("user_id").cast("string"), F.lit('", ')))
        .when(kind == "purchase", F.lit('"cliente": "Bruno", '))
        .when((kind == "error") & (value > 400), F.lit('"cliente": null, '))
        .otherwise(F.lit(""))
    )
    intent = (
        F.when(kind == "click", "Inquiry")
        .when(kind == "purchase", "Scheduling")
        .when(kind == "error", "Complaint")
        .when(value > 450, "Sale")
        .otherwise("Other")
    )
    potential = (
        F.when(value < 1, F.concat(F.lit("-"), value.cast("decimal(9,2)").cast("string")))
        .when(value > 480, F.lit('"high"'))
        .otherwise(value.cast("decimal(9,2)").cast("string"))
    )
    fear = F.when(k.cast("int") > 80, F.lit(', "fobias_alergias": "needle_phobia"')).otherwise(F.lit(""))
    note = F.when(kind == "view", F.lit(', "obs": "CPF 123.456.789-00 CNPJ 12.345.678/0001-90"')).otherwise(F.lit(""))
    document = F.concat(
        F.lit("{"), client,
        F.lit('"intencao": "'), intent,
        F.lit('", "potencial": '), potential,
        F.lit(', "qtd_consultas": '), k,
        fear, note,
        F.lit(', "canal": "chat"}'),
    )
    return events.select("event_id", "user_id", event_phone().alias("phone"), "ts", document.alias("summary_json"))


def payload_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Webhook payloads as JSON text, one per conversation turn."""
    role = F.col("role")
    fields = F.struct(
        F.when(role != "system", F.concat(F.lit("+55 81 9"), F.lpad(F.col("conv_id").cast("string"), 8, "0"))).alias("phone"),
        role.alias("patient_name"),
        F.when(role == "user", F.col("text")).otherwise(F.lit(" \n\t ")).alias("message_text"),
        F.when(role == "assistant", F.col("text")).when(role == "user", F.lit("")).alias("audio_transcription"),
    )
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.to_json(fields).alias("payload"))


def services_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priced services: (item_id, service_name, category, price)."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"),
        F.concat_ws(" ", "p_name", "p_type").alias("service_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
    )


def interactions_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interactions with the item they concern and the amount paid, if any."""
    kind, value = F.col("event_type"), F.col("value").cast("decimal(12,2)")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("interaction"),
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("contato_id"),
        F.regexp_extract("props", r"(\d+)", 1).cast("bigint").alias("item_id"),
        F.when(kind != "view", value * 2).cast("decimal(12,2)").alias("estimated_potential"),
        F.when(kind == "click", "Inquiry")
        .when(kind == "purchase", "Scheduling")
        .when(kind == "error", "Complaint")
        .otherwise("Other")
        .alias("ai_intent"),
        F.when(F.col("value") > 150, "needle_phobia").otherwise("none").alias("fear"),
        F.when(kind == "purchase", value).alias("valor_pago"),
        F.col("ts").alias("created_at"),
    )


def vectors_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors by collection: (vec_id, collection, embedding)."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("label").cast("string").alias("collection"), "embedding"
    )
