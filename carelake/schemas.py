"""Declared schemas of the bronze, gold and record layers."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


MONEY_SOURCE = T.DecimalType(13, 4)

# -- bronze ---------------------------------------------------------------

BILLING_BRONZE = _struct(
    ("id", T.StringType()),
    ("contato_id", T.StringType()),
    ("valor", MONEY_SOURCE),
    ("valor_currency", T.StringType()),
    ("data_recebimento", T.DateType()),
    ("status", T.StringType()),
    ("created_at", T.TimestampNTZType()),
    ("modified_at", T.TimestampNTZType()),
)

CONTACT_BRONZE = _struct(
    ("id", T.StringType()),
    ("c_status_atendimento", T.StringType()),
    ("c_lifetime_value", MONEY_SOURCE),
    ("c_lifetime_value_currency", T.StringType()),
    ("c_potencial_venda", MONEY_SOURCE),
    ("c_potencial_venda_currency", T.StringType()),
    ("c_qtd_consultas", T.IntegerType()),
    ("c_ultima_visita", T.DateType()),
    ("c_aisummary", T.StringType()),
    ("created_at", T.TimestampNTZType()),
    ("modified_at", T.TimestampNTZType()),
)

RAG_AUDIT_BRONZE = _struct(
    ("uuid", T.StringType()),
    ("name", T.StringType()),
    ("cmetadata", T.StringType()),
)

# -- gold -----------------------------------------------------------------

DIM_PATIENTS = _struct(
    ("patient_key", T.StringType()),
    ("intent_segment", T.StringType()),
    ("fear_segment", T.StringType()),
    ("first_contact", T.DateType()),
    ("last_contact", T.DateType()),
    ("total_visits", T.IntegerType()),
)

DIM_SERVICES = _struct(
    ("service_key", T.IntegerType()),
    ("service_name", T.StringType()),
    ("category", T.StringType()),
    ("avg_price_brl", T.DecimalType(10, 2)),
)

DIM_DATE = _struct(
    ("date_key", T.DateType()),
    ("year", T.IntegerType()),
    ("month", T.IntegerType()),
    ("quarter", T.IntegerType()),
    ("day_of_week", T.IntegerType()),
    ("is_weekend", T.BooleanType()),
)

FACT_INTERACTIONS = _struct(
    ("interaction_id", T.StringType()),
    ("patient_key", T.StringType()),
    ("service_key", T.IntegerType()),
    ("date_key", T.DateType()),
    ("estimated_potential", T.DecimalType(12, 2)),
    ("ai_intent", T.StringType()),
    ("visit_count", T.IntegerType()),
    ("valor_pago", T.DecimalType(12, 2)),
    ("ltv_acumulado", T.DecimalType(12, 2)),
    ("created_at", T.TimestampNTZType()),
)

# -- records --------------------------------------------------------------

PAYLOAD = _struct(
    ("phone", T.StringType()),
    ("patient_name", T.StringType()),
    ("message_text", T.StringType()),
    ("audio_transcription", T.StringType()),
)

MESSAGE_EVENT = _struct(
    ("event_id", T.LongType()),
    ("ts", T.TimestampNTZType()),
    ("user_id", T.LongType()),
    ("event_type", T.StringType()),
    ("value", T.DoubleType()),
    ("props", T.StringType()),
)
