"""Declarative data tests. Each returns failing rows or failure counts."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class TableChecks:
    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    accepted: dict[str, tuple[str, ...]] = field(default_factory=dict)


# The declared checks of the staging models and marts.
DECLARED = {
    "stg_recebimentos": TableChecks(
        not_null=("contato_hash", "valor", "moeda", "data_recebimento", "status"),
        accepted={"moeda": ("brl",), "status": ("pago", "pendente", "cancelado", "estornado")},
    ),
    "stg_contacts": TableChecks(
        not_null=("contato_hash", "status_atendimento", "lifetime_value", "potencial_venda", "qtd_consultas"),
        unique=("contato_hash",),
    ),
    "stg_ai_summaries": TableChecks(
        not_null=("contato_hash", "summary_quality", "summary_length"),
        unique=("contato_hash",),
        accepted={"summary_quality": ("ok", "too_short", "empty", "missing")},
    ),
    "fct_ltv": TableChecks(
        not_null=(
            "contato_hash", "ltv_acumulado", "ticket_medio", "frequencia_visitas",
            "primeira_visita", "ultima_visita", "dias_desde_ultima_visita",
        ),
        unique=("contato_hash",),
    ),
    "fct_pipeline": TableChecks(
        not_null=(
            "contato_hash", "status_atendimento", "pipeline_segment", "total_pago_recebimentos", "qtd_consultas",
        ),
        unique=("contato_hash",),
        accepted={"pipeline_segment": ("churned", "upsell_opportunity", "loyal", "active")},
    ),
    "fct_ai_performance": TableChecks(
        not_null=("summary_quality", "total_contacts", "coverage_pct"),
        unique=("summary_quality",),
    ),
}


def null_rows(table: DataFrame, column: str) -> DataFrame:
    return table.where(F.col(column).isNull())


def null_counts(table: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """(column_name, failures) for all columns in one pass."""
    counts = table.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "failures")


def duplicates(table: DataFrame, column: str) -> DataFrame:
    """(value, n_records) of values that occur more than once; NULL is no value."""
    return (
        table.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def repeated_keys(keyed: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(table_name, repeated): for tables and their keys, how many rows more than distinct keys; nulls are no keys."""
    parts = [duplicates(table, key).agg(F.lit(name).alias("table_name"), F.coalesce(F.sum(F.col("n_records") - 1), F.lit(0)).alias("repeated"))
             for name, (table, key) in keyed.items()]
    return reduce(DataFrame.union, parts)


def unexpected_values(table: DataFrame, column: str, accepted: tuple[str, ...]) -> DataFrame:
    """(value, n_records) of values outside the list; NULL passes."""
    return (
        table.where(~F.col(column).isin(*accepted))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("n_records"))
    )


def table_report(name: str, table: DataFrame, wanted: TableChecks) -> DataFrame:
    """(table_name, column_name, test, failures) for the checks of one table, from one pass over it.

    As in declarative test runners, not_null counts rows, while unique and
    accepted_values count distinct offending values. A row gives an entry
    (check, value) for every null that must not be, every value that must be
    unique, and every value outside its list; entries are counted before the
    shuffle, so neither a hot value nor a column of nulls gathers in one task.
    """
    checks = {f"{c}|not_null": F.when(F.col(c).isNull(), F.lit("")) for c in wanted.not_null}
    checks |= {f"{c}|unique": F.col(c).cast("string") for c in wanted.unique}
    checks |= {f"{c}|accepted_values": F.when(~F.col(c).isin(*values), F.col(c).cast("string")) for c, values in wanted.accepted.items()}
    if not checks:
        return table.sparkSession.createDataFrame([], "table_name string, column_name string, test string, failures bigint")
    entries = F.array_compact(F.array(*[F.when(value.isNotNull(), F.struct(F.lit(check).alias("check"), value.alias("value")))
                                        for check, value in checks.items()]))
    counted = table.select(F.inline(entries)).groupBy("check", "value").agg(F.count("*").alias("n"))

    def failures(check: str):
        own = F.col("check") == check
        if check.endswith("|not_null"):
            return F.coalesce(F.sum(F.when(own, F.col("n"))), F.lit(0))
        return F.count_if(own & (F.col("n") > 1)) if check.endswith("|unique") else F.count_if(own)

    named = F.split("check", r"\|")
    rows = counted.agg(*[failures(check).alias(check) for check in checks]).unpivot([], list(checks), "check", "failures")
    return rows.select(F.lit(name).alias("table_name"), named[0].alias("column_name"), named[1].alias("test"), "failures")


def report(tables: dict[str, DataFrame], checks: dict[str, TableChecks] = DECLARED) -> DataFrame:
    """One row per table, column and test with its number of failures."""
    return reduce(DataFrame.union, [table_report(n, t, checks[n]) for n, t in tables.items()])


def fk_orphans(fact: DataFrame, key: str, dimension: DataFrame, dimension_key: str) -> DataFrame:
    """(value, n_records) of non-NULL foreign keys without a dimension row."""
    used = (
        fact.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("value"))
        .agg(F.count("*").alias("n_records"))
    )
    return used.join(dimension.select(F.col(dimension_key).alias("value")), "value", "left_anti")


def leaks(table: DataFrame, columns: tuple[str, ...], pattern_test) -> DataFrame:
    """Rows in which any listed text column still holds personal data."""
    return table.where(_leaking(columns, pattern_test))


def without_leaks(table: DataFrame, columns: tuple[str, ...], pattern_test) -> DataFrame:
    """All other rows; null texts hold nothing."""
    return table.where(~_leaking(columns, pattern_test))


def _leaking(columns: tuple[str, ...], pattern_test) -> Column:
    return reduce(lambda a, b: a | b, [F.coalesce(pattern_test(F.col(c)), F.lit(False)) for c in columns])
