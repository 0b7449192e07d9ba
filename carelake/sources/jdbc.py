"""Exports from the operational databases.

The filter and the column list are part of the pushed query, so the database
sends only live rows and only allowed columns. ``JdbcSource`` holds connection
options; ranges on a timestamp column split one table into parallel reads.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from carelake import schemas
from carelake.functions.privacy import scrub_pii

# Columns that must never leave the contact table: direct identifiers and the
# display strings of the user interface.
CONTACT_DENYLIST = frozenset(
    {
        "first_name", "last_name", "phone_number", "email_address", "address", "description",
        "c_display_ltv", "c_display_potencial", "c_display_visitas", "c_c_kanban_card",
    }
)


# Reads of one table; each is a connection's query, and a database takes only so many.
MOST_READS = 10_000


@dataclass(frozen=True)
class JdbcSource:
    """Connection options of one database; credentials come from the caller."""

    url: str
    properties: dict[str, str] = field(default_factory=dict)

    def options(
        self,
        table: str,
        partition_column: str | None = None,
        bounds: tuple[str, str] | None = None,
        partitions: int = 1,
    ) -> dict[str, str]:
        """Reader options; partitioned reads need a numeric, date or timestamp column."""
        chosen = {"url": self.url, "dbtable": table, "fetchsize": "10000", **self.properties}
        if partition_column is not None:
            if bounds is None:
                raise ValueError("a partitioned read needs lower and upper bounds")
            chosen.update(
                partitionColumn=partition_column,
                lowerBound=bounds[0],
                upperBound=bounds[1],
                numPartitions=str(partitions),
            )
        return chosen

    def table(self, spark: SparkSession, table: str, **split) -> DataFrame:
        """A lazy table; filters and column lists on it are pushed to the database."""
        return spark.read.format("jdbc").options(**self.options(table, **split)).load()

    def bounds(self, spark: SparkSession, table: str, column: str) -> Row:
        """(low, high, n) of a column, one row that the database computes."""
        return self.table(spark, f"(select min({column}) as low, max({column}) as high, count(*) as n from {table}) bounds").first()

    def split_table(self, spark: SparkSession, table: str, column: str, rows_per_read: int = 1_000_000) -> DataFrame:
        """A lazy table in as many parallel reads as its size asks for, each of a range of ``column``.

        One query asks for the smallest and largest value and the number of rows
        first; an indexed number, date or timestamp suits best.
        """
        known = self.bounds(spark, table, column)
        return spark.read.jdbc(self.url, table, predicates=split_predicates(column, known.low, known.high, known.n, rows_per_read),
                               properties={"fetchsize": "10000", **self.properties})


def split_predicates(column: str, low, high, rows: int, rows_per_read: int = 1_000_000) -> list[str]:
    """Conditions that part a table into ranges of about ``rows_per_read`` rows, and one for its nulls.

    Every row meets exactly one of them: the outer ranges are open, so rows that
    were added beyond the bounds since are read, too. Ranges are equally wide;
    values that crowd make some reads larger. A column of one value, or none,
    gives one range.
    """
    if rows_per_read < 1:
        raise ValueError("a read takes one row at least")
    reads = min(max(1, -(-rows // rows_per_read)), MOST_READS)
    cuts = []
    if low is not None and high is not None and low < high:
        cuts = sorted({_cut(low, high, i, reads) for i in range(1, reads)} - {low})
    marks = [_literal(c) for c in cuts]
    if not marks:
        return [f"{column} is not null", f"{column} is null"]
    inner = [f"{column} >= {a} and {column} < {b}" for a, b in zip(marks, marks[1:])]
    return [f"{column} < {marks[0]}", *inner, f"{column} >= {marks[-1]}", f"{column} is null"]


def _cut(low, high, part: int, parts: int):
    """The value a share of the way from low to high, in the column's own type."""
    if isinstance(low, dt.datetime):
        return low + (high - low) * part / parts
    if isinstance(low, dt.date):
        return low + dt.timedelta(days=(high - low).days * part // parts)
    if isinstance(low, int):
        return low + (high - low) * part // parts
    return low + (high - low) * part / parts


def _literal(value) -> str:
    if isinstance(value, dt.datetime):
        return f"timestamp '{value:%Y-%m-%d %H:%M:%S.%f}'"
    return f"date '{value}'" if isinstance(value, dt.date) else str(value)


def live_rows(source: DataFrame) -> DataFrame:
    """Rows that were not soft-deleted."""
    return source.where(F.col("deleted") == 0)


def project_allowlist(source: DataFrame, allowed: list[str]) -> DataFrame:
    """Exactly the allowed columns; a denied name in the list is an error."""
    denied = CONTACT_DENYLIST.intersection(allowed)
    if denied:
        raise ValueError(f"columns may not be exported: {sorted(denied)}")
    return source.select(*allowed)


def _declared(source: DataFrame, schema) -> DataFrame:
    columns: list[Column] = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]
    return source.select(*columns)


def export_billing(source: DataFrame) -> DataFrame:
    """Live billing rows in the declared bronze schema."""
    columns = schemas.BILLING_BRONZE.fieldNames()
    return _declared(project_allowlist(live_rows(source), columns), schemas.BILLING_BRONZE)


def export_contacts(source: DataFrame, unicode_scrub: bool = False) -> DataFrame:
    """Live contacts, allowed columns only, with the free text scrubbed."""
    columns = schemas.CONTACT_BRONZE.fieldNames()
    exported = project_allowlist(live_rows(source), columns).withColumn(
        "c_aisummary", scrub_pii(F.col("c_aisummary"), unicode_scrub)
    )
    return _declared(exported, schemas.CONTACT_BRONZE)


def export_rag_audit(source: DataFrame) -> DataFrame:
    """Collection metadata; institutional knowledge only, so no filter."""
    return _declared(source, schemas.RAG_AUDIT_BRONZE)
