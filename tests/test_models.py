"""Staging, marts, gold and snapshots on small hand-made tables."""

import datetime as dt
from decimal import Decimal

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from carelake import schemas
from carelake.operators import grouping, quality
from carelake.plans import gold, marts, staging
from carelake.sources import collections, documents, jdbc, snapshots

AS_OF = dt.date(2025, 1, 1)


def billing_rows(spark, rows):
    full = [(str(i), c, Decimal(str(v)) if v is not None else None, "BRL", dt.date(2024, 1, 1 + i % 28), "PAGO", None, None)
            for i, (c, v) in enumerate(rows)]
    return spark.createDataFrame(full, schemas.BILLING_BRONZE)


def contact_rows(spark, rows):
    full = [(i, s, ltv, "brl", pot, "brl", visits, None, note, None, None) for i, s, ltv, pot, visits, note in rows]
    return spark.createDataFrame(full, schemas.CONTACT_BRONZE)


SEGMENTS = [
    ("finalizado", 0, 500, 1000, 1, "churned"),
    ("ativo", 500, 2000, 1000, 1, "upsell_opportunity"),
    ("ativo", 500, 100, 1000, 5, "loyal"),
    ("ativo", 200, 100, 300, 1, "active"),
    ("ativo", 0, None, 300, 3, "loyal"),
    ("ativo", 0, 400, None, None, "active"),
    ("finalizado", None, 100, 300, 1, "churned"),
    ("finalizado", 10, 400, 300, 1, "upsell_opportunity"),
    (None, 0, 100, 300, 1, "active"),
]


def test_pipeline_segments(spark):
    frame = spark.createDataFrame(
        [(i, *case[:5]) for i, case in enumerate(SEGMENTS)],
        "i int, status string, paid int, potential int, lifetime int, visits int",
    )
    segment = marts.pipeline_segment(*[F.col(c) for c in ("status", "paid", "potential", "lifetime", "visits")])
    rows = frame.select("i", segment.alias("s")).orderBy("i").collect()
    assert [r.s for r in rows] == [case[5] for case in SEGMENTS]


def test_staging_drops_invalid_billing(spark):
    rows = [("a", 10.555), ("a", 0), ("b", -1), (None, 5), ("c", None)]
    staged = staging.stg_recebimentos(billing_rows(spark, rows), "s").collect()
    assert [(r.valor, r.moeda, r.status) for r in staged] == [(Decimal("10.56"), "brl", "pago")]


def test_ai_performance_equals_the_row_join(spark):
    """With repeated keys, the scaled sums equal joining row by row."""
    rows = []
    for key, copies in (("a", 3), ("b", 1), ("c", 2)):
        for i in range(copies):
            rows.append((key, "x", Decimal(10 + i), Decimal(7 * i), i or None, ["ok " * 40, "short", "  ", None][i % 4]))
    rows.append(("d", "x", None, Decimal(5), None, "y" * 60))
    contacts = staging.stg_contacts(contact_rows(spark, rows), "s").cache()
    summaries = staging.stg_ai_summaries(contacts)
    pairs = summaries.select("contato_hash", "summary_quality", "summary_length").join(contacts, "contato_hash")
    expected = {
        r.q: (r.n, float(r.ltv), float(r.pot), r.vis, r.chars)
        for r in pairs.groupBy(F.col("summary_quality").alias("q")).agg(
            F.count("*").alias("n"), F.sum("lifetime_value").alias("ltv"), F.sum("potencial_venda").alias("pot"),
            F.round(F.avg("qtd_consultas"), 1).alias("vis"), F.round(F.avg("summary_length"), 0).alias("chars"),
        ).collect()
    }
    got = {r.summary_quality: r for r in marts.fct_ai_performance(contacts).collect()}
    assert {q: (r.total_contacts, float(r.total_ltv), float(r.total_potencial), r.avg_consultas, r.avg_summary_length)
            for q, r in got.items()} == expected
    assert got["ok"].coverage_pct == round(expected["ok"][0] * 100.0 / len(rows), 2)


def test_summaries_meet_every_row_of_their_contact(spark):
    summaries = spark.createDataFrame([("a", "ok"), ("a", "too_short"), (None, "ok"), ("z", "ok")],
                                      "contato_hash string, summary_quality string")
    contacts = spark.createDataFrame([("a", 1, 2, 3), ("a", 4, None, 6), (None, 7, 8, 9), ("b", 1, 1, 1)],
                                     "contato_hash string, lifetime_value int, potencial_venda int, qtd_consultas int")
    rows = marts.summaries_with_contacts(summaries, contacts).collect()
    assert sorted((r.contato_hash, r.summary_quality, r.lifetime_value) for r in rows) == [
        ("a", "ok", 1), ("a", "ok", 4), ("a", "too_short", 1), ("a", "too_short", 4)]
    totals = marts.summaries_with_contact_totals(summaries, contacts).collect()
    assert sorted((r.summary_quality, r.n_rows, r.sum_ltv, r.n_pot) for r in totals) == [("ok", 2, 5, 1), ("too_short", 2, 5, 1)]


def test_ai_performance_without_contacts(spark):
    assert marts.fct_ai_performance(staging.stg_contacts(contact_rows(spark, []), "s")).collect() == []


def test_features_keep_every_row_and_group_nulls(spark):
    rows = [("a", 1), ("a", 2), (None, 3), (None, 4), ("b", None)]
    got = marts.silver_features(billing_rows(spark, rows), AS_OF).collect()
    assert len(got) == 5
    totals = {(r.id, float(r.ltv_acumulado) if r.ltv_acumulado is not None else None, r.frequencia_visitas) for r in got}
    assert totals == {("0", 3.0, 2), ("1", 3.0, 2), ("2", 7.0, 2), ("3", 7.0, 2), ("4", None, 1)}
    assert "contato_id" not in got[0].asDict()
    assert {r.silver_dt for r in got} == {"2025-01-01"}


def test_hot_key_is_split(spark):
    """A key with a third of all rows: the final plan splits its partition."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        n = 90_000
        rows = spark.range(0, n, 1, 16).select(
            F.col("id").cast("string").alias("id"),
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("contato_id"),
            F.lit(1).cast("decimal(13,4)").alias("valor"),
            F.lit(AS_OF).alias("data_recebimento"),
        )
        frame = marts.silver_features(rows, AS_OF)
        hot = frame.where(F.col("frequencia_visitas") > 1)
        frame.write.format("noop").mode("overwrite").save()
        collected = frame.collect()
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
        assert "Window" not in plan
        assert len(collected) == n
        assert hot.count() == n // 3
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_numbering_is_dense_and_stable(spark):
    names = spark.range(5000).select(F.concat(F.lit("service "), F.col("id").cast("string")).alias("name"))
    first = {r.name: r.n for r in grouping.number_rows(names, F.col("name"), "n").collect()}
    again = {r.name: r.n for r in grouping.number_rows(names.repartition(7), F.col("name"), "n").collect()}
    assert first == again
    assert sorted(first.values()) == list(range(1, 5001))


def test_date_dimension(spark):
    span = spark.createDataFrame([(dt.datetime(2024, 2, 28, 5),), (dt.datetime(2024, 3, 3),)], "at timestamp_ntz")
    days = gold.dim_date(span, "at").orderBy("date_key").collect()
    assert [d.date_key.day for d in days] == [28, 29, 1, 2, 3]
    assert [(d.day_of_week, d.is_weekend) for d in days][-2:] == [(6, True), (7, True)]


def test_gold_views_put_null_first(spark):
    fact = spark.createDataFrame(
        [("1", "p", "Inquiry", Decimal(0), Decimal(5), Decimal(1)), ("2", "q", "Other", None, Decimal(5), None)],
        "interaction_id string, patient_key string, ai_intent string, estimated_potential decimal(12,2), "
        "valor_pago decimal(12,2), ltv_acumulado decimal(12,2)",
    )
    by_intent = gold.vw_pipeline_by_intent(fact).collect()
    assert [r.ai_intent for r in by_intent] == ["Other", "Inquiry"]
    assert [r.conversion_rate_pct for r in by_intent] == [None, None]
    patients = spark.createDataFrame([("p", "none")], "patient_key string, fear_segment string")
    assert gold.vw_fear_vs_conversion(fact, patients).first().total_patients == 1


def test_quality_report(spark):
    table = spark.createDataFrame([("a", "x"), ("a", "y"), (None, "x"), ("b", None), ("c", "z"), ("d", "z")], "k string, v string")
    checks = {"t": quality.TableChecks(("k", "v"), ("k",), {"v": ("x", "y")})}
    got = {(r.column_name, r.test): r.failures for r in quality.report({"t": table}, checks).collect()}
    assert got == {("k", "not_null"): 1, ("v", "not_null"): 1, ("k", "unique"): 1, ("v", "accepted_values"): 1}


def test_allowlist_refuses_identifiers(spark):
    frame = spark.createDataFrame([("1", "Ana")], "id string, first_name string")
    with pytest.raises(ValueError, match="first_name"):
        jdbc.project_allowlist(frame, ["id", "first_name"])


def test_jdbc_options():
    source = jdbc.JdbcSource("jdbc:mariadb://db/crm", {"user": "u"})
    options = source.options("contact", "created_at", ("2020-01-01", "2025-01-01"), 16)
    assert options["numPartitions"] == "16" and options["user"] == "u" and options["dbtable"] == "contact"
    with pytest.raises(ValueError):
        source.options("contact", "created_at")


@pytest.mark.parametrize("values", [
    [1, 2, 3, 50, 51, 10**12, None], [Decimal("-1.5"), Decimal("2.25"), Decimal("2.5")], [7, 7], [None], [],
    [dt.date(2024, 1, 1) + dt.timedelta(days=i * i) for i in range(30)] + [None, None],
    [dt.datetime(2024, 1, 1, 5) + dt.timedelta(seconds=i**3) for i in range(60)],
])
@pytest.mark.parametrize("rows_per_read", [1, 3, 1000])
def test_split_reads_take_every_row_once(spark, values, rows_per_read):
    known = [v for v in values if v is not None]
    low, high = (min(known), max(known)) if known else (None, None)
    predicates = jdbc.split_predicates("c", low, high, len(values), rows_per_read)
    assert len(predicates) <= len(values) // rows_per_read + 2 + (not values)
    kind = {dt.date: "date", dt.datetime: "timestamp_ntz", Decimal: "decimal(9,2)"}.get(type(low), "long")
    # Rows that came after the bounds were asked for are read, too.
    more = [] if low is None else [low - (high - low), high + (high - low)]
    frame = spark.createDataFrame([(v,) for v in values + more], f"c {kind}")
    counts = frame.agg(*[F.count_if(F.expr(p)).alias(f"n{i}") for i, p in enumerate(predicates)]).first()
    assert sum(counts) == len(values + more)
    met = frame.select(sum((F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in predicates), F.lit(0)).alias("n"))
    assert met.where("n <> 1").count() == 0


# -- snapshots ----------------------------------------------------------------


def write_day(root, day, columns):
    folder = root / f"dt={day}"
    folder.mkdir(parents=True)
    pq.write_table(pa.table(columns), folder / "data.parquet")


def test_drifting_daily_files(spark, tmp_path):
    day = dt.date(2024, 5, 1)
    write_day(tmp_path, "2024-05-01", {
        "id": pa.array(["1", "2"]), "valor": pa.array([Decimal("10.5000"), Decimal("2.0000")], pa.decimal128(6, 4)),
        "data_recebimento": pa.array([day, day]), "c_qtd": pa.array([1, 2], pa.int64()),
    })
    write_day(tmp_path, "2024-05-02", {
        "id": pa.array(["3", "4"]), "valor": pa.array([Decimal("1000.5000"), None], pa.decimal128(8, 4)),
        "data_recebimento": pa.array([day, None]), "c_qtd": pa.array([1.0, None]), "extra": pa.array(["x", "y"]),
    })
    write_day(tmp_path, "2024-05-03", {
        "id": pa.array(["5", "6"]), "valor": pa.array([None, None], pa.int32()),
        "data_recebimento": pa.array([None, None], pa.int32()), "c_qtd": pa.array([7, 8], pa.int64()),
    })
    target = "id string, valor decimal(13,4), data_recebimento date, c_qtd int, modified_at timestamp_ntz"
    schema = spark.createDataFrame([], target).schema
    frame = snapshots.scan_union_by_name(spark, str(tmp_path), schema, keep_dt=True)
    rows = {r.id: r for r in frame.collect()}
    assert len(rows) == 6
    assert frame.select(*schema.fieldNames()).schema == schema
    assert rows["3"].valor == Decimal("1000.5000") and rows["4"].c_qtd is None and rows["6"].c_qtd == 8
    assert rows["5"].data_recebimento is None and rows["1"].data_recebimento == day
    assert {r.dt.day for r in rows.values()} == {1, 2, 3}


def test_pandas_nanosecond_timestamps(spark, tmp_path):
    stamps = pd.to_datetime(["2024-05-01 10:20:30.123456", None])
    write_day(tmp_path, "2024-05-01", {"id": pa.array(["1", "2"]), "created_at": pa.array(stamps, pa.timestamp("ns"))})
    schema = spark.createDataFrame([], "id string, created_at timestamp_ntz").schema
    rows = {r.id: r.created_at for r in snapshots.scan_union_by_name(spark, str(tmp_path), schema).collect()}
    assert rows == {"1": dt.datetime(2024, 5, 1, 10, 20, 30, 123456), "2": None}


def test_integer_where_a_date_belongs_is_an_error(spark, tmp_path):
    write_day(tmp_path, "2024-05-01", {"id": pa.array(["1"]), "d": pa.array([5], pa.int32())})
    schema = spark.createDataFrame([], "id string, d date").schema
    with pytest.raises(Exception, match="unexpected integer"):
        snapshots.scan_union_by_name(spark, str(tmp_path), schema).collect()


def test_snapshot_fan_out_and_latest(spark, tmp_path):
    path = str(tmp_path / "contact")
    rows = contact_rows(spark, [("a", "x", Decimal(1), Decimal(1), 1, "n" * 60), ("b", "x", Decimal(1), Decimal(1), 1, "n" * 60)])
    for day in (dt.date(2024, 1, 1), dt.date(2024, 1, 2)):
        snapshots.write_snapshot(rows, path, day)
    both = staging.stg_contacts(snapshots.scan_all(spark, path), "s")
    assert both.count() == 4
    assert marts.fct_ai_performance(both).first().total_contacts == 8
    for latest in (snapshots.scan_latest(spark, path), snapshots.latest_snapshot(snapshots.scan_all(spark, path))):
        assert latest.count() == 2
        assert marts.fct_ai_performance(staging.stg_contacts(latest, "s")).first().total_contacts == 2


def test_latest_snapshot_prunes_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    for day in range(1, 4):
        snapshots.write_snapshot(spark.range(3), path, dt.date(2024, 1, day))
    frame = snapshots.scan_latest(spark, path)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and frame.count() == 3


def test_collection_replace_leaves_others(spark, tmp_path):
    path = str(tmp_path / "v")
    base = spark.createDataFrame([(1, [1.0], "a"), (2, [2.0], "b")], "id int, vec array<float>, collection string")
    collections.replace_collections(base, path)
    collections.replace_collections(base.where("collection = 'a'").withColumn("id", F.lit(9)), path)
    assert {(r.id, r.collection) for r in spark.read.parquet(path).collect()} == {(9, "a"), (2, "b")}
    assert collections.read_collection(spark, path, "b").first().id == 2


def test_vector_width_check(spark):
    frame = spark.createDataFrame([([1.0, 2.0],), ([1.0],)], "vec array<float>")
    with pytest.raises(Exception, match="expected width 2"):
        collections.check_width(frame, "vec", 2).collect()


def test_markdown_reader(spark, tmp_path):
    (tmp_path / "a.md").write_text("# Title\n\n- one\n", encoding="utf-8")
    row = documents.scan_markdown(spark, str(tmp_path)).first()
    assert row.text == "# Title\n\n- one\n" and row.source.endswith("a.md")
