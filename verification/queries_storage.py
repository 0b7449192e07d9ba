"""Sinks and scans, knowledge search, and streams.

Writers put their output under the session's shared scratch folder and the
query reads it back.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from carelake import schemas
from carelake.operators import chunking, signatures, vectors
from carelake.plans import knowledge, marts
from carelake.session import scratch_path, stored
from carelake.sources import collections, documents, jdbc, snapshots, tables, written
from carelake.streaming import sessions as session_stream, upsert
from verification.prelude import with_tables
from verification.queries_models import (
    BILLING_COLUMNS, FEATURES_SQL, LTV_COLUMNS, RUN_DATE, billing, contacts_raw, stg_billing,
)
from verification.queries_records import MERGED_COLUMNS, MERGED_SQL, live_contacts
from verification.registry import query, shown
from verification.sql_knowledge import CHUNKS, EMBEDDINGS, LEAKS

def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


DAYS = [dt.date(2024, 12, 30), dt.date(2024, 12, 31), dt.date(2025, 1, 1)]

# -- snapshots ---------------------------------------------------------------


def _write_two_days(spark, d) -> str:
    """The same table exported on two days; the first day is then exported again."""
    path = scratch_path(spark, "c_recebimento")
    rows = billing(spark, d)
    snapshots.write_snapshot(rows.where(F.col("valor") > 0), path, DAYS[0])
    snapshots.write_snapshot(rows.withColumn("status", F.upper("status")), path, DAYS[1])
    snapshots.write_snapshot(rows, path, DAYS[0])
    return path


_TWO_DAYS_SQL = with_tables("billing") + f""", snaps as (
    select *, date '{DAYS[0]}' as dt from billing
    union all select * replace (upper(status) as status), date '{DAYS[1]}' from billing)
"""


@query("sink_bronze_snapshot", _TWO_DAYS_SQL + shown("snaps", {**BILLING_COLUMNS, "dt": "t"}))
def sink_bronze_snapshot(spark, d):
    return snapshots.scan_all(spark, _write_two_days(spark, d))


@query("scan_bronze_all", _TWO_DAYS_SQL + """
select cast(dt as varchar) as dt, status, count(*) as n_rows, cast(sum(valor) as double) as total from snaps group by dt, status""")
def scan_bronze_all(spark, d):
    rows = snapshots.scan_all(spark, _write_two_days(spark, d))
    return rows.groupBy("dt", "status").agg(F.count("*").alias("n_rows"), F.sum("valor").alias("total"))


@query("latest_snapshot", _TWO_DAYS_SQL + shown("snaps", {**BILLING_COLUMNS, "dt": "t"})
       + " where dt = (select max(dt) from snaps)")
def latest_snapshot(spark, d):
    return snapshots.scan_latest(spark, _write_two_days(spark, d))


def _write_drifted(spark, d) -> str:
    """Three days whose stored types disagree, as untyped exports produce them."""
    path = scratch_path(spark, "drifted")
    rows = billing(spark, d)
    days = [
        rows.withColumn("valor", F.col("valor").cast("decimal(12,4)")),
        rows.withColumns({"valor": F.col("valor").cast("double"), "extra": F.lit("x")}).drop("modified_at"),
        rows.withColumns({c: F.lit(None).cast("int") for c in ("valor", "data_recebimento", "created_at")}),
    ]
    for day, frame in zip(DAYS, days):
        frame.write.mode("overwrite").parquet(f"{path}/dt={day}")
    return path


@query("scan_bronze_union_by_name", with_tables("billing") + f""", snaps as (
    select *, date '{DAYS[0]}' as dt from billing
    union all select * replace (cast(null as timestamp) as modified_at), date '{DAYS[1]}' from billing
    union all select * replace (cast(null as decimal(13,4)) as valor, cast(null as date) as data_recebimento,
                                cast(null as timestamp) as created_at), date '{DAYS[2]}' from billing)
""" + shown("snaps", {**BILLING_COLUMNS, "dt": "t"}))
def scan_bronze_union_by_name(spark, d):
    return snapshots.scan_union_by_name(spark, _write_drifted(spark, d), schemas.BILLING_BRONZE, keep_dt=True)


@query("sink_silver_parquet", FEATURES_SQL)
def sink_silver_parquet(spark, d):
    rows = marts.silver_features(billing(spark, d), RUN_DATE)
    return written.write_partition(rows, scratch_path(spark, "silver"), "dt", str(RUN_DATE)).drop("dt")


@query("materialize_table", with_tables("fct_ltv") + shown("fct_ltv", LTV_COLUMNS))
def materialize_table(spark, d):
    return written.materialize_table(marts.fct_ltv(stg_billing(spark, d), RUN_DATE), scratch_path(spark, "fct_ltv"))


@query("src_jdbc_rag_audit", """
select 'collection-' || label as uuid, 'clinic_' || label as name,
       '{"vectors": ' || count(*) || '}' as cmetadata from embeddings group by label""")
def src_jdbc_rag_audit(spark, d):
    """Collection metadata, one row per collection of the vector table."""
    stored = tables.vectors_source(spark, d).groupBy("collection").agg(F.count("*").alias("n"))
    source = stored.select(
        F.concat(F.lit("collection-"), "collection").alias("uuid"),
        F.concat(F.lit("clinic_"), "collection").alias("name"),
        F.concat(F.lit('{"vectors": '), F.col("n").cast("string"), F.lit("}")).alias("cmetadata"),
    )
    return jdbc.export_rag_audit(source)


@query("sink_contact_upsert", MERGED_SQL)
def sink_contact_upsert(spark, d):
    """The summaries logged as one batch, merged into a new version, and that version read back."""
    root = scratch_path(spark, "contacts")
    upsert.create(live_contacts(spark, d), root)
    upsert.write_batch(tables.summary_json(spark, d), 0, root)
    upsert.compact(spark, root)
    upsert.prune(spark, root, versions=1)
    return upsert.newest_version(spark, root).select(*MERGED_COLUMNS)


# -- knowledge -----------------------------------------------------------------


@query("scan_knowledge_docs", """
select doc_id, source, length(text) as chars, md5(text) as digest from documents where text is not null
union all select page_id, url, length(html), md5(html) from pages where html is not null""")
def scan_knowledge_docs(spark, d):
    pages = tables.table(spark, d, "pages").select(
        F.col("page_id").alias("doc_id"), F.col("url").alias("source"), F.col("html").alias("text")
    )
    sources = documents.scan_table_documents(tables.table(spark, d, "documents")).union(
        documents.scan_table_documents(pages).select("doc_id", "source", "text")
    )
    return sources.select("doc_id", "source", F.length("text").alias("chars"), F.md5("text").alias("digest"))


def _chunks(spark, d):
    return chunking.chunk_documents(documents.scan_table_documents(tables.table(spark, d, "documents")))


@query("chunk_documents", f"with recursive {CHUNKS} select doc_id, chunk_no, chunk from chunks")
def chunk_documents(spark, d):
    return _chunks(spark, d)


@query("chunk_fixed_window", """
select doc_id, step as chunk_no, substr(text, step * 450 + 1, 500) as chunk
from (select doc_id, text, unnest(range(greatest(cast(ceil((length(text) - 50) / 450.0) as bigint), 1))) as step
      from documents where length(text) > 0)""")
def chunk_fixed_window(spark, d):
    return chunking.chunk_fixed_window(tables.table(spark, d, "documents"))


_CHUNK_ID = 1_000_000
_TEXTS = f"texts as (select 'chunk' as kind, doc_id * {_CHUNK_ID} + chunk_no as id, chunk from chunks)"


@query("embed_chunks", f"""with recursive {CHUNKS}, {_TEXTS}, {EMBEDDINGS}
select id // {_CHUNK_ID} as doc_id, id % {_CHUNK_ID} as chunk_no, array_to_string(list_transform(vec, lambda x: cast(round(x * 1e6) as bigint)), ',') as embedding
from embedded""")
def embed_chunks(spark, d):
    """The vectors, in millionths."""
    chunks = stored(_chunks(spark, d), "chunks")
    embedded = knowledge.embed_chunks(chunks, knowledge.fit_embedder(chunks))
    # Most are zero, and rounding a number costs more than testing it.
    millionths = F.transform("embedding", lambda x: F.when(x == 0, F.lit(0).cast("bigint")).otherwise(F.round(x * 1e6).cast("bigint")))
    return embedded.select("doc_id", "chunk_no", F.array_join(millionths, ",").alias("embedding"))


@query("answer_blocks", f"""with recursive {CHUNKS}, texts as (
    select 'chunk' as kind, doc_id * {_CHUNK_ID} + chunk_no as id, chunk from chunks union all select 'question', item_id, text from benchmark),
{EMBEDDINGS},
safe as (select id, vec, chunk as text from embedded join texts using (kind, id) where kind = 'chunk' and not {LEAKS.replace('text', 'chunk')}),
s as (select q.id as query_id, c.id as chunk_id, c.text, list_dot_product(q.vec, c.vec) as cosine from embedded q, safe c where q.kind = 'question'),
ranked as (select *, row_number() over (partition by query_id order by round(cosine, 9) desc, chunk_id) as place from s)
select query_id, {_literal(knowledge.BLOCK_HEAD)} || string_agg('  - [' || cast(round_even(round(cosine, 2) * 100, 0) as integer) || '% relevant] ' || text,
    chr(10) order by place) || {_literal(knowledge.BLOCK_TAIL)} as block
from ranked where place <= 3 group by query_id""")
def answer_blocks(spark, d):
    """Documents ingested; then each benchmark text as a question, answered by a block of context in one call."""
    chunks = stored(_chunks(spark, d), "chunks")
    embedder = knowledge.fit_embedder(chunks)
    # Only the search reads the vectors, and once, so they need not be stored.
    known = knowledge.embed_chunks(chunks, embedder).select(
        (F.col("doc_id") * _CHUNK_ID + F.col("chunk_no")).alias("id"), F.col("chunk").alias("text"), F.col("embedding").alias("vec"),
        F.lit("docs").alias("collection"))
    questions = tables.table(spark, d, "benchmark").select(F.col("item_id").alias("id"), "text", F.lit("docs").alias("collection"))
    return knowledge.answer_blocks(questions, known, embedder)


def _vectors(spark, d):
    return tables.vectors_source(spark, d).select(
        F.col("vec_id").alias("id"), "collection", F.col("embedding").alias("vec")
    )


def _stored_collections(spark, d) -> str:
    path = scratch_path(spark, "vectors")
    collections.replace_collections(_vectors(spark, d), path)
    return path


_VECTOR_SQL = "md5(list_aggregate(embedding, 'string_agg', ','))"


@query("sink_vector_collection", """
select cast(label as varchar) as collection, vec_id as id, len(embedding) as width,
       list_sum(list_transform(embedding, lambda x: x::double)) as total from embeddings""")
def sink_vector_collection(spark, d):
    """All collections stored, then replaced once more; nothing is doubled."""
    path = _stored_collections(spark, d)
    collections.replace_collections(_vectors(spark, d), path)
    stored = spark.read.parquet(path)
    total = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return stored.select(
        F.col("collection").cast("string").alias("collection"), "id", F.size("vec").alias("width"), total.alias("total")
    )


@query("filter_collection", "select vec_id as id, len(embedding) as width from embeddings where label = 3")
def filter_collection(spark, d):
    stored = collections.read_collection(spark, _stored_collections(spark, d), "3")
    return stored.select("id", F.size("vec").alias("width"))


_SCORES_SQL = """
with s as (
    select q.vec_id as query_id, c.vec_id as chunk_id,
           list_cosine_similarity(q.embedding::double[], c.embedding::double[]) as cosine
    from embeddings q join embeddings c on q.label = c.label),
ranked as (
    select *, row_number() over (partition by query_id order by round(cosine, 9) desc, chunk_id) as place from s)
"""


@query("topk_cosine", _SCORES_SQL
       + "select query_id, chunk_id, round(cosine, 2) as relevance, place from ranked where place <= 3")
def topk_cosine(spark, d):
    """Every vector as a query against its own collection."""
    points = _vectors(spark, d)
    return vectors.topk_cosine(points, points, 3).drop("cosine")


@query("cross_join_queries_chunks", _SCORES_SQL + """
select query_id, count(*) as n_chunks, round(max(cosine), 6) as best, round(min(cosine), 6) as worst,
       round(avg(cosine), 6) as mean from s group by query_id""")
def cross_join_queries_chunks(spark, d):
    points = _vectors(spark, d)
    scores = vectors.score_summary(points, points)
    return scores.select("query_id", "n_chunks", *[F.round(c, 6).alias(c) for c in ("best", "worst", "mean")])


_SIGNED_SQL = f"""
with planes as (select p, list_transform(range(64), lambda i: case when (cast('0x' || substr(md5('{signatures.SEED}|' || p || '|0'), 1 + i // 4, 1) as int)
    >> (3 - i % 4)) & 1 = 1 then 1.0::double else -1.0::double end) as plane from range({signatures.BANDS * signatures.BAND_BITS}) t(p)),
v as (select vec_id, label, embedding::double[] as vec, list_transform(embedding, lambda x: floor(x::double * {signatures.UNIT})) as whole from embeddings),
sides as (select vec_id, label, p, case when list_dot_product(whole, plane) > 0 then 1 else 0 end as bit from v, planes),
words as (select vec_id, list(word order by w) as words from (
    select vec_id, p // 32 as w, sum(bit << (p % 32)) as word from sides group by all) group by vec_id),
bands as (select vec_id, label, p // {signatures.BAND_BITS} as band, sum(bit << (p % {signatures.BAND_BITS})) as code from sides group by all),
shared as (select distinct q.vec_id as query_id, c.vec_id as chunk_id from bands q join bands c on q.label = c.label and q.band = c.band and q.code = c.code),
counted as (select query_id, chunk_id, list_sum(list_transform(range(1, len(a.words) + 1),
    lambda i: bit_count(xor(a.words[i]::bigint, b.words[i]::bigint)))) as differing
    from shared join words a on a.vec_id = query_id join words b on b.vec_id = chunk_id),
sieved as (select * from (select *, row_number() over (partition by query_id order by differing, chunk_id) as n from counted) where n <= {signatures.RERANKED}),
compared as (select query_id, chunk_id, list_cosine_similarity(q.vec, c.vec) as cosine
    from sieved join v q on q.vec_id = query_id join v c on c.vec_id = chunk_id),
near as (select * from (select *, row_number() over (partition by query_id order by round(cosine, 9) desc, chunk_id) as place from compared) where place <= 3)
"""


@query("topk_ann_lsh", _SIGNED_SQL + "select query_id, chunk_id, round(cosine, 2) as relevance, place from near")
def topk_ann_lsh(spark, d):
    points = _vectors(spark, d)
    return signatures.topk_signatures(points, points, 3).drop("cosine")


@query("topk_ann_recall", _SIGNED_SQL + """, s as (
    select q.vec_id as query_id, c.vec_id as chunk_id, list_cosine_similarity(q.vec, c.vec) as cosine from v q join v c on q.label = c.label),
exact as (select * from (select *, row_number() over (partition by query_id order by round(cosine, 9) desc, chunk_id) as place from s) where place <= 3)
select (select count(*) from compared) as compared_pairs, (select count(*) from s) as all_pairs,
    (select count(*) from exact join near using (query_id, chunk_id)) as found, (select count(*) from exact) as expected""")
def topk_ann_recall(spark, d):
    """How many pairs of vectors the approximate search compares, and how many of the exact neighbours it finds."""
    points = _vectors(spark, d)
    signed = signatures.signatures(points)
    pairs = stored(signatures.candidates(signed, signed), "candidates")
    near = vectors.keep_topk(signatures.cosines(pairs, points, points), 3)
    found = vectors.recall(near, vectors.topk_cosine(points, points, 3)).select("found", "expected")
    sizes = points.groupBy("collection").count().agg(F.expr("sum(count * count)").alias("all_pairs"))
    return pairs.agg(F.count("*").alias("compared_pairs")).join(sizes).join(found)


_LINES_SQL = _SCORES_SQL + """, hits as (
    select query_id, string_agg('  - [' || cast(round_even(round(cosine, 2) * 100, 0) as integer) || '% relevant] ' || d.text,
                                chr(10) order by place) as lines
    from ranked join documents d on d.doc_id = chunk_id where place <= 3 group by query_id),
lined as (select vec_id as query_id, coalesce(lines, '') as lines from embeddings left join hits on query_id = vec_id)
"""


def _results(spark, d):
    points = _vectors(spark, d)
    texts = tables.table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text")
    return knowledge.search_results(vectors.topk_cosine(points, points, 3), texts, points)


@query("rag_lines", _LINES_SQL + "select query_id, lines from lined")
def rag_lines(spark, d):
    return knowledge.rag_lines(_results(spark, d))


@query("rag_block", _LINES_SQL + f"""
select query_id, case when lines = '' then '' else
    {_literal(knowledge.BLOCK_HEAD)} || lines || {_literal(knowledge.BLOCK_TAIL)} end as block from lined""")
def rag_block(spark, d):
    return knowledge.rag_block(_results(spark, d))


# -- streams ---------------------------------------------------------------------


def _event_stream(spark, d):
    return documents.message_stream(spark, d, schemas.MESSAGE_EVENT, "events.parquet")


@query("src_message_stream", with_tables("messages")
       + "select event_id, user_id, phone, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as ts, text from messages")
def src_message_stream(spark, d):
    path = scratch_path(spark, "messages")
    stream = tables.chat_columns(_event_stream(spark, d))
    session_stream.run_to_parquet(stream, path, f"{path}-checkpoint").awaitTermination()
    return spark.read.parquet(path)


@query("conversation_sessions_stream", with_tables("messages") + """, flagged as (
    select *, case when ts - lag(ts) over (partition by user_id order by ts) <= interval 1 hour then 0 else 1 end as opens
    from messages),
numbered as (select *, sum(opens) over (partition by user_id order by ts range unbounded preceding) as session from flagged)
select user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') as session_start,
       strftime(max(ts) + interval 1 hour, '%Y-%m-%d %H:%M:%S.%f') as session_end, count(*) as n_messages,
       string_agg(text, chr(10) order by ts, event_id) as text
from numbered group by user_id, session
having max(ts) + interval 1 hour <= (select max(ts) - interval 1 minute from messages)""")
def conversation_sessions_stream(spark, d):
    """Sessions closed by the watermark; the newest stay open and are not emitted."""
    path = scratch_path(spark, "sessions")
    messages = tables.chat_columns(_event_stream(spark, d))
    stream = session_stream.conversation_sessions_stream(messages, "user_id", "ts", "event_id", "text", "1 hour")
    session_stream.run_to_parquet(stream, path, f"{path}-checkpoint").awaitTermination()
    return spark.read.parquet(path)


@query("conversation_messages_stream", with_tables("messages") + """, flagged as (
    select *, case when ts - lag(ts) over (partition by user_id order by ts) <= interval 1 hour then 0 else 1 end as opens
    from messages),
numbered as (select *, sum(opens) over (partition by user_id order by ts range unbounded preceding) as session from flagged)
select cast(user_id as varchar) as user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as ts, cast(event_id as varchar) as event_id, text,
       strftime(min(ts) over (partition by user_id, session), '%Y-%m-%d %H:%M:%S.%f') as session_start,
       row_number() over (partition by user_id, session order by ts, cast(event_id as varchar)) as position, cast(null as varchar) as reason
from numbered where epoch_us(ts) <= (select epoch_ms(max(ts)) - 60000 from messages) * 1000""")
def conversation_messages_stream(spark, d):
    """Every message with its session, as the watermark passes it; nothing is gathered by session."""
    path = scratch_path(spark, "session-messages")
    stream = session_stream.session_messages_stream(
        tables.chat_columns(_event_stream(spark, d)), "user_id", "ts", "event_id", "text", 3600)
    with session_stream.rocks_state(spark):
        session_stream.run_to_parquet(stream, path, f"{path}-checkpoint").awaitTermination()
    return spark.read.parquet(path)


@query("stream_upsert", MERGED_SQL)
def stream_upsert(spark, d):
    """Updates streamed into the log, then merged with the contacts' version."""
    root = scratch_path(spark, "streamed-contacts")
    upsert.create(live_contacts(spark, d), root)
    upsert.stream_upsert(tables.summary_columns(_event_stream(spark, d)), root).awaitTermination()
    return upsert.current_contacts(spark, root).select(*MERGED_COLUMNS)
