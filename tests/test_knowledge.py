"""Chunking, embedding and vector search against brute force."""

import functools
import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from carelake.functions import privacy
from carelake.operators import chunking, signatures, vectors
from carelake.plans import knowledge

WORDS = st.lists(st.sampled_from(["alpha", "be", "ç", "gamma-delta", "x" * 30, "\n", "\n\n", " "]), max_size=120)


@settings(max_examples=300, deadline=None)
@given(WORDS.map(" ".join), st.integers(5, 60), st.integers(0, 4))
def test_split_properties(text, size, overlap):
    chunks = chunking.split_text(text, size, overlap)
    assert all(0 < len(c) <= size and c == c.strip() for c in chunks)
    position = 0
    for chunk in chunks:
        found = text.find(chunk, max(0, position - size))
        assert found >= 0
        position = found + len(chunk)
    assert set("".join(text.split())) == set("".join("".join(chunks).split()))


def test_split_cases():
    assert chunking.split_text("") == []
    assert chunking.split_text("short text") == ["short text"]
    assert chunking.split_text("aaa bbb ccc", 7, 0) == ["aaa bbb", "ccc"]
    assert chunking.split_text("aaa bbb ccc", 8, 4) == ["aaa bbb", "bbb ccc"]
    # No room for an overlap next to the new piece.
    assert chunking.split_text("aaa bbb ccc", 7, 4) == ["aaa bbb", "ccc"]
    assert chunking.split_text("one two\n\nthree", 8, 0) == ["one two", "three"]
    assert chunking.split_text("abcdefghij", 4, 1) == ["abcd", "defg", "ghij"]
    assert chunking.split_text("p1\n\np2\n\np3", 7, 2) == ["p1\n\np2", "p3"]


@pytest.mark.parametrize("size, overlap", [(4, 1), (5, 4), (5, 9), (1, 0), (1, 3), (10, 0)])
def test_characters_are_packed_like_any_pieces(size, overlap):
    for n in range(1, 40):
        text = "".join(chr(97 + i % 26) for i in range(n))
        packed = list(chunking._pack(list(text), size, overlap)) if size > 1 else list(text)
        assert list(chunking._windows(text, size, overlap)) == packed
    assert list(chunking._windows("", size, overlap)) == []


def test_chunks_of_documents(spark):
    docs = spark.createDataFrame([(1, "w " * 600), (2, None), (3, "")], "doc_id long, text string")
    rows = chunking.chunk_documents(docs).collect()
    assert {r.doc_id for r in rows} == {1}
    assert [r.chunk_no for r in rows] == list(range(len(rows)))
    assert [r.chunk for r in rows] == chunking.split_text("w " * 600)


def test_chunks_leave_a_task_in_small_batches(spark):
    """Memory is that of a few chunks, however many a batch of documents comes to; ids may be missing."""
    rows = [(i // 7 if i % 5 else None, i % 7, "é" * (i % 300)) for i in range(2000)]
    batches = list(chunking._batches(iter(rows), 1000))
    assert [tuple(r.values()) for b in batches for r in b.to_pylist()] == rows
    assert max(sum(map(len, b.column(2).to_pylist())) for b in batches) < 1000 + 300
    docs = spark.createDataFrame([(None, "a b"), (2, "w " * 2000)], "doc_id int, text string").coalesce(1)
    known = chunking.chunk_documents(docs)
    assert dict(known.dtypes)["doc_id"] == "bigint" and {r.doc_id for r in known.collect()} == {None, 2}


@pytest.mark.parametrize("length", [1, 49, 50, 51, 499, 500, 501, 950, 951, 2000])
def test_fixed_windows_cover_the_text(spark, length):
    text = "".join(chr(ord("a") + i % 26) for i in range(length - 1)) + "é"
    rows = chunking.chunk_fixed_window(spark.createDataFrame([(1, text)], "doc_id long, text string")).orderBy("chunk_no").collect()
    assert [r.chunk for r in rows] == [text[i * 450 : i * 450 + 500] for i in range(len(rows))]
    assert (len(rows) - 1) * 450 + 500 >= length and (len(rows) == 1 or (len(rows) - 2) * 450 + 500 < length)


def points(spark, n=400, width=8, collections=3, seed=3):
    rng = np.random.default_rng(seed)
    matrix = rng.normal(size=(n, width)).astype(np.float32)
    matrix[10] = matrix[13]
    matrix[20] = 0
    group = np.where(np.arange(n) % 3 == 0, 0, rng.integers(0, collections, n))
    rows = [(i, str(group[i]), matrix[i].tolist()) for i in range(n)]
    return spark.createDataFrame(rows, "id long, collection string, vec array<float>"), matrix.astype(np.float64), group


def brute_force(matrix, group, k):
    norms = np.linalg.norm(matrix, axis=1)
    norms[norms == 0] = 1
    cosine = np.round((matrix / norms[:, None]) @ (matrix / norms[:, None]).T, 9)
    best = {}
    for q in range(len(matrix)):
        inside = np.flatnonzero(group == group[q])
        ranked = sorted(inside, key=lambda c: (-cosine[q, c], c))[:k]
        best[q] = [int(c) for c in ranked]
    return best


@pytest.mark.parametrize("block_rows", [7, 1024])
def test_topk_equals_brute_force(spark, monkeypatch, block_rows):
    """Tiny blocks and several partitions; equal vectors rank by id."""
    monkeypatch.setattr(vectors, "_BLOCK_ROWS", block_rows)
    frame, matrix, group = points(spark)
    got = {}
    for r in vectors.topk_cosine(frame, frame.repartition(5), 3).orderBy("query_id", "place").collect():
        got.setdefault(r.query_id, []).append(r.chunk_id)
    assert got == brute_force(matrix, group, 3)


def test_topk_without_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame, matrix, group = points(spark, n=90)
        got = {(r.query_id, r.place): r.chunk_id for r in vectors.topk_cosine(frame, frame, 2).collect()}
        assert got == {(q, p + 1): c for q, best in brute_force(matrix, group, 2).items() for p, c in enumerate(best)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_one_collection_keeps_all_tasks_busy(spark, monkeypatch):
    """Without a broadcast the blocks of a single collection are dealt over most partitions, each pair once."""
    monkeypatch.setattr(vectors, "_BLOCK_ROWS", 5)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame, _, _ = points(spark, n=400, collections=1)
        pairs = vectors._block_pairs(frame, frame, ["collection"])
        sizes = pairs.select(F.spark_partition_id().alias("p"), F.size("q_ids") * F.size("c_ids")).groupBy("p").sum().collect()
        assert len(sizes) >= 5 and sum(r[2] for r in sizes) == 400 * 400
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_best_places_equal_a_full_sort():
    rng = np.random.default_rng(2)
    scores, ids = rng.integers(-3, 3, (50, 40)) / 3 + rng.normal(size=(50, 40)) * 1e-12, rng.permutation(40) * 10**12
    full = [sorted(range(40), key=lambda c: (-round(row[c], 9), ids[c]))[:7] for row in scores]
    assert (vectors._best_places(scores, ids, 7) == full).all() and vectors._best_places(scores, ids, 99).shape == (50, 40)


def test_blocks_are_compared_a_few_queries_at_once():
    """No matrix holds more, and together they are the whole pair of blocks."""
    rng = np.random.default_rng(6)
    q, c = rng.normal(size=(300, 8)), rng.normal(size=(50, 8))
    q[5] = 0
    columns = [pa.array([list(x)]) for m, first in ((q, 0), (c, 1000)) for x in (range(first, first + len(m)), m.ravel(), np.linalg.norm(m, axis=1))]
    parts = list(vectors._each_pair(pa.RecordBatch.from_arrays(columns, names=vectors._PAIR)))
    assert max(len(scores) for _, _, scores in parts) <= 128 and np.concatenate([ids for ids, _, _ in parts]).tolist() == list(range(300))
    lengths = np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(c, axis=1)
    assert np.allclose(np.concatenate([scores for _, _, scores in parts]), np.divide(q @ c.T, lengths, out=np.zeros_like(lengths), where=lengths > 0))


def test_widths_must_agree(spark):
    frame = spark.createDataFrame([(1, "a", [1.0, 2.0]), (2, "a", [1.0])], "id long, collection string, vec array<float>").coalesce(1)
    with pytest.raises(Exception, match="one width"):
        vectors.topk_cosine(frame, frame).collect()


def test_signature_search(spark):
    """Candidates, their order and what is compared, against plain numpy."""
    frame, matrix, group = points(spark, n=300, width=24)
    signed = signatures.signatures(frame, bands=20, bits=4)
    planes = signatures.hyperplanes(24, 80)
    sides = np.floor(matrix.astype(float) * 2**20) @ planes > 0
    bands = sides.reshape(-1, 20, 4)
    expected = {}
    for q in range(300):
        near = [(int((sides[q] != sides[c]).sum()), c) for c in range(300) if group[c] == group[q] and (bands[q] == bands[c]).all(1).any()]
        expected[q] = sorted(near)[:12]
    got = {}
    for r in signatures.candidates(signed, signed.repartition(5), 12).orderBy("query_id", "differing", "chunk_id").collect():
        got.setdefault(r.query_id, []).append((r.differing, r.chunk_id))
    assert got == expected
    exact = vectors.topk_cosine(frame, frame, 3)
    result = vectors.recall(signatures.topk_signatures(frame, frame, 3, bands=20, bits=4, reranked=12), exact).first()
    assert result.expected == 900 and result.recall > 0.6


def test_signatures_find_near_vectors_among_many(spark):
    """Vectors near one another are found although few buckets are searched."""
    rng = np.random.default_rng(8)
    base = rng.normal(size=(1500, 200))
    near = base + rng.normal(size=base.shape) * 0.1
    side = lambda m, first: spark.createDataFrame([(first + i, "a", row.tolist()) for i, row in enumerate(m)], "id long, collection string, vec array<double>")
    chunks, queries = side(base, 0), side(near, 10_000)
    got = signatures.topk_signatures(queries, chunks, 1, bands=16, bits=10, reranked=4).collect()
    assert sum(r.query_id - 10_000 == r.chunk_id for r in got) > 1490
    sides = [signatures.signatures(x, bands=16, bits=10) for x in (queries, chunks)]
    assert signatures.candidates(*sides, 1500).count() < 0.05 * 1500**2


def test_signatures_meet_once_however_many_bands(spark):
    """Each pair of a collection is compared once, not once for each band that it shares."""
    frame, _, group = points(spark, n=300, width=24)
    signed = signatures.signatures(frame, bands=70, bits=2)
    pairs = signatures._block_pairs(signed.repartition(4), signed.repartition(3), "collection")
    met = pairs.select(F.explode("q_ids").alias("q"), "c_ids").select("q", F.explode("c_ids").alias("c"))
    assert met.count() == met.distinct().count() == sum(a == b for a in group for b in group)


def test_best_candidates_are_folded_over_blocks():
    rng = np.random.default_rng(4)
    q, c = (rng.integers(0, 2, (n, 70, 3)) for n in (30, 400))
    c[:100] = c[100:200]
    q[0] = 1 - c[5]
    words = lambda x: np.packbits(np.pad(x.transpose(0, 2, 1), ((0, 0), (0, 0), (0, 58))), axis=2, bitorder="little").reshape(len(x), -1).view(np.uint64)
    counts = signatures._differing(words(q), words(c), 70)
    unlike = q[:, None] != c[None]
    assert (counts == np.where(unlike.any(3).all(2), signatures._APART, unlike.sum((2, 3)))).all() and counts[0, 5] == signatures._APART
    ids, best = rng.permutation(400), signatures._Best(np.arange(30), 7)
    for start in range(0, 400, 50):
        for first in (0, 15):
            best.add(first, counts[first:first + 15, start:start + 50], ids[start:start + 50])
        rows, found, chunk = best.fold()
        assert len(rows) == 30 * 7
    for i in range(30):
        assert list(zip(found[rows == i], chunk[rows == i])) == sorted((n, c) for n, c in zip(counts[i], ids) if n != signatures._APART)[:7]


def test_odd_vectors(spark):
    schema = "id long, collection string, vec array<float>"
    frame = spark.createDataFrame([(1, "a", [0.0, 0.0]), (2, "a", [1.0, 2.0]), (3, None, [1.0, 2.0]), (4, "a", None), (5, "a", []), (6, "a", [1.0, None])], schema)
    got = {(r.query_id, r.chunk_id): r.relevance for r in signatures.topk_signatures(frame, frame).collect()}
    assert got[1, 1] == 0.0 and got[2, 2] == 1.0 and {a for a, _ in got} == {1, 2}
    assert signatures.topk_signatures(frame.limit(0), frame).count() == 0


def test_single_hit_relevance(spark):
    """A cosine distance of 0.15 is a relevance of 0.85."""
    chunk = [0.85, float(np.sqrt(1 - 0.85**2))]
    chunks = spark.createDataFrame([(7, "docs", chunk)], "id long, collection string, vec array<double>")
    queries = spark.createDataFrame([(1, "docs", [1.0, 0.0])], "id long, collection string, vec array<double>")
    row = vectors.topk_cosine(queries, chunks).first()
    assert (row.chunk_id, row.relevance) == (7, 0.85)
    assert vectors.topk_cosine(queries.withColumn("collection", F.lit("other")), chunks).collect() == []


def test_ingest_search_and_block(spark):
    docs = spark.createDataFrame(
        [(1, "Teeth whitening session price"), (2, "Parking is free for patients"), (3, "Dental implants surgery")],
        "doc_id long, text string",
    )
    chunks = chunking.chunk_documents(docs)
    embedder = knowledge.fit_embedder(chunks)
    stored = knowledge.embed_chunks(chunks, embedder).select(
        F.col("doc_id").alias("id"), F.lit("docs").alias("collection"), F.col("embedding").alias("vec")
    )
    asked = spark.createDataFrame([(100, 0, "price of teeth whitening")], "doc_id long, chunk_no int, chunk string")
    query = knowledge.embed_chunks(asked, embedder).select(
        F.col("doc_id").alias("id"), F.lit("docs").alias("collection"), F.col("embedding").alias("vec")
    )
    asked = query.select("id").union(spark.range(10**6, 10**6 + 1))
    results = knowledge.search_results(vectors.topk_cosine(query, stored, 2), docs.withColumnRenamed("doc_id", "id"), asked)
    first = results.where("query_id = 100").first().results
    assert len(first) == 2 and first[0].texto == "Teeth whitening session price"
    blocks = {r.query_id: r.block for r in knowledge.rag_block(results).collect()}
    assert blocks.keys() == {100, 10**6} and blocks[10**6] == ""
    block = blocks[100]
    assert block.startswith("\nCLINIC KNOWLEDGE BASE CONTEXT") and f"% relevant] {first[0].texto}\n" in block
    empty = results.select("query_id", F.slice("results", 1, 0).alias("results"))
    assert knowledge.rag_block(empty).first().block == ""


def test_own_embedder(spark):
    chunks = spark.createDataFrame([(1, 0, "x")], "doc_id long, chunk_no int, chunk string")
    row = knowledge.embed_chunks(chunks, lambda c: c.withColumn("embedding", F.array(F.lit(1.0)))).first()
    assert row.embedding == [1.0]


def test_embedder_equals_numpy(spark):
    texts = ["Price, price of WHITENING", "the price", "über Größe 42", "", None, "the the the x"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, chunk string")
    dims = [[int(hashlib.md5(t.encode()).hexdigest()[:8], 16) % 16 for t in re.findall(r"[^\W_]+", (text or "").lower())] for text in texts]
    rarity = np.array([np.log(7 / (sum(d in x for x in dims) + 1)) for d in range(16)])
    for got, own in zip(knowledge.fit_embedder(rows, 16)(rows).orderBy("id").collect(), dims):
        weights = np.bincount(own, minlength=16) * rarity
        norm = np.linalg.norm(weights)
        assert np.allclose(got.embedding, weights / norm if norm else weights)


def test_terms_are_hashed_once_for_many_chunks(monkeypatch):
    """What a batch costs follows its different terms, and counts are those of each row, slices and nulls included."""
    rng = random.Random(3)
    rows = [None if i % 50 == 7 else [f"t{rng.randint(0, 30)}" for _ in range(i % 40)] for i in range(3000)]
    hashed = []
    monkeypatch.setattr(knowledge, "_hash", lambda term: hashed.append(term) or int(hashlib.md5(term).hexdigest()[:8], 16))
    parts = list(knowledge._parts(pa.array(rows, pa.list_(pa.string()))))
    counts = np.concatenate([knowledge.term_counts(part, 16) for _, part in parts])
    expected = np.array([np.bincount([int(hashlib.md5(t.encode()).hexdigest()[:8], 16) % 16 for t in row or []], minlength=16) for row in rows])
    assert (counts == expected).all() and len(hashed) <= 31 * len(parts) and max(len(p) for _, p in parts) <= 1024


def test_embedding_adds_in_the_order_of_dimensions(spark):
    """Bit for bit what the SQL's ordered sum gives."""
    texts = [" ".join(f"w{(i * j) % 97}" for j in range(60)) for i in range(30)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, chunk string")
    dims = [[int(hashlib.md5(t.encode()).hexdigest()[:8], 16) % 64 for t in text.split()] for text in texts]
    rarity = [math.log(31 / (sum(d in x for x in dims) + 1)) for d in range(64)]
    for got, own in zip(knowledge.fit_embedder(rows, 64)(rows).orderBy("id").collect(), dims):
        weights = [own.count(d) * rarity[d] for d in range(64)]
        norm = math.sqrt(functools.reduce(lambda total, w: total + w * w, weights, 0.0))
        assert got.embedding == [w / norm if norm else 0.0 for w in weights]


def test_answers_never_show_personal_data(spark):
    texts = ["Whitening costs 300, call +5581999990000", "Whitening is quick", "Parking is free", "CPF 123.456.789-00 whitening whitening"]
    chunks = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, chunk string")
    embedder = knowledge.fit_embedder(chunks)
    known = embedder(chunks).select("id", F.col("chunk").alias("text"), F.col("embedding").alias("vec"), F.lit("c").alias("collection"))
    questions = spark.createDataFrame([(1, "whitening?", "c"), (2, "whitening?", "other"), (3, None, "c")], "id long, text string, collection string")
    blocks = {r.query_id: r.block for r in knowledge.answer_blocks(questions, known, embedder, 3).collect()}
    assert "quick" in blocks[1] and "free" in blocks[1] and "5581" not in blocks[1] and "CPF" not in blocks[1]
    assert blocks[2] == "" and blocks.keys() == {1, 2, 3}


def test_a_batch_hashes_its_terms_once(monkeypatch):
    """Each different term of a whole batch, however many rows are counted at a time; empty and null texts have none."""
    rng = random.Random(5)
    rows = [None if i % 50 == 7 else " ".join(f"t{rng.randint(0, 30)}" for _ in range(i % 40)) for i in range(3000)]
    hashed = []
    monkeypatch.setattr(knowledge, "_hash", lambda term: hashed.append(term) or int(hashlib.md5(term).hexdigest()[:8], 16))
    counts = np.concatenate([counts for _, counts in knowledge._counted(pa.array(rows), 16)])
    expected = [np.bincount([int(hashlib.md5(t.encode()).hexdigest()[:8], 16) % 16 for t in (row or "").split()], minlength=16) for row in rows]
    assert (counts == np.array(expected)).all() and sorted(hashed) == sorted({t.encode() for row in rows if row for t in row.split()})


def test_few_questions_leave_chunks_where_they_are(spark, monkeypatch):
    """No chunk is copied, shuffled or embedded twice; many questions get the same blocks on the grid."""
    texts = [f"price {i} of whitening number w{i * i % 37}" for i in range(60)] + [None, "", "CPF 123.456.789-00 price"]
    chunks = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, chunk string")
    embedder = knowledge.fit_embedder(chunks)
    known = embedder(chunks).select("id", F.col("chunk").alias("text"), F.col("embedding").alias("vec"), F.lit("c").alias("collection"))
    questions = spark.createDataFrame([(1, "w3 price", "c"), (2, "number 40", "c"), (3, None, "c")], "id long, text string, collection string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = knowledge.answer_blocks(questions, known, embedder)
        plan = few._jdf.queryExecution().executedPlan().toString()
        assert "Generate" not in plan and plan.count("ArrowEvalPython") == 1 and plan.count("SortMergeJoin") == 1
        monkeypatch.setattr(knowledge, "_FEW", 2)
        many = knowledge.answer_blocks(questions, known, embedder)
        assert "Generate" in many._jdf.queryExecution().executedPlan().toString()
        assert sorted(few.collect()) == sorted(many.collect()) and all("price" in r.block and "CPF" not in r.block for r in few.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_leaks_are_those_of_the_pattern(values):
    """The quicker test finds what the published pattern finds."""
    rng = random.Random(9)
    texts = ["".join(rng.choice(["1", "23", "456", "456", ".", ".", "-", "+", "x", "7890123"]) for _ in range(rng.randint(1, 9))) for _ in range(3000)]
    texts += ["123.456.789-00", "0123.456.789-001", "123.456.78-00", "+123456789", "+1234567890", "12345678901234", "\u0661" * 12, "", None]
    got = values(texts, privacy.has_leak)
    assert got == [None if t is None else bool(re.search(privacy.LEAK_PATTERN, t, re.ASCII)) for t in texts] and True in got[:3000] and False in got[:3000]
