"""The pipeline's stages on a small table."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from carelake.llm.catalog import ORACLES, QUERIES


def test_all_operators_are_registered():
    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


def test_stages_keep_the_columns_and_pass_on_what_they_keep(spark, odd_documents, no_documents):
    for start in (odd_documents, no_documents):
        docs = start.withColumnRenamed("spans", "n_words")
        counts = []
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, docs, "")
            assert kept.columns == docs.columns
            docs = spark.createDataFrame(kept.collect(), kept.schema)
            counts.append(docs.count())
        pieces = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
        assert sum(r.start == 0 for r in pieces) == counts[-1]
        if start is odd_documents:
            assert counts[1] < counts[0] and {r.doc_id for r in docs.collect()} >= {4, 20}


def test_stages_bear_clashing_columns(spark, odd_documents):
    """Columns named like those that the operators use come through every stage with their values."""
    names = ["_doc", "_copy", "_row", "_nth", "_times", "_", "component", "size", "kept text"]
    docs = odd_documents.drop("spans").select("*", *[(F.length("text") * i).alias(n) for i, n in enumerate(names)])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, "")
        assert kept.columns == docs.columns
        docs = spark.createDataFrame(kept.collect(), kept.schema)
    assert docs.count() > 5 and docs.where("_copy <> `_doc` + `_row` / 2 or size <> 7 * `_copy`").count() == 0


def test_mixing_takes_the_same_of_tied_rows(spark):
    """Rows that share doc_id, source and size, in another order each time."""
    rows = [(None, f"w{i:03d} x y z", "a") for i in range(40)] + [(1, f"v{i:03d} x y z", "b") for i in range(40)] + [(2, "u " * 20, "c")]
    once = []
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(seed + 2)
        once.append(sorted(map(str, corpus_pipeline.mix_sources(spark, docs, "").collect())))
    assert once[0] == once[1]


def test_near_copies_link_by_five_words_from_four_fifths_on(spark):
    """The stage against brute force; some pairs reach 0.8 on five words, but not 0.85 on four."""
    rng, data = random.Random(9), []
    for i in range(12):
        base = [f"w{rng.randrange(500)}" for _ in range(100)]
        data.append((i, " ".join(base)))
        for j in range(3):
            near = list(base)
            for at in rng.sample(range(5, 95), j + 1):
                near[at] = "other"
            data.append((100 + 10 * i + j, " ".join(near)))
    sets = {k: [{tuple(w[i:i + k]) for i in range(len(w) - k + 1)} for w in (t.split() for _, t in data)] for k in (4, 5)}

    def links(k, percent):
        s = sets[k]
        return {(a, b) for a in range(len(s)) for b in range(a) if 100 * len(s[a] & s[b]) >= percent * len(s[a] | s[b])}

    assert links(5, 80) - links(4, 85)
    lowest = [d for d, _ in data]
    for _ in data:
        for a, b in links(5, 80):
            lowest[a] = lowest[b] = min(lowest[a], lowest[b])
    docs = spark.createDataFrame(data, "doc_id long, text string")
    kept = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()}
    assert kept == set(lowest)
