"""Fingerprints against the same hashes computed in Python; containment and merging of sketches."""

import hashlib
import random
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from carelake.llm import fingerprints

BOUND = -(1 << 63) + (1 << 64) // 8


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def hash_of(first, *more):
    """Spark's xxhash64 of a text, or of whole numbers one after the other."""
    h = 42
    for x in (first, *more):
        h = xxhash.xxh64(x.encode() if isinstance(x, str) else x.to_bytes(8, "little", signed=True), seed=h).intdigest()
    return signed(h)


def sketch_of(text, bound=BOUND):
    words = [hash_of(w) for w in re.findall(r"[^ \t-\r]+", text or "")]
    if not words:
        return []
    if len(words) < 5:
        return sorted(x for x in [hash_of(*words)] if x < bound)
    for by in (1, 2, 1):
        words = [hash_of(a, b) for a, b in zip(words, words[by:])]
    return sorted({x for x in words if x < bound})


def text_of(sketch):
    return "".join(f"{x & (1 << 64) - 1:016X}" for x in sketch)


def likeness(a, b):
    shared = len(set(a) & set(b))
    return 1.0 if not a and not b else shared / (len(a) + len(b) - shared)


@pytest.mark.parametrize("partitions", [1, 8])
def test_all_columns(spark, odd_documents, partitions):
    more = spark.createDataFrame([(1000 + i, " ".join(random.Random(i).choices(["tree", "lamp", "Ünï", "x", "\n"], k=i)), "a", "c") for i in range(60)],
                                 odd_documents.schema)
    docs = odd_documents.unionByName(more).unionByName(more.where("doc_id < 1003"))
    rows = sorted([(r.doc_id, r.text or "") for r in docs.collect()], key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()), reverse=True)
    expected = Counter()
    for (doc_id, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        own, other, following = sketch_of(text), sketch_of(edited), sketch_of(after)
        expected[doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), text_of(own), text_of(other),
                 likeness(own, other), likeness(own, following)] += 1
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = fingerprints.compare_edited(docs)
        assert Counter(tuple(r) for r in got.collect()) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)


def test_containment_and_merged_sketches(spark):
    """A sketch of a part tells how much of it a much longer text holds; the union of sketches is the whole's."""
    words = [f"w{random.Random(3).randrange(10**9) + i}" for i in range(8000)]
    long, part = " ".join(words), " ".join(words[1000:1800])
    mixed = " ".join(words[2000:2400] + [f"v{i}" for i in range(400)])
    frame = spark.createDataFrame([(long, part, mixed, " ".join(words[:4000]), " ".join(words[3996:]))], "long string, part string, mixed string, head string, tail string")
    for name in frame.columns:
        frame = fingerprints.sketch(frame, name, f"s_{name}")
    row = frame.select(
        fingerprints.containment(F.col("s_part"), F.col("s_long")).alias("whole"), fingerprints.containment(F.col("s_mixed"), F.col("s_long")).alias("half"),
        fingerprints.containment(F.array().cast("array<bigint>"), F.col("s_long")).alias("none"),
        (F.array_sort(F.array_union("s_head", "s_tail")) == F.col("s_long")).alias("merged"),
        fingerprints.likeness(F.col("s_part"), F.col("s_long")).alias("like")).first()
    assert row.whole == 1.0 and row.none == 1.0 and row.merged and abs(row.half - 0.5) < 0.15 and row.like < 0.2
