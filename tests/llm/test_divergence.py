"""The audit against a plain computation with dense vectors."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from carelake.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, part int, value string, term int"


def expected(rows, least=30, top=50):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)
        groups[lang or ""].add(source or "")
        counts[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]

        def share(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p = {s: share(counts[lang, s]) for s in sources}
        q = share(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(items) if part == "pair" or i < top]
    return Counter(out)


def got(spark, rows, **options):
    frame = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(4)
    return Counter(tuple(r) for r in divergence.audit(frame, **options).select("lang", "source", "part", "item", "value", "rank").collect())


def odd_rows():
    rng = random.Random(5)
    names = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)] + ["été", "Été", "日本", "ß", "don", "t"]
    rows = []
    for i in range(900):
        lang, source = rng.choice(["en", "en", "de", None, ""]), rng.choice(["a", "a", "a", "b", "é", "z", None, ""])
        first = rng.randrange(200)
        words = [rng.choice(names[first:first + 90] + names[-6:]).capitalize() for _ in range(rng.randrange(40))]
        rows.append((rng.choice([i, None, 7]), rng.choice([" ", "\n", "1", "'"]).join(words) if words else None, lang, source))
    rows += [(i, "the same row", "en", "a") for i in range(40)] + [(1, None, "fr", "x"), (2, "alone", "fr", "y"), (3, "", "fr", None)]
    return rows + [(4, "long term " * 400_000 + "x" * 3_000_000, "en", "long"), (5, "only once", "xx", "single")]


def test_audit(spark):
    assert got(spark, odd_rows()) == expected(odd_rows())


def test_many_sources_few_terms(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice("abcdefghij") * 2 for _ in range(rng.randrange(6))), "en", f"s{i % 150}") for i in range(600)]
    assert got(spark, rows, least=20, top=3) == expected(rows, 20, 3)


def test_partial_counts_add_up(monkeypatch):
    """Whatever a task holds before it hands on, every group shows and the sums are the same."""
    rows = [(lang, source, text) for _, text, lang, source in odd_rows()[:300]]
    batches = [pa.RecordBatch.from_arrays([pa.array([r[i] or "" for r in rows[at:at + 70]], pa.string()) for i in range(3)], names=["lang", "source", "text"])
               for at in range(0, 300, 70)]
    sums = []
    for held in (1, 500, 10**6):
        monkeypatch.setattr(divergence, "HELD_TERMS", held)
        total = Counter()
        for batch in divergence.count_terms(iter(batches)):
            for r in batch.to_pylist():
                total[r["lang"], r["source"], r["term"], "n"] += r["n"]
                total[r["lang"], r["source"], r["term"], "docs"] += r["docs"]
        sums.append(dict(total))
    assert sums[0] == sums[1] == sums[2] and {k[:2] for k in sums[0]} == {(r[0] or "", r[1] or "") for r in rows}


def test_no_documents(spark):
    assert not got(spark, [])


def test_block_sums_equal_dense_sums():
    rng = np.random.default_rng(3)
    for rows_a, rows_b, width, filled in ((5, 3, 7, 0.3), (8, 8, 8, 0.0), (1, 6, 1, 1.0), (13, 16, 11, 0.05)):
        side = 16
        a, b = (np.zeros((side, side), np.int64) for _ in "ab")
        for block, rows in ((a, rows_a), (b, rows_b)):
            block[:rows, :width] = rng.integers(5, 50, (rows, width)) * (rng.random((rows, width)) < filled)
        empty_a, empty_b = rng.integers(1, 5, rows_a), rng.integers(1, 5, rows_b)
        dense = lambda x, empty: np.where(x[:len(empty), :width] > 0, x[:len(empty), :width], empty[:, None])
        one, other = dense(a, empty_a), dense(b, empty_b)
        assert (divergence.block_sums(a, b, empty_a, empty_b, width, False) == np.abs(one[:, None] - other[None]).sum(2)).all()
        later = np.triu_indices(rows_a, 1)
        assert (divergence.block_sums(a, a, empty_a, empty_a, width, True)[later] == np.abs(one[:, None] - one[None]).sum(2)[later]).all()


def test_terms_of_long_texts_are_not_cut(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 7)
    text = "Abc déf, ghi-jklmnopqrstu v  "
    assert sum(divergence.pieces_of_terms(text.encode()), []) == ["abc".encode(), "déf".encode(), b"ghi", b"jklmnopqrstu", b"v"]
