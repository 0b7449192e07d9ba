"""The manifest against a plain computation of the same trees."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest

from carelake.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, pos int, path string, digest string"
RESULT = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(digests, fan):
    """The root, and of each leaf the (left, right) siblings level by level."""
    paths, at = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        for path, place in zip(paths, at):
            first = place // fan * fan
            path.append(("".join(digests[first:place]), "".join(digests[place + 1:first + fan])))
        digests = [sha("".join(digests[i:i + fan])) for i in range(0, len(digests), fan)]
        at = [place // fan for place in at]
    return digests[0], paths


def expected(rows, fan=8):
    groups = defaultdict(list)
    for doc_id, source, lang, n_chars, text in rows:
        small = text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        changed = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
        groups[lang].append((doc_id, leaf(doc_id, source, lang, n_chars, text),
                             leaf(doc_id, source, lang, n_chars, small if changed else text)))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    for lang in langs:
        groups[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    below = {lang: tree([r[1] for r in groups[lang]], fan) for lang in langs}
    root, tops = tree([below[lang][0] for lang in langs], fan) if langs else (None, [])
    out = Counter()
    for lang, top in zip(langs, tops):
        for (doc_id, own, changed), path in zip(groups[lang], below[lang][1]):
            folded = changed
            for left, right in path + top:
                folded = sha(left + folded + right)
            out[doc_id, own, below[lang][0], root, sha("".join(a + b for a, b in path + top)), folded, folded == root] += 1
    return out


def got(spark, rows, **options):
    frame = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA).repartition(5)
    return Counter(tuple(r) for r in merkle.manifest(frame, **options).select(*RESULT).collect())


def odd_rows():
    rows = [(i, f"src{i % 3}", "en", i, f"Text {i} ÄB") for i in range(150)]
    rows += [(i, None, "de", None, None) for i in range(200, 209)] + [(300, "", "", 0, "")]
    rows += [(None, "a", "en", 1, "Null Id"), (None, "a", "en", 1, "Null Id"), (7, "b", "en", 1, "same id"), (7, "src1", "en", 7, "Text 7 ÄB")]
    rows += [(400 + i, "a", None, 2, "No Language") for i in range(8)] + [(500, "a", "é", 3, "ALONE " * 200_000)]
    return rows + [(600 + i, "s", f"lang{i}", 1, "A") for i in range(12)]


def test_manifest(spark):
    assert got(spark, odd_rows()) == expected(odd_rows())


@pytest.mark.parametrize("n", [0, 1, 65])
def test_sizes_about_full_runs(spark, n):
    rows = [(i, "s", "en", i, "Aa") for i in range(n)]
    assert got(spark, rows) == expected(rows)


def test_other_fan(spark):
    assert got(spark, odd_rows()[:40], fan=3) == expected(odd_rows()[:40], fan=3)


def test_tampering_shows(spark):
    rows = odd_rows()
    result = expected(rows)
    tampered = [r for r in rows if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] and r[4] != r[4].lower()]
    assert sum(n for r, n in result.items() if not r[6]) == len(tampered) > 10
