"""Each operator against a plain computation over a small table of odd rows."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from carelake.llm import (fingerprints, mixing, packing, page_text, parity_join, quality_rules, substring_dedup,
                          suffix_dedup, suffix_sort, token_frames, warc)

WORD_FILE, BYTE_FILE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def words(text):
    return re.findall(r"[^ \t-\r]+", text or "")


def mixed_words(seed, n):
    return " ".join(f"w{x}" for x in np.random.default_rng(seed).integers(0, 400, n))


def rows(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


def by_multiset(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.select(*columns).collect())


def test_warc_round_trip(spark):
    trap = "x\r\n\r\nWARC/1.1\r\nContent-Length: 2\r\n\r\nab\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n"
    data = [(1, "http://a\n/", trap), (2, None, trap), (3, "u", None), (4, "u", ""), (5, "u", "é" * 3000), (5, "u", "é" * 3000),
            (None, "u", trap), (None, "v", "alone")]
    pages = spark.createDataFrame([(*d, 1) for d in data], "page_id long, url string, html string, digest int")
    heads = {}
    for page, _, html in data:
        heads[html or ""] = max(heads.get(html or "", -1), -1 if page is None else page)
    expected = Counter()
    for page, _, html in data:
        payload, head = (html or "").encode(), heads[html or ""]
        revisit = head >= 0 and page != head
        expected[page, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(),
                 "revisit" if revisit else "response", head if revisit else None] += 1
    got = warc.archive_round_trip(pages)
    assert by_multiset(got, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == expected
    assert warc.archive_round_trip(pages.limit(0)).count() == 0


def test_chain_rejects_records_inside_payloads():
    inner = b"WARC/1.1\r\nContent-Length: 1\r\n\r\nx\r\n\r\n"
    block = b"\r\n\r\n" + inner
    outer = b"WARC/1.1\r\nContent-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"
    found = list(warc.candidates(outer + inner))
    assert len(found) == 3
    kept = warc.reachable(np.array([f[0] for f in found]), np.array([f[1] for f in found]))
    assert [f[0] for f, k in zip(found, kept) if k] == [0, len(outer)]


def test_token_files(spark, odd_documents, no_documents):
    tokenizer = Tokenizer.from_file(WORD_FILE)
    got = token_frames.token_index(odd_documents, WORD_FILE).collect()
    expected, start = [], 0
    for doc_id, text in sorted(rows(odd_documents), key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [1], "<u4")
        expected.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    key = lambda r: r[1]
    assert sorted([(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got], key=key) == sorted(expected, key=key)
    assert token_frames.token_index(no_documents, WORD_FILE).count() == 0


def test_frames_can_be_read_alone_and_damage_is_found():
    builder = token_frames.FileBuilder(3, 2, 10, 3)
    parts = [p for i in range(9) for p in builder.add(i, np.arange(i + 1, dtype="<u4"))] + list(builder.finish())
    content = b"".join(p + token_frames.SEPARATOR for p in parts)
    assert [(d, ids.tolist()) for d, ids in token_frames.read_documents(content, {2, 7})] == [
        (2, [0, 1, 2]), (7, list(range(8)))]
    broken = bytearray(content)
    broken[8] ^= 255
    with pytest.raises(ValueError):
        list(token_frames.read_documents(bytes(broken)))


def test_page_text(spark):
    shared = "read our great weekly letter and tell all your friends"
    data = [
        (1, "http://a.b/1", "<html><nav>menu</nav><article><h1>T&amp;i</h1><p><b>one\n two<br>x<p>y&nbsp;z<div class='ad'>buy</div>"
                            "<div id=comments>me</div></article><footer>f"),
        (2, "http://a.b/2", f"<body><div>{shared}</div><p>first page here</p></body>"),
        (3, "http://a.b/3", f"<body><div>{shared}</div><p>second page here</p></body>"),
        (4, "http://c.d/3", f"<body><div>{shared}</div></body>"), (5, None, None), (6, "x", "<script>if (a<b) '</p>'</script>ok<p cla")]
    pages = spark.createDataFrame([(*d, 1) for d in data], "page_id long, url string, html string, article int")
    got = {r.page_id: (r.text, r.n_chars) for r in page_text.main_text(pages).collect()}
    texts = {1: "T&i one two x y z", 2: "first page here", 3: "second page here", 4: shared, 5: "", 6: "ok"}
    assert got == {k: (v, len(v)) for k, v in texts.items()}
    assert page_text.main_text(pages.limit(0)).count() == 0


@pytest.mark.parametrize("page, text", [
    ("<div class='has-sidebar'><article>whole text</article><p>teaser</div>", "whole text"),
    ("<section id=with-comments><div class='nav-fixed'><div><main><p>whole<p>text</main></div>x</div></section>", "whole text"),
    ("<main><div class='single-related'><article>whole text<div class=ad>buy</div></article></div></main>", "whole text"),
    ("<article>story<div class=comments><article>me</article></div></article>", "story"),
    ("<div class=has-sidebar><aside><article>no</article></aside><dialog><article>no</article></dialog></div>", ""),
    ("<nav class=nav-fixed><article>no</article></nav><footer><div class=x><main>no</main></div></footer>", ""),
    ("<div class=has-sidebar hidden><article>no</article></div><div role=dialog><article>no</article></div>", ""),
    ("<div hidden><div class=has-sidebar><article>no</article></div></div><div class=sidebar>no</div>ok", "ok"),
])
def test_an_article_outranks_the_class_of_its_wrapper(page, text):
    blocks = page_text.Blocks().of(page)
    assert " ".join(t for t, _ in blocks) == text


def test_page_text_of_large_hosts(spark):
    """A host over the size of a group: what two of its pages share goes, whatever groups they are in."""
    notice, menu, least = mixed_words(1000, 12), mixed_words(1001, 9), 8
    texts = [f"{mixed_words(i, 30)} {notice if i % 13 == 0 else ''} {mixed_words(100 + i, 5)} {menu if i in (3, 38) else ''}" for i in range(40)]
    data = [(i, "http://a.b/x", f"<body><p>{t}</p><div>é\u00a0{i}</div>") for i, t in enumerate([*texts, texts[5], "short"])]
    streams = {i: words(t) + ["é", str(i)] for i, t in enumerate([*texts, texts[5], "short"])}
    pages_of = {}
    for i, w in streams.items():
        for at in range(len(w) - least + 1):
            pages_of.setdefault(tuple(w[at:at + least]), set()).add(i)
    expected = {}
    for i, w in streams.items():
        gone = {j for at in range(len(w) - least + 1) if len(pages_of[tuple(w[at:at + least])]) > 1 for j in range(at, at + least)}
        expected[i] = " ".join(x for j, x in enumerate(w) if j not in gone)
    pages = spark.createDataFrame(data + [(99, "http://c.d/", f"<p>{notice}")], "page_id long, url string, html string")
    for host_pages in (4, 256):
        got = {r.page_id: r.text for r in page_text.main_text(pages, host_pages).collect()}
        assert got == expected | {99: notice}


def test_mixing(odd_documents, no_documents):
    mixed = mixing.mix(odd_documents).collect()
    total, sizes = sum(r.size for r in mixed), {}
    assert Counter((r.doc_id, r.size) for r in mixed) == Counter((d, len(words(t))) for d, t in rows(odd_documents))
    for r in mixed:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights, targets, open_ = {s: i % 3 + 1 for i, s in enumerate(order)}, {}, set(order)
    while True:
        share = (total - sum(targets.values())) / max(1, sum(weights[s] for s in open_))
        over = [s for s in open_ if share * weights[s] > 3 * sizes[s]]
        if not over:
            break
        for s in over:
            targets[s] = 3 * sizes[s]
            open_.discard(s)
    targets |= {s: share * weights[s] for s in open_}
    for r in mixed:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, targets[r.source], abs_tol=1e-6)
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.size * r.times
    for s in order:
        taken = sum(r.taken for r in mixed if r.source == s)
        assert abs(taken - targets[s]) <= 2 * max(r.size for r in mixed if r.source == s)
    assert by_multiset(mixing.mix(odd_documents), "doc_id", "taken") == Counter((r.doc_id, r.taken) for r in mixed)
    assert mixing.mix(no_documents).count() == 0


@pytest.mark.parametrize("length, gram", [(400, 100), (30, 8)])
def test_suffix_dedup(odd_documents, no_documents, length, gram):
    data = [(d, t.encode()) for d, t in rows(odd_documents)]
    seen = Counter(t[i:i + length] for _, t in data for i in range(len(t) - length + 1))
    expected = Counter()
    for d, t in data:
        gone = np.zeros(len(t) + length, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = True
        gone = gone[:len(t)]
        spans = int((gone & ~np.concatenate([[False], gone])[:len(t)]).sum())
        expected[d, len(t), int(gone.sum()), spans, bytes(np.frombuffer(t, np.uint8)[~gone])] += 1
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))
                  for r in suffix_dedup.remove_repeats(odd_documents, length, gram).collect())
    assert got == expected
    assert suffix_dedup.remove_repeats(no_documents).count() == 0


def test_repeated_pattern_gives_few_rows(spark, monkeypatch):
    texts = [f"{hashlib.sha256(b'a%d' % i).hexdigest()} {'Osas ' * 300}{hashlib.sha256(b'b%d' % i).hexdigest()}" for i in range(6)]
    texts += ["ab" * 700 + "c" + "ab" * 700, "x" * 1000, "x" * 400, "x" * 399, "long line of one text, told again\n" * 60]
    seen = Counter(t[i:i + 400] for t in texts for i in range(len(t) - 399))
    expected = {}
    for doc_id, text in enumerate(texts):
        gone = np.zeros(len(text), bool)
        for i in range(len(text) - 399):
            if seen[text[i:i + 400]] > 1:
                gone[i:i + 400] = True
        expected[doc_id] = (int(gone.sum()), bytes(np.frombuffer(text.encode(), np.uint8)[~gone]))
    counts, kept = {}, suffix_dedup.stored

    def counting(df, name):
        out = kept(df, name)
        counts[name] = out.count()
        return out

    monkeypatch.setattr(suffix_dedup, "stored", counting)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: (r.n_removed, bytes(r.kept)) for r in suffix_dedup.remove_repeats(frame).collect()} == expected
    assert counts["live-byte-runs"] < 20 * len(texts)


def test_crowded_anchors_give_the_same(odd_documents, monkeypatch):
    usual = by_multiset(suffix_dedup.remove_repeats(odd_documents, 30, 8), "doc_id", "kept")
    monkeypatch.setattr(suffix_dedup, "CROWD", 1)
    assert by_multiset(suffix_dedup.remove_repeats(odd_documents, 30, 8), "doc_id", "kept") == usual


def test_suffix_sort_equals_plain_sort():
    rng = np.random.default_rng(5)
    data = rng.integers(97, 99, 400).astype(np.uint8)
    starts = np.sort(rng.choice(390, 120, replace=False))
    lengths, groups = rng.integers(0, 10, 120), np.sort(rng.integers(0, 4, 120))
    order = suffix_sort.sort_suffixes(suffix_sort.Extensions(data, "byte"), starts, lengths, groups)
    plain = sorted(range(120), key=lambda i: (groups[i], data[starts[i]:starts[i] + lengths[i]].tobytes()))
    assert order.tolist() == plain


def test_packing(odd_documents, no_documents):
    tokenizer = Tokenizer.from_file(BYTE_FILE)
    got = packing.pack(odd_documents, BYTE_FILE, group_documents=6).collect()
    pieces = Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got)
    expected = Counter()
    for doc_id, text in rows(odd_documents):
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [0], "<u4")
        for at in range(0, len(ids), 1024):
            part = ids[at:at + 1024]
            expected[doc_id, at, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    assert pieces == expected
    filled = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled.get(r.sequence_id, 0)
        filled[r.sequence_id] = r.offset + r.length
    assert max(filled.values()) <= 1024
    assert packing.pack(no_documents, BYTE_FILE).count() == 0


def test_first_fit_decreasing_equals_a_scan():
    sizes = np.random.default_rng(1).integers(1, 60, 300)
    bins, offsets = packing.first_fit_decreasing(sizes, 100)
    room, expected = [], {}
    for i in np.argsort(-sizes, kind="stable"):
        at = next((b for b, left in enumerate(room) if left >= sizes[i]), len(room))
        if at == len(room):
            room.append(100)
        expected[i] = (at, 100 - room[at])
        room[at] -= sizes[i]
    assert {i: (bins[i], offsets[i]) for i in range(300)} == expected


@pytest.mark.parametrize("window, gram", [(50, 14), (5, 2)])
def test_substring_dedup(odd_documents, no_documents, window, gram):
    data = [(d, words(t)) for d, t in rows(odd_documents)]
    number = lambda d: 1 << 63 if d is None else d
    first = {}
    for d, w in data:
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            first[key] = min(first.get(key, number(d)), number(d))
    expected = Counter()
    for d, w in data:
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < number(d):
                gone.update(range(i, i + window))
        expected[d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone), "clash"] += 1
    got = substring_dedup.remove_repeats(odd_documents.withColumnRenamed("spans", "extra"), window, gram)
    assert by_multiset(got, "doc_id", "n_words", "n_removed", "kept_text", "extra") == expected
    assert substring_dedup.remove_repeats(no_documents).count() == 0


def test_substring_dedup_takes_every_place_of_a_run(spark):
    """A run that the head document, or another row with its id, has again loses the same windows there."""
    passage, mid, tail = mixed_words(50, 60), mixed_words(51, 40), mixed_words(52, 20)
    again = f"{mixed_words(53, 40)} {passage} {tail} {mixed_words(54, 90)} {mixed_words(55, 33)} {passage} {tail}"
    data = [(1, f"{mid} {passage} {mixed_words(56, 30)}"), (5, again), (5, f"{mixed_words(57, 25)} {passage} {tail}"),
            (None, f"{mid} {mixed_words(58, 45)} {mid} {mid} {mixed_words(58, 45)}"), (None, f"{mixed_words(58, 45)} {mixed_words(59, 30)}")]
    for window, gram in [(50, 14), (20, 5), (5, 2)]:
        first, expected = {}, Counter()
        number = lambda d: 1 << 63 if d is None else d
        for d, t in data:
            w = words(t)
            for i in range(len(w) - window + 1):
                key = tuple(w[i:i + window])
                first[key] = min(first.get(key, number(d)), number(d))
        for d, t in data:
            w = words(t)
            gone = {j for i in range(len(w) - window + 1) if first[tuple(w[i:i + window])] < number(d) for j in range(i, i + window)}
            expected[d, len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)] += 1
        got = substring_dedup.remove_repeats(spark.createDataFrame(data, "doc_id long, text string"), window, gram)
        assert by_multiset(got, "doc_id", "n_removed", "kept_text") == expected


def test_quality_rules(odd_documents, no_documents):
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                  for r in quality_rules.apply_rules(odd_documents, ["doc_id", "spans"]).collect())
    expected = Counter()
    for d, t in rows(odd_documents):
        w = words(t)
        lines = [x for x in t.split("\n") if words(x)]
        places = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
        again = {j for i in range(len(w) - 7) if places[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
        expected[d, len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(again),
                 len(w) < 20 or 100 * len(again) > 30 * len(w)] += 1
    assert got == expected
    assert quality_rules.apply_rules(no_documents, ["doc_id"]).count() == 0


def test_fingerprints(odd_documents, no_documents):
    got = fingerprints.compare_edited(odd_documents).collect()
    data = sorted(rows(odd_documents), key=lambda r: (-math.inf if r[0] is None else r[0], r[1]), reverse=True)
    expected = Counter()
    for i, (d, t) in enumerate(data):
        following, half = data[(i + 1) % len(data)][1], len(t) // 2
        expected[d, len(t), hashlib.sha256((t[:len(t) - half] + following[:half]).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == expected
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    prints = {r.doc_id: r.fingerprint for r in got}
    assert prints[10] == prints[4] and prints[3] == prints[8] == "" and prints[30] != prints[10]
    assert fingerprints.compare_edited(no_documents).count() == 0


def test_parity_join(odd_documents, no_documents):
    data = rows(odd_documents)
    sets = []
    for _, t in data:
        w = [x.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for x in words(t)]
        sets.append({tuple(w[i:i + 4]) for i in range(max(1, len(w) - 3))} if w else set())
    number, lowest = [1 << 63 if d is None else d for d, _ in data], [None] * len(data)
    for i in range(len(data)):
        reached, todo = {i}, [i]
        while todo:
            x = todo.pop()
            for y in range(len(data)):
                if y not in reached and sets[x] and 100 * len(sets[x] & sets[y]) >= 85 * len(sets[x] | sets[y]):
                    reached.add(y)
                    todo.append(y)
        least = min(number[j] for j in reached)
        lowest[i] = None if least == 1 << 63 else least
    expected = Counter((d, len(s), low) for (d, _), s, low in zip(data, sets, lowest))
    assert by_multiset(parity_join.link_components(odd_documents), "doc_id", "n_shingles", "component_id") == expected
    assert parity_join.link_components(no_documents).count() == 0


def test_parity_join_of_texts_that_share_an_id(spark):
    """Each set is verified by its own text, though others have the same or no doc_id."""
    texts = [mixed_words(seed, 80) for seed in range(12)]
    near = [t + " end" for t in texts]
    data = [(1, t) for t in texts] + [(20 + i, t) for i, t in enumerate(near)]
    got = parity_join.link_components(spark.createDataFrame(data, "doc_id long, text string"))
    assert by_multiset(got, "doc_id", "component_id") == Counter([(d, 1) for d, _ in data])
    data = [(None, t) for t in texts + near] + [(None, texts[0])]
    kept = [r.text for r in parity_join.one_of_each(spark.createDataFrame(data, "doc_id long, text string")).collect()]
    assert sorted(t.removesuffix(" end") for t in kept) == sorted(texts)
