"""Inputs made to mislead: texts whose simple hashes agree, fake archive records, pages with stray tags."""

import base64
import hashlib
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from carelake.llm import packing, page_text, parity_join, substring_dedup, suffix_dedup, token_frames, warc

WORD_FILE, BYTE_FILE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def complements(a, b, n):
    """A Thue-Morse sequence of two signs and its complement: equal modulo 2**64 for polynomials of every odd base."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return [a if x else b for x in bits], [b if x else a for x in bits]


@pytest.fixture(scope="module")
def twins(spark):
    one, other = ("".join(x) for x in complements("a", "b", 1024))
    three, four = ("".join(x) for x in complements(";", ">", 512))
    words = [" ".join(x) for x in complements("river", "stone", 4096)]
    rows = list(enumerate([one, other, three, four, *words]))
    return rows, spark.createDataFrame(rows, "doc_id long, text string")


def test_ids_of_twins(twins):
    rows, frame = twins
    for path, end, got in (
            (WORD_FILE, 1, {r.doc_id: r.ids_crc32 for r in token_frames.token_index(frame, WORD_FILE).collect()}),):
        tokenizer = Tokenizer.from_file(path)
        assert got == {i: zlib.crc32(np.array(tokenizer.encode(t, add_special_tokens=False).ids + [end], "<u4").tobytes()) for i, t in rows}
    tokenizer = Tokenizer.from_file(BYTE_FILE)
    pieces = {}
    for r in packing.pack(frame, BYTE_FILE).collect():
        pieces.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32))
    for i, text in rows:
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [0], "<u4")
        assert sorted(pieces[i]) == [(a, n, zlib.crc32(ids[a:a + n].tobytes())) for a, n, _ in sorted(pieces[i])]


def test_twins_are_not_near(twins):
    rows, frame = twins
    got = {r.doc_id: r.component_id for r in parity_join.link_components(frame.where("doc_id < 4")).collect()}
    assert got == {i: i for i in range(4)}


def test_twins_lose_what_they_share_only(twins):
    rows, frame = twins
    starts = Counter()
    data = [t.encode() for _, t in rows]
    for text in data:
        starts.update(text[i:i + 400] for i in range(len(text) - 399))
    expected = {}
    for (i, _), text in zip(rows, data):
        gone = np.zeros(len(text), bool)
        for at in range(len(text) - 399):
            if starts[text[at:at + 400]] > 1:
                gone[at:at + 400] = True
        expected[i] = (int(gone.sum()), hashlib.sha256(bytes(np.frombuffer(text, np.uint8)[~gone])).hexdigest())
    got = {r.doc_id: (r.n_removed, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in suffix_dedup.remove_repeats(frame).collect()}
    assert got == expected


def test_repeated_windows_of_twins(twins):
    rows, frame = twins
    first, expected = {}, {}
    for i, text in rows:
        words = text.split(" ")
        gone = set()
        for at in range(len(words) - 49):
            if first.setdefault(tuple(words[at:at + 50]), i) < i:
                gone.update(range(at, at + 50))
        expected[i] = len(gone)
    assert {r.doc_id: r.n_removed for r in substring_dedup.remove_repeats(frame).collect()} == expected


FAKE = "\r\n\r\nWARC/1.1\r\nWARC-Type: revisit\r\nX-Payload-Length: many\r\nContent-Length: {}\r\n\r\n{}\r\n\r\n"


def test_archives_of_hostile_pages(spark):
    htmls = [FAKE.format(0, ""), FAKE.format("9" * 5000, ""), FAKE.format("0" * 300 + "5", "abcde"), FAKE.format("9" * 18, ""), "x" + FAKE.format(3, "abc") * 3,
             "\r\n\r\nWARC/1.1\r\n" * 50, "\r\n\r\nWARC/1.1\r\nContent-Length: 1\r\n", FAKE.format("١", "a")]
    pages = spark.createDataFrame([(i, f"http://x/{i}", h) for i, h in enumerate(htmls)], "page_id long, url string, html string")
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type) for r in warc.archive_round_trip(pages).collect()}
    assert got == {i: (len(h.encode()), base64.b32encode(hashlib.sha1(h.encode()).digest()).decode(), "response") for i, h in enumerate(htmls)}


def test_fake_records_take_linear_time():
    """A megabyte of records inside a payload, each of which claims all that follows."""
    fake = b"WARC/1.1\r\nContent-Length: %07d\r\n\r\n"
    n = 25_000
    width = len(fake % 0) + 4
    inside = b"".join(b"\r\n\r\n" + fake % (width * (n - i - 1)) for i in range(n)) + b"\r\n\r\n"
    content = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n" % len(inside) + inside + b"\r\n\r\n"
    began = time.time()
    assert len(list(warc.candidates(content))) > n // 2
    assert [(r[0], r[6]) for r in warc.records(content)] == [(0, len(inside))]
    assert time.time() - began < 10


@pytest.mark.parametrize("page, text", [
    ("<article><p>Body text.</p></article><section class='comments'><h2>Comments</h2><article class='comment'><p>Nice post</p></article></section>", "Body text."),
    ("<article>Body.</article><div id=respond><article>one</article><article>two</article></div>", "Body."),
    ("<div class=related><article>teaser</article></div><main>Body.</main>", "Body."),
    ("<div class=post>Body.</div><div class=comments><article class=comment>one</article></div>", "Body."),
    ("<div class=has-sidebar><article class='post'>Body.</article></div>", "Body."),
    ("<article class='post with-comments'>Body.</article>", "Body."),
])
def test_comments_are_no_main_text(page, text):
    assert " ".join(t for t, _ in page_text.Blocks().of(page)) == text


@pytest.mark.parametrize("unit", ["<div>", "<b>", "<p>x"])
def test_stray_tags_take_linear_time(unit):
    page = "<article>start" + unit * 100_000 + "</i>" * 100_000 + "</section>" * 20_000 + "end"
    began = time.time()
    blocks = page_text.Blocks().of(page)
    assert blocks[0][0].startswith("start") and blocks[-1][0].endswith("end") and time.time() - began < 15
