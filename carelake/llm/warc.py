"""WARC archives: written by Spark, read back along a verified chain of records."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from carelake.session import scratch_path

MIN_REVISIT_BYTES = 0
RECORDS_PER_FILE = 20_000
DATE = "1970-01-01T00:00:00Z"

# Fixed values of the format.
MAGIC = b"WARC/1.1\r\n"
BREAK = b"\r\n\r\n"
GZIP = b"\x1f\x8b"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
ID = "urn:page:"
_FIELD = re.compile(rb"^([A-Za-z-]+): (.*)$")
_LENGTH = re.compile(rb"\r\nContent-Length: ([0-9]+)(?=\r\n)", re.I)


def base32(hex_digest: Column) -> Column:
    """Base32 of a hexadecimal SHA-1: each ten digits are forty bits, eight letters."""
    letters = []
    for group in range(4):
        bits = F.conv(F.substring(hex_digest, 10 * group + 1, 10), 16, 10).cast("long")
        for i in range(8):
            place = F.shiftright(bits, 35 - 5 * i).bitwiseAND(F.lit(31)).cast("int") + 1
            letters.append(F.substring(F.lit(BASE32), place, F.lit(1)))
    return F.concat(*letters)


def with_roles(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Adds digest, bytes and the page that a revisit refers to (null for a response).

    Of equal payloads the largest page_id is the response. Digests, not payloads,
    are grouped; a payload with many copies is joined to its one group row, which
    Spark splits. A null page_id counts as the smallest; when all copies of a
    payload have none, each is a response.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload"),
                        F.sha1(payload.cast("binary")).alias("digest"), F.octet_length(payload).cast("long").alias("bytes"))
    heads = (pages.select(F.col("page_id").cast("long"), F.sha1(payload.cast("binary")).alias("digest"))
             .groupBy("digest").agg(F.max("page_id").alias("head")))
    revisits = (F.col("bytes") >= min_bytes) & F.col("head").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("head"))
    return rows.join(heads, "digest").withColumn("refers_to", F.when(revisits, F.col("head"))).drop("head")


def write_archives(pages: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE,
                   min_bytes: int = MIN_REVISIT_BYTES) -> None:
    """One record per row of (page_id, url, html), html in UTF-8, null as empty.

    Revisits carry the digest and length of the full payload and no block. Spark's
    text writer ends each row with the two line breaks that end a record. Line
    breaks in an address are escaped; a null address has no field. Each file is
    compressed as a whole.
    """
    revisit = F.col("refers_to").isNotNull()
    address = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    name = F.coalesce(F.col("page_id").cast("string"), F.lit("none"))
    text = F.concat(
        F.lit(MAGIC.decode()),
        F.when(revisit, F.lit("WARC-Type: revisit\r\n")).otherwise(F.lit("WARC-Type: response\r\n")),
        F.lit(f"WARC-Record-ID: <{ID}"), name, F.lit(">\r\n"),
        F.when(revisit, F.concat(F.lit(f"WARC-Refers-To: <{ID}"), F.col("refers_to").cast("string"), F.lit(
            ">\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"))).otherwise(F.lit("")),
        F.coalesce(F.concat(F.lit("WARC-Target-URI: "), address, F.lit("\r\n")), F.lit("")),
        F.lit(f"WARC-Date: {DATE}\r\nWARC-Payload-Digest: sha1:"), base32(F.col("digest")),
        F.lit("\r\nX-Payload-Length: "), F.col("bytes").cast("string"),
        F.lit("\r\nContent-Length: "), F.when(revisit, F.lit("0")).otherwise(F.col("bytes").cast("string")),
        F.lit(BREAK.decode()), F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    (with_roles(pages, min_bytes).select(text.alias("value")).write
     .option("lineSep", BREAK.decode()).option("maxRecordsPerFile", records_per_file)
     .option("compression", "gzip").text(path))


def fields_of(head: bytes) -> dict[str, str]:
    found = {}
    for line in head.split(b"\r\n")[1:]:
        match = _FIELD.match(line)
        if match:
            found[match[1].decode().lower()] = match[2].decode("utf-8", "replace")
    return found


def candidates(content: bytes) -> Iterator[tuple[int, int, int]]:
    """(offset, successor, payload offset) of all that looks like a record, inside payloads too.

    A candidate begins with the magic line at the file's start or after a blank
    line, and has a header with a length that stays in the file and ends in a
    blank line. Nothing else of it is read, so whatever a payload holds costs
    one look at its bytes.
    """
    digits, at = len(str(len(content))), content.find(MAGIC)
    while at >= 0:
        if at == 0 or content[at - 4:at] == BREAK:
            end = content.find(BREAK, at)
            given = _LENGTH.findall(content, at, end + 2) if end >= 0 else []
            length = given[-1].lstrip(b"0") or b"0" if given else b""
            if length and len(length) <= digits:
                after = end + 4 + int(length)
                if content[after:after + 4] == BREAK:
                    yield at, after + 4, end + 4
            # No other record can begin before this header's end.
            at = content.find(MAGIC, at + 1) if end < 0 else content.find(MAGIC, end)
        else:
            at = content.find(MAGIC, at + 1)


def reachable(offsets: np.ndarray, successors: np.ndarray) -> np.ndarray:
    """Which candidates of one file a chain of records from offset 0 reaches, by pointer jumping.

    Each round lets every reached record mark what lies 2**k records on and
    doubles all jumps, so n records need log2(n) rounds.
    """
    n = len(offsets)
    place = np.minimum(np.searchsorted(offsets, successors), n)
    jump = np.append(np.where(np.append(offsets, -1)[place] == successors, place, n), n)
    reached = np.append(offsets == 0, False)
    for _ in range(max(1, int(n).bit_length())):
        reached[jump[reached]] = True
        jump = jump[jump]
    return reached[:n]


RECORDS = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("offset", T.LongType()), T.StructField("successor", T.LongType()),
    T.StructField("page", T.StringType()), T.StructField("url", T.StringType()), T.StructField("record_type", T.StringType()),
    T.StructField("refers", T.StringType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_digest", T.StringType())])


def records(content: bytes) -> Iterator[tuple]:
    """The records of one archive: offset, successor, page, url, type, what it refers to, length and digest of the payload.

    Candidates are offsets and successors only; pointer jumping from the file's
    start says which are records, and those alone are parsed and hashed.
    """
    found = np.array(list(candidates(content)), np.int64).reshape(-1, 3)
    for offset, after, start in found[reachable(found[:, 0], found[:, 1])].tolist():
        fields = fields_of(content[offset:start - 4])
        kind = fields.get("warc-type", "")
        stated = fields.get("x-payload-length", "0")
        if kind == "revisit":
            size = int(stated) if stated.isascii() and stated.isdecimal() and len(stated) < 19 else None
            digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
        else:
            payload = memoryview(content)[start:after - 4]
            size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
        yield (offset, after, fields.get("warc-record-id", ""), fields.get("warc-target-uri"), kind, fields.get("warc-refers-to"), size, digest)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives in a folder, in no order, with digests taken from the payloads read.

    A task reads a file, follows its chain from the start and emits what is on
    it. A revisit's length is what its record states, null if that is no number.
    """
    kinds = pa.schema([(f.name, pa.int64() if f.dataType == T.LongType() else pa.string()) for f in RECORDS])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path_, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                content = value.as_py()
                if content[:2] == GZIP:
                    content = gzip.decompress(content)
                rows = [dict(zip(RECORDS.names, (path_, *r))) for r in records(content)]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(scan, RECORDS)


def archive_round_trip(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write (page_id, url, html) as archives in the shared folder and read them back, one row per page.

    page_id, payload_bytes, payload_digest, record_type, refers_to. Null html is
    an empty payload, and empty payloads are equal like any others. Repeated rows
    have a record each. Extra columns are ignored; an empty table gives no rows.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "archives")
    write_archives(pages, path, min_bytes=min_bytes)
    number = lambda c: F.regexp_extract(c, f"{ID}(-?[0-9]+)>", 1)
    return read_archives(spark, path).select(
        F.expr("try_cast(nullif(regexp_extract(page, 'urn:page:(-?[0-9]+)>', 1), '') as bigint)").alias("page_id"),
        "payload_bytes", "payload_digest", "record_type",
        F.when(F.col("record_type") == "revisit", number(F.col("refers")).cast("long")).alias("refers_to"))
