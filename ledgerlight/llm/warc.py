"""WARC archives: one gzip member per record, and a sequential reader that checks what it reads.

Writing: every page becomes one record of its own gzip member. Records with
equal payloads are stored once: the one with the largest id is the
``response``, the others are ``revisit`` records that refer to it and carry
the HTTP header only. Spark's text writer puts the members into the archive
files, so any file system Spark can write will do and a lost executor only
repeats its task. That writer ends each row with a separator; the separator is
a zero byte and stands for the last byte of the member (the top byte of its
size field, zero below 16 MiB). A larger member is followed by an empty member
that lacks its last byte, so every file is a plain sequence of members.

Reading: archives are inflated in small slices, member after member; a
record's block is framed by its ``Content-Length`` and both digests are
computed again. Memory is one archive file plus one record.

Defined results: a null payload is empty; a null url gives no target; a null
id reads back as null and is never the response of a group that has an id;
rows that share the largest id of their group are all responses; an empty
table gives no records.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import materialise

DATE = "1970-01-01T00:00:00Z"
LEVEL = 4
SLICE = 1 << 16
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = ("page_id long, record_type string, refers_to long, target_uri string, payload_bytes long, "
          "payload_digest string, digests_ok boolean, payload binary")


def _member(data: bytes) -> bytes:
    c = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def sha1_32(data: bytes) -> str:
    """Base-32 SHA-1, the digest form of WARC headers."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _urn(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record's bytes, headers to the closing blank lines."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            b"Content-Length: %d\r\n\r\n" % len(payload))
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~"))
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {PROFILE}"]
    head += [f"WARC-Payload-Digest: sha1:{sha1_32(payload)}", f"WARC-Block-Digest: sha1:{sha1_32(block)}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _members(ids: pd.Series, urls: pd.Series, payloads: pd.Series, refers: pd.Series) -> pd.Series:
    out = []
    for i, u, p, r in zip(ids, urls, payloads, refers):
        m = _member(record(int(i) if i is not None else None, u, p, int(r) if r is not None else None))
        out.append(m[:-1] if m[-1] == 0 else m + _member(b"")[:-1])
    return pd.Series(out, dtype=object)


def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html",
                   min_bytes: int = 0) -> None:
    """Write ``pages`` as archive files under ``path``.

    Payloads of at least ``min_bytes`` that occur more than once are stored
    once. Only digests and ids are grouped; the payloads join the table of
    repeated digests, which Spark broadcasts below its threshold and else
    shuffles (AQE may split a digest that many pages share).
    """
    p = pages.select(F.col(key).alias("id"), F.col(url).alias("url"),
                     F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload")) \
        .withColumn("digest", F.sha1("payload"))
    same = materialise(p.where(F.octet_length("payload") >= min_bytes).groupBy("digest")
                       .agg(F.count("*").alias("n"), F.max("id").alias("keeper"))
                       .where("n > 1").select("digest", "keeper"), "payloads")
    refers = F.when(F.col("id").eqNullSafe(F.col("keeper")), None).otherwise(F.col("keeper"))
    member = pandas_udf(_members, "binary")(F.col("id").cast("string"), "url", "payload", refers.cast("string"))
    p.join(same, "digest", "left").select(member.cast("string").alias("value")) \
        .write.option("lineSep", "\x00").text(path)


def _headers(data: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in data.decode().split("\r\n")[1:])}


def members(content: bytes) -> Iterator[bytes]:
    """The members of an archive one by one, inflated slice by slice; empty members are skipped."""
    at = 0
    while at < len(content):
        inflate, out = zlib.decompressobj(31), bytearray()
        while not inflate.eof:
            piece = content[at:at + SLICE]
            if not piece:
                raise EOFError("archive ends within a member")
            out += inflate.decompress(piece)
            at += len(piece) - len(inflate.unused_data)
        if out:
            yield bytes(out)


def parse(data: bytes) -> tuple:
    """The fields of :data:`RECORD` for one record."""
    end = data.index(b"\r\n\r\n")
    head = _headers(data[:end])
    size = int(head["content-length"])
    block = data[end + 4:end + 4 + size]
    if len(block) != size or data[end + 4 + size:] != b"\r\n\r\n":
        raise ValueError(f"record {head.get('warc-record-id')} is not framed by its Content-Length")
    cut = block.index(b"\r\n\r\n")
    payload = block[cut + 4:]
    stated = head["warc-payload-digest"].removeprefix("sha1:")
    number = lambda urn: None if urn is None or urn.endswith(":none>") else int(urn.rpartition(":")[2][:-1])
    ok = head["warc-block-digest"] == f"sha1:{sha1_32(block)}"
    if head["warc-type"] == "response":
        digest = sha1_32(payload)
        n, ok = len(payload), ok and digest == stated
    else:
        digest, n = stated, int(_headers(block[:cut])["content-length"])
    return (number(head["warc-record-id"]), head["warc-type"], number(head.get("warc-refers-to")),
            head.get("warc-target-uri"), n, digest, ok, payload)


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """One row per record of the archives under ``path``, columns of :data:`RECORD`.

    Without ``payload`` that column is null; lengths and digests are still
    those of the payload that was read. A record whose digest differs has
    ``digests_ok`` false; a broken member or frame fails the job.
    """
    names = [x.split()[0] for x in RECORD.split(", ")]

    def read(batches):
        def frame(rows):
            df = pd.DataFrame(rows, columns=names)
            return df.astype({"page_id": "Int64", "refers_to": "Int64"})

        for b in batches:
            for content in b["content"]:
                rows, held = [], 0
                for m in members(content):
                    row = parse(m)
                    rows.append(row if payload else (*row[:-1], None))
                    held += len(row[-1]) if payload else 0
                    if held > 1 << 23 or len(rows) >= 5000:
                        yield frame(rows)
                        rows, held = [], 0
                if rows:
                    yield frame(rows)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInPandas(read, RECORD)
