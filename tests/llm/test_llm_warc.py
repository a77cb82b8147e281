import gzip
import hashlib
import base64
import os
import zlib

import pytest

from ledgerlight.llm import warc as w
from ledgerlight.llm.common import shared_path

SCHEMA = "page_id long, url string, html string, id long, payload string, digest string"


def b32(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_round_trip(spark):
    big = "".join(chr(97 + i * i % 26) for i in range(1000)) * 18_000       # a record above 16 MiB
    rows = [(1, "http://a/é b\r\nX: y", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "u", None), (4, "u", ""), (None, "u", "<p>é</p>"),
            (None, "v", "alone"), (5, "u", big), (6, "u", "x"), (7, "u", "x"), (7, "u2", "x"), (8, "u", "\r\n\r\n\x00")]
    df = spark.createDataFrame([(*r, 1, "p", "d") for r in rows], SCHEMA)
    path = shared_path(spark, "test-warc")
    w.write_archives(df.repartition(3), path)
    got = w.read_archives(spark, path).collect()
    assert len(got) == len(rows) and all(r["digests_ok"] for r in got)
    keeper = {}
    for k, _, h in rows:
        if k is not None:
            keeper[h or ""] = max(keeper.get(h or "", k), k)
    want = sorted((repr(k), len((h or "").encode()), b32((h or "").encode()),
                   "response" if k == keeper.get(h or "") else "revisit",
                   repr(None if k == keeper.get(h or "") else keeper[h or ""])) for k, _, h in rows)
    assert sorted((repr(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], repr(r["refers_to"])) for r in got) == want
    for r in got:
        if r["record_type"] == "response":
            assert b32(r["payload"]) == r["payload_digest"] and len(r["payload"]) == r["payload_bytes"]
    # any gzip reader sees the same archive
    files = [f"{path.removeprefix('file:')}/{f}" for f in os.listdir(path.removeprefix("file:")) if f.startswith("part-")]
    text = b"".join(gzip.open(f).read() for f in files)
    assert text.count(b"WARC/1.1\r\n") == len(rows)
    bare = w.read_archives(spark, path, payload=False).collect()
    assert sorted(r["payload_digest"] for r in bare) == sorted(r["payload_digest"] for r in got) and all(r["payload"] is None for r in bare)


def test_min_bytes_and_no_rows(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    path = shared_path(spark, "test-warc")
    w.write_archives(df, path, min_bytes=3)
    assert sorted((r["page_id"], r["record_type"], r["refers_to"]) for r in w.read_archives(spark, path).collect()) == \
        [(1, "response", None), (2, "response", None), (3, "revisit", 4), (4, "response", None)]
    path = shared_path(spark, "test-warc")
    w.write_archives(df.limit(0), path)
    assert w.read_archives(spark, path).count() == 0


def test_reader_checks_what_it_reads():
    good = w.record(1, "u", b"payload", None)
    assert w.parse(good)[6]
    assert not w.parse(good.replace(b"payload\r\n", b"paylord\r\n"))[6]
    with pytest.raises(ValueError):
        w.parse(good[:-3])
    member = w._member(good)
    assert list(w.members(member + w._member(b"") + member)) == [good, good]
    with pytest.raises(EOFError):
        list(w.members(member[:-5]))
    with pytest.raises(zlib.error):
        list(w.members(member + b"garbage"))
