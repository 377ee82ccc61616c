"""WARC archives: results against SQL, the files themselves, and odd inputs."""

from __future__ import annotations

import base64
import glob
import gzip
import hashlib
import uuid
import zlib

import pytest

from smelter.llm import warc
from tests.oracle import connect, differences

SMALL = "/root/testdata/sf0.001"
KIND = "page_id long, url string, html string, payload_bytes int"
SPLIT = "é\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n" * 40000
ODD = [(1, None, None, 0), (1, "a", "x", 0), (2, "b\r\nWARC-Type: no", "x", 0), (2, "b", "x", 0), (None, "c", "x", 0), (None, "c", "z", 0),
       (5, "d", "", 0), (6, "é", SPLIT, 0)]


@pytest.fixture
def folder(tmp_path):
    return f"{tmp_path}/warc-{uuid.uuid4().hex}"


def test_against_sql(spark):
    assert not differences(warc.page_records_back(spark.read.parquet(f"{SMALL}/pages.parquet")), connect(SMALL), warc.PAGES_SQL)


def test_odd_rows(spark, folder):
    pages = spark.createDataFrame(ODD, KIND).repartition(3)
    got = sorted((tuple(r) for r in warc.page_records_back(pages).collect()), key=repr)
    digest = lambda t: base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
    want = [(1, 0, digest(""), "response", None), (1, 1, digest("x"), "response", None), (2, 1, digest("x"), "revisit", 1), (2, 1, digest("x"), "revisit", 1),
            (None, 1, digest("x"), "revisit", 1), (None, 1, digest("z"), "response", None), (5, 0, digest(""), "revisit", 1),
            (6, len(SPLIT.encode()), digest(SPLIT), "response", None)]
    assert got == sorted(want, key=repr)
    assert warc.page_records_back(pages.where("false")).collect() == []
    warc.archive(pages, folder, least_bytes=1)
    kinds = {(r.page_id, r.payload_bytes): r.record_type for r in warc.read_pages(spark, folder).collect()}
    assert kinds[(5, 0)] == "response" and kinds[(2, 1)] == "revisit"


def test_every_record_is_a_member_at_its_place(spark, folder):
    pages = spark.createDataFrame(ODD, KIND).coalesce(1)
    warc.write_monolithic(warc.page_records(pages), f"{folder}-raw")
    assert warc.normalise(spark, f"{folder}-raw", folder) == len(ODD)
    (raw,), (made,) = glob.glob(f"{folder}-raw/*.gz"), glob.glob(f"{folder}/*.gz")
    whole = zlib.decompressobj(31)
    assert whole.decompress(open(raw, "rb").read()) and whole.eof and not whole.unused_data  # one stream
    assert gzip.open(raw).read() == gzip.open(made).read()
    data, at = open(made, "rb").read(), 0
    for line in open(f"{made}.idx").read().splitlines():
        offset, length, kind, record_id, _ = line.split("\t")
        member = zlib.decompressobj(31)
        text = member.decompress(data[int(offset):int(offset) + int(length)])
        assert int(offset) == at and member.eof and not member.unused_data and text.startswith(b"WARC/1.1\r\nWARC-Type: " + kind.encode()) and record_id.encode() in text
        at += int(length)
    assert at == len(data)
    index = warc.read_index(spark, folder)
    assert [bytes(r.payload).decode() for r in warc.fetch(index.where("record_id LIKE '%page:6:%'")).collect()] == [SPLIT]
    before = data
    warc.normalise(spark, f"{folder}-raw", folder)  # a task that runs again leaves the same files
    assert open(made, "rb").read() == before


def test_streams_in_small_chunks_and_in_members(monkeypatch):
    import io

    monkeypatch.setattr(warc, "CHUNK", 7)
    text = b"".join(b"line %d\r\n" % i for i in range(3000))
    assert b"".join(warc.inflated(io.BytesIO(gzip.compress(text)))) == text
    assert b"".join(warc.inflated(io.BytesIO(gzip.compress(text) + gzip.compress(b"") + gzip.compress(text[:50])))) == text + text[:50]
    with pytest.raises(ValueError):
        b"".join(warc.inflated(io.BytesIO(gzip.compress(text)[:-9])))
    reader = warc.Reader(iter([b"WARC/1.1\r\nA: 1\r", b"\n\r", b"\nbody"]))
    assert warc.headers(reader.head()) == {"a": "1"} and reader.take(4) == b"body" and reader.head() == b""


def test_damage_is_reported(spark, folder):
    warc.write_monolithic(warc.page_records(spark.createDataFrame(ODD[:3], KIND).coalesce(1)), f"{folder}-raw")
    (raw,) = glob.glob(f"{folder}-raw/*.gz")
    whole = gzip.open(raw).read()
    for broken in (whole[:-30], whole.replace(b"WARC/1.1", b"WARC-1.1"), whole + b"rest"):
        with open(raw, "wb") as f:
            f.write(gzip.compress(broken))
        with pytest.raises(ValueError):
            warc._normalise_file(raw, f"{folder}-bad")
    member = whole[:whole.index(b"HTTP/")] + b"HTTP/1.1 200 OK\r\nContent-Length: 0\r\n\r\nother payload of another digest"
    with pytest.raises(ValueError):
        warc._record(gzip.compress(member))
