"""WARC writing and reading: exact round trips, segments, verification."""

import random

import pytest

from conftest import SF01
from watchtide.llm import warc as X
from watchtide.llm.common import scratch


@pytest.mark.parametrize("n", [0, 1, 2047, 2048, 2049, 10_000])
def test_chunked_framing_round_trip(n):
    payload = random.Random(n).randbytes(n)
    framed = X.chunked(payload)
    assert X.dechunked(framed) == payload and framed.endswith(b"0\r\n\r\n")
    assert X.dechunked(b"3;x=y\r\nabc\r\n0\r\n\r\n") == b"abc"


@pytest.mark.parametrize("body", [b"", b"5\r\nabc", b"zz\r\n", b"3\r\nabcd\r\n0\r\n\r\n"])
def test_broken_framing_is_an_error(body):
    with pytest.raises(ValueError):
        X.dechunked(body)


def test_archives_are_well_formed(spark):
    pages = spark.createDataFrame([(1, "http://a/", "x" * 5000), (2, "http://b/\r\nEvil: 1", "WARC/1.1\r\n\r\n" * 40), (3, None, None)],
                                  "page_id long, url string, html string")
    path = scratch(spark, "warc-test")
    X.write_warc(pages, path, segment_bytes=1000)
    recs = X.read_records(spark, path).collect()
    assert {r.kind for r in recs} == {"response", "continuation"}
    mine = sorted((r for r in recs if ":1:" in (r.origin or r.record_id)), key=lambda r: r.segment)
    assert [r.segment for r in mine] == [1, 2, 3, 4, 5, 6]
    assert [r.total is not None for r in mine] == [False] * 5 + [True] and mine[-1].total == sum(len(r.block) for r in mine)
    assert all(len(r.block) <= 1000 for r in recs) and [r.url for r in recs if ":2:" in r.record_id][0] == "http://b/%0D%0AEvil: 1"
    got = {r.record_id.split(":")[2]: bytes(r.payload) for r in X.read_warc(spark, path).collect()}
    assert got == {"1": b"x" * 5000, "2": b"WARC/1.1\r\n\r\n" * 40, "3": b""}


def records(spark, rows):
    return spark.createDataFrame(rows, X._RECORDS)


def test_segments_are_verified(spark):
    def seg(origin, n, block, total=None):
        return (f"{origin}:{n}" if n > 1 else origin, "response" if n == 1 else "continuation", "u", "d", None, origin if n > 1 else None, n, total, block)
    rows = [seg("ok", 2, b"cd"), seg("ok", 1, b"ab"), seg("ok", 3, b"e", 5),
            seg("gap", 1, b"ab"), seg("gap", 3, b"e", 5), seg("short", 1, b"ab"), seg("short", 2, b"c", 9),
            seg("twice", 1, b"a"), seg("twice", 2, b"b", 3), seg("twice", 2, b"b", 3), seg("headless", 2, b"b", 1), seg("open", 1, b"a"), seg("open", 2, b"b"),
            ("single", "response", "u", "d", None, None, 0, None, b"z")]
    got = {r.record_id: (bytes(r.block) if r.block is not None else None, r.complete) for r in X.reassemble(records(spark, rows)).collect()}
    assert got.pop("ok") == (b"abcde", True) and got.pop("single") == (b"z", True)
    assert got == {k: (None, False) for k in ("gap", "short", "twice", "headless", "open")}


def test_whole_table_against_plain_python(spark):
    import hashlib
    pages = spark.read.parquet(f"{SF01}/pages.parquet")
    pages = pages.union(pages.where("page_id % 3 = 0").selectExpr("page_id + 100000", "url", "html"))
    got = {r.page_id: r for r in X.op1_warc(pages).collect()}
    rows = {r.page_id: (r.html or "").encode() for r in pages.collect()}
    first = {}
    for i in sorted(rows):
        first.setdefault(rows[i], i)
    assert set(got) == set(rows)
    for i, p in rows.items():
        shared = len(p) >= 100 and first[p] != i
        assert tuple(got[i])[:5] == (i, len(p), hashlib.sha256(p).hexdigest(), "revisit" if shared else "response", first[p] if shared else None)


def test_defined_cases(spark):
    big = "é" * 300_000
    rows = [(None, None, None), (None, "u", "y" * 200), (5, "u", "y" * 200), (5, "u", "y" * 200), (7, "u", big), (9, "v", big), (3, "w", "small"), (4, "w", "small")]
    got = X.op1_warc(spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, kind int")).collect()
    kinds = sorted((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to or 0) for r in got)
    assert kinds == [(0, 0, "response", 0), (0, 200, "revisit", 5), (3, 5, "response", 0), (4, 5, "response", 0), (5, 200, "response", 0),
                     (5, 200, "revisit", 5), (7, 600_000, "response", 0), (9, 600_000, "revisit", 7)]
    assert X.op1_warc(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_archives_of_many_members_and_broken_ones(spark, tmp_path):
    import gzip

    records = [b for i in range(5) for b in X.page_records(f"urn:page:{i}:0", f"http://a/{i}", bytes([65 + i]) * 300, "d", None, 8192)]
    members = [gzip.compress(r + X.END.encode()) for r in records]
    (tmp_path / "part-0.gz").write_bytes(b"".join(members))
    found = X.read_warc(spark, str(tmp_path)).collect()
    assert sorted(bytes(r.payload) for r in found) == [bytes([65 + i]) * 300 for i in range(5)] and all(r.complete for r in found)
    assert X.unpacked(members[0] + b"\0" * 512) == records[0] + X.END.encode() and X.unpacked(b"") == b""
    with pytest.raises(ValueError):
        X.unpacked(b"".join(members)[:-9])


def test_header_fields_with_and_without_a_space():
    [(fields, block)] = X.parse(b"WARC/1.0\r\nWARC-Type:response\r\nContent-Length:  3 \r\nX: a:b\r\n\r\nabc\r\n\r\n")
    assert fields == {"warc-type": "response", "content-length": "3", "x": "a:b"} and block == b"abc"
