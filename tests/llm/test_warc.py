import base64
import gzip
import hashlib

import pytest

from tunehouse.llm import warc
from tunehouse.session import scratch_path

PAGES = [
    (1, "http://a.example/x", "<p>one\r\n\r\ntwo</p>"),
    (2, "http://a.example/y", "<p>one\r\n\r\ntwo</p>"),
    (3, "http://b.example/", "é😀"),
    (4, None, None),
    (5, "http://c.example/ a\r\nX: y", ""),
    (5, "http://c.example/ a\r\nX: y", ""),
    (None, "http://d.example/", "é😀"),
    (None, "http://e.example/", "alone"),
    (6, "http://f.example/", "long " * 100_000),
    (7, "http://[bad|host", "x"),
    (8, "no url at all", "y"),
]


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def expected(pages, least=0):
    first = {}
    for k, _, html in pages:
        if len((html or "").encode()) >= least:
            first[html or ""] = max(first.get(html or "", -1), -1 if k is None else k)
    out = []
    for k, _, html in pages:
        best = first.get(html or "", k)
        again = best != -1 and best != k
        out.append((k, len((html or "").encode()), digest(html), "revisit" if again else "response", best if again else None))
    return sorted(out, key=repr)


def round_trip(spark, pages, least=0, per_file=2):
    df = spark.createDataFrame([(*p, 1, "z") for p in pages], "page_id bigint, url string, html string, kind int, payload string")
    path = scratch_path(spark, "warc-test")
    warc.write_captures(df, path, least, per_file)
    return path, warc.assemble(warc.read_records(spark, path))


@pytest.mark.parametrize("least", [0, 1, 6, 10**9])
def test_round_trip(spark, least):
    _, captures = round_trip(spark, PAGES, least)
    assert sorted((tuple(r) for r in warc.resolved(captures).collect()), key=repr) == expected(PAGES, least)


def test_nested_rows_hold_the_payload(spark):
    path, captures = round_trip(spark, PAGES)
    rows = captures.collect()
    assert len(rows) == len(PAGES) and all(r["n_requests"] == r["n_metadata"] == 1 for r in rows)
    for r in rows:
        if r["capture"]["kind"] == "response":
            html = bytes(r["capture"]["payload"]).decode()
            assert html in {p[2] or "" for p in PAGES if p[0] == r["page_id"]}
            assert r["capture"]["payload_digest"] == "sha1:" + digest(html)
        uri = r["capture"]["target_uri"]
        assert r["request"]["block"].startswith(f"GET {uri or '/'} HTTP/1.1")
    assert {r["capture"]["target_uri"] for r in rows} >= {"http://c.example/ a X: y", None}
    hosts = {r["page_id"]: r["request"]["block"].partition("Host: ")[2].strip() for r in rows}
    assert hosts[1] == "a.example" and hosts[7] == "[bad|host" and hosts[8] == ""
    slim = warc.read_records(spark, path, payloads=False)
    assert slim.where("payload is not null").count() == 0 and slim.where("payload_bytes > 0").count() > 0


def test_files_are_bounded(spark):
    import glob

    path, _ = round_trip(spark, PAGES, per_file=1)
    files = glob.glob(f"{path}/part-*.gz")
    assert len(files) >= len(PAGES)
    for f in files:
        with gzip.open(f) as g:
            assert len(list(warc.parse_records(g.read()))) == 3


def test_no_pages(spark):
    _, captures = round_trip(spark, [])
    assert warc.resolved(captures).count() == 0


def record(**fields):
    block = fields.pop("block", b"")
    lines = [b"WARC/1.0"] + [f"{k.replace('_', '-')}: {v}".encode() for k, v in fields.items()]
    return b"\r\n".join([*lines, f"content-length: {len(block)}".encode()]) + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_foreign_archives(spark):
    one = record(WARC_Type="warcinfo", block=b"software: x\r\n")
    http = b"HTTP/1.0 200 OK\r\n\r\n\r\n\r\npay\r\n\r\nload"
    two = record(WARC_Type="response", WARC_Record_ID="<a>", Content_Type="application/http; msgtype=response", block=http)
    lone = record(WARC_Type="request", WARC_Record_ID="<r>", WARC_Concurrent_To="<gone>", block=b"GET / HTTP/1.0")
    rows = list(warc.parse_records(gzip.compress(one) + gzip.compress(two + lone)))
    assert [r["kind"] for r in rows] == ["warcinfo", "response", "request"]
    assert rows[1]["payload"] == b"\r\n\r\npay\r\n\r\nload"
    for bad in (two[:-6], b"junk" + two, two.replace(b"WARC/1.0", b"HTTP/1.0")):
        with pytest.raises(ValueError):
            list(warc.parse_records(bad))
    records = spark.createDataFrame([{**dict.fromkeys("record_id concurrent_to target_uri date payload_digest refers_to_uri block payload_bytes payload_sha1 payload".split()), **r} for r in rows], warc.RECORD)
    captures = {r["capture_id"]: r for r in warc.assemble(records).collect()}
    assert captures["<gone>"]["capture"] is None and captures["<gone>"]["n_requests"] == 1
    assert captures["<a>"]["request"] is None


def test_base32(one):
    from pyspark.sql import functions as F

    for text in ("", "a", "é" * 50):
        assert one(warc.base32_sha1(F.lit(text))) == digest(text)
