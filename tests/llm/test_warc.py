import base64
import gzip
import hashlib

import pandas as pd
import pytest

import llm_cases  # noqa: F401
from manifestqc.llm import warc
from manifestqc.session import scratch_path

PAGE = "page_id long, url string, html string"


def pages():
    big = "<p>" + "long text \r\n\r\n" * 20_000
    return [(1, "http://a.example/x y\n", "same"), (2, "http://b.example/", "same"), (9, "http://c.example/", "same"), (3, None, None), (4, "", ""), (5, "http://é.example/", "Ünï 日本"),
            (6, "http://d.example/", big), (7, "http://d.example/", big), (None, "http://e.example/", "same"), (9, "http://c.example/", "same"), (8, "u", "HTTP/1.1 200 OK\r\n\r\nnested")]


def expected(rows, min_bytes=0):
    out, last = [], {}
    for i, _, h in rows:
        if i is not None:
            last[h or ""] = max(i, last.get(h or "", i))
    for i, _, h in rows:
        p = (h or "").encode()
        to = last.get(h or "") if i is not None and len(p) >= min_bytes else None
        to = None if to == i else to
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "response" if to is None else "revisit", to))
    return out


def key(t):
    return tuple((x is None, x) for x in t)


@pytest.mark.parametrize("min_bytes,file_bytes", [(0, 64 << 20), (5, 500)])
def test_pages_come_back(spark, min_bytes, file_bytes):
    df = spark.createDataFrame([(*r, "x", 1) for r in pages()], PAGE + ", refers_to string, http int").repartition(3)
    base = scratch_path(spark, "t-warc")
    manifest = warc.converted(warc.arc_containers(df, container_bytes=1000), base, min_bytes, file_bytes)
    got = warc.read_warc(manifest, base).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=key) == sorted(expected(pages(), min_bytes), key=key)
    assert {r.target_uri for r in got if r.page_id in (3, 4)} == {"about:blank"}
    assert {r.target_uri for r in got if r.page_id == 1} == {"http://a.example/x%20y%0A"}
    assert {r.warc_date for r in got} == {"2008-04-30T20:48:25Z"}


def test_empty_table(spark):
    base = scratch_path(spark, "t-warc")
    manifest = warc.converted(warc.arc_containers(spark.createDataFrame([], PAGE)), base)
    assert manifest.count() == 0 and warc.read_warc(manifest, base).count() == 0


@pytest.mark.parametrize("version", [1, 2])
@pytest.mark.parametrize("packed", [False, True])
def test_both_versions_parse(version, packed):
    body = b"HTTP/1.0 200 OK\r\n\r\npay\nload\n"
    parts = [warc.arc_head(version, "x.arc")] + [warc.arc_line(version, f"http://h/{k}", "192.0.2.9", "20010203040506", "text/html", len(body), "x.arc") + body + b"\n" for k in range(3)]
    data = b"".join(gzip.compress(p) for p in parts) if packed else b"".join(parts)
    got = list(warc.parse_arc(data))
    assert [h["URL"] for h, _ in got] == [f"http://h/{k}" for k in range(3)] and {b for _, b in got} == {body}
    assert got[0][0]["Archive-date"] == "20010203040506" and warc.warc_date("20010203040506") == "2001-02-03T04:05:06Z"


def test_damaged_containers_are_refused():
    head = warc.arc_head(1, "x")
    with pytest.raises(ValueError):
        list(warc.parse_arc(b"http://x 1 2 3 4\n"))
    with pytest.raises(ValueError):
        list(warc.parse_arc(head + b"http://x 192.0.2.1 20010101000000 text/html 50\nshort"))
    with pytest.raises(ValueError):
        list(warc.parse_arc(head + b"http://x 20010101000000 text/html 1\nx"))


def test_identifiers_carry_numbers():
    for n in (0, 1, -1, 2**63 - 1, -2**63, 123456789012):
        assert warc.uuid_number(warc.record_uuid(n)) == n
    assert warc.uuid_number(warc.record_uuid(None)) is None


def test_reader_finds_a_wrong_digest(spark):
    base = scratch_path(spark, "t-warc")
    manifest = warc.converted(warc.arc_containers(spark.createDataFrame([(1, "u", "h")], PAGE)), base).toPandas()
    path = manifest["path"][0]
    bad = [warc.convert(1, "u", "0", "20010101000000", b"HTTP/1.1 200 OK\r\n\r\nx", 1, warc.sha1_base32(b"y"), None)]
    with open(path, "wb") as f:
        f.write(b"".join(bad))
    with pytest.raises(Exception, match="does not hold"):
        warc.read_warc(spark.createDataFrame(manifest.astype({"n": int}).to_dict("records"), "path string, n long, bytes long"), base).collect()
    assert isinstance(manifest, pd.DataFrame)
