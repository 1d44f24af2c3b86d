"""Ids beyond 2^53 beside a null, in one batch, come back as they are."""

from llm_cases import docs_of  # noqa: F401

from manifestqc.llm import chat, common, near_dup, packing, training_order, warc
from manifestqc.session import scratch_path

BIG = 1 << 53
ROWS = [(BIG + 1, "one two three four five"), (None, "no id here at all"), (BIG + 2, "six seven eight nine ten"), (-BIG - 1, "eleven twelve"), (1, None)]
IDS = {BIG + 1, BIG + 2, -BIG - 1, 1, None}


def test_helpers():
    import pandas as pd
    ids = [BIG + 1, None, -BIG - 1]
    assert common.id_list(pd.Series([None if i is None else str(i) for i in ids])) == ids
    assert [None if x is pd.NA else int(x) for x in common.id_array(ids)] == ids and len(common.id_array([])) == 0


def test_training_order(spark, docs_of):  # noqa: F811
    base = scratch_path(spark, "t-ids")
    manifest = training_order.write_shards(docs_of(ROWS).coalesce(1), base, length=4)
    kind = training_order.record_type(4, 1 << 16)
    assert {r.doc_id for r in training_order.read_shards(manifest, base, kind).collect()} <= IDS
    assert {r.doc_id for r in training_order.read_shards(manifest, base, kind).collect()} >= {BIG + 1, None}


def test_packing(docs_of):  # noqa: F811
    assert {r.doc_id for r in packing.pack_documents(docs_of(ROWS).coalesce(1)).collect()} == IDS


def test_near_duplicates(docs_of):  # noqa: F811
    got = near_dup.near_duplicates(docs_of(ROWS).coalesce(1), width=4).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(i, i) for i in IDS}


def test_chat(spark):
    rows = [(i, 0, "user", t) for i, t in ROWS]
    got = chat.formatted(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").coalesce(1)).collect()
    assert {r.conv_id for r in got} == IDS


def test_warc_ids_and_blanks_in_addresses(spark):
    pages = spark.createDataFrame([(i, "http://h/x", t) for i, t in ROWS] + [(BIG + 3, "http://h/y", ROWS[0][1])], "page_id long, url string, html string").coalesce(1)
    base = scratch_path(spark, "t-ids-warc")
    got = {r.page_id: r.refers_to for r in warc.read_warc(warc.converted(warc.arc_containers(pages), base), base).collect()}
    assert got == {**dict.fromkeys(IDS), BIG + 1: BIG + 3, BIG + 3: None}
    body = b"HTTP/1.0 200 OK\r\n\r\nx"
    for version in (1, 2):
        data = warc.arc_head(version, "x.arc") + warc.arc_line(version, "http://h/a b  c", "192.0.2.9", "20010203040506", "text/html", len(body), "x.arc") + body + b"\n"
        assert [(h["URL"], block) for h, block in warc.parse_arc(data)] == [("http://h/a b  c", body)]
