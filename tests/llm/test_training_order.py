import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_cases import corpus, docs_of
from manifestqc.llm import training_order as order
from manifestqc.llm.tokens import load, tokenizer_path
from manifestqc.session import scratch_path


def pieces(rows, length):
    """Sequences of one task's stream: doc_id and place of the first id, and the ids."""
    t, ids, at = load(tokenizer_path()), [], []
    for i, text in rows:
        doc = t.encode(text or "", add_special_tokens=False).ids + [order.END_ID]
        ids += doc
        at += [(i, k) for k in range(len(doc))]
    return [(*at[k], ids[k:k + length]) for k in range(0, len(ids), length)]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 1000, 65_537])
def test_permutation_and_inverse(n):
    slots = order.permute(np.arange(n), n)
    assert sorted(slots) == list(range(n))
    assert (order.permute(slots, n, inverse=True) == np.arange(n)).all()
    if n > 100:
        assert (order.permute(np.arange(n), n, key=1) != slots).mean() > 0.9
        assert abs(np.corrcoef(np.arange(n), slots)[0, 1]) < 0.1


@pytest.mark.parametrize("length,shard_bytes", [(16, 48 * 20), (2048, 32 << 20)])
def test_shards_hold_every_sequence_in_slot_order(spark, length, shard_bytes):
    rows = corpus(2, 60) + [(500, None), (None, "null id"), (3, "repeat"), (3, "repeat")]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, slot int, ids string").repartition(5)
    base = scratch_path(spark, "t-order")
    manifest = order.write_shards(df, base, length=length, shard_bytes=shard_bytes)
    kind = order.record_type(length, 1 << 16)
    got = order.read_shards(manifest, base, kind, with_ids=True).collect()
    tasks = df.select(F.spark_partition_id().alias("task"), "doc_id", "text").collect()
    want = [x for task in sorted({r.task for r in tasks}) for x in pieces([(r.doc_id, r.text) for r in tasks if r.task == task], length)]
    assert sorted(r.slot for r in got) == list(range(len(want)))
    key = lambda x: (x[0] is None, x[0], x[1], x[2])
    assert sorted(((r.doc_id, r.start, r.ids) for r in got), key=key) == sorted(want, key=key)
    per = shard_bytes // kind.itemsize
    for r in got:
        assert order.locate(r.slot, per, kind.itemsize) == (r.shard, r.byte_offset)
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    if length == 16:
        some = len(want) // 2
        rest = order.read_shards(manifest, base, kind, from_slot=some).collect()
        assert sorted(r.slot for r in rest) == list(range(some, len(want)))
        last = max(manifest.collect(), key=lambda m: m.shard)
        with open(last.path, "r+b") as f:
            f.write(b"\xff")
        with pytest.raises(Exception, match="checksum"):
            order.read_shards(manifest, base, kind).collect()


def test_empty_table(spark, docs_of):
    base = scratch_path(spark, "t-order")
    manifest = order.write_shards(docs_of([]), base)
    assert manifest.count() == 0 and order.read_shards(manifest, base, order.record_type(2048, 10)).count() == 0
