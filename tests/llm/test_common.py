"""Word hashes and the memory of reused workers."""

import re

import numpy as np
import pandas as pd

from manifestqc.llm import common, packing


def _hash(word: bytes) -> int:
    value, power = 0, 1
    for byte in word:
        power = power * int(common._STEP) % 2**64
        value = (value + int(common._LETTERS[byte]) * power) % 2**64
    return int(common.mix(np.array([value], np.uint64))[0])


def test_words_hash_alike_at_any_place():
    """In the first stretch, over the end of one, behind a word that is longer than two of them."""
    words = [b"one", b"two"] * (common.STRETCH // 8) + [b"z" * (2 * common.STRETCH + 5), b"one", b"x" * common.STRETCH, b"two"]
    hashes, starts = common.hashed_runs(b" \n".join(words))
    known = {w: _hash(w) for w in set(words)}
    assert hashes.tolist() == [known[w] for w in words]
    assert starts[:2].tolist() == [0, 5]


def _own_mb() -> int:
    with open("/proc/self/smaps_rollup") as f:
        return sum(map(int, re.findall(r"\nPss_(?:Anon|Shmem):\s+(\d+)", f.read()))) // 1024


def test_freed_memory_goes_back():
    """Small pieces freed between others stay in a worker's heap, and what Arrow freed in its pool."""
    common.give_back()
    before = _own_mb()
    pieces = [np.zeros(8192, np.uint8) + 1 for _ in range(20_000)]
    last = np.zeros(8192, np.uint8) + 1  # above them in the heap
    del pieces
    common.give_back()
    assert last[0] == 1 and _own_mb() - before < 60


def test_packing_gives_back_first(spark, monkeypatch):
    held = {}

    class Docs:
        def mapInPandas(self, run, schema):
            held["run"] = run

    monkeypatch.setattr(packing, "exact_ids", lambda df, *c: Docs())
    monkeypatch.setattr(packing, "give_back", lambda: held.setdefault("given", True))
    packing.token_pieces(spark.createDataFrame([(1, "a")], "doc_id long, text string"))
    assert list(held["run"](iter([]))) == [] and held["given"]


def test_packing_gives_back_behind_it(spark, monkeypatch):
    """Workers take turns, so an idle one should hold no more than its cache of words."""
    held, given = {}, []

    class Docs:
        def mapInPandas(self, run, schema):
            held["run"] = run

    monkeypatch.setattr(packing, "exact_ids", lambda df, *c: Docs())
    monkeypatch.setattr(packing, "give_back", lambda: given.append(1))
    packing.token_pieces(spark.createDataFrame([(1, "a")], "doc_id long, text string"))
    rows = [r for part in held["run"](iter([pd.DataFrame({"doc_id": ["1"], "text": ["a b"]})])) for r in part["doc_id"]]
    assert rows == [1] and len(given) == 2


def test_word_keys():
    """A key is of the word's bytes alone, at any place and of any length."""
    words = [b"a", b"a\0", b"abcdefgh", b"abcdefghi", b"abcdefgh\0", b"x" * 511, b"x" * 512, b"x" * 513, b"x" * 2000, b"x" * 1999 + b"y", "\u00e9\u4e00".encode()]
    keys, starts = common.word_keys(b" \n".join(words * 2) + b" ")
    assert keys[:len(words)].tolist() == keys[len(words):].tolist() and len(set(keys.tolist())) == len(words)
    assert starts[:3].tolist() == [0, 3, 7]
    assert [len(v) for v in common.word_keys(b"")] == [0, 0] and [len(v) for v in common.word_keys(b" \n")] == [0, 0]


def test_what_an_earlier_operator_left_goes_back(monkeypatch):
    done = []
    monkeypatch.setattr(common, "give_back", lambda: done.append("back"))
    monkeypatch.setattr(common, "RELEASE", [lambda: done.append("freed")])
    common.word_keys(b"a")
    assert done == ["freed", "back"]


def test_summed_bins(spark):
    """Sums of every stretch, also where some tasks get none."""
    from manifestqc.llm.common import summed_bins
    r = np.random.default_rng(3)
    for size, stretch in [(10, 1024), (100, 7), (64, 8)]:
        rows = [r.integers(0, 2**40, size) for _ in range(5)]
        df = spark.createDataFrame([(k, [int(x) for x in v]) for k, v in enumerate(rows)] + [(9, None)], "k int, bins array<long>").repartition(3)
        assert (summed_bins(df, "bins", size, stretch) == sum(rows)).all()
        assert (summed_bins(df.where("k = 9"), "bins", size, stretch) == 0).all()
