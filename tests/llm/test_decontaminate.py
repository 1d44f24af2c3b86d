import hashlib
import random
import re

import pytest

from llm_cases import docs_of, words
from manifestqc.llm import decontaminate

ITEM = "item_id long, text string"
WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def word_list(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_force(text, items, width=10):
    w, hit, met = word_list(text), set(), set()
    for i, t in items:
        x = word_list(t)
        for k in range(max(1, len(x) - width + 1)) if x else []:
            p = x[k:k + width]
            for j in range(len(w) - len(p) + 1):
                if w[j:j + len(p)] == p:
                    hit.update(range(j, j + len(p)))
                    if i is not None:
                        met.add(str(i))
    return len(w), len(hit), len(met), hashlib.sha256(",".join(sorted(met)).encode()).hexdigest(), bool(hit)


def cases(seed=1):
    r = random.Random(seed)
    items = [(k, " ".join(words(r, r.randint(1, 40), 50))) for k in range(40)] + [(40, "Two Words"), (41, None), (42, "..."), (None, "orphan item words"), (3, "again under three")]
    docs = []
    for i in range(80):
        w = words(r, r.randint(0, 60), 50)
        if i % 2 and items[i % 40][1]:
            x = items[i % 40][1].split(" ")
            a = r.randrange(len(x))
            w[len(w) // 2:len(w) // 2] = x[a:a + r.randint(5, 30)]
        docs.append((i, " ".join(f"{x.upper()}-" if r.random() < 0.2 else x for x in w)))
    docs += [(100, None), (101, ""), (102, "¡Two, WORDS!é two\x7fwords"), (103, "an orphan-item words here"), (104, "two words " * 20_000), (105, "日本 two words 日本")]
    return items, docs


@pytest.mark.parametrize("block_chars", [decontaminate.BLOCK_CHARS, 2_000])
def test_matches_brute_force(spark, docs_of, block_chars):
    items, rows = cases()
    got = {r.doc_id: r for r in decontaminate.contamination(docs_of(rows), spark.createDataFrame(items, ITEM), block_chars=block_chars).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        r = got[i]
        if i != 104:
            assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == brute_force(text, items), i
        covered = [word_list(text[s.start:s.end]) for s in r.spans]
        assert sum(map(len, covered)) == r.n_hit
        for s in r.spans:
            assert not WORD.match(text, s.start - 1) if s.start else True
            assert word_list(text[s.start]) and word_list(text[s.end - 1])
    assert got[104].n_hit == 40_000 and len(got[104].spans) == 1


def test_blocks_are_bounded_and_whole(spark):
    items, _ = cases()
    items += [(1000 + k, "one window that very many items have") for k in range(300)]
    found, total = decontaminate.sized_windows(spark.createDataFrame(items, ITEM), 10, 50)
    blocks = list(decontaminate.window_blocks(found, total, 2_000))
    assert len(blocks) > 5
    want, got = {}, {}
    for i, t in items:
        for w in decontaminate.item_windows(t or "", 10):
            want.setdefault(w, set()).update([] if i is None else [str(i)])
    for block in blocks:
        assert sum(len(w) + 8 + 8 * len(ids) for w, (_, ids) in block.items()) <= 2_000
        for w, (n, ids) in block.items():
            assert n == len(w.split())
            assert not got.setdefault(w, set()) & set(ids)
            got[w].update(ids)
    assert got == want
    assert len(list(decontaminate.window_blocks(found, total, total))) == 1


def test_items_in_shards(spark, docs_of):
    benchmark = spark.createDataFrame([(k, "one window that many items have") for k in range(90)], ITEM)
    docs = docs_of([(1, "so: One window that many items have."), (2, "none")])
    for chars in (decontaminate.BLOCK_CHARS, 300):
        found, name = decontaminate.scanned(docs, benchmark, 10, chars, shard_items=20)
        got = {r.doc_id: r[name] for r in found.collect()}
        assert (got[1].n_items, got[1].n_hit, got[2].n_items) == (90, 6, 0)
        assert got[1].items_sha256 == hashlib.sha256(",".join(sorted(map(str, range(90)))).encode()).hexdigest()


def test_filter_keeps_columns(spark):
    items = spark.createDataFrame([(1, "a b c d e f g h i j k")], ITEM)
    rows = [(1, "x a B c d e f g h i j y", 5), (2, "a b c d e f g h i", 6), (None, None, None), (2, "a b c d e f g h i", 6)]
    df = spark.createDataFrame([(i, t, n, "z") for i, t, n in rows], "doc_id long, text string, n_words int, _found string")
    left = decontaminate.decontaminated(df, items)
    assert left.columns == df.columns and sorted((r.doc_id or 0, r.n_words or 0) for r in left.collect()) == [(0, 0), (2, 6), (2, 6)]


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], ITEM)
    assert decontaminate.contamination(docs_of([]), spark.createDataFrame([(1, "a b")], ITEM)).count() == 0
    got = decontaminate.contamination(docs_of([(1, "a b")]), none).collect()
    assert [(r.n_words, r.n_hit, r.contaminated) for r in got] == [(2, 0, False)]
