"""Ranked lexical search against a brute-force version of its definition."""

import random
import re
from collections import Counter
from math import floor, log

import numpy as np
import pytest
from llm_cases import corpus, docs_of  # noqa: F401

from manifestqc.llm import lexical

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms_of(text):
    return Counter(w.translate(LOWER) for w in WORDS.findall(text or ""))


def expected(docs, items, top=20):
    counted = [(i, c) for i, t in docs if (c := terms_of(t))]
    n_docs, n_words = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(w for _, c in counted for w in c)
    asked = {}
    for i, t in set(items):
        asked.setdefault(i, Counter()).update(terms_of(t))
    out = []
    for item, want in asked.items():
        rows = []
        for doc, c in counted:
            m = 100 - 25 + (25 * sum(c.values()) * n_docs) // n_words
            score = sum(k * floor(1000 * log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 12 * m)) for w, k in want.items() if c[w])
            if score > 0:
                rows.append((doc, score))
        rows.sort(key=lambda r: (-r[1], r[0] is None, r[0] or 0))
        out += [(item, k + 1, doc, score) for k, (doc, score) in enumerate(rows[:top])]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize("settings", [{}, {"shard_docs": 16, "block": 4, "first": 2}, {"shard_docs": 5, "block": 2, "first": 3, "batch_terms": 40}])
def test_same_as_scoring_every_document(spark, docs_of, settings):  # noqa: F811
    docs = corpus(n=150)
    r = random.Random(3)
    items = [(k, " ".join(r.sample(docs[r.randrange(150)][1].split(), 3) + docs[r.randrange(150)][1].split()[:9])) for k in range(12)]
    got = found(lexical.search(docs_of(docs).repartition(3), items_of(spark, items), **settings))
    assert got == expected(docs, items)


def test_ties_nulls_repeats_and_words(spark, docs_of):  # noqa: F811
    docs = [(k, "alpha beta") for k in range(60)] + [(None, "alpha beta"), (7, "alpha beta"), (200, None), (201, ""), (202, " .,;\n"), (203, "ÀLPHA Éa\x80b 9x"), (None, "gamma"),
                                                    ((1 << 53) + 1, "gamma gamma"), ((1 << 53) + 2, "gamma"), (300, "long " * 300_000 + "gamma")]
    items = [(1, "Alpha ALPHA delta"), (2, None), (3, "?!"), (4, "gamma beta"), (4, "gamma beta"), (4, "9X"), (None, "Éa\x80b"), ((1 << 53) + 1, "delta")]
    items_df = items_of(spark, items).selectExpr("item_id", "text", "'x' as doc_id", "1 as n")
    frame = docs_of(docs).withColumnRenamed("lang", "item_id").withColumnRenamed("source", "score")
    for settings in ({}, {"shard_docs": 7, "block": 3, "first": 2, "batch_terms": 2}):
        assert found(lexical.search(frame, items_df, **settings)) == expected(docs, items)


def test_empty_tables(spark, docs_of):  # noqa: F811
    some = docs_of([(1, "alpha")])
    assert found(lexical.search(some.limit(0), items_of(spark, [(1, "alpha")]))) == []
    assert found(lexical.search(some, items_of(spark, [(1, "alpha")]).limit(0))) == []
    assert found(lexical.search(some, items_of(spark, [(1, "beta")]))) == []
    assert lexical.search(some, items_of(spark, [(1, None)])).dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]


def packed_corpus(n_docs=400, n_terms=80, seed=5):
    r = np.random.default_rng(seed)
    share = 0.9 / (1 + np.arange(n_terms)) ** 0.7
    rows = [np.flatnonzero(r.random(n_terms) < share * r.uniform(0.3, 1.5)) for _ in range(n_docs)]
    terms = np.concatenate(rows).astype(np.int32)
    return terms, r.integers(1, 1000, len(terms)) * 1000, np.cumsum([len(x) for x in rows])


def test_blocks_partition_lists_and_summaries_are_maxima():
    terms, impacts, ends = packed_corpus()
    index = lexical.BlockedIndex(terms, impacts, ends, block=8)
    starts = np.concatenate([[0], ends[:-1]])
    vectors = [dict(zip(terms[a:z].tolist(), impacts[a:z].tolist())) for a, z in zip(starts, ends)]
    for i, term in enumerate(index.present.tolist()):
        docs, block_ends, tops, numbers, values = index.blocks(i)
        assert sorted(docs.tolist()) == [d for d, v in enumerate(vectors) if term in v]
        for b, (a, z) in enumerate(zip(np.concatenate([[0], block_ends[:-1]]), block_ends)):
            assert 0 < z - a <= 8
            low = tops[b - 1] if b else 0
            want = {}
            for d in docs[a:z].tolist():
                for w, x in vectors[d].items():
                    want[w] = max(x, want.get(w, 0))
            assert dict(zip(numbers[low:tops[b]].tolist(), values[low:tops[b]].tolist())) == want


def test_bounds_skip_documents_and_lose_none():
    terms, impacts, ends = packed_corpus(n_docs=1500)
    index = lexical.BlockedIndex(terms, impacts, ends)
    ids = np.array(list(range(len(ends))), dtype=object)
    r = np.random.default_rng(9)
    scored = []
    for _ in range(20):
        asked = np.sort(r.choice(80, 6, replace=False))
        weights = r.integers(100, 9000, 6)
        dense = np.zeros(80, np.int64)
        best = lexical.Best(20, 1)
        scored.append(lexical.search_shard(index, ids, asked, weights, dense, best))
        assert not dense.any()
        dense[asked] = weights
        every = index.scores(np.arange(len(ends)), dense)
        order = sorted(range(len(ends)), key=lambda d: (-every[d], d))[:20]
        assert best.rows == [(int(every[d]), d) for d in order]
    assert np.mean(scored) < 0.8 * len(ends)
