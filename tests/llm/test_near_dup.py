from collections import defaultdict

import numpy as np
import pytest

from llm_cases import corpus, docs_of
from manifestqc.llm import near_dup
from manifestqc.llm.components import connected


def shingles(text, width):
    w = (text or "").encode().lower().split()
    return {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def brute_force(rows, width, percent):
    sets = [(i, shingles(t, width)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for k, (a, s) in enumerate(sets):
        for b, t in sets[:k]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in sets}, {i: len(s) for i, s in sets}


@pytest.mark.parametrize("width", [4, 5])
def test_components_match_brute_force(docs_of, width):
    rows = corpus()
    parts, sizes = brute_force(rows, width, 80)
    got = near_dup.near_duplicates(docs_of(rows), width=width).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: r.component_id for r in got} == parts
    assert {r.doc_id: r.n_shingles for r in got} == sizes
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_large_group_of_near_copies_and_a_chain(docs_of):
    base = [f"b{k}" for k in range(100)]
    rows = [(0, " ".join(base))]
    for i in range(1, 150):  # every one is near the base, not all near each other
        w = list(base)
        w[(7 * i) % 100] = f"x{i}"
        rows.append((i, " ".join(w)))
    chain = [f"c{k}" for k in range(80)]
    for i in range(150, 170):  # each is near the one before; the ends share nothing
        rows.append((i, " ".join(chain)))
        chain = chain[6:] + [f"d{i}_{k}" for k in range(6)]
    parts, _ = brute_force(rows, 4, 80)
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(docs_of(rows), width=4).collect()}
    assert got == parts
    assert len(set(got.values())) == 2


def test_nulls_repeats_and_clashing_columns(spark):
    text = "alpha beta gamma delta epsilon zeta"
    rows = [(1, text), (1, text), (2, text.upper()), (None, text), (3, None), (4, ""), (5, "short one"), (6, "Short ONE")]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, kept int, component_id string")
    got = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in near_dup.near_duplicates(df, width=4).collect())
    assert got == [(0, 0, True), (1, 1, True), (1, 1, True), (2, 1, False), (3, 3, True), (4, 4, True), (5, 5, True), (6, 5, False)]
    left = near_dup.deduplicated(df, width=4)
    assert left.columns == df.columns
    assert sorted((r.doc_id or 0) for r in left.collect()) == [0, 1, 1, 3, 4, 5]


def test_empty_table(docs_of):
    assert near_dup.near_duplicates(docs_of([])).count() == 0
    assert near_dup.deduplicated(docs_of([])).count() == 0


def test_posterior_bound_keeps_similar_pairs():
    least = near_dup.fewest_matches(0.8, 1e-6)
    assert least == sorted(least) and least[-1] < 0.8 * near_dup.HASHES
    r = np.random.default_rng(3)
    agree = r.random((20_000, near_dup.HASHES)) < 0.8
    for k, m in enumerate(least):
        assert (agree[:, : (k + 1) * near_dup.BATCH].sum(1) >= m).mean() > 0.9999
    far = r.random((20_000, near_dup.HASHES)) < 0.3
    assert (far.sum(1) >= least[-1]).mean() < 1e-3 and (far[:, :32].sum(1) >= least[1]).mean() < 0.2


def test_connected_on_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 100 + k) for k in range(1, 80)] + [(200, 200)]
    got = {r.id: r.component for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    groups = defaultdict(set)
    for i, c in got.items():
        groups[c].add(i)
    assert groups == {0: set(range(51)), 100: set(range(100, 180))}


def test_pruning_loses_no_link_that_is_known_exactly(docs_of):
    rows = []
    for i in range(30):  # pairs a little above the threshold: 14 of 118 shingles on each side
        w = [f"p{i}w{k}" for k in range(120)]
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(w[:106] + [f"q{i}w{k}" for k in range(12)]))]
    parts, _ = brute_force(rows, 3, 80)
    assert all(parts[2 * i + 1] == 2 * i for i in range(30))
    got = near_dup.near_duplicates(docs_of(rows), width=3, miss=0.9).collect()
    assert {r.doc_id: r.component_id for r in got} == parts


def test_miss_rate_at_the_threshold():
    least = near_dup.fewest_matches(0.8, 1e-6)
    r = np.random.default_rng(3)
    agree = np.cumsum(r.binomial(near_dup.BATCH, 0.6, (200_000, len(least))), axis=1)
    assert abs((agree < np.array(least)).any(axis=1).mean() - near_dup.miss_rate(least, 0.6)) < 0.005
    assert 3e-6 < near_dup.miss_rate(least, 0.8) < 1e-5
