"""Multiprobe hashing against brute force: exact distances and order, recall, and every row where no index is good enough."""

import numpy as np
import pytest
from llm_cases import docs_of  # noqa: F401
from pyspark.sql import functions as F

from manifestqc.llm import neighbours as nb

SCHEMA = "vec_id long, embedding array<float>, label int, query_id long, score double, vector string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, 1, 2.0, "x") for i, v in rows], SCHEMA)


def kept(rows):
    """Distinct (id, float32 entries) that take part."""
    good = [(i, tuple(np.float32(x) + 0.0 for x in v)) for i, v in rows if v is not None and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v)]
    sizes = [len(v) for _, v in good]
    d = max(set(sizes), key=lambda x: (sizes.count(x), x)) if sizes else 0
    return list({(i, v) for i, v in good if len(v) == d})


def exact(rows, every, top=10):
    rows = kept(rows)
    out = {}
    for i, v in rows:
        if i is not None and i % every == 0:
            near = [(float(np.sqrt(((np.array(w, float) - np.array(v, float)) ** 2).sum())), j) for j, w in rows if (j, w) != (i, v)]
            near.sort(key=lambda x: (x[0], x[1] is None, x[1] or 0))
            out.setdefault(i, []).append([(j, s) for s, j in near[:top]])
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return out


def clustered(n, d=24, seed=3):
    r = np.random.default_rng(seed)
    centres = r.standard_normal((12, d)) * 1.5
    v = centres[r.integers(0, 12, n)] + r.standard_normal((n, d))
    v[: n // 3] = centres[0] + 0.01 * r.standard_normal((n // 3, d))  # a third of all rows in one place
    return [(int(i), x.astype(np.float32)) for i, x in zip(r.permutation(n), v)]


def test_recall_and_exact_scores(spark):
    rows = clustered(4000)
    want = exact(rows, 50)
    got = found(nb.neighbours(frame(spark, rows).repartition(5), F.col("vec_id") % 50 == 0, lot_rows=256, group=16))
    assert got.keys() == want.keys()
    by_id = dict(rows)
    hits = 0
    for q, near in got.items():
        assert [k for k, _, _ in near] == list(range(1, 11))
        for _, i, s in near:
            assert i != q and s == pytest.approx(np.linalg.norm(by_id[i].astype(float) - by_id[q].astype(float)), rel=1e-14)
        assert near == sorted(near, key=lambda x: (x[2], x[1]))
        hits += len({i for _, i, _ in near} & {i for i, _ in want[q][0]})
    assert hits >= 0.9 * 10 * len(want)


HARD = ([(k, [1.0, 2.0, 3.0]) for k in range(40)] + [(3, [1.0, 2.0, 3.0]), (100, [0.0, 0.0, 0.0]), (101, None), (102, [1.0, None, 2.0]), (103, [float("nan"), 1, 1]),
        (104, [float("inf"), 1, 1]), (105, []), (106, [1.0, 2.0]), (None, [1.0, 2.0, 3.5]), (None, [1.0, 2.0, 3.5]), (200, [-0.0, 1.0, 0.0]), (201, [0.0, 1.0, 0.0]),
         (202, [0.0, -1.0, 0.0]), (203, [2.0, 0.0, 0.0]), ((1 << 53) + 1, [5.0, 5.0, 5.0]), ((1 << 53) + 2, [5.0, 5.0, 5.0]), (300, [1.0, 1.0, 1.0]), (300, [9.0, 9.0, 9.0])])


@pytest.mark.parametrize("rows", [HARD, HARD[:7], HARD[:1], HARD[40:47]])
def test_copies_ties_nulls_and_odd_vectors(spark, rows):
    """A recall that no index has makes every row a candidate, so the result is exact."""
    got = found(nb.neighbours(frame(spark, rows), recall=2.0))
    want = {i: sorted(((k + 1, j, pytest.approx(s, rel=1e-14)) for near in lists for k, (j, s) in enumerate(near)), key=lambda x: x[0]) for i, lists in exact(rows, 1).items()}
    want = {i: v for i, v in want.items() if v}
    assert got.keys() == want.keys()
    for i in want:
        if i != 300:
            assert got[i] == want[i]
        else:  # two rows share the id: two lists
            assert sorted(k for k, _, _ in got[i]) == sorted(k for k, _, _ in want[i])


def test_too_few_candidates_means_every_row(spark):
    rows = clustered(300)
    got = found(nb.neighbours(frame(spark, rows + [(5000, [1000.0] * 24)]), F.col("vec_id") % 100 == 0))
    assert all(len(v) == 10 for v in got.values()) and 5000 in got
    assert [i for _, i, _ in got[5000]] == [i for i, _ in exact(rows + [(5000, [1000.0] * 24)], 100)[5000][0]]


def test_empty(spark):
    assert found(nb.neighbours(frame(spark, clustered(5)).limit(0))) == {}
    assert found(nb.neighbours(frame(spark, [(1, None), (2, [0.0])]))) == {}
    assert nb.neighbours(frame(spark, []), F.col("vec_id") % 100 == 0).dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]


def test_probes_are_the_likeliest_buckets():
    h = nb.Hashes(6, 4, 2, 1.0)
    v = np.random.default_rng(1).standard_normal((3, 6))
    chance, buckets = h.probes(h.projected(v), 1, 0.8, 50)
    every, names = h.probes(h.projected(v), 1, 0.8, 5**4)
    assert (np.diff(every, axis=1) <= 0).all() and every.sum(axis=1) == pytest.approx([1, 1, 1], abs=1e-3)
    assert np.allclose(chance, every[:, :50]) and all(set(a) == set(b[:50]) or np.isclose(e[49], e[50]) for a, b, e in zip(buckets, names, every))
    near = v[0] + 0.8 * np.random.default_rng(2).standard_normal((4000, 6)) * np.sqrt(1 / 6) / 1  # distance about 0.8
    home = h.buckets(near)[1]
    assert np.isin(home, buckets[0]).mean() == pytest.approx(chance[0].sum(), abs=0.05)
    assert h.buckets(v)[1][0] == names[0][0] or every[0][0] < 0.6
