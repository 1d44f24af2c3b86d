"""Whitening against a dense eigendecomposition, exact whole-number columns, and the eigensolver on known matrices."""

import math

import numpy as np
import pytest

from manifestqc.llm import whitening as wh

SCHEMA = "vec_id long, embedding array<float>, n long, component int, label string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, 2, "x") for i, v in rows], SCHEMA)


def whole(rows):
    good = [(i, [math.floor(1024 * float(np.float32(x))) + 100000 for x in v]) for i, v in rows if v and None not in v and np.isfinite(np.array(v, float)).all()]
    sizes = [len(v) for _, v in good]
    d = max(set(sizes), key=lambda x: (sizes.count(x), x)) if sizes else 0
    return [(i, v) for i, v in good if len(v) == d]


def check(got, rows, components=8):
    rows = whole(rows)
    ids, x = [i for i, _ in rows], np.array([v for _, v in rows])
    n, s = len(x), x.sum(axis=0)
    centred = x - s / n
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1], u[:, ::-1]
    k = min(components, int((e > 1e-9 * e.sum()).sum()))
    assert len(got) == n * k and {r["n"] for r in got} == {n}
    table = {}
    for r in got:
        table.setdefault(r["component"], []).append((str(r["vec_id"]), r["deviation"], r["whitened"], r["explained"], r["identity_error"]))
    assert sorted(table) == list(range(1, k + 1))
    dev = [int(sum((n * int(a) - int(b)) ** 2 for a, b in zip(v, s))) for v in x]
    for c, found in table.items():
        want = sorted(zip(map(str, ids), dev, centred @ u[:, c - 1] / np.sqrt(e[c - 1])))
        for sign in (1, -1):
            if np.allclose([f[2] for f in sorted(found, key=lambda f: (f[0], f[1], sign * f[2]))], [sign * w for _, _, w in sorted(want, key=lambda w: (w[0], w[1], w[2]))], atol=1e-8):
                break
        else:
            raise AssertionError(f"component {c}")
        assert sorted(f[:2] for f in found) == [w[:2] for w in want]
        assert all(f[3] == pytest.approx(e[c - 1] / e.sum(), rel=1e-10) and f[4] < 1e-9 for f in found)


def test_against_dense(spark):
    r = np.random.default_rng(4)
    v = r.standard_normal((500, 20)) * np.linspace(0.2, 2, 20) + 3
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    odd = [(900, None), (901, [None] + [1.0] * 19), (902, [float("nan")] * 20), (903, [float("-inf")] * 20), (904, []), (905, [1.0] * 3), (None, [0.5] * 20),
           ((1 << 53) + 1, [0.25] * 20), ((1 << 53) + 1, [0.25] * 20), (3, v[3].tolist())]
    check(wh.whitened(frame(spark, rows + odd).repartition(5)).collect(), rows + odd)


def test_few_dimensions_and_little_variance(spark):
    r = np.random.default_rng(5)
    rows = [(i, x.tolist()) for i, x in enumerate(r.standard_normal((60, 3)))]
    check(wh.whitened(frame(spark, rows)).collect(), rows)
    line = [(i, [i * 0.5, 1.0, -i * 1.0, 7.0]) for i in range(50)]  # one direction only
    got = wh.whitened(frame(spark, line)).collect()
    assert {r["component"] for r in got} == {1} and len(got) == 50 and got[0]["explained"] == pytest.approx(1)


def test_no_variance_and_empty(spark):
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 5, [(1, None)], [(1, [])]):
        out = wh.whitened(frame(spark, rows))
        assert out.collect() == [] and out.dtypes == [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"),
                                                     ("explained", "double"), ("identity_error", "double")]


def test_sums_on_spark_and_on_the_driver_agree(spark):
    rows = frame(spark, [(i, x.tolist()) for i, x in enumerate(np.random.default_rng(9).standard_normal((300, 6)))]).repartition(4)
    few, many = wh.Fit(rows), wh.Fit(rows, partials=0)
    columns = np.random.default_rng(10).standard_normal((6, 3))
    assert np.allclose(few.product(columns), many.product(columns), rtol=1e-12) and few.trace() == pytest.approx(many.trace(), rel=1e-12)


def test_exact_beyond_products_of_64_bits():
    x = np.array([[3, 10**9], [5, -(10**9)]])
    sums = [8, 0]
    assert wh.deviations(x, 2, sums, False).tolist() == [(6 - 8) ** 2 + (2 * 10**9) ** 2, (10 - 8) ** 2 + (2 * 10**9) ** 2]
    with pytest.raises(OverflowError):
        wh.deviations(x * 10**4, 2, sums, False)
    with pytest.raises(OverflowError):
        wh.whole_numbers(np.array([1e30]))


@pytest.mark.parametrize("d,values", [(30, np.linspace(1, 2, 30)), (200, np.r_[np.full(5, 9.0), np.linspace(0, 8.9, 195)]), (50, np.r_[1.0, np.zeros(49)]),
                                      (12, np.ones(12)), (5, np.arange(5.0)), (300, 1.02 ** -np.arange(300))])
def test_eigenpairs_of_known_matrices(d, values):
    q = np.linalg.qr(np.random.default_rng(6).standard_normal((d, d)))[0]
    v = (q * values) @ q.T
    got, u = wh.jacobi_davidson(lambda z: v @ z, d, 8)
    want = np.sort(values)[::-1][:8]
    assert np.allclose(got, want, atol=1e-13 * want[0] * 10)
    assert np.abs(u.T @ u - np.eye(len(want))).max() < 1e-12
    assert np.linalg.norm(v @ u - u * got, axis=0).max() < 1e-12 * want[0]


def test_minres_solves():
    a = np.random.default_rng(7).standard_normal((15, 15))
    a = a + a.T
    b = np.random.default_rng(8).standard_normal((15, 3))
    assert np.allclose(a @ wh.minres(lambda z: a @ z, b, 60, 1e-13), b, atol=1e-8)
