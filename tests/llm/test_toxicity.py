import random
import zlib

import numpy as np

from llm_cases import docs_of, words
from manifestqc.llm import toxicity


def labelled_corpus(spark, n=900, seed=5):
    r = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        toxic = i % 6 == 0
        w = words(r, r.randint(5, 200))
        if toxic:
            for _ in range(max(2, len(w) // 25)):
                w[r.randrange(len(w))] = r.choice(["idiot", "scum", "nasty", "vileword" + r.choice("abcdef")])
        docs.append((i, " ".join(w)))
        if i % 10:
            labels.append((i, 1, int(toxic)))
    return docs, labels, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_rows_are_found(spark, docs_of):
    docs, labels, table = labelled_corpus(spark)
    got = {r.doc_id: r for r in toxicity.toxicity(docs_of(docs), table).collect()}
    assert len(got) == len(docs)
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [(got[i].predicted, i % 6 == 0) for i in got if got[i].held_out]
    hits = sum(p and y for p, y in held)
    assert hits / sum(p for p, _ in held) > 0.9 and hits / sum(y for _, y in held) > 0.9


def test_held_out_labels_are_not_read(spark, docs_of):
    docs, labels, table = labelled_corpus(spark, 300)
    flipped = spark.createDataFrame([(i, q, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in labels], table.schema)
    a, b = (sorted((r.doc_id, r.score) for r in toxicity.toxicity(docs_of(docs), t).collect()) for t in (table, flipped))
    assert a == b


def test_nulls_repeats_clashing_columns_and_no_labels(spark):
    docs, _, table = labelled_corpus(spark, 300)
    rows = [(i, t) for i, t in docs] + [(900, None), (901, ""), (None, "idiot scum"), (902, "x " * 30_000), (0, docs[0][1])]
    df = spark.createDataFrame([(i, t, "s", 5) for i, t in rows], "doc_id long, text string, score string, predicted int")
    known = table.union(spark.createDataFrame([(None, 1, 1), (3, 1, None), (12, 0, 1), (12, 0, 0)], table.schema))
    out = toxicity.toxicity(df, known).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    assert by[900].score == by[901].score and by[900].predicted == 0 and by[None].predicted == 1 and not by[None].held_out
    kept = toxicity.not_toxic(df, known)
    assert kept.columns == df.columns and kept.where("doc_id = 900").count() == 1 and kept.where("doc_id is null").count() == 0
    none = toxicity.toxicity(df, table.limit(0)).collect()
    assert len(none) == len(rows) and {r.predicted for r in none} == {0}
    assert toxicity.toxicity(df.limit(0), table).count() == 0


def brute_segments(s):
    """All maximal segments by their recursive definition: the best segment, then the same left and right of it."""
    if len(s) == 0:
        return []
    upto = np.concatenate([[0], np.cumsum(s)])
    best = max(((upto[z + 1] - upto[a], -(z - a), -a) for a in range(len(s)) for z in range(a, len(s))))
    if best[0] <= 0:
        return []
    a = -best[2]
    z = a - best[1]
    right = [(x + z + 1, y + z + 1, v) for x, y, v in brute_segments(s[z + 1:])]
    return brute_segments(s[:a]) + [(a, z, float(best[0]))] + right


def test_segments_match_their_definition():
    r = np.random.default_rng(2)
    for _ in range(300):
        s = r.integers(-6, 7, r.integers(0, 14)) + r.random() * 1e-3
        s = s + r.random(len(s)) * 1e-6  # no ties
        got, want = toxicity.segments(s), brute_segments(s)
        assert [(a, z) for a, z, _ in got] == [(a, z) for a, z, _ in want]
        assert np.allclose([v for _, _, v in got], [v for _, _, v in want])


def test_lambda_solves_its_equation():
    steps, share = np.array([-0.1, 2.0, 5.0]), np.array([0.98, 0.015, 0.005])
    lam = toxicity._solve_lambda(steps, share)
    assert abs((share * np.exp(lam * steps)).sum() - 1) < 1e-6
