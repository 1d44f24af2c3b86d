import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from llm_cases import corpus, docs_of, words
from manifestqc.llm import quality

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute_force(t):
    w = WORD.findall(t or "")
    c = Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
    hit = {k + d for k in range(len(w) - 2) if c[tuple(w[k:k + 3])] > 1 for d in range(3)}
    lines = [x for x in (t or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(hit),
            len(w) < 50 or 100 * len(hit) > 50 * len(w))


def test_base_counts_match_brute_force():
    r = random.Random(9)
    texts = [t for _, t in corpus()] + ["", "a a a a", "a b c a b c x", "x\n x\nx\n\n \n", "é\x1cñ\x85日 本\x0b|<>"]
    texts += ["".join(r.choices("ab \n\t#|é\x1c ", k=r.randint(0, 200))) for _ in range(300)]
    for t in texts:
        assert quality.base_counts(t) == brute_force(t), repr(t)


def labelled_corpus(spark, n=300):
    r = random.Random(11)
    rows, labels = [], []
    for i in range(n):
        w = words(r, r.randint(60, 200), 800)
        good = i % 5 > 0
        rows.append((i, " ".join(w) if good else " ".join(x.upper() + "$$$" for x in w)))
        if i % 3:
            labels.append((i, int(good), 0))
    return rows, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_target_like_texts_are_kept_and_others_not(spark, docs_of):
    rows, labels = labelled_corpus(spark)
    got = {r.doc_id: r for r in quality.quality(docs_of(rows), labels).collect()}
    kept = [(got[i].kept, i % 5 > 0) for i, _ in rows]
    assert sum(k for k, good in kept if good) / sum(good for _, good in kept) > 0.97
    assert not any(k for k, good in kept if not good)
    again = {r.doc_id: r.log_ratio for r in quality.quality(docs_of(rows).repartition(5), labels).collect()}
    assert all(abs(again[i] - got[i].log_ratio) < 1e-9 for i in again)


def test_nulls_repeats_clashing_columns_and_no_target(spark, docs_of):
    rows, labels = labelled_corpus(spark, 60)
    rows = rows + [(500, None), (501, ""), (None, rows[1][1]), (1, rows[1][1]), (502, "word and more words " * 10_000)]
    df = spark.createDataFrame([(i, t, 1.0, "k", 3) for i, t in rows], "doc_id long, text string, log_ratio double, kept string, label int")
    got = quality.quality(df, labels).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[500][1:8] == by[501][1:8] == (0, 0, 0, 0, 0, True, False) and by[502].base_failed
    assert by[None].kept == by[1].kept
    bare = quality.quality(df, labels.where("quality = 7")).collect()
    assert all(r.kept == (not r.base_failed) for r in bare)
    assert quality.quality(df.limit(0), labels).count() == 0


def test_threshold_covers_all_held_out_labels(spark, docs_of):
    texts = [(i, " ".join(f"w{(i * 7 + k * k) % (60 + i)}" for k in range(60 + i % 9))) for i in range(300)]
    df = docs_of(texts)
    labels = spark.createDataFrame([(i, 1 if i % 5 else 0, 0) for i, _ in texts] + [(5, 1, 0), (None, 1, 0), (7, None, 0)], "doc_id long, quality int, toxic int")
    ratio = quality.log_ratio(df, labels, 40)
    steps = sorted(int(np.floor(quality.score(t, ratio) * quality.STEP)) for i, t in texts
                   if (i % 5 or i == 5) and zlib.crc32(str(i).encode()) % 3 == 1 and not quality.base_counts(t)[5])
    assert len(steps) > 40
    low, middle = (steps[int(share * len(steps))] for share in (0.05, 0.5))
    want = (low - (middle - low)) / quality.STEP
    assert quality.threshold(df, labels, ratio, 0.05) == want
    got = quality.quality(df, labels, max_labels=40, reject_share=0.05).collect()
    assert all(r.kept == (not r.base_failed and r.log_ratio >= want) for r in got) and len({r.kept for r in got}) == 2


def test_target_takes_every_label(spark, docs_of):
    """More labels than any bound on their number, and documents only where the hash of the id comes last."""
    labels = spark.range(260_000).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    ids = [r.id for r in spark.range(260_000).orderBy(F.xxhash64("id").desc()).limit(40).collect()]
    texts = {i: f"word{i} and other{i % 7} words, " * (1 + i % 3) for i in ids}
    rows = [*texts.items(), (ids[0], "once more"), (None, "no id"), (300_000, "no label"), (ids[1], None)]
    raw, target = np.zeros(quality.BUCKETS), np.zeros(quality.BUCKETS)
    for i, t in rows:
        b = quality.buckets(t or "")
        np.add.at(raw, b, 1)
        if i is not None and i < 260_000 and zlib.crc32(str(i).encode()) % 3 != 1:
            np.add.at(target, b, 1)
    prior = quality.SMOOTHING * (raw + 1) / (raw.sum() + quality.BUCKETS) * quality.BUCKETS
    want = np.log((target + prior) / (target.sum() + prior.sum())) - np.log((raw + prior) / (raw.sum() + prior.sum()))
    got = sorted((r.n_words, r.log_ratio) for r in quality.quality(docs_of(rows), labels).collect())
    means = sorted((len(WORD.findall(t or "")), float(want[quality.buckets(t)].mean()) if t else 0.0) for _, t in rows)
    assert target.any() and len(got) == len(rows) and np.allclose(got, means, rtol=0, atol=1e-12)
