"""Toxicity as maximum-scoring segment search over token log-odds.

Tokens are lower-cased words and, for words over ``LEAD`` bytes, their first
``LEAD`` bytes.  From labelled rows every token gets the log-odds of toxic against
clean documents under a Dirichlet prior that splits ``PRIOR`` pseudo-counts
as the classes are split, so that rare tokens stay near zero; tokens whose
log-odds are not significant (``MIN_Z``) or small (``MIN_ODDS``) score zero.  A position scores the sum of its
tokens, less a small drift, which makes the mean of clean text negative as
segment statistics need.

A linear scan (over the positive positions, with a stack of candidates) finds
every maximal-scoring segment of a text.  Segment scores are calibrated as
extreme values: ``lam`` solves E[exp(lam * score)] = 1 over the positions of
clean training texts and ``k`` is fitted to their maxima, so that
E = k * n * exp(-lam * S) is the number of such segments expected by chance in
n words.  Segments with E below ``MAX_E`` are passages.  The document's
evidence is the sum of -ln E over its passages, and a logistic curve fitted on
the training rows turns it into a score from 0 to 1.

Labels are learnt from a bounded sample: the ``MAX_LABELS`` labelled rows with
the smallest hash of doc_id (all of them where there are fewer), which makes the
table broadcast bounded.  The token table is bounded too (``MAX_TOKENS`` by
significance).  Scoring reads every document whole, in one narrow scan.

Defined results: null or wordless text has no passage and gets the score of no
evidence; a null doc_id is scored like any other; repeated label rows count as
toxic if one of them is; without rows of both classes every score is 0; an empty
table gives no rows; other columns are kept by ``not_toxic`` and not read otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import exp, log

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from manifestqc.llm.common import checkpoint, hashed_runs

MAX_LABELS = 200_000
MAX_TOKENS = 1 << 18
PRIOR = 5.0
MIN_Z = 4.0
MIN_ODDS = 1.5
MIN_DRIFT = 0.05
MAX_E = 0.1
REJECT = 0.7
LEAD = 4
BIN = 64  # position scores are counted in steps of 1 / BIN for the calibration
# letters, digits and bytes of other characters make words
_WORD = np.array([48 <= c <= 57 or 97 <= c <= 122 or c >= 128 for c in range(256)], np.uint8)


def tokens(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-case words, and of their leads (0 for short words)."""
    word, _, lead = hashed_runs(text.lower().encode("utf-8", "replace") if isinstance(text, str) else b"", _WORD, LEAD)
    return word, lead


@dataclass
class Model:
    tokens: np.ndarray  # sorted uint64
    odds: np.ndarray
    drift: float = MIN_DRIFT
    lam: float = 1.0
    k: float = 1.0
    slope: float = 0.0
    base: float = -30.0

    def scores(self, found: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        out = np.full(len(found[0]), -self.drift)
        if len(out) and len(self.tokens):
            for h in found:
                at = np.minimum(np.searchsorted(self.tokens, h), len(self.tokens) - 1)
                out += np.where(self.tokens[at] == h, self.odds[at], 0.0)
        return out

    def evidence(self, n: int, best: list[float]) -> float:
        """Sum of -ln E over the segments expected less than MAX_E times."""
        found = [self.lam * s - log(max(self.k * n, 1e-300)) for s in best]
        return sum(x for x in found if x > -log(MAX_E))

    def score(self, evidence: float) -> float:
        z = self.base + self.slope * np.log1p(evidence)
        return float(1 / (1 + exp(-max(-30.0, min(30.0, z)))))


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, last, score), left to right, in linear time."""
    upto = np.concatenate([[0.0], np.cumsum(scores)])
    stack: list[tuple[int, int, float, float]] = []  # first, last, sum before, sum with
    for i in np.flatnonzero(scores > 0).tolist():
        new = (i, i, float(upto[i]), float(upto[i + 1]))
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= new[2]:
                j -= 1
            if j < 0 or stack[j][3] >= new[3]:
                stack.append(new)
                break
            new = (stack[j][0], new[1], stack[j][2], new[3])
            del stack[j:]
    return [(a, z, r - left) for a, z, left, r in stack]


def training_rows(docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS) -> DataFrame:
    """text and toxic of the labelled rows that may be learnt from: crc32(doc_id as text) mod 3 is not 1.

    Equal texts count once, as copies would pass for many observations of their
    words.  Only ids and hashes of the sample move, never texts.
    """
    known = (labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labels))
    hashes = docs.join(F.broadcast(known), "doc_id").where("text is not null").select("doc_id", "toxic", F.xxhash64("text").alias("h"))
    once = checkpoint(hashes.groupBy("h").agg(F.min(F.struct("doc_id", "toxic")).alias("one")).select("h", "one.*"))
    found = docs.select("doc_id", "text").join(F.broadcast(once), "doc_id").where(F.xxhash64("text") == F.col("h"))
    return found.select("text", "toxic")


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _token_counts(train: DataFrame) -> tuple[DataFrame, list[int]]:
    """Documents of each class that hold a token, counted once per document; and the documents of each class."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            per_class: list[list[np.ndarray]] = [[], []]
            for text, y in zip(pdf["text"], pdf["toxic"]):
                word, lead = tokens(text)
                if len(word):
                    per_class[int(y > 0)].append(np.unique(np.concatenate([word, lead[lead != 0]])))
            for y, parts in enumerate(per_class):
                if parts:
                    token, n = np.unique(np.concatenate(parts), return_counts=True)
                    yield pd.DataFrame({"token": token.view(np.int64), "n0": n * (1 - y), "n1": n * y})

    counts = train.mapInPandas(run, "token long, n0 long, n1 long").groupBy("token").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    per = {r["y"]: r["n"] for r in train.groupBy((F.col("toxic") > 0).alias("y")).agg(F.count(F.lit(1)).alias("n")).collect()}
    return counts, [per.get(False, 0), per.get(True, 0)]


def _odds(counts: DataFrame, docs0: int, docs1: int, max_tokens: int) -> tuple[np.ndarray, np.ndarray]:
    share1 = docs1 / (docs0 + docs1)
    a1, a0 = F.col("n1") + PRIOR * share1, F.col("n0") + PRIOR * (1 - share1)
    odds = F.log(a1 / a0) - log(docs1 / docs0)
    z = odds / F.sqrt(1 / a1 + 1 / a0)
    best = (counts.select("token", odds.alias("odds"), z.alias("z")).where((F.abs("z") >= MIN_Z) & (F.abs("odds") >= MIN_ODDS))
            .orderBy(F.abs("z").desc(), "token").limit(max_tokens).toPandas())
    tokens = best["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], best["odds"].to_numpy(np.float64)[order]


def _position_histogram(train: DataFrame, model: Model) -> dict[int, int]:
    """Position scores without drift of the clean rows, in steps of 1 / BIN: a table whose size the odds bound."""
    held = train.sparkSession.sparkContext.broadcast(model)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            steps = [np.rint((held.value.scores(w) + held.value.drift) * BIN).astype(np.int64) for w in map(tokens, pdf["text"]) if len(w[0])]
            if steps:
                step, n = np.unique(np.concatenate(steps), return_counts=True)
                yield pd.DataFrame({"step": step, "n": n})

    rows = train.where("toxic = 0").mapInPandas(run, "step long, n long").groupBy("step").agg(F.sum("n").alias("n")).collect()
    return {r["step"]: r["n"] for r in rows}


def _solve_lambda(steps: np.ndarray, share: np.ndarray) -> float:
    """The positive root of sum(share * exp(lam * score)) = 1."""
    if not (steps > 0).any():
        return 1.0
    lo, hi = 1e-4, 1.0
    value = lambda x: float((share * np.exp(np.minimum(x * steps, 700))).sum())
    while value(hi) < 1 and hi < 64:
        hi *= 2
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if value(mid) < 1 else (lo, mid)
    return hi


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and base of a weighted one-variable logistic fit with a weak pull to zero (Newton steps)."""
    a = np.stack([x, np.ones_like(x)], 1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        gradient = a.T @ (weight * (y - p)) - 0.01 * beta
        hessian = (a * (weight * p * (1 - p))[:, None]).T @ a + 0.01 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS, max_tokens: int = MAX_TOKENS) -> Model:
    train = training_rows(docs, labels, max_labels)
    counts, (docs0, docs1) = _token_counts(train)
    none = Model(np.zeros(0, np.uint64), np.zeros(0))
    if not docs0 or not docs1:
        return none
    model = Model(*_odds(counts, docs0, docs1, max_tokens))
    histogram = _position_histogram(train, model)
    if not histogram or not len(model.tokens):
        return none
    steps = np.array(list(histogram), np.float64) / BIN
    share = np.array(list(histogram.values()), np.float64)
    share /= share.sum()
    model.drift = max(MIN_DRIFT, 2 * float((share * steps).sum()))
    model.lam = _solve_lambda(steps - model.drift, share)
    held = train.sparkSession.sparkContext.broadcast(model)

    def best(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for text, y in zip(pdf["text"], pdf["toxic"]):
                scores = held.value.scores(tokens(text))
                rows.append((int(y > 0), len(scores), [s for _, _, s in segments(scores)]))
            yield pd.DataFrame(rows, columns=["y", "n", "best"])

    found = checkpoint(train.mapInPandas(best, "y int, n long, best array<double>"))
    top = F.coalesce(F.array_max("best"), F.lit(0.0))
    clean = found.where("y = 0 and n > 0").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("n") * F.exp(-model.lam * top)).alias("x")).first()
    if not clean["n"]:
        return none
    model.k = clean["n"] / clean["x"]
    passage = F.transform("best", lambda s: F.lit(model.lam) * s - F.log(F.lit(model.k) * F.col("n")))
    evidence = F.aggregate(F.filter(passage, lambda x: x > -log(MAX_E)), F.lit(0.0), lambda a, x: a + x)
    bins = (found.select("y", F.floor(F.log1p(F.when(F.col("n") > 0, evidence).otherwise(0.0)) * BIN).alias("bin"))
            .groupBy("bin", "y").agg(F.count(F.lit(1)).alias("n")).toPandas())
    model.slope, model.base = _logistic(bins["bin"].to_numpy(np.float64) / BIN, bins["y"].to_numpy(np.float64), bins["n"].to_numpy(np.float64))
    return model


SCORED = "score double, predicted int, passages array<struct<first:int,last:int,log_odds:double>>"


def scorer(spark, model: Model):
    """Column function: text -> SCORED.  Passages are word numbers (letters and digits) with their summed log-odds."""
    held = spark.sparkContext.broadcast(model)

    @F.pandas_udf(SCORED)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = held.value
        for texts in batches:
            rows = []
            for text in texts:
                scores = m.scores(tokens(text))
                found = segments(scores)
                score = m.score(m.evidence(len(scores), [s for _, _, s in found]))
                limit = log(max(m.k * len(scores), 1e-300)) - log(MAX_E)
                rows.append((score, int(score >= REJECT), [{"first": a, "last": z, "log_odds": s} for a, z, s in found if m.lam * s > limit]))
            yield pd.DataFrame(rows, columns=["score", "predicted", "passages"])

    return run


def toxicity(docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS) -> DataFrame:
    """doc_id, held_out, score, predicted and passages of every document."""
    run = scorer(docs.sparkSession, fit(docs, labels, max_labels))
    return (docs.select("doc_id", run(F.col("text")).alias("r"))
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "r.score", "r.predicted", "r.passages"))


def not_toxic(docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS) -> DataFrame:
    """``docs`` without the rows predicted toxic; columns as they are."""
    run = scorer(docs.sparkSession, fit(docs, labels, max_labels))
    name = "_toxicity"
    while name in docs.columns:
        name += "_"
    return docs.withColumn(name, run(F.col("text"))).where(F.col(f"{name}.predicted") == 0).drop(name)
