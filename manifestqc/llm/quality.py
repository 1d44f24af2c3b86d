"""Quality rules: base rules on words and lines, then a hashed n-gram log-likelihood ratio.

Words, marks and pairs of neighbours are hashed into BUCKETS buckets.  Two
multinomials are counted: over the trusted target (documents labelled as good)
and over the whole raw corpus.  A document's score is its mean log-ratio of the
two, so length does not matter.

Trusted documents whose crc32(doc_id as text) mod 3 is 1 are left out of the
target and show how unseen good documents score.  The threshold lies below the
score that all but ``REJECT_SHARE`` of them reach, by the distance from there to
their median.  It is read from a histogram in fixed steps, is the same number for
every document, and nothing is random.

The target counts cover all other trusted documents, the raw counts all
documents, the threshold all trusted documents left out of the target, and every
document is scored whole.  Only documents that may be trusted (a bitmap says) meet
the labels in a shuffle.  ``max_labels`` bounds the target to the labels of
smallest hash where a caller asks for it; nothing does by default.

Defined results: null or wordless text has all counts 0, the score 0 and fails the
base rules; without trusted rows the method keeps what the base rules keep;
repeated rows are scored each on its own; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from manifestqc.llm.common import bit_number, checkpoint, hashed_runs, mix, possible, split_by_ids, summed_bins, text_slices, window_hashes

BUCKETS = 1 << 16
REJECT_SHARE = 0.0005
STEP = 1024  # scores are counted in steps of 1 / STEP for the threshold
SMOOTHING = 1.0
MIN_WORDS, MAX_REPEAT_PERCENT, REPEAT_WIDTH = 50, 50, 3
WHITE, SYMBOLS = " \t\n\x0b\x0c\r", "#*$%&|<>"
# words (letters, digits, bytes of other characters) and runs of marks
_TOKENS = np.array([0 if c in b" \t\n\x0b\x0c\r" else 1 if chr(c).isascii() and chr(c).isalnum() or c >= 128 else 2 for c in range(256)], np.uint8)
_MUL = np.uint64(0x9E3779B97F4A7C15)


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def base_counts(text: str) -> tuple[int, int, int, int, int, bool]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    words = hashed_runs(text.encode("utf-8", "surrogatepass"))[0]
    n = len(words)
    chars = len(text) - sum(map(text.count, WHITE))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(WHITE)]
    repeat = 0
    if n >= REPEAT_WIDTH:
        h = window_hashes(words, REPEAT_WIDTH)
        _, where, count = np.unique(h, return_inverse=True, return_counts=True)
        twice = count[where] > 1
        if twice.any():
            hit = np.zeros(n, bool)
            for k in range(REPEAT_WIDTH):
                hit[k:k + len(twice)] |= twice
            repeat = int(hit.sum())
    failed = n < MIN_WORDS or 100 * repeat > MAX_REPEAT_PERCENT * n
    return n, chars, symbols, len(lines) - len(set(lines)), repeat, failed


def buckets(text: str) -> np.ndarray:
    """Bucket of every token and of every pair of neighbours."""
    h = hashed_runs(text.encode("utf-8", "surrogatepass"), _TOKENS)[0]
    grams = np.concatenate([mix(h), mix(h[:-1] * _MUL + h[1:] + np.uint64(1))]) if len(h) else h
    return (grams >> np.uint64(48)).astype(np.int64)


def target_ids(labels: DataFrame, max_labels: int | None) -> DataFrame:
    """doc_id of every trusted document that is not held out, once; an id labelled more than once has its largest label."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.max("quality").cast("int").alias("label"))
    if max_labels is not None:
        known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labels)
    return known.where((F.col("label") == 1) & ~held_out(F.col("doc_id"))).select("doc_id")


def log_ratio(docs: DataFrame, labels: DataFrame, max_labels: int | None = None) -> np.ndarray | None:
    """ln(target / raw) of each bucket; every document is counted once."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for pdf, texts in text_slices(frames):
            for text, label in zip(texts, pdf["label"]):
                if text:
                    n = np.bincount(buckets(text), minlength=BUCKETS) if len(text) > BUCKETS else None
                    if n is None:
                        b, c = np.unique(buckets(text), return_counts=True)
                        raw[b] += c
                        if label == 1:
                            target[b] += c
                    else:
                        raw += n
                        if label == 1:
                            target += n
        if raw.any():
            yield pd.DataFrame({"raw": [raw], "target": [target]})

    known = checkpoint(target_ids(labels, max_labels))
    others, perhaps = split_by_ids(docs.select("doc_id", "text"), known)
    met = perhaps.join(known.withColumn("label", F.lit(1)), "doc_id", "left").select("text", F.coalesce("label", F.lit(0)).alias("label"))
    texts = others.select("text", F.lit(0).alias("label")).unionByName(met)
    counted = checkpoint(texts.mapInPandas(run, "raw array<long>, target array<long>"))
    raw, target = (summed_bins(counted, c, BUCKETS).astype(np.float64) for c in ("raw", "target"))
    if not target.any():
        return None
    prior = SMOOTHING * (raw + 1) / (raw.sum() + BUCKETS) * BUCKETS
    return np.log((target + prior) / (target.sum() + prior.sum())) - np.log((raw + prior) / (raw.sum() + prior.sum()))


def score(text: str, ratio: np.ndarray) -> float:
    b = buckets(text)
    return float(ratio[b].mean()) if len(b) else 0.0


def threshold(docs: DataFrame, labels: DataFrame, ratio: np.ndarray, reject_share: float) -> float:
    """The least score to keep, from all trusted documents left out of the target that pass the base rules."""
    held = docs.sparkSession.sparkContext.broadcast(ratio)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf, texts in text_slices(frames):
            found = [(i, int(np.floor(score(t, held.value) * STEP))) for i, t in zip(pdf["doc_id"].tolist(), texts) if not base_counts(t)[5]]
            yield pd.DataFrame(found, columns=["doc_id", "step"], dtype=np.int64)

    known = checkpoint(labels.where(held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("quality").cast("int").alias("label")).where("label = 1").select("doc_id"))
    bit = bit_number(F.xxhash64("doc_id"))
    # ids and steps meet the labels, not texts; the bitmap leaves out most documents without a trusted label
    trusted = docs.where(held_out(F.col("doc_id"))).where(possible(known, bit)(bit)).select("doc_id", "text").mapInPandas(run, "doc_id long, step long").join(known, "doc_id")
    rows = sorted((r["step"], r["n"]) for r in trusted.groupBy("step").agg(F.count(F.lit(1)).alias("n")).collect())
    total = sum(n for _, n in rows)
    if not total:
        return -np.inf

    def reached(share: float) -> int:
        below = 0
        for step, n in rows:
            below += n
            if below > share * total:
                return step
        return rows[-1][0]

    low, middle = reached(reject_share), reached(0.5)
    return (low - (middle - low)) / STEP


VERDICT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, log_ratio double")


def quality(docs: DataFrame, labels: DataFrame, max_labels: int | None = None, reject_share: float = REJECT_SHARE) -> DataFrame:
    """doc_id and VERDICT of every document."""
    ratio = log_ratio(docs, labels, max_labels)
    least = -np.inf if ratio is None else threshold(docs, labels, ratio, reject_share)
    held = docs.sparkSession.sparkContext.broadcast(np.zeros(BUCKETS) if ratio is None else ratio)

    @F.pandas_udf(VERDICT)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text in texts:
                text = text if isinstance(text, str) else ""
                base, mean = base_counts(text), score(text, held.value)
                rows.append((*base, not base[5] and mean >= least, mean))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in VERDICT.split(", ")])

    return docs.select("doc_id", run(F.col("text")).alias("r")).select("doc_id", "r.*")
