"""MinHash near-duplicates with sequential Bayesian verification.

1. Every whole text becomes its set of distinct word shingles (64-bit hashes),
   an identity of that set and a MinHash signature.  Texts with equal sets are
   collapsed first: one representative stands for all copies.
2. Signatures are banded.  28 bands of 4 rows miss a pair at similarity 0.8
   with probability (1 - 0.8^4)^28 < 4e-7, and more similar pairs less often.
3. In each bucket every member is paired with the bucket's hub, the member
   with the most bucket mates overall.  Two members of a bucket are both in the
   group of its hub; n near copies make about n such rows, not n^2 pairs.
4. Members that are similar to their hub are linked through it.  Only pairs
   with a member that is not can hold another link; these are compared in blocks
   of at most about ``BLOCK`` by ``BLOCK`` members, and a block returns no more links than
   it has members, which connect what the found pairs connect.
5. Every candidate is first checked against batches of signature positions: after
   each batch the posterior probability (uniform prior) that the similarity reaches
   the threshold decides, and a pair is pruned when it falls under ``hub_miss`` (with
   the hub) or ``miss`` (among members; see ``miss_rate`` for what that loses).  Only
   then are shingle sets read: those of pairs with the hub that are left, and of members
   that are left with a member pruned from the hub.  Survivors are verified on the
   full sets: with the hub by their intersection, among members by the differences to
   the hub, which give the exact intersection of the full sets as well.

Signatures travel for pairs only, and shingle sets only for what pruning leaves;
the latter are found again in a narrow scan behind a bitmap of fixed size.

Defined results: null or wordless text is an empty set, linked with nothing;
fewer words than a shingle give one shingle of all of them; ties go to the
smaller id; rows that repeat a doc_id are one document, whose links are those
of all its texts; a null doc_id is its own component (null) and is kept; an
empty table gives no rows; columns beside doc_id and the text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from manifestqc.llm.common import bit_number, bitmap, checkpoint, exact_ids, hashed_runs, id_array, id_list, in_bitmap, split_by_ids, text_slices, window_hashes
from manifestqc.llm.components import connected

BANDS, ROWS, HASHES = 28, 4, 128
MISS = 1e-6
#: A pair that is pruned from its hub has no second chance, so its bound is far lower.
HUB_MISS = 1e-9
BATCH = 16
BLOCK = 256


def _coefficients() -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(20240607)
    return r.integers(1, 2**63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1), r.integers(0, 2**63, HASHES, np.uint64)


def shingle_set(text: str, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes of the words between ASCII white space, A-Z lower-cased."""
    return np.unique(window_hashes(hashed_runs(text.encode("utf-8", "surrogatepass").lower())[0], width))


def signature(shingles: np.ndarray, block: int = 4096) -> np.ndarray:
    """HASHES minima as uint32."""
    mul, add = _coefficients()
    out = np.full(HASHES, np.uint32(0xFFFFFFFF))
    for i in range(0, len(shingles), block):
        part = (shingles[i:i + block, None] * mul[None, :] + add[None, :]) >> np.uint64(32)
        out = np.minimum(out, part.min(axis=0).astype(np.uint32))
    return out


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, set_id (16 bytes), signature (bytes) of every document."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf, texts in text_slices(frames):
            rows = []
            for text in texts:
                s = shingle_set(text, width)
                rows.append((len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest(), signature(s).tobytes()) if len(s) else (0, None, None))
            out = pd.DataFrame(rows, columns=["n_shingles", "set_id", "signature"], index=pdf.index)
            out["doc_id"] = id_array(id_list(pdf["doc_id"]))
            yield out[["doc_id", "n_shingles", "set_id", "signature"]]

    return exact_ids(docs.select("doc_id", "text"), "doc_id").mapInPandas(run, "doc_id long, n_shingles long, set_id binary, signature binary")


def fewest_matches(threshold: float, miss: float, batch: int = BATCH, hashes: int = HASHES) -> list[int]:
    """After each batch, the fewest agreeing positions a pair may have to stay.

    With m of n agreeing and a uniform prior the similarity is Beta(m+1, n-m+1);
    the chance that it is at least t equals that of at most m successes in n+1 trials.
    """
    least = []
    for n in range(batch, hashes + 1, batch):
        total, m = 0.0, 0
        while True:
            total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if total >= miss:
                break
            m += 1
        least.append(m)
    return least


def miss_rate(least: list[int], similarity: float, batch: int = BATCH) -> float:
    """Probability that a pair of this similarity is pruned after some batch."""
    alive = np.ones(1)
    step = np.array([comb(batch, k) * similarity**k * (1 - similarity) ** (batch - k) for k in range(batch + 1)])
    lost = 0.0
    for m in least:
        alive = np.convolve(alive, step)
        lost += float(alive[:m].sum())
        alive[:m] = 0.0
    return lost


def survivors(left: np.ndarray, right: np.ndarray, least: list[int], alive: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs into two signature arrays that no batch prunes; pairs pruned by one batch are not compared in the next."""
    a, b = alive
    agree = np.zeros(len(a), np.int64)
    for k, m in enumerate(least):
        part = slice(k * BATCH, (k + 1) * BATCH)
        agree = agree + (left[a, part] == right[b, part]).sum(axis=1)
        stay = agree >= m
        a, b, agree = a[stay], b[stay], agree[stay]
    return a, b


def matrix(signatures: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(map(bytes, signatures)), np.uint32).reshape(-1, HASHES)


def full_sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(id, shingles) of the documents in ``ids``, found in a narrow scan behind a bitmap."""
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(ids, bit_number(F.xxhash64("id"))))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            pdf = pdf[in_bitmap(bits.value, pdf["bit"].to_numpy())]
            for part, texts in text_slices(iter([pdf]), max_chars=200_000):
                sets = [shingle_set(t, width).view(np.int64) for t in texts]
                yield pd.DataFrame({"id": part["doc_id"].to_numpy(), "shingles": sets})

    rows = docs.where("doc_id is not null").select("doc_id", "text", bit_number(F.xxhash64("doc_id")).alias("bit")).mapInPandas(run, "id long, shingles array<long>")
    return rows.join(ids, "id", "left_semi")


def screened(stars: DataFrame, signatures: DataFrame, percent: int, miss: float) -> DataFrame:
    """Stars (hub, id) with the member's size and signature, and whether the batches leave the pair ``likely``."""
    least = fewest_matches(percent / 100, miss)
    member = signatures.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "signature")
    hub = signatures.select(F.col("doc_id").alias("hub"), F.col("n_shingles").alias("hub_n"), F.col("signature").alias("hub_signature"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            if len(pdf):
                small, large = np.minimum(pdf["n"], pdf["hub_n"]), np.maximum(pdf["n"], pdf["hub_n"])
                near = np.nonzero((100 * small >= percent * large).to_numpy())[0]
                stay, _ = survivors(matrix(pdf["signature"]), matrix(pdf["hub_signature"]), least, (near, near))
                likely = np.zeros(len(pdf), bool)
                likely[stay] = True
                yield pdf[["hub", "id", "n", "signature"]].assign(likely=likely)

    return checkpoint(stars.join(member, "id").join(hub, "hub").mapInPandas(run, "hub long, id long, n long, signature binary, likely boolean"))


def verified(docs: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """Screened stars with the member's differences to the hub and whether they are linked (exactly, on the full sets)."""
    ids = checkpoint(pairs.select("id").union(pairs.select("hub")).distinct())
    sets = full_sets(docs, ids, width)
    x, h = sets.select("id", F.col("shingles").alias("xs")), sets.select(F.col("id").alias("hub"), F.col("shingles").alias("hs"))
    n, m = F.size("xs"), F.size("hs")
    return checkpoint(pairs.select("hub", "id", "signature").join(x, "id").join(h, "hub").withColumn("both", F.size(F.array_intersect("xs", "hs")))
                      .select("hub", "id", n.alias("n"), "signature",
                              (100 * F.col("both") >= percent * (n + m - F.col("both"))).alias("linked"),
                              F.concat(F.array_except("xs", "hs"), F.array_except("hs", "xs")).alias("differs")))


def candidates(rest: pd.DataFrame, every: pd.DataFrame, least: list[int], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of two blocks of members of one hub that the length filter and the batches leave."""
    nx, ny = rest["n"].to_numpy(np.int64), every["n"].to_numpy(np.int64)
    ids_x, ids_y = rest["id"].to_numpy(), every["id"].to_numpy()
    small, large = np.minimum.outer(nx, ny), np.maximum.outer(nx, ny)
    # pairs of two unlinked members would come up twice
    once = (ids_x[:, None] != ids_y[None, :]) & (every["linked"].to_numpy()[None, :] | (ids_x[:, None] < ids_y[None, :]))
    return survivors(matrix(rest["signature"]), matrix(every["signature"]), least, np.nonzero(once & (100 * small >= percent * large)))


def block_links(rest: pd.DataFrame, every: pd.DataFrame, least: list[int], percent: int) -> list[tuple[int, int]]:
    """Links between two blocks of members of one hub, at most one fewer than members."""
    nx, ny = rest["n"].to_numpy(np.int64), every["n"].to_numpy(np.int64)
    ids_x, ids_y = rest["id"].to_numpy(), every["id"].to_numpy()
    a, b = candidates(rest, every, least, percent)
    parent: dict[int, int] = {}

    def find(v: int) -> int:
        while parent.setdefault(v, v) != v:
            v = parent[v]
        return v

    other = [np.asarray(d, np.int64) for d in every["differs"]]
    owner = np.repeat(np.arange(len(other)), [len(d) for d in other])
    value = np.concatenate(other) if other else np.zeros(0, np.int64)
    order = np.argsort(value, kind="stable")
    value, owner = value[order], owner[order]
    links = []
    for x in np.unique(a).tolist():
        mine = np.asarray(rest["differs"].iloc[x], np.int64)
        lo, hi = np.searchsorted(value, mine, "left"), np.searchsorted(value, mine, "right")
        size = hi - lo
        hits = np.repeat(lo - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        shared = np.bincount(owner[hits], minlength=len(other))
        for y in b[a == x].tolist():
            both = (nx[x] + ny[y] - (len(mine) + len(other[y]) - 2 * shared[y])) // 2
            if 100 * both >= percent * (nx[x] + ny[y] - both):
                u, v = find(int(ids_x[x])), find(int(ids_y[y]))
                if u != v:
                    parent[max(u, v)] = min(u, v)
                    links.append((int(ids_x[x]), int(ids_y[y])))
    return links


def by_blocks(rows: DataFrame, payload: list[str], run: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str, block: int = BLOCK) -> DataFrame:
    """``run`` on every block of unlinked members against every block of all members of the same hub."""
    sizes = rows.groupBy("hub").agg(F.count(F.lit(1)).alias("members"), F.sum(F.when(F.col("linked"), 0).otherwise(1)).alias("rest"))
    sizes = checkpoint(sizes.where("rest > 0 and members > 1")
                       .select("hub", F.ceil(F.col("members") / block).cast("int").alias("blocks"), F.ceil(F.col("rest") / block).cast("int").alias("rest_blocks")))
    rows = rows.join(sizes, "hub")
    h = F.xxhash64("id")
    left = (rows.where(~F.col("linked")).withColumn("i", F.pmod(h, F.col("rest_blocks")).cast("int"))
            .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("side", F.lit(0)))
    right = (rows.withColumn("j", F.pmod(h, F.col("blocks")).cast("int"))
             .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("rest_blocks") - 1))).withColumn("side", F.lit(1)))
    columns = ["hub", "i", "j", "side", "id", "n", "linked", *payload]

    def both_sides(pdf: pd.DataFrame) -> pd.DataFrame:
        return run(pdf[pdf["side"] == 0], pdf[pdf["side"] == 1])

    return left.select(columns).union(right.select(columns)).groupBy("hub", "i", "j").applyInPandas(both_sides, schema)


def open_members(pairs: DataFrame, percent: int, miss: float) -> DataFrame:
    """(hub, id) of members that the batches leave with a member which is pruned from the hub."""
    least = fewest_matches(percent / 100, miss)

    def run(rest: pd.DataFrame, every: pd.DataFrame) -> pd.DataFrame:
        a, b = candidates(rest, every, least, percent)
        ids = np.unique(np.concatenate([rest["id"].to_numpy(np.int64)[a], every["id"].to_numpy(np.int64)[b]]))
        return pd.DataFrame({"hub": np.full(len(ids), every["hub"].iloc[0] if len(every) else 0, np.int64), "id": ids})

    rows = pairs.withColumnRenamed("likely", "linked")
    return by_blocks(rows, ["signature"], run, "hub long, id long").distinct()


def among_members(rows: DataFrame, percent: int, miss: float) -> DataFrame:
    """Links (a, b) of members that are not linked to their hub with any other member of it."""
    least = fewest_matches(percent / 100, miss)

    def run(rest: pd.DataFrame, every: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(block_links(rest, every, least, percent), columns=["a", "b"], dtype=np.int64)

    return by_blocks(rows, ["signature", "differs"], run, "a long, b long")


def buckets(representatives: DataFrame) -> DataFrame:
    """(key, id, weight) for ids that share a bucket; weight is an id's number of bucket mates over all bands."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        step = np.uint64(0x9E3779B97F4A7C15)
        for pdf in frames:
            if len(pdf):
                s = np.frombuffer(b"".join(map(bytes, pdf["signature"])), np.uint32).reshape(-1, HASHES)[:, : BANDS * ROWS]
                s = s.reshape(-1, BANDS, ROWS).astype(np.uint64)
                key = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :] * step
                for r in range(ROWS):
                    key = (key ^ s[:, :, r]) * step
                    key ^= key >> np.uint64(31)
                yield pd.DataFrame({"key": key.ravel().view(np.int64), "id": np.repeat(pdf["doc_id"].to_numpy(), BANDS)})

    rows = representatives.select("doc_id", "signature").mapInPandas(run, "key long, id long")
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("mates")).where("mates > 1")
    shared = checkpoint(rows.join(sizes, "key"))
    weights = checkpoint(shared.groupBy("id").agg(F.sum("mates").alias("weight")))
    return checkpoint(shared.select("key", "id").join(weights, "id"))


def near_duplicate_links(docs: DataFrame, width: int = 5, percent: int = 80, miss: float = MISS, hub_miss: float = HUB_MISS) -> tuple[DataFrame, DataFrame]:
    """Sketches of all documents, and links (a, b) that connect every group of near-duplicates."""
    sketched = checkpoint(sketches(docs, width))
    named = sketched.where("doc_id is not null and n_shingles > 0")
    first = checkpoint(named.groupBy("set_id").agg(F.min("doc_id").alias("rep")))
    copies = named.select("doc_id", "set_id").join(first, "set_id").where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    # one row per distinct set: a document that repeats its doc_id with other texts keeps each of them
    reps = checkpoint(named.join(first.select("set_id", F.col("rep").alias("doc_id")), ["set_id", "doc_id"], "left_semi").dropDuplicates(["set_id"]))

    shared = buckets(reps)
    hubs = shared.groupBy("key").agg(F.max(F.struct("weight", (-F.col("id")).alias("minus"))).alias("top")).select("key", (-F.col("top.minus")).alias("hub"))
    stars = checkpoint(shared.join(checkpoint(hubs), "key").where("id <> hub").select("hub", "id").distinct())
    pairs = screened(stars, reps, percent, hub_miss)
    # sets are read for pairs that are likely, and for members that may be similar to one that is not
    alive = checkpoint(open_members(pairs, percent, miss))
    rows = verified(docs, pairs.where("likely").union(pairs.where("not likely").join(alive, ["hub", "id"], "left_semi").select(pairs.columns)), width, percent)
    links = rows.where("linked").select(F.col("id").alias("a"), F.col("hub").alias("b"))
    return sketched, checkpoint(copies.union(links).union(among_members(rows, percent, miss)))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, miss: float = MISS, hub_miss: float = HUB_MISS) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id of the group) and kept, for every row of ``docs``."""
    sketched, links = near_duplicate_links(docs, width, percent, miss, hub_miss)
    parts = checkpoint(connected(links))
    return (sketched.select("doc_id", "n_shingles").join(parts.withColumnRenamed("id", "doc_id"), "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def deduplicated(docs: DataFrame, width: int = 5, percent: int = 80, miss: float = MISS, hub_miss: float = HUB_MISS) -> DataFrame:
    """``docs`` with one document (the smallest doc_id) of each group; columns as they are."""
    gone = checkpoint(near_duplicates(docs, width, percent, miss, hub_miss).where(~F.col("kept")).select("doc_id").distinct())
    same, some = split_by_ids(docs, gone)
    names = [F.col(f"`{c}`") for c in docs.columns]
    return same.select(names).union(some.join(gone, "doc_id", "left_anti").select(names))
