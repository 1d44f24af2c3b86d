"""Embedding whitening by a block Jacobi-Davidson method that never forms the covariance.

1. Vectors become whole numbers, packed in blocks of one Arrow batch; counts, sums and
   extremes are exact.
2. The only use of the covariance V is its product with a few columns: every task
   centres its blocks, multiplies, and adds up; a product is one pass over the packed
   vectors.  The sums of at most ``PARTIALS`` tasks are added on the driver, more of them on Spark.
3. Jacobi-Davidson: Rayleigh-Ritz in a small subspace; for each wanted pair that has not
   converged the correction equation, projected off all wanted and locked vectors, is
   solved roughly by MINRES (all pairs step together, so that a step is one product);
   the corrections widen the subspace, which restarts from its best Ritz vectors when it is full.
   Pairs whose residual is at rounding level are locked and leave the subspace.
4. It ends when all wanted pairs are locked and no Ritz value of the rest is above them;
   the residuals are then measured again with a fresh product.

The driver holds a few columns of the vectors' length, never vectors of the table.

Defined results: rows whose vector is null or holds null or non-finite entries take no
part, nor do vectors of another length than most have (of equally many, the longer); a
null vec_id stays null; repeated rows count each; components without variance (fewer
distinct vectors than components) cannot be whitened and give no rows, so one vector,
equal vectors and empty tables give none; other columns are not read.  Entries beyond
2^43 and deviations beyond 64 bits end the job with an error, as they are no longs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from manifestqc.llm.common import checkpoint

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
GUARD = 4  # Ritz vectors beyond the wanted ones
INNER = 4  # MINRES steps at most; more of them save rounds but cost more products
INNER_TOLERANCE = 0.02
ROUNDING = 16  # residuals may be so many times the rounding error of a product
MOST_ROUNDS = 200
TASK_BYTES = 64 << 20
PARTIALS = 256  # so many tasks' sums are added on the driver, more of them on Spark

PACKED = "d int, n long, ids array<long>, block binary, sums array<long>, least array<long>, most array<long>"


def whole_numbers(entries: np.ndarray) -> np.ndarray:
    if entries.size and np.abs(entries).max() > 2.0**43:
        raise OverflowError("an entry is too large for exact sums of longs")
    return np.floor(SCALE * entries).astype(np.int64) + SHIFT


def packed(embeddings: DataFrame) -> DataFrame:
    """Blocks of whole-number vectors of one length, with their ids, sums and extremes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in PACKED.split(", ")]
        kinds = [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.binary(), *[pa.list_(pa.int64())] * 3]
        for batch in batches:
            lengths = pc.list_value_length(batch.column("embedding"))
            for d in pc.unique(lengths).to_pylist():
                if not d:  # null or empty
                    continue
                here = pc.equal(lengths, d).fill_null(False)
                entries = batch.column("embedding").filter(here).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, d)
                finite = np.isfinite(entries).all(axis=1)
                if not finite.any():
                    continue
                x = whole_numbers(entries[finite])
                ids = batch.column("vec_id").filter(here).filter(pa.array(finite)).to_pylist()
                values = [d, len(x), ids, x.astype("<i8").tobytes(), x.sum(axis=0).tolist(), x.min(axis=0).tolist(), x.max(axis=0).tolist()]
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

    return embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda c: c.cast("double")).alias("embedding")).mapInArrow(run, PACKED)


class Fit:
    """The packed vectors of the usual length with their exact count and sums, and sums of functions of the centred vectors."""

    def __init__(self, embeddings: DataFrame, partials: int = PARTIALS):
        blocks = checkpoint(packed(embeddings))
        length = blocks.groupBy("d").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
        self.d, self.n = (length["d"], length["n"]) if length else (0, 0)
        self.blocks = blocks.where(F.col("d") == self.d)
        each = (self.blocks.select(F.posexplode(F.arrays_zip("sums", "least", "most")).alias("i", "x")).groupBy("i")
                .agg(F.sum("x.sums").alias("s"), F.min("x.least").alias("low"), F.max("x.most").alias("high"))).toPandas().sort_values("i")
        self.sums, self.low, self.high = ([int(v) for v in each[c]] for c in ("s", "low", "high"))
        # Whole and fractional part of the means, so that centring rounds once.
        self.centre = (np.array([s // self.n for s in self.sums], np.int64), np.array([s % self.n / self.n for s in self.sums]))
        tasks = max(embeddings.sparkSession.sparkContext.defaultParallelism, -(-self.n * self.d * 8 // TASK_BYTES))
        self.spread = self.blocks.select("block").coalesce(tasks)
        self.tasks, self.partials = tasks, partials

    def total(self, size: int, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """Sum over blocks of ``of`` (centred block -> ``size`` numbers), added in tasks and then on Spark."""
        d, (whole, part) = self.d, self.centre

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros(size)
            for batch in batches:
                for raw in batch.column("block"):
                    out += of((np.frombuffer(raw.as_buffer(), "<i8").reshape(-1, d) - whole) - part)
            yield pa.RecordBatch.from_arrays([pa.array([out.tolist()], pa.list_(pa.float64()))], ["x"])

        sums = self.spread.mapInArrow(run, "x array<double>")
        if self.tasks <= self.partials:
            return np.sum([r["x"] for r in sums.collect()], axis=0)
        rows = sums.select(F.posexplode("x").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).toPandas()
        out = np.zeros(size)
        out[rows["i"].to_numpy(np.int64)] = rows["x"].to_numpy()
        return out

    def product(self, columns: np.ndarray) -> np.ndarray:
        """V times a few columns, without V."""
        held = self.blocks.sparkSession.sparkContext.broadcast(np.ascontiguousarray(columns))
        out = self.total(columns.size, lambda x: (x.T @ (x @ held.value)).ravel()).reshape(columns.shape) / self.n
        held.unpersist()
        return out

    def trace(self) -> float:
        return float(self.total(1, lambda x: np.array([(x * x).sum()]))[0]) / self.n

    def covariance_of(self, columns: np.ndarray) -> np.ndarray:
        """Covariance of the vectors multiplied by ``columns``."""
        held = self.blocks.sparkSession.sparkContext.broadcast(columns)
        k = columns.shape[1]

        def of(x: np.ndarray) -> np.ndarray:
            w = x @ held.value
            return np.concatenate([(w.T @ w).ravel(), w.sum(axis=0)])

        out = self.total(k * k + k, of) / self.n
        return out[:k * k].reshape(k, k) - np.outer(out[k * k:], out[k * k:])


def orthonormal(columns: np.ndarray, against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``columns`` add to the orthonormal ``against``."""
    columns = columns / np.maximum(np.linalg.norm(columns, axis=0), np.finfo(float).tiny)
    columns = columns - against @ (against.T @ columns)
    u, s, _ = np.linalg.svd(columns, full_matrices=False)
    u = u[:, s > 1e-8][:, :len(columns) - against.shape[1]]
    for _ in range(2):
        u = np.linalg.qr(u - against @ (against.T @ u))[0] if u.shape[1] else u
    return u


def minres(apply: Callable[[np.ndarray], np.ndarray], right: np.ndarray, steps: int, tolerance: float) -> np.ndarray:
    """Rough solutions of symmetric systems, one a column, which step together (MINRES)."""
    tiny = np.finfo(float).tiny
    x, w, w_before = np.zeros_like(right), np.zeros_like(right), np.zeros_like(right)
    old, y = np.zeros_like(right), right.copy()
    r = right.copy()
    start = beta = np.linalg.norm(right, axis=0)
    k = right.shape[1]
    beta_old, turned, slope, cosine, sine, left = np.ones(k), np.zeros(k), np.zeros(k), -np.ones(k), np.zeros(k), start.copy()
    for step in range(steps):
        going = (beta > 1e-14 * start) & (left > tolerance * start)
        if not going.any():
            break
        v = np.where(going, y / np.maximum(beta, tiny), 0)
        y = apply(v)
        if step:
            y = y - (beta / beta_old) * old
        alpha = (v * y).sum(axis=0)
        y = y - (alpha / np.maximum(beta, tiny)) * r
        old, r, beta_old = r, y, beta
        beta = np.linalg.norm(y, axis=0)
        turned_old, delta, bar = turned, cosine * slope + sine * alpha, sine * slope - cosine * alpha
        turned, slope = sine * beta, -cosine * beta
        gamma = np.maximum(np.hypot(bar, beta), tiny)
        cosine, sine = bar / gamma, beta / gamma
        w, w_before = (v - turned_old * w_before - delta * w) / gamma, w
        x = np.where(going, x + cosine * left * w, x)
        left = np.where(going, sine * left, left)
    return x


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], d: int, wanted: int, inner: int = INNER, rounds: int = MOST_ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and their vectors, of a symmetric operator known by its products."""
    wanted = min(wanted, d)
    size = min(d, wanted + GUARD)
    most = max(size + 2 * wanted, 40)
    basis = orthonormal(np.random.default_rng(20240619).standard_normal((d, size)), np.zeros((d, 0)))
    image = product(basis)
    locked, locked_values = np.zeros((d, 0)), np.zeros(0)
    for _ in range(rounds):
        h = basis.T @ image
        values, turn = np.linalg.eigh((h + h.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        basis, image = basis @ turn, image @ turn
        level = np.finfo(float).eps * np.sqrt(d) * max([0.0, *values[:1], *locked_values])
        need = wanted - len(locked_values)
        if need <= 0 and (not len(values) or values[0] <= np.sort(locked_values)[::-1][wanted - 1] + ROUNDING * level):
            break
        need = min(max(need, 1), len(values))
        residuals = image[:, :need] - basis[:, :need] * values[:need]
        size_of = np.linalg.norm(residuals - locked @ (locked.T @ residuals), axis=0)
        full = basis.shape[1] + locked.shape[1] == d
        open_ = size_of > ROUNDING * level
        done = int(np.argmax(open_)) if open_.any() else need  # from the largest on, as a larger one may still turn up below
        if done:
            locked = np.hstack([locked, basis[:, :done]])
            locked_values = np.append(locked_values, values[:done])
            basis, image = basis[:, done:], image[:, done:]
            continue
        if full:
            image = product(basis)
            continue
        if basis.shape[1] + need > most:
            keep = wanted + GUARD
            basis, image = basis[:, :keep], image[:, :keep]
        off = np.hstack([locked, basis[:, :need]])
        shift = values[:need][open_]

        def projected(z: np.ndarray, off=off, shift=shift) -> np.ndarray:
            y = product(z) - z * shift
            return y - off @ (off.T @ y)

        residuals = residuals[:, open_] - off @ (off.T @ residuals[:, open_])
        new = orthonormal(minres(projected, -residuals, inner, INNER_TOLERANCE), np.hstack([locked, basis]))
        if not new.shape[1]:
            new = orthonormal(residuals, np.hstack([locked, basis]))
        basis, image = np.hstack([basis, new]), np.hstack([image, product(new)])
        against = locked.T @ image  # products leave the complement of the locked vectors by rounding only
        image = image - locked @ against
    else:
        raise RuntimeError(f"eigenvectors did not reach double precision in {rounds} rounds")
    order = np.argsort(-locked_values, kind="stable")[:wanted]
    return locked_values[order], locked[:, order]


WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def deviations(x: np.ndarray, n: int, sums: list[int], exact_in_64_bits: bool) -> np.ndarray:
    """Sum over dimensions of (n x - S)^2 for each row."""
    if exact_in_64_bits:
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1)
    big = ((n * x.astype(object) - np.array(sums, object)) ** 2).sum(axis=1)
    if max(big) >= 1 << 63:
        raise OverflowError("a deviation does not fit a long")
    return big.astype(np.int64)


def whitened(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """For every vector and component: n, deviation, whitened, explained, identity_error."""
    spark = embeddings.sparkSession
    fit = Fit(embeddings)
    if not fit.n:
        return spark.createDataFrame([], WHITENED)
    values, vectors = jacobi_davidson(fit.product, fit.d, components)
    fresh = fit.product(vectors)
    values = (vectors * fresh).sum(axis=0)
    residual = np.linalg.norm(fresh - vectors * values, axis=0).max()
    if residual > 4 * ROUNDING * np.finfo(float).eps * np.sqrt(fit.d) * values.max():
        raise RuntimeError(f"residual {residual} of the eigenvectors is above rounding level")
    trace = fit.trace()
    held_up = values > 4 * fit.d * np.finfo(float).eps * max(trace, 0)
    values, vectors = values[held_up], vectors[:, held_up]
    if not len(values):
        return spark.createDataFrame([], WHITENED)
    columns = vectors / np.sqrt(values)
    error = float(np.abs(fit.covariance_of(columns) - np.eye(len(values))).max())
    explained = values / trace
    reach = sum(max(abs(fit.n * a - s), abs(fit.n * b - s)) ** 2 for a, b, s in zip(fit.low, fit.high, fit.sums))
    simple = reach < 1 << 63 and all(fit.n * max(abs(a), abs(b)) < 1 << 62 for a, b in zip(fit.low, fit.high))
    held = spark.sparkContext.broadcast((fit.n, fit.d, fit.sums, fit.centre, columns, explained))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, d, sums, (whole, part), c, e = held.value
        for batch in batches:
            for ids, raw in zip(batch.column("ids"), batch.column("block")):
                x = np.frombuffer(raw.as_buffer(), "<i8").reshape(-1, d)
                w = ((x - whole) - part) @ c
                rows, k = w.shape
                yield pa.RecordBatch.from_arrays([
                    ids.values.take(pa.array(np.repeat(np.arange(rows), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)), pa.array(np.full(rows * k, n, np.int64)),
                    pa.array(np.repeat(deviations(x, n, sums, simple), k)), pa.array(w.ravel()), pa.array(np.tile(e, rows)), pa.array(np.full(rows * k, error)),
                ], [f.split()[0] for f in WHITENED.split(", ")])

    return fit.blocks.select("ids", "block").mapInArrow(run, WHITENED)
