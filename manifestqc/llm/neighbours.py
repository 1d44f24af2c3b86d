"""Approximate nearest neighbours by multiprobe p-stable hashing.

1. Equal vectors are collapsed: one stands for all, with the ``TOP + 1`` smallest ids
   of its copies, which are all that any result can hold.
2. A table hashes a vector by ``m`` Gaussian projections, each cut into cells of width
   ``WIDTH`` after a random shift.  A bucket is the tuple of its cells.
3. A neighbour at distance r lies in a cell with the probability that a normal
   deviate of standard deviation r falls into it, so a bucket has an estimated success
   probability.  A query's buckets of all tables, its own and perturbed ones, are visited
   in the order of that estimate until the chance that some table holds the neighbour
   reaches the aim.
4. ``m``, r and the aim are fitted on a bounded sample: ``SAMPLE`` vectors of smallest
   hash, whose true neighbours are found exactly among all rows.  Their recall has to
   reach ``RECALL``; where that takes more than ``PROBES`` buckets a table, ``m`` falls, and at
   last every bucket is visited.
5. Buckets are dealt into lots of about ``LOT`` rows, larger buckets over several parts of
   their lot, and a query travels once to each lot it visits, with the buckets it wants.
   Queries meet a part in groups of at most about ``QUERIES``.  A task measures a query's
   candidates in double precision and passes on the nearest; the tables' lists are merged.
   Queries with too few candidates are compared with every row.

Defined results: rows whose vector is null, empty, zero or holds null or non-finite
entries take no part, nor do vectors of another length than most have (of equally many,
the longer); equal rows count once; rows that share an id but not the vector are rows
of their own, as queries and as candidates; a row with a null id is a candidate, last
among equal distances, and no query; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import erf, log2, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from manifestqc.llm.common import checkpoint, mix

TOP = 10
TABLES = 3
WIDTH = 3.0
ROWS_PER_BUCKET = 16
SAMPLE = 128
RECALL = 0.97
AIMS = (0.9, 0.93, 0.95, 0.97, 0.98, 0.99, 0.995, 0.999)
PROBES = 8192
LOT = 2048
QUERIES = 2048
BRUTE_QUERIES = 1024
_GRID = np.linspace(-8, 8, 8001)
_NORMAL = np.array([0.5 * (1 + erf(z / sqrt(2))) for z in _GRID])
_REACH = np.arange(-2, 3)  # cells beside a query's own that hold all but a negligible part


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, vector): finite, non-zero vectors of the usual length, as doubles without negative zeros."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0)).alias("vector"))
    finite = F.forall("vector", lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    rows = rows.where(F.col("vector").isNotNull() & finite & F.exists("vector", lambda x: x != 0))
    length = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).select("d").first()
    return rows.where(F.size("vector") == (length["d"] if length else 0))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of an array<double> column of one length."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def distances(rows: np.ndarray, vector: np.ndarray) -> np.ndarray:
    return np.sqrt(((rows - vector) ** 2).sum(axis=1))


def nearest(rows: np.ndarray, norms: np.ndarray, first: np.ndarray, vector: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances of the ``top`` nearest rows, ties to the smaller ``first``.

    A product finds what may be among them, with room for its rounding; only that is measured exactly.
    """
    some = np.arange(len(rows))
    if len(rows) > 4 * top:
        norm = float(vector @ vector)
        rough = norms - 2 * (rows @ vector) + norm
        limit = np.partition(rough, top - 1)[top - 1]
        some = np.flatnonzero(rough <= limit + 1e-12 * len(vector) * (norms.max() + norm))
    exact = distances(rows[some], vector)
    order = np.lexsort((first[some], exact))[:top]
    return some[order], exact[order]


class Hashes:
    """The projections, shifts and bucket numbers of all tables."""

    def __init__(self, dimension: int, m: int, tables: int, scale: float):
        r = np.random.default_rng(20240617)
        self.m, self.tables = m, tables
        self.width = WIDTH * scale
        self.normals = r.standard_normal((dimension, tables * m))
        self.shifts = r.uniform(0, self.width, tables * m)
        self.mixers = r.integers(1, 2**62, tables * m, np.int64) | 1
        self.salts = r.integers(1, 2**62, tables, np.int64)

    def projected(self, vectors: np.ndarray) -> np.ndarray:
        return vectors @ self.normals + self.shifts

    def bucket(self, cells: np.ndarray, table: int) -> np.ndarray:
        """64-bit numbers of tuples of cells (in the last axis)."""
        mixers = self.mixers[table * self.m:(table + 1) * self.m].view(np.uint64)
        h = (cells.view(np.uint64) * mixers).sum(axis=-1) + np.uint64(self.salts[table])
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        return (h ^ (h >> np.uint64(29))).view(np.int64)

    def buckets(self, vectors: np.ndarray) -> np.ndarray:
        """(tables, rows): the bucket of every vector in every table."""
        cells = np.floor(self.projected(vectors) / self.width).astype(np.int64)
        return np.stack([self.bucket(cells[:, t * self.m:(t + 1) * self.m], t) for t in range(self.tables)])

    def probes(self, places: np.ndarray, table: int, radius: float, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each query, the ``most`` likeliest buckets of one table: their chances, falling, and numbers.

        Built projection by projection: a likeliest tuple has a likeliest beginning.
        """
        places = places[:, table * self.m:(table + 1) * self.m]
        own = np.floor(places / self.width)
        edges = ((own[:, :, None] + _REACH) * self.width - places[:, :, None]) / radius
        chance = np.interp(edges + self.width / radius, _GRID, _NORMAL) - np.interp(edges, _GRID, _NORMAL)
        order = np.argsort(-chance, axis=2, kind="stable")
        logs = np.log(np.maximum(np.take_along_axis(chance, order, 2), 1e-15))
        cells = (own[:, :, None] + _REACH[order]).astype(np.int64)
        mixers = self.mixers[table * self.m:(table + 1) * self.m].view(np.uint64)
        best = np.zeros((len(places), 1))
        sums = np.zeros((len(places), 1), np.uint64)
        for j in range(self.m):
            grown = (best[:, :, None] + logs[:, None, j, :]).reshape(len(places), -1)
            k = min(most, grown.shape[1])
            keep = np.argpartition(-grown, k - 1, axis=1)[:, :k] if k < grown.shape[1] else np.broadcast_to(np.arange(k), (len(places), k))
            term = cells[:, j, :].view(np.uint64) * mixers[j]
            sums = np.take_along_axis(sums, keep // len(_REACH), 1) + np.take_along_axis(term, keep % len(_REACH), 1)
            best = np.take_along_axis(grown, keep, 1)
        order = np.argsort(-best, axis=1, kind="stable")
        h = np.take_along_axis(sums, order, 1) + np.uint64(self.salts[table])
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        return np.exp(np.take_along_axis(best, order, 1)), (h ^ (h >> np.uint64(29))).view(np.int64)

    def visited(self, vectors: np.ndarray, radius: float, aim: float, most: int) -> Iterator[tuple[np.ndarray, bool]]:
        """For each query the buckets to visit, and whether they reach the aim with ``most`` buckets a table."""
        done: dict[int, np.ndarray] = {}
        open_, width = np.arange(len(vectors)), min(most, 512)
        while len(open_):
            step = max(1, (1 << 18) // width)
            for a in range(0, len(open_), step):
                some = open_[a:a + step]
                places = self.projected(vectors[some])
                found = [self.probes(places, t, radius, width) for t in range(self.tables)]
                for i, q in enumerate(some.tolist()):
                    buckets, enough = self._chosen([(c[i], b[i]) for c, b in found], aim)
                    if enough or width >= most:
                        done[q] = (buckets, enough)
            open_, width = np.array([q for q in open_.tolist() if q not in done], np.int64), min(most, 4 * width)
        return (done[q] for q in range(len(vectors)))

    @staticmethod
    def _chosen(found: list[tuple[np.ndarray, np.ndarray]], aim: float) -> tuple[np.ndarray, bool]:
        """One query's buckets of all tables by falling chance, until some table holds the neighbour with chance ``aim``."""
        chance = np.concatenate([c for c, _ in found])
        table = np.repeat(np.arange(len(found)), [len(c) for c, _ in found])
        order = np.argsort(-chance, kind="stable")
        missed = np.ones(len(order))
        for t in range(len(found)):
            missed *= 1 - np.minimum(np.cumsum(np.where(table[order] == t, chance[order], 0)), 1)
        enough = int(np.searchsorted(-missed, -(1 - aim)))
        return np.concatenate([b for _, b in found])[order[:enough + 1]], enough < len(order)


def representatives(rows: DataFrame, top: int) -> DataFrame:
    """(rep, vector, ids, first): distinct vectors with their ``top + 1`` smallest ids."""
    key = F.struct(F.xxhash64("vector").alias("a"), F.xxhash64(F.lit(7), F.col("vector")).alias("b"))
    keyed = rows.withColumn("key", key).groupBy("key", "vec_id").agg(F.first("vector").alias("vector"))
    order = Window.partitionBy("key").orderBy(F.asc_nulls_last("vec_id"))
    least = keyed.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= top + 1)
    grouped = least.groupBy("key").agg(F.first("vector").alias("vector"), F.sort_array(F.collect_list(F.struct("nth", "vec_id"))).alias("ids"))
    return checkpoint(grouped.select(F.monotonically_increasing_id().alias("rep"), "key", "vector", F.col("ids.vec_id").alias("ids"),
                                     F.coalesce(F.col("ids")[0]["vec_id"], F.lit((1 << 63) - 1)).alias("first")))


def _near_schema() -> str:
    return "query long, rep long, first long, distance double"


def _near_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.int64()] * 3 + [pa.float64()])], ["query", "rep", "first", "distance"])


def best_of(found: DataFrame, top: int) -> DataFrame:
    """The ``top`` nearest representatives of each query."""
    order = Window.partitionBy("query").orderBy("distance", "first", "rep")
    return found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= top).drop("nth")


def by_every_row(reps: DataFrame, asked: list[tuple[int, list[float]]], top: int) -> DataFrame:
    """(query, rep, first, distance): the ``top`` nearest of all rows for a bounded block of queries."""
    held = reps.sparkSession.sparkContext.broadcast(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = matrix(batch.column("vector"))
            rep, first = batch.column("rep").to_numpy(), batch.column("first").to_numpy()
            norms = (rows**2).sum(axis=1)
            out = []
            for q, v in held.value if len(rows) else []:
                at, d = nearest(rows, norms, first, np.array(v), top)
                out += [(q, int(rep[i]), int(first[i]), float(x)) for i, x in zip(at, d)]
            yield _near_batch(out)

    return best_of(reps.select("rep", "vector", "first").mapInArrow(run, _near_schema()), top)


def fitted(reps: DataFrame, n: int, tables: int, top: int, sample: int, recall: float, most: int) -> tuple[Hashes, float, float] | None:
    """Hashes, radius and aim that find the sample's neighbours, None where only visiting every row does."""
    chosen = reps.orderBy(F.xxhash64("vector", F.lit(3)), "rep").limit(sample).select("rep", "vector").collect()
    true = by_every_row(reps, [(r["rep"], r["vector"]) for r in chosen], top + 1).where("query <> rep")
    rows = true.join(reps.select("rep", "vector"), "rep").select("query", "distance", "vector").collect()
    vectors = {r["rep"]: np.array(r["vector"]) for r in chosen}
    if not rows:
        return None
    near: dict[int, list] = {}
    for r in rows:
        near.setdefault(r["query"], []).append((r["distance"], r["vector"]))
    farthest = np.array([max(d for d, _ in x) for x in near.values()])
    radius = float(np.percentile(farthest, 75))
    queries = np.array([vectors[q] for q in near])
    found = [np.array([v for _, v in x]) for x in near.values()]
    m = max(1, round(log2(max(n, 2) / ROWS_PER_BUCKET)))
    while m >= 1:
        hashes = Hashes(queries.shape[1], m, tables, radius / 1.1)
        homes = [hashes.buckets(x) for x in found]
        for aim in AIMS:
            hits, reached = [], True
            for home, (visited, enough) in zip(homes, hashes.visited(queries, radius, aim, most)):
                hits.append(np.isin(home, visited).any(axis=0))
                reached &= enough
            if reached and np.concatenate(hits).mean() >= recall:
                return hashes, radius, aim
            if not reached:
                break
        m = m * 3 // 4
    return None


def lot_of(buckets: np.ndarray, lots: int) -> np.ndarray:
    return (mix(buckets.view(np.uint64)) % np.uint64(lots)).astype(np.int64)


def _in_lots(reps: DataFrame, hashes: Hashes, lots: int, lot_rows: int) -> tuple[DataFrame, DataFrame]:
    """Hashed rows (lot, part, bucket, rep, first, vector), and the parts of each lot.

    A bucket of more than a lot's rows is dealt over several parts of its lot, the others stand in part 0.
    """
    held = reps.sparkSession.sparkContext.broadcast(hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                for buckets in held.value.buckets(matrix(batch.column("vector"))):
                    yield pa.RecordBatch.from_arrays([pa.array(lot_of(buckets, lots)), pa.array(buckets), *[batch.column(c) for c in ("rep", "first", "vector")]],
                                                     ["lot", "bucket", "rep", "first", "vector"])

    rows = reps.select("rep", "first", "vector").mapInArrow(run, "lot long, bucket long, rep long, first long, vector array<double>")
    sizes = checkpoint(rows.groupBy("lot", "bucket").agg(F.ceil(F.count(F.lit(1)) / F.lit(lot_rows)).cast("int").alias("parts")))
    large = sizes.where("parts > 1").select("bucket", "parts")
    parted = rows.join(large, "bucket", "left").withColumn("part", F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("rep"), F.col("parts"))).cast("int")).drop("parts")
    return parted, sizes.groupBy("lot").agg(F.max("parts").alias("parts"))


def _probed(queries: DataFrame, hashes: Hashes, radius: float, aim: float, most: int, lots: int) -> DataFrame:
    """(query, vector, lot, buckets): the buckets that a query visits, gathered by lot."""
    held = queries.sparkSession.sparkContext.broadcast((hashes, radius, aim, most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, r, a, t = held.value
        for batch in batches:
            if batch.num_rows:
                for i, (buckets, _) in enumerate(h.visited(matrix(batch.column("vector")), r, a, t)):
                    lot = lot_of(buckets, lots)
                    order = np.argsort(lot, kind="stable")
                    number, starts = np.unique(lot[order], return_index=True)
                    same = pa.array(np.full(len(number), i))
                    gathered = pa.ListArray.from_arrays(pa.array(np.append(starts, len(order)), pa.int32()), pa.array(buckets[order]))
                    yield pa.RecordBatch.from_arrays([batch.column("rep").take(same), batch.column("vector").take(same), pa.array(number), gathered], ["query", "vector", "lot", "buckets"])

    return queries.select("rep", "vector").mapInArrow(run, "query long, vector array<double>, lot long, buckets array<long>")


def _searched(top: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            bucket, rep, first = (left.column(c).to_numpy() for c in ("bucket", "rep", "first"))
            rows = matrix(left.column("vector").combine_chunks())
            order = np.argsort(bucket, kind="stable")
            bucket, rep, first, rows = bucket[order], rep[order], first[order], rows[order]
            norms = (rows**2).sum(axis=1)
            for query, vector, visited in zip(right.column("query").to_pylist(), matrix(right.column("vector").combine_chunks()), right.column("buckets").to_pylist()):
                v = np.unique(np.array(visited, np.int64))
                low, high = np.searchsorted(bucket, v, "left"), np.searchsorted(bucket, v, "right")
                lengths = high - low
                some = np.repeat(low - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
                _, once = np.unique(rep[some], return_index=True)  # tables share a lot
                some = some[once]
                at, d = nearest(rows[some], norms[some], first[some], vector, top)
                out += [(query, int(rep[some[i]]), int(first[some[i]]), float(x)) for i, x in zip(at, d)]
        return pa.Table.from_batches([_near_batch(out)])
    return run


def candidates(reps: DataFrame, queries: DataFrame, n: int, hashes: Hashes, radius: float, aim: float, top: int, most: int, lot_rows: int, group: int) -> DataFrame:
    """(query, rep, first, distance): of each lot, the ``top`` nearest rows in the buckets that a query visits."""
    lots = -(-n * hashes.tables // lot_rows)
    rows, parts = _in_lots(reps, hashes, lots, lot_rows)
    probed = checkpoint(_probed(queries, hashes, radius, aim, most, lots))
    # A group is one part of a lot and a share of the queries that visit the lot.
    shape = checkpoint(probed.groupBy("lot").agg(F.ceil(F.count(F.lit(1)) / F.lit(group)).cast("int").alias("groups")).join(parts, "lot"))
    asked = (probed.join(shape, "lot").withColumn("group", F.pmod(F.xxhash64("query"), F.col("groups")).cast("int"))
             .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("groups", "parts"))
    met = rows.join(shape.drop("parts"), "lot").withColumn("group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))).drop("groups")
    return met.groupBy("lot", "part", "group").cogroup(asked.groupBy("lot", "part", "group")).applyInArrow(_searched(top), _near_schema())


def neighbours(embeddings: DataFrame, asks: Column | None = None, top: int = TOP, tables: int = TABLES, sample: int = SAMPLE, recall: float = RECALL,
               most: int = PROBES, lot_rows: int = LOT, group: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest rows found for every row that ``asks`` (a condition on vec_id; default: all with an id)."""
    rows = usable(embeddings)
    reps = representatives(rows, top)
    n = reps.count()
    key = F.struct(F.xxhash64("vector").alias("a"), F.xxhash64(F.lit(7), F.col("vector")).alias("b"))
    asking = rows.where(F.col("vec_id").isNotNull() & (F.lit(True) if asks is None else asks)).select(key.alias("key"), "vec_id").distinct()
    members = checkpoint(asking.join(reps.select("key", "rep"), "key").select(F.col("vec_id").alias("query_id"), F.col("rep").alias("query")))
    queries = checkpoint(reps.join(members.select(F.col("query").alias("rep")).distinct(), "rep", "left_semi").select("rep", "vector"))
    fit = fitted(reps, n, tables, top, sample, recall, most)
    wanted = min(top + 1, n)
    if fit is None:  # no index finds enough
        found = None
        short = queries
    else:
        hashes, radius, aim = fit
        found = checkpoint(best_of(candidates(reps, queries, n, hashes, radius, aim, top + 1, most, lot_rows, group).dropDuplicates(["query", "rep"]), top + 1))
        whole = found.groupBy(F.col("query").alias("rep")).count().where(F.col("count") >= wanted)
        short = queries.join(whole, "rep", "left_anti")
        found = found.join(whole.select(F.col("rep").alias("query")), "query", "left_semi")
    for block in _blocks(checkpoint(short), BRUTE_QUERIES):
        part = checkpoint(by_every_row(reps, block, top + 1))
        found = part if found is None else found.unionByName(part)
    if found is None:
        return embeddings.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    copies = (found.join(reps.select("rep", "ids"), "rep").join(members, "query")
              .select("query_id", "query", (F.col("query") == F.col("rep")).alias("same"), F.explode("ids").alias("vec_id"), F.col("distance").alias("score")))
    others = copies.where(~(F.col("same") & F.col("vec_id").eqNullSafe(F.col("query_id"))))
    order = Window.partitionBy("query_id", "query").orderBy("score", F.asc_nulls_last("vec_id"))
    return others.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def _blocks(queries: DataFrame, size: int) -> Iterator[list[tuple[int, list[float]]]]:
    """The queries in blocks of at most ``size``, one at a time on the driver."""
    block = []
    for r in queries.toLocalIterator():
        block.append((r["rep"], r["vector"]))
        if len(block) == size:
            yield block
            block = []
    if block:
        yield block
