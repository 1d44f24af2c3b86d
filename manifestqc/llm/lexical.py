"""Ranked lexical search over per-term blocks of similar documents.

1. One scan counts the words of every document and its occurrences of the items'
   terms.  Documents travel as shards: at most ``SHARD`` documents, packed, in the
   order of the scan, so no text and no posting list is shuffled and a term that most
   documents hold is spread over all shards.
2. Document frequencies, the number of documents and of words are sums over shards;
   with them a term has its weight and a posting its impact, both whole numbers.
3. Inside a shard a posting list is cut into blocks of documents that resemble each
   other: postings go to the nearest of evenly spaced pivots in a random projection of
   the impact vectors, clusters are cut at ``BLOCK`` documents.  A block's summary is
   the largest impact of each term over its documents.  Blocks of a list are made
   when the first item opens it and serve all later ones.
4. An item scores the lists that fit one block as they are and opens the others by
   falling contribution.  A block is skipped only when weights times summary stay below
   the item's 20th best score so far, a list and all after it only when their largest
   impacts together do.  What is left is scored in full.  Equal scores are never
   skipped, so the result is exact.
5. One shard in ``FIRST`` is searched first; its 20th best scores are lower bounds
   that the search of all others starts from.

Items are taken in batches of at most ``BATCH_TERMS`` terms (or one item), which
bounds what is broadcast; each batch is one scan of the documents.

Defined results: null and wordless texts have no terms, such documents are not
counted and such items give no rows; rows of ``items`` that are equal count once,
different texts of one item_id are one item with all their terms; a null item_id is
an item as well; every row of ``docs`` is a document, a null doc_id comes last
among equal scores; empty tables give no rows; other columns are not read.  Words
are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from manifestqc.llm.common import checkpoint, hashed_runs

TOP = 20
BLOCK = 32
SHARD = 2048
SHARD_POSTINGS = 400_000
FIRST = 16
BATCH_TERMS = 200_000
SLICE_BYTES = 1 << 20
PROJECTION = 24
# Bytes of words: digits, letters and everything beyond ASCII.
WORD = np.array([48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128 for c in range(256)], np.uint8)

SHARDS = "shard long, ids array<long>, sizes binary, ends binary, terms binary, counts binary, distinct array<int>, holding array<int>, docs long, words long"


def pieces(raw: bytes, size: int = SLICE_BYTES) -> Iterator[bytes]:
    """A text in parts of about ``size`` bytes, cut after bytes that stand in no word."""
    at = 0
    while len(raw) - at > size:
        end = at + size
        while end < len(raw) and WORD[raw[end]]:
            end += 1
        yield raw[at:end]
        at = end
    yield raw[at:]


def slices(texts: list[bytes]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
    """Bounded runs of texts as one lower-cased byte string, with the place of each part and the number of its text."""
    parts, of, size = [], [], 0
    for i, raw in enumerate(texts):
        for part in pieces(raw):
            parts.append(part)
            of.append(i)
            size += len(part) + 1
            if size >= SLICE_BYTES:
                yield b"\n".join(parts).lower(), np.cumsum([0] + [len(p) + 1 for p in parts[:-1]]), np.array(of)
                parts, of, size = [], [], 0
    if parts:
        yield b"\n".join(parts).lower(), np.cumsum([0] + [len(p) + 1 for p in parts[:-1]]), np.array(of)


def as_bytes(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, n): how often each item asks for each term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, terms, counts = [], [], []
            for i, raw in zip(batch.column("item_id").to_pylist(), as_bytes(batch.column("text"))):
                low = raw.lower()
                edges = np.flatnonzero(np.diff(np.concatenate([[0], WORD[np.frombuffer(low, np.uint8)], [0]]).astype(np.int8)))
                found: dict[bytes, int] = {}
                for a, z in edges.reshape(-1, 2):
                    found[low[a:z]] = found.get(low[a:z], 0) + 1
                ids += [i] * len(found)
                terms += [w.decode("utf-8") for w in found]
                counts += found.values()
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(terms, pa.string()), pa.array(counts, pa.int64())], ["item_id", "term", "n"])

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text")).distinct()
    return rows.mapInArrow(run, "item_id long, term string, n long").groupBy("item_id", "term").agg(F.sum("n").alias("n"))


def batches_of(terms: DataFrame, batch_terms: int) -> Iterator[list[tuple[int | None, dict[str, int]]]]:
    """Items with their terms, in batches of at most ``batch_terms`` terms each, or of one item."""
    place = lambda n: F.pmod(F.xxhash64("item_id"), F.lit(n))
    sizes = checkpoint(terms.groupBy("item_id").agg(F.count(F.lit(1)).alias("size")))
    n = max(1, -(-(sizes.agg(F.sum("size")).first()[0] or 0) // batch_terms))
    while not sizes.groupBy(place(n).alias("k")).agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("items")).where((F.col("size") > batch_terms) & (F.col("items") > 1)).isEmpty():
        n *= 2
    for k in range(n):
        batch: dict[int | None, dict[str, int]] = {}
        for r in terms.where(place(n) == k).toLocalIterator():
            batch.setdefault(r["item_id"], {})[r["term"]] = r["n"]
        if batch:
            yield sorted(batch.items(), key=lambda x: (x[0] is None, x[0]))


class _Shard:
    """Documents gathered until they fill a shard."""

    def __init__(self, number: int):
        self.number, self.ids, self.sizes, self.terms, self.counts, self.lengths = number, [], [], [], [], []

    def row(self) -> pa.RecordBatch:
        sizes, terms, counts = np.concatenate(self.sizes), np.concatenate(self.terms), np.concatenate(self.counts)
        ends = np.cumsum(np.concatenate(self.lengths))
        distinct, holding = np.unique(terms, return_counts=True)
        values = [self.number, self.ids, sizes.astype("<i8").tobytes(), ends.astype("<i8").tobytes(), terms.astype("<i4").tobytes(), counts.astype("<i8").tobytes(),
                  distinct.tolist(), holding.tolist(), len(sizes), int(sizes.sum())]
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], [c.split()[0] for c in SHARDS.split(", ")])

    def __len__(self) -> int:
        return len(self.ids)


def counted(texts: list[bytes], vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text, and (text, place in the sorted ``vocabulary``, occurrences) in order."""
    n = np.zeros(len(texts), np.int64)
    keys, times = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for raw, starts, of in slices(texts):
        hashes, at = hashed_runs(raw, WORD)
        text = of[np.searchsorted(starts, at, "right") - 1]
        n += np.bincount(text, minlength=len(texts))
        place = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
        hit = vocabulary[place] == hashes
        key, count = np.unique(text[hit] * len(vocabulary) + place[hit], return_counts=True)
        keys.append(key)
        times.append(count)
    key, back = np.unique(np.concatenate(keys), return_inverse=True)  # a long text spans several slices
    count = np.zeros(len(key), np.int64)
    np.add.at(count, back, np.concatenate(times))
    return n, key // len(vocabulary), key % len(vocabulary), count


def shards(docs: DataFrame, vocabulary: list[str], shard_docs: int = SHARD) -> DataFrame:
    """Packed shards of all documents with a word: their sizes and their postings of the ``vocabulary`` (by place in hash order)."""
    held = docs.sparkSession.sparkContext.broadcast(vocabulary_hashes(vocabulary)[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        shard = _Shard(number)
        postings = 0
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            texts = as_bytes(batch.column("text"))
            for start in range(0, len(texts), shard_docs):
                n, text, term, count = counted(texts[start:start + shard_docs], held.value)
                lengths = np.bincount(text, minlength=len(n))
                full = np.flatnonzero(n)
                shard.ids += [ids[start + i] for i in full]
                shard.sizes.append(n[full])
                shard.lengths.append(lengths[full])
                shard.terms.append(term)
                shard.counts.append(count)
                postings += len(term)
                if len(shard) >= shard_docs or postings >= SHARD_POSTINGS:
                    yield shard.row()
                    number += 1
                    shard, postings = _Shard(number), 0
        if len(shard):
            yield shard.row()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SHARDS)


def vocabulary_hashes(vocabulary: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms in ascending order, and the terms' numbers in that order."""
    hashes, _ = hashed_runs("\n".join(vocabulary).encode("utf-8"), WORD)
    order = np.argsort(hashes)
    if len(np.unique(hashes)) != len(vocabulary):
        raise RuntimeError("two terms of the items share a hash")
    return hashes[order], order


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of many runs, one after the other."""
    total = int(lengths.sum())
    return np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(total) if total else np.zeros(0, np.int64)


class BlockedIndex:
    """Posting lists of one shard in blocks of similar documents, with the largest impacts of each block."""

    def __init__(self, terms: np.ndarray, impacts: np.ndarray, ends: np.ndarray, block: int = BLOCK):
        self.block = block
        self.terms, self.impacts, self.ends = terms, impacts, ends
        self.starts = np.concatenate([[0], ends[:-1]])
        self.lengths = ends - self.starts
        order = np.argsort(terms, kind="stable")
        self.list_docs = np.repeat(np.arange(len(ends)), self.lengths)[order]
        self.present, self.list_of = np.unique(terms, return_inverse=True)
        self.list_starts = np.searchsorted(terms[order], self.present)
        self.list_ends = np.append(self.list_starts[1:], len(order))
        self.largest = np.maximum.reduceat(impacts[order], self.list_starts) if len(order) else np.zeros(0, np.int64)
        self._projected: np.ndarray | None = None
        self._blocks: dict[int, tuple[np.ndarray, ...]] = {}

    def place(self, terms: np.ndarray) -> np.ndarray:
        """Number of each term's list here, -1 where no document of the shard holds it."""
        if not len(self.present):
            return np.full(len(terms), -1)
        at = np.minimum(np.searchsorted(self.present, terms), len(self.present) - 1)
        return np.where(self.present[at] == terms, at, -1)

    def projected(self) -> np.ndarray:
        """Unit vectors of a random projection of the documents' impacts."""
        if self._projected is None:
            signs = np.random.default_rng(20240613).standard_normal((int(self.present[-1]) + 1, PROJECTION)).astype(np.float32)
            out = np.zeros((len(self.ends), PROJECTION), np.float32)
            for a in range(0, len(self.ends), 256):
                some = slice(int(self.starts[a]), int(self.ends[min(a + 256, len(self.ends)) - 1]))
                rows = np.repeat(np.arange(a, min(a + 256, len(self.ends))), self.lengths[a:a + 256])
                np.add.at(out, rows, signs[self.terms[some]] * self.impacts[some, None].astype(np.float32))
            self._projected = out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), np.float32(1e-9))
        return self._projected

    def blocks(self, i: int) -> tuple[np.ndarray, ...]:
        """Of list ``i``: documents in block order, block ends, and the summaries' ends, terms and impacts."""
        if i in self._blocks:
            return self._blocks[i]
        docs = self.list_docs[self.list_starts[i]:self.list_ends[i]]
        if len(docs) > self.block:
            vectors = self.projected()[docs]
            pivots = vectors[np.linspace(0, len(docs) - 1, -(-len(docs) // self.block)).astype(int)]
            cluster = (vectors @ pivots.T).argmax(axis=1)
            order = np.argsort(cluster, kind="stable")
            docs, cluster = docs[order], cluster[order]
            first = np.flatnonzero(np.diff(cluster, prepend=-1))
            within = np.arange(len(docs)) - np.repeat(first, np.diff(np.append(first, len(docs))))
            opens = np.flatnonzero(within % self.block == 0)
        else:
            opens = np.zeros(1, np.int64)
        ends = np.append(opens[1:], len(docs))
        lengths = self.lengths[docs]
        entries = spread(self.starts[docs], lengths)
        of = np.repeat(np.repeat(np.arange(len(ends)), ends - opens), lengths)
        place = self.list_of[entries]
        tops, numbers, values = [], [], []
        step = max(1, (1 << 21) // len(self.present))
        for a in range(0, len(ends), step):  # a bounded table at a time
            z = min(a + step, len(ends))
            low, high = np.searchsorted(of, [a, z])
            grid = np.zeros((z - a) * len(self.present), np.int64)
            np.maximum.at(grid, (of[low:high] - a) * len(self.present) + place[low:high], self.impacts[entries[low:high]])
            there = np.flatnonzero(grid)
            tops.append(np.searchsorted(there, np.arange(1, z - a + 1) * len(self.present)) + (tops[-1][-1] if tops else 0))
            numbers.append(self.present[there % len(self.present)])
            values.append(grid[there])
        made = docs, ends, np.concatenate(tops), np.concatenate(numbers), np.concatenate(values)
        self._blocks[i] = made
        return made

    def scores(self, docs: np.ndarray, weights: np.ndarray) -> np.ndarray:
        lengths = self.lengths[docs]
        entries = spread(self.starts[docs], lengths)
        return _sums(weights[self.terms[entries]] * self.impacts[entries], np.cumsum(lengths))


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    out = total[ends]
    out[1:] -= out[:-1].copy()
    return out


class Best:
    """The best documents of one item so far: score falling, then smaller id, no id last."""

    def __init__(self, top: int, least: int):
        self.top, self.rows, self.least = top, [], max(1, least)

    def add(self, scores: np.ndarray, ids: list) -> None:
        good = np.flatnonzero(scores >= self.least)
        if len(good):
            self.rows += [(int(scores[i]), ids[i]) for i in good]
            self.rows.sort(key=lambda r: (-r[0], r[1] is None, r[1] or 0))
            del self.rows[self.top:]
            if len(self.rows) == self.top:
                self.least = max(self.least, self.rows[-1][0])


def search_shard(index: BlockedIndex, ids: np.ndarray, terms: np.ndarray, weights: np.ndarray, dense: np.ndarray, best: Best) -> int:
    """Adds the documents of a shard that may belong to an item's best.  Returns how many were scored.

    ``dense`` is a zeroed vector over the vocabulary that this call may write to and leaves zeroed.
    """
    at = index.place(terms)
    held = at >= 0
    if not held.any():
        return 0
    lists, weight = at[held], weights[held]
    dense[terms] = weights
    seen = np.zeros(len(index.ends), bool)
    short = index.list_ends[lists] - index.list_starts[lists] <= index.block
    if short.any():
        one = lists[short]
        seen[index.list_docs[spread(index.list_starts[one], (index.list_ends - index.list_starts)[one])]] = True
        found = np.flatnonzero(seen)
        best.add(index.scores(found, dense), ids[found])
    lists, most = lists[~short], (weight * index.largest[lists])[~short]
    order = np.argsort(-most, kind="stable")
    lists, most = lists[order], most[order]
    rest = np.cumsum(most[::-1])[::-1]
    for k, i in enumerate(lists):
        if rest[k] < best.least:  # documents of these lists only cannot reach the least score
            break
        docs, ends, tops, numbers, values = index.blocks(int(i))
        bounds = _sums(dense[numbers] * values, tops)
        opens = np.concatenate([[0], ends[:-1]])
        by_bound = np.argsort(-bounds, kind="stable")
        for a in range(0, len(by_bound), 4):
            some = by_bound[a:a + 4]
            some = some[bounds[some] >= best.least]
            if not len(some):
                break
            found = docs[spread(opens[some], (ends - opens)[some])]
            found = found[~seen[found]]
            seen[found] = True
            if len(found):
                best.add(index.scores(found, dense), ids[found])
    dense[terms] = 0
    return int(seen.sum())


def impacts_of(counts: np.ndarray, sizes: np.ndarray, n_docs: int, n_words: int) -> np.ndarray:
    """Whole-number impact of ``counts`` occurrences in documents of ``sizes`` words."""
    if 25 * int(sizes.max(initial=0)) * n_docs >= 1 << 63:
        raise OverflowError("document sizes times the number of documents exceed 64 bits")
    length = 100 - 25 + 25 * sizes * n_docs // n_words
    return 10**9 * counts // (1000 * counts + 12 * length)


FOUND = "item_id long, doc_id long, score long"


def found_in(packed: DataFrame, items: list[tuple], stats: tuple[int, int], least: dict, top: int, block: int) -> DataFrame:
    """The best of each task's shards for every item (number, id, terms, weights), from the ``least`` scores on."""
    held = packed.sparkSession.sparkContext.broadcast((items, least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, lower = held.value
        best = [Best(top, lower.get(i, 1)) for i, _, _ in asked]
        width = 1 + max(int(t.max()) for _, t, _ in asked)
        dense = np.zeros(width, np.int64)
        for batch in batches:
            for r in batch.select(["ids", "sizes", "ends", "terms", "counts"]).to_pylist():
                sizes, ends, counts = (np.frombuffer(r[c], "<i8") for c in ("sizes", "ends", "counts"))
                terms = np.frombuffer(r["terms"], "<i4")
                impacts = impacts_of(counts, np.repeat(sizes, np.diff(ends, prepend=0)), *stats)
                index = BlockedIndex(terms, impacts, ends, block)
                ids = np.array(r["ids"], dtype=object)
                for (_, t, w), b in zip(asked, best):
                    search_shard(index, ids, t, w, dense, b)
        rows = [(i, doc, score) for (i, _, _), b in zip(asked, best) for score, doc in b.rows]
        columns = list(zip(*rows)) if rows else [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item_id", "doc_id", "score"])

    return packed.mapInArrow(run, FOUND)


def ranked(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search_batch(docs: DataFrame, batch: list[tuple[int | None, dict[str, int]]], top: int, shard_docs: int, block: int, first: int) -> DataFrame | None:
    vocabulary = sorted({w for _, asked in batch for w in asked})
    _, order = vocabulary_hashes(vocabulary)
    place = {vocabulary[i]: k for k, i in enumerate(order)}
    packed = checkpoint(shards(docs, vocabulary, shard_docs))
    n_docs, n_words = packed.agg(F.sum("docs"), F.sum("words")).first()
    if not n_docs:
        return None
    held = np.zeros(len(vocabulary), np.int64)
    frequencies = (packed.select(F.explode(F.arrays_zip("distinct", "holding")).alias("x")).groupBy("x.distinct").agg(F.sum("x.holding").alias("n"))).toPandas()
    held[frequencies["distinct"].to_numpy(np.int64)] = frequencies["n"].to_numpy(np.int64)
    weight = [floor(1000 * log((2 * n_docs + 2) / (2 * n + 1))) for n in held.tolist()]
    items = []
    for i, asked in batch:
        at = np.array(sorted(place[w] for w in asked), np.int64)
        of = {place[w]: n for w, n in asked.items()}
        items.append((i, at, np.array([weight[k] * of[k] for k in at.tolist()], np.int64)))
    early = F.pmod(F.xxhash64("shard"), F.lit(first)) == 0
    start = checkpoint(ranked(found_in(packed.where(early), items, (n_docs, n_words), {}, top, block), top))
    least = {r["item_id"]: r["score"] for r in start.where(F.col("rank") == top).collect()}
    rest = found_in(packed.where(~early), items, (n_docs, n_words), least, top, block)
    return ranked(start.drop("rank").unionByName(rest), top)


def search(docs: DataFrame, items: DataFrame, top: int = TOP, shard_docs: int = SHARD, block: int = BLOCK, first: int = FIRST, batch_terms: int = BATCH_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``top`` highest-scoring documents with a score above 0."""
    terms = checkpoint(item_terms(items))
    out = None
    for batch in batches_of(terms, batch_terms):
        part = search_batch(docs, batch, top, shard_docs, block, first)
        if part is not None:
            out = part if out is None else out.unionByName(part)
    if out is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return out.select("item_id", "rank", "doc_id", "score")
