"""Benchmark decontamination with one Aho-Corasick automaton over normalised test items.

Item texts are lower-cased (A-Z) and cut into words; every run of ``width``
words is a window (a shorter item is one window).  The automaton holds each
distinct window once, as normalised text between single spaces, so that a match
is always on whole words.  A document is normalised the same way and scanned
once; match ends are turned into word numbers, and word numbers into offsets of
the original text (normalising keeps every byte's place, so words map back).

The item table travels to the workers in blocks of at most ``BLOCK_CHARS`` of
normalised windows and item ids.  A table that needs several blocks is scanned block
by block: the driver gathers one block, the hits of its scan are checkpointed, and
its broadcast is destroyed before the next one is gathered.  The hits are merged per
document, so the size of the benchmark does not limit the operator.  The ids of a
window that very many items have come in shards of about ``ITEMS`` ids.

Defined results: null or wordless text has no words and no hits; null items and
items without words give no window; repeated items count once per item_id; a
null item_id counts as no item but its words hit; overlapping and repeated
windows are each reported; empty tables give no rows or no hits; other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from manifestqc.llm.common import checkpoint, text_slices

WIDTH = 10
BLOCK_CHARS = 32_000_000
ITEMS = 100_000
# A-Z to a-z; other ASCII beside digits and letters to a space; bytes of other characters stay.
NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def normal_words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(NORMAL).split()


def padded(words: list[bytes]) -> str:
    return " " + b" ".join(words).decode("utf-8", "surrogatepass") + " "


def item_windows(text: str, width: int) -> list[str]:
    words = normal_words(text)
    return [padded(words[i:i + width]) for i in range(max(1, len(words) - width + 1))] if words else []


def sized_windows(benchmark: DataFrame, width: int, shard_items: int) -> tuple[DataFrame, int]:
    """(phrase, items, size): the distinct windows with shards of their item ids, checkpointed, and the sum of the sizes."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf, texts in text_slices(frames):
            rows = [(None if i != i else str(int(i)), w) for i, t in zip(pdf["item_id"].tolist(), texts) for w in dict.fromkeys(item_windows(t, width))]
            yield pd.DataFrame(rows, columns=["item", "phrase"])

    shards = max(1, -(-benchmark.count() // shard_items))
    windows = benchmark.select("item_id", "text").mapInPandas(run, "item string, phrase string")
    size = F.length("phrase") + 8 + 8 * F.size("items")
    found = checkpoint(windows.groupBy("phrase", F.pmod(F.xxhash64("item"), F.lit(shards)).alias("shard")).agg(F.collect_set("item").alias("items"))
                       .select("phrase", "items", size.alias("size")))
    return found, found.agg(F.sum("size")).first()[0] or 0


def window_blocks(found: DataFrame, total: int, block_chars: int) -> Iterator[dict[str, tuple[int, list[str]]]]:
    """Blocks of window -> (words, item ids), each of ``block_chars`` at most (or one row of ``sized_windows`` that is larger).

    The rows are gathered by hash in parts of about half a block, one partition
    of a part at a time; a block ends before the row that would exceed the bound.
    """
    parts = -(-2 * total // block_chars) if total > block_chars else 1
    block: dict[str, tuple[int, list[str]]] = {}
    size = 0
    for k in range(parts):
        part = found.where(F.pmod(F.xxhash64("phrase"), F.lit(parts)) == k) if parts > 1 else found
        for r in part.toLocalIterator():
            if block and size + r["size"] > block_chars:
                yield block
                block, size = {}, 0
            n, items = block.get(r["phrase"], (r["phrase"].count(" ") - 1, []))
            block[r["phrase"]] = n, items + r["items"]
            size += r["size"]
    if block:
        yield block


def automaton(phrases: dict[str, tuple[int, list[str]]]):
    import ahocorasick
    machine = ahocorasick.Automaton()
    for phrase, value in phrases.items():
        machine.add_word(phrase, value)
    machine.make_automaton()
    return machine


def original_spans(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
    """(first word, last word, start, end) with offsets in characters of the original text, end exclusive."""
    raw = text.encode("utf-8", "surrogatepass")
    flags = np.frombuffer(raw.translate(NORMAL), np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    starts, ends = edges[::2], edges[1::2]
    chars = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)  # characters up to and with each byte
    return [(a, z, int(chars[starts[a]]) - 1, int(chars[ends[z] - 1])) for a, z in runs]


def scan(text: str, machine) -> tuple[int, set[str], list[tuple[int, int]]]:
    """Words, items met, and merged runs of hit words (first, last)."""
    words = normal_words(text)
    if not words or not len(machine):
        return len(words), set(), []
    line = padded(words)
    items: set[str] = set()
    found = []
    for end, (n, ids) in machine.iter(line):
        found.append((end, n))
        items.update(ids)
    if not found:
        return len(words), items, []
    spaces = np.flatnonzero(np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32) == 32)
    runs: list[list[int]] = []
    for end, n in found:  # ends come in order; a longer window that ends here starts earlier
        last = int(np.searchsorted(spaces, end)) - 1
        first = last - n + 1
        while runs and first <= runs[-1][1] + 1:
            first, last = min(first, runs[-1][0]), max(last, runs[-1][1])
            runs.pop()
        runs.append([first, last])
    return len(words), items, [(a, z) for a, z in runs]


def merged(runs: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    out: list[list[int]] = []
    for a, z, s, e in sorted(runs):
        if out and a <= out[-1][1] + 1:
            if z > out[-1][1]:
                out[-1][1], out[-1][3] = z, e
        else:
            out.append([a, z, s, e])
    return [tuple(x) for x in out]


RESULT = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, spans array<struct<start:long,end:long>>"
FOUND = "n long, items array<string>, runs array<struct<a:long,z:long,s:long,e:long>>"


def _hits(texts: pd.Series, machine) -> Iterator[tuple]:
    for text in texts:
        text = text if isinstance(text, str) else ""
        n, items, runs = scan(text, machine)
        yield n, items, original_spans(text, runs) if runs else []


def _result(n: int, items, runs) -> tuple:
    hit = sum(z - a + 1 for a, z, _, _ in runs)
    digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
    return n, hit, len(items), digest, hit > 0, [{"start": s, "end": e} for _, _, s, e in runs]


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.replace("<start:long,end:long>", "").replace("<a:long,z:long,s:long,e:long>", "").split(", ")]


def scanned(docs: DataFrame, benchmark: DataFrame, width: int, block_chars: int, shard_items: int = ITEMS) -> tuple[DataFrame, str]:
    """``docs`` with a struct column of RESULT; its name, which no column of ``docs`` has."""
    name = "_found"
    while name in docs.columns:
        name += "_"
    held = docs.sparkSession.sparkContext.broadcast
    windows, total = sized_windows(benchmark, width, shard_items)
    blocks = window_blocks(windows, total, block_chars)
    if total <= block_chars:
        block = held(next(blocks, {}))

        @F.pandas_udf(RESULT)
        def whole(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            machine = automaton(block.value)
            for texts in batches:
                yield pd.DataFrame([_result(*h) for h in _hits(texts, machine)], columns=_names(RESULT))

        return docs.withColumn(name, whole(F.col("text"))), name

    def scanner(block: Broadcast):
        @F.pandas_udf(FOUND)
        def part(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            machine = automaton(block.value)
            for texts in batches:
                yield pd.DataFrame([(n, sorted(items), [dict(zip("azse", r)) for r in runs]) for n, items, runs in _hits(texts, machine)], columns=_names(FOUND))
        return part

    @F.pandas_udf(RESULT)
    def merge(words: pd.Series, items: pd.Series, runs: pd.Series) -> pd.DataFrame:
        rows = []
        for n, met, found in zip(words, items, runs):
            rows.append(_result(n, set(met), merged([(r["a"], r["z"], r["s"], r["e"]) for r in found])))
        return pd.DataFrame(rows, columns=_names(RESULT))

    key = name + "row"
    numbered = checkpoint(docs.withColumn(key, F.monotonically_increasing_id()))
    hits = None
    for phrases in blocks:
        block = held(phrases)
        one = numbered.select(F.col(key), scanner(block)(F.col("text")).alias("h")).select(key, "h.*")
        one = checkpoint(one if hits is None else one.where(F.size("runs") > 0))  # the first one counts every row's words
        hits = one if hits is None else hits.union(one)
        block.destroy()
    found = (hits.groupBy(key).agg(F.max("n").alias("n"), F.flatten(F.collect_list("items")).alias("items"), F.flatten(F.collect_list("runs")).alias("runs"))
             .select(key, merge("n", "items", "runs").alias(name)))
    return numbered.join(found, key).drop(key), name


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id and RESULT for every row of ``docs``; spans are the hit passages in the original text."""
    found, name = scanned(docs, benchmark, width, block_chars)
    return found.select("doc_id", f"{name}.*")


def decontaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` without the rows that hold a window of a test item; columns as they are."""
    found, name = scanned(docs, benchmark, width, block_chars)
    return found.where(~F.col(f"{name}.contaminated")).drop(name)
