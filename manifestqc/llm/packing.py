"""Packing: shortest-pack-first over the length histogram.

Documents become token ids; ids beyond the capacity are cut into full pieces
and one rest.  Only the histogram of piece lengths (at most ``capacity`` rows)
reaches the driver.  Lengths are placed longest first, each on the pattern
that holds the fewest tokens so far, or on a new one if it does not fit, and the
counts of the patterns are split accordingly.  Every placement takes a run of
ranks of its length, so pieces find their sequence by (length, rank).

Ranks do not need all pieces of one length in one task: pieces are numbered in
hashed buckets (about sqrt(n) of them, each about sqrt(n) rows for one hot
length) and the bucket counts give the offsets.

Defined results: null text counts as empty; an empty text is one piece with the
end id; repeated rows are packed each on its own; a null doc_id stays null; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from manifestqc.llm.common import checkpoint, exact_ids, give_back, id_array, id_list, text_slices, trim
from manifestqc.llm.tokens import piece_ids, tokenizer_path

CAPACITY = 4096
END_ID = 2
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PLACES = "length long, lo long, hi long, first_sequence long, offset long, sequence_tokens long"


def token_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: full pieces of ``capacity`` ids and the rest of the document (``ids`` as bytes if asked for)."""
    path = path or tokenizer_path()

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        give_back()  # before the tokenizer and its cache of words take theirs
        encode = piece_ids(path, end_id).encode

        def cut_slice(pdf: pd.DataFrame, texts: list[str]) -> pd.DataFrame:
            rows = []
            for doc_id, raw in zip(id_list(pdf["doc_id"]), encode(texts)):
                n = len(raw) // 4
                for start in range(0, n, capacity):
                    part = raw[4 * start: 4 * (start + capacity)]
                    rows.append((doc_id, start, len(part) // 4, zlib.crc32(part), n) + ((part,) if with_ids else ()))
            out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids)
            return out.assign(doc_id=id_array([r[0] for r in rows]))

        try:
            for pdf, texts in text_slices(frames, max_chars=1_000_000):
                yield cut_slice(pdf, texts)
                trim()
        finally:
            pdf = texts = None
            give_back()  # workers take turns: while others pack, this one waits with its cache of words alone

    return exact_ids(docs.select("doc_id", "text"), "doc_id").mapInPandas(cut, PIECES + (", ids binary" if with_ids else ""))


def pack_histogram(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, tuple[int, ...]]]:
    """(count, lengths) of every pattern.  The heap holds one entry per pattern, fewest tokens first."""
    open_packs: list[tuple[int, int]] = []
    groups: dict[int, tuple[int, tuple[int, ...]]] = {}
    number = 0

    def put(count: int, lengths: tuple[int, ...]) -> None:
        nonlocal number
        groups[number] = (count, lengths)
        heapq.heappush(open_packs, (sum(lengths), number))
        number += 1

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if not open_packs or open_packs[0][0] + length > capacity:
                put(left, (length,))
                break
            _, shortest = heapq.heappop(open_packs)
            count, lengths = groups.pop(shortest)
            if count > left:
                put(count - left, lengths)
            put(min(count, left), (*lengths, length))
            left -= min(count, left)
    return list(groups.values())


def placements(patterns: list[tuple[int, tuple[int, ...]]]) -> list[tuple[int, int, int, int, int, int]]:
    """Rows of PLACES: which ranks of a length go to which run of sequences, and where in them."""
    next_rank: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for count, lengths in patterns:
        offset = 0
        for length in lengths:
            lo = next_rank[length]
            next_rank[length] = lo + count
            rows.append((length, lo, lo + count, sequence, offset, sum(lengths)))
            offset += length
        sequence += count
    return rows


def rank_within_length(pieces: DataFrame, total: int) -> DataFrame:
    """Adds ``rank``, gapless from 0 for each length."""
    buckets = max(1, math.isqrt(total))
    order = ["doc_id", "start", "ids_crc32", "doc_tokens"]
    numbered = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)))
    before = (numbered.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)))
              .select("length", "bucket", F.coalesce("before", F.lit(0)).alias("before")))
    within = numbered.withColumn("k", F.row_number().over(Window.partitionBy("length", "bucket").orderBy(*order)))
    return within.join(before, ["length", "bucket"]).withColumn("rank", F.col("before") + F.col("k") - 1).drop("bucket", "before", "k")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id, offset, sequence_tokens and padded_to (the capacity, or the content where that is a power of two)."""
    spark = pieces.sparkSession
    pieces = checkpoint(pieces)
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = placements(pack_histogram(counts, capacity))
    places = F.broadcast(spark.createDataFrame(pd.DataFrame(rows, columns=[c.split()[0] for c in PLACES.split(", ")]), PLACES) if rows
                         else spark.createDataFrame([], PLACES))
    ranked = rank_within_length(pieces, sum(counts.values()))
    tokens = F.col("sequence_tokens")
    power = tokens.bitwiseAND(tokens - 1) == 0
    return (ranked.join(places, (ranked["length"] == places["length"]) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
            .select("doc_id", "start", ranked["length"], "ids_crc32", "doc_tokens",
                    (F.col("first_sequence") + F.col("rank") - F.col("lo")).alias("sequence_id"), "offset", "sequence_tokens",
                    F.when(power, tokens).otherwise(F.lit(capacity)).cast("long").alias("padded_to")))


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    return pack(token_pieces(docs, path, capacity, end_id), capacity)


def sequences(docs: DataFrame, packed: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The packed training rows themselves: sequence_id, doc_ids, offsets and ids (array of int); needs unique doc_id."""
    ids = token_pieces(docs, path, capacity, end_id, with_ids=True).select("doc_id", "start", "ids")
    parts = packed.join(ids, packed["doc_id"].eqNullSafe(ids["doc_id"]) & (packed["start"] == ids["start"]))
    return (parts.groupBy("sequence_id")
            .agg(F.sort_array(F.collect_list(F.struct(packed["offset"], packed["doc_id"], ids["ids"]))).alias("parts"), F.max("padded_to").alias("padded_to"))
            .select("sequence_id", F.col("parts.doc_id").alias("doc_ids"), F.col("parts.offset").alias("offsets"), F.col("parts.ids").alias("ids"), "padded_to"))
