"""Line deduplication as an exact set-similarity join.

A line is the set of its distinct tokens, which are runs of ``width``
consecutive words (single words saturate: on a large corpus even the rarest word
of a line is in many lines, so that candidates would grow with the square of the
input).  A line of fewer words has one token, its whole sequence of words, so that
exact copies of it go.  A line goes if an earlier line (by doc_id, then line number) has a set
of Jaccard similarity ``percent`` or more.

1. One scan gives every line the 128-bit identity of its set, and counts tokens
   in 65,536 bins.  The bins' ranks by count, then the token, are the rarity
   order: a total order, so the filters below are exact whatever the counts.
2. Lines of equal sets are collapsed to their first occurrence.
3. A second scan puts each line's tokens in that order and emits its prefix: any
   two sets that reach the similarity share a token in their prefixes.  Prefixes
   are dealt out by token in packed blocks; tokens of one set only are dropped.
4. Candidates share a prefix token and pass the length and positional filters.
   Each set is first paired with the earliest set of the token only; the sets
   still without an earlier match are then paired with all other earlier ones, so a
   group of near-equal lines costs about as many pairs as it has lines.
5. Pairs are verified on the full sets of their lines; the lines of pairs, and no
   others, are taken from the few documents that hold them (behind a bitmap of fixed size).

Defined results: lines under ``min_words`` words (by default the wordless ones) are
neither matched nor removed; null text has no lines; rows that repeat
a doc_id are one document at the same positions (their equal lines stay or go
together); rows with a null doc_id take no part and stay as they are; an empty
table gives no rows; other columns are kept by ``dedup_lines``, and n_chars,
where there is one, follows the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from manifestqc.llm.common import bit_number, bitmap, checkpoint, in_bitmap, mix, possible, split_by_ids, summed_bins, text_slices, word_keys

WIDTH = 5
PERCENT = 80
BINS = 1 << 16
RECORD = np.dtype([("token", "<i8"), ("s1", "<i8"), ("n", "<u4"), ("pos", "<u4")])
RECORDS_PER_TASK = 2_000_000
_MUL = np.uint64(0x9E3779B97F4A7C15)


class Lines:
    """The lines with ``least`` (or ``width``) words or more of a slice of texts, and their distinct tokens (owner ascending)."""

    def __init__(self, texts: list[str], width: int, least: int | None = None):
        raw = "\n".join(texts).encode("utf-8", "surrogatepass").lower()
        breaks = np.flatnonzero(np.frombuffer(raw, np.uint8) == 10)
        h, first = word_keys(raw)
        line = np.cumsum(np.bincount(np.searchsorted(first, breaks), minlength=len(first) + 1))[:len(first)]  # of each word, over all texts
        head = np.cumsum([0] + [t.count("\n") + 1 for t in texts])  # first line of each text
        new = np.flatnonzero(np.diff(line, prepend=-1))  # first word of each line that has any
        sizes = np.diff(new, append=len(line))
        enough = sizes >= (width if least is None else min(least, width))
        known = line[new[enough]]
        self.row = np.searchsorted(head, known, "right") - 1
        self.number = known - head[self.row]
        h, owner = h[np.repeat(enough, sizes)], np.repeat(np.arange(len(known)), sizes[enough])
        count = max(0, len(h) - width + 1)
        run = h[:count].copy()
        for k in range(1, width):
            run = run * _MUL + h[k:count + k]
        inside = owner[:count] == owner[width - 1:width - 1 + count]
        token, of_run = mix(run[inside]), owner[:count][inside]
        sizes = sizes[enough]
        short = np.flatnonzero(sizes < width)
        if len(short):  # one token: the whole sequence
            at, size = (np.cumsum(sizes) - sizes)[short], sizes[short]
            whole = h[at]
            for k in range(1, width - 1):
                more = size > k
                whole[more] = whole[more] * _MUL + h[at[more] + k]
            place = np.searchsorted(of_run, short)
            token, of_run = np.insert(token, place, mix(whole + size.astype(np.uint64))), np.insert(of_run, place, short)
        owner = of_run
        own = token ^ (owner.astype(np.uint64) * _MUL)
        ordered = np.sort(own)
        again = ordered[1:][ordered[1:] == ordered[:-1]]
        if len(again):  # a token twice in a line: only what may be such a token is looked at again
            some = np.zeros(1 << 16, bool)
            some[(again >> np.uint64(48)).astype(np.int64)] = True
            look = np.flatnonzero(some[(own >> np.uint64(48)).astype(np.int64)])
            _, once = np.unique(own[look], return_index=True)
            keep = np.ones(len(own), bool)
            keep[look] = False
            keep[look[once]] = True
            token, owner = token[keep], owner[keep]
        self.token, self.owner = token, owner
        self.start = np.searchsorted(owner, np.arange(len(self.row)))
        self.n = np.diff(np.append(self.start, len(owner)))

    def __len__(self) -> int:
        return len(self.row)

    def identities(self) -> tuple[np.ndarray, np.ndarray]:
        """Two order-free 64-bit sums of each line's tokens."""
        if not len(self):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        one = np.add.reduceat(mix(self.token + _MUL), self.start)
        two = np.add.reduceat(mix((self.token ^ (self.token >> np.uint64(32))) * _MUL), self.start)
        return mix(one + self.n.astype(np.uint64)).view(np.int64), mix(two).view(np.int64)


def order_in_lines(owner: np.ndarray, token: np.ndarray) -> np.ndarray:
    """np.lexsort((token, owner)) for ascending owners, by one sort of packed keys wherever these tell all tokens apart."""
    if not len(owner):
        return np.zeros(0, np.int64)
    bits = np.uint64(int(owner[-1]).bit_length())
    packed = (owner.astype(np.uint64) << (np.uint64(64) - bits) if bits else 0) | token >> bits
    order = np.argsort(packed)
    packed = packed[order]
    return np.lexsort((token, owner)) if (packed[1:] == packed[:-1]).any() else order


def _needed(n, percent: int):
    """Fewest tokens a set of n shares with a similar set that is no smaller than the similarity allows."""
    return -((-percent * n) // 100)


def line_sets(docs: DataFrame, width: int, least: int | None = None) -> DataFrame:
    """A row per line (doc_id, line, n, s1, s2), and per task one row that holds the token counts (bins)."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bins = np.zeros(BINS, np.int64)
        for pdf, texts in text_slices(frames):
            lines = Lines(texts, width, least)
            bins += np.bincount((lines.token >> np.uint64(48)).astype(np.int64), minlength=BINS)
            s1, s2 = lines.identities()
            yield pd.DataFrame({"doc_id": pdf["doc_id"].to_numpy()[lines.row], "line": lines.number, "n": lines.n, "s1": s1, "s2": s2, "bins": None})
        if bins.any():
            yield pd.DataFrame({"doc_id": [0], "line": [0], "n": [0], "s1": [0], "s2": [0], "bins": [bins]})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, line long, n long, s1 long, s2 long, bins array<long>")


def rarity_ranks(found: DataFrame) -> tuple[np.ndarray, int]:
    """Rank of each bin by its count over all documents (BINS numbers reach the driver), and the number of tokens."""
    counts = summed_bins(found, "bins", BINS)
    ranks = np.empty(BINS, np.uint64)
    ranks[np.lexsort((np.arange(BINS), counts))] = np.arange(BINS, dtype=np.uint64)
    return ranks, int(counts.sum())


def packed(columns: list[np.ndarray]) -> bytes:
    """Records as bytes, one column after the other, which shuffles compress better than whole records."""
    return b"".join(v.tobytes() for v in columns)


def unpacked(raw: bytes) -> np.ndarray:
    """The records of ``packed``."""
    out, at = np.empty(len(raw) // RECORD.itemsize, RECORD), 0
    for c in RECORD.names:
        out[c] = np.frombuffer(raw, RECORD[c], len(out), at)
        at += len(out) * RECORD[c].itemsize
    return out


def prefixes(docs: DataFrame, ranks: np.ndarray, width: int, percent: int, parts: int) -> DataFrame:
    """(part, records): the rarest tokens of each line of ``width`` words or more, enough to share one with every similar line.

    Shorter lines are no candidates: their only token is in lines of equal sets, which are collapsed.

    Records (token, identity, set size, place in the order) leave in packed
    blocks, one per slice of texts and target partition; the token decides the partition.
    """
    held = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, texts in text_slices(frames, max_chars=1_000_000):
            lines = Lines(texts, width)
            if not len(lines):
                continue
            s1, _ = lines.identities()
            _, first = np.unique(s1, return_index=True)
            once = np.zeros(len(lines), bool)
            once[first] = True
            kept = once[lines.owner]
            owner, token = lines.owner[kept], lines.token[kept]
            token = (held.value[(token >> np.uint64(48)).astype(np.int64)] << np.uint64(48)) | (token & np.uint64((1 << 48) - 1))
            order = order_in_lines(owner, token)
            owner, token = owner[order], token[order]
            n = lines.n[owner]
            size = np.bincount(owner)
            pos = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
            head = pos < n - _needed(n, percent) + 1
            head = np.flatnonzero(head)
            part = (token[head] & np.uint64(0xFFFFFFFF)).astype(np.int64) % parts
            order = np.argsort(part, kind="stable")
            head, part = head[order], part[order]
            out = [v.astype(RECORD[c]) for c, v in zip(RECORD.names, (token[head].view(np.int64), s1[owner[head]], n[head], pos[head]))]
            at = np.flatnonzero(np.diff(part, prepend=-1))
            yield pd.DataFrame({"part": part[at], "records": [packed([v[a:z] for v in out]) for a, z in zip(at, [*at[1:], len(part)])]})

    return docs.select("text").mapInPandas(run, "part int, records binary")


def _distinct(blocks: list[np.ndarray]) -> np.ndarray:
    rows = np.concatenate(blocks) if blocks else np.zeros(0, RECORD)
    rows = rows[np.lexsort((rows["s1"], rows["token"]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows["token"][1:] != rows["token"][:-1]) | (rows["s1"][1:] != rows["s1"][:-1])
    return rows[new]


def _with_neighbour(tokens: np.ndarray) -> np.ndarray:
    """Of sorted tokens, whether the one before or behind is equal."""
    same = tokens[1:] == tokens[:-1]
    out = np.zeros(len(tokens), bool)
    out[1:] |= same
    out[:-1] |= same
    return out


def _met_again(blocks: list[np.ndarray]) -> np.ndarray:
    """The records whose token another record has too; most have a token of their own, and need no order."""
    rows = np.concatenate(blocks) if blocks else np.zeros(0, RECORD)
    order = np.argsort(rows["token"])
    return rows[order[_with_neighbour(rows["token"][order])]]


def shared_prefixes(blocks: DataFrame, parts: int, most: int = 64 << 20) -> DataFrame:
    """The distinct (token, s1, n, pos) whose token more than one set has.

    A task holds its distinct records: repeats, which a common line has many of,
    are dropped whenever ``most`` bytes have come together.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size, limit = [], 0, most
        for pdf in frames:
            for raw in pdf["records"]:
                held.append(unpacked(raw))
                size += len(raw)
                if size >= limit:
                    held = [_distinct(held)]
                    size = held[0].nbytes
                    limit = max(most, 2 * size)
        held = [_met_again(held)]
        rows = _distinct(held)
        rows = rows[_with_neighbour(rows["token"])]
        for i in range(0, len(rows), 100_000):
            yield pd.DataFrame({c: rows[c][i:i + 100_000].astype(np.int64) for c in RECORD.names})

    return blocks.repartitionById(parts, "part").mapInPandas(run, "token long, s1 long, n long, pos long")


def lines_at(docs: DataFrame, places: DataFrame) -> DataFrame:
    """(doc_id, line, content) of the places (doc_id, line); documents without any stay out of the shuffle.

    One step of Python a task, which sees numbers only: a second one would take another worker, whose memory stays.
    """
    doc_bit, bits = bit_number(F.xxhash64("doc_id")), 1 << 23
    step = 40503
    line_bit = doc_bit.bitwiseXOR((F.col("line") * step % bits).cast("int"))
    held = docs.sparkSession.sparkContext.broadcast((bitmap(places, doc_bit), bitmap(places, line_bit)))

    @F.pandas_udf("array<int>")
    def possible_lines(doc: pd.Series, n_lines: pd.Series) -> pd.Series:
        of_docs, of_lines = held.value
        out = []
        some = in_bitmap(of_docs, doc.to_numpy())
        for number, n, look in zip(doc.tolist(), n_lines.tolist(), some.tolist()):
            k = np.arange(n if look else 0)
            out.append(k[in_bitmap(of_lines, number ^ k * step % bits)].astype(np.int32))
        return pd.Series(out, dtype=object)

    # not deterministic, so that the filter does not compute it a second time, beside the first
    at = possible_lines.asNondeterministic()(doc_bit, _n_lines()).alias("at")
    some = docs.where("doc_id is not null and text is not null").select("doc_id", "text", at).where(F.size("at") > 0)
    lines = some.select("doc_id", "at", F.posexplode(F.split("text", "\n", -1)).alias("line", "content")).where(F.array_contains("at", F.col("line")))
    return lines.select("doc_id", F.col("line").cast("long").alias("line"), "content").join(places, ["doc_id", "line"])


def _n_lines():
    """Lines of ``text``."""
    return F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"))) + 1


def similar_lines(width: int, percent: int):
    """Column function of two lines: whether their sets reach the similarity."""
    @F.pandas_udf("boolean")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        out = []
        for k in range(0, len(x), 512):
            a, b = Lines(x.iloc[k:k + 512].tolist(), width), Lines(y.iloc[k:k + 512].tolist(), width)
            n, m = np.zeros(min(512, len(x) - k), np.int64), np.zeros(min(512, len(x) - k), np.int64)
            n[a.row], m[b.row] = a.n, b.n
            own_a, own_b = (v.token ^ (v.row[v.owner].astype(np.uint64) * _MUL) for v in (a, b))
            both = np.bincount(a.row[a.owner][np.isin(own_a, own_b)], minlength=len(n))
            out.append(100 * both >= percent * (n + m - both))
        return pd.Series(np.concatenate(out) if out else np.zeros(0, bool))

    return run


def later_matches(docs: DataFrame, sets: DataFrame, ranks: np.ndarray, tokens: int, width: int, percent: int) -> DataFrame:
    """(s1, s2) of the sets that match an earlier one.  ``sets``: s1, s2, doc_id, line of each first occurrence."""
    records = tokens * (100 - percent) // 100 + tokens // 16  # about the prefixes' share, and one more per line
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-records // RECORDS_PER_TASK))
    shared = checkpoint(shared_prefixes(prefixes(docs, ranks, width, percent, parts), parts))
    wanted = shared.select("s1").distinct()
    bit = bit_number(F.col("s1"))
    # sorted by place, so that the order of the ids is that of first occurrences
    where = checkpoint(sets.where(possible(shared, bit)(bit)).join(wanted, "s1", "left_semi")
                       .orderBy("doc_id", "line").withColumn("id", F.monotonically_increasing_id()))
    member = checkpoint(shared.join(where.select("s1", "id"), "s1").select("token", "id", "n", "pos"))

    def similar(pairs: DataFrame) -> DataFrame:
        """Later sets of the pairs (x, y) that verify.  Only the lines of pairs are taken from the documents."""
        pairs = checkpoint(pairs.distinct())
        paired = pairs.select(F.col("x").alias("id")).union(pairs.select("y")).distinct()
        places = checkpoint(where.join(paired, "id", "left_semi").select("doc_id", "line", "id"))
        content = checkpoint(lines_at(docs, places).select("id", "content"))
        x, y = (content.select(F.col("id").alias(c), F.col("content").alias(f"{c}_line")) for c in "xy")
        return pairs.join(x, "x").join(y, "y").where(similar_lines(width, percent)("x_line", "y_line")).select("x").distinct()

    first = member.groupBy("token").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("sets"))
    member = checkpoint(member.join(first, "token"))
    x, y = (member.select("token", "first", "sets", F.col("id").alias(c), F.col("n").alias(f"{c}n"), F.col("pos").alias(f"{c}p")) for c in "xy")
    overlap = F.ceil(percent * (F.col("xn") + F.col("yn")) / F.lit(100 + percent))
    fits = ((F.col("y") < F.col("x")) & (100 * F.least("xn", "yn") >= percent * F.greatest("xn", "yn"))
            & (F.least(F.col("xn") - F.col("xp"), F.col("yn") - F.col("yp")) >= overlap))
    near = x.where("x > first").drop("first", "sets").join(y.where("y = first").drop("first", "sets"), "token").where(fits).select("x", "y")
    matched = checkpoint(similar(near))
    # what is left did not match the earliest set of any of its tokens: only pairs of other sets are new
    x, y = x.where("sets > 2 and x > first").drop("first", "sets"), y.where("sets > 2 and y > first").drop("first", "sets")
    rest = x.join(matched, "x", "left_anti").join(y, "token").where(fits).select("x", "y")
    later = matched.union(similar(rest)).withColumnRenamed("x", "id")
    return checkpoint(where.join(later, "id").select("s1", "s2"))


def removed_lines(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, min_words: int = 1) -> DataFrame:
    """(doc_id, lines): the sorted numbers of the lines that an earlier line matches, for documents that have any."""
    if min_words < 1:
        raise ValueError("a line needs one word at least: min_words >= 1")
    known = docs.where("doc_id is not null")
    found = checkpoint(line_sets(known, width, min_words))
    ranks, tokens = rarity_ranks(found)
    lines = found.where("bins is null").drop("bins")
    if min_words > width:
        lines = lines.where(F.col("n") >= min_words - width + 1)
    sets = checkpoint(lines.groupBy("s1", "s2").agg(F.min(F.struct("doc_id", "line")).alias("at"), F.count(F.lit(1)).alias("copies"))
                      .select("s1", "s2", "copies", "at.doc_id", "at.line"))
    later = later_matches(known, sets.drop("copies"), ranks, tokens, width, percent).withColumn("goes", F.lit(True))
    repeated = sets.where("copies > 1").select("s1", "s2", F.col("doc_id").alias("d"), F.col("line").alias("l"))
    concerned = checkpoint(repeated.join(later, ["s1", "s2"], "full_outer"))  # sets that lose some line; most sets lose none
    bit = bit_number(F.col("s1"))
    gone = (lines.where(possible(concerned, bit)(bit)).join(concerned, ["s1", "s2"])
            .where("goes or doc_id <> d or line <> l").select("doc_id", "line").distinct())
    return checkpoint(gone.groupBy("doc_id").agg(F.sort_array(F.collect_list("line")).alias("lines")))


def line_report(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, min_words: int = 1) -> DataFrame:
    """doc_id, n_lines, n_removed and removed_lines (numbers from 0, comma-joined) of every document."""
    gone = removed_lines(docs, width, percent, min_words)
    return (docs.select("doc_id", F.coalesce(_n_lines(), F.lit(0)).cast("long").alias("n_lines")).join(gone, "doc_id", "left")
            .select("doc_id", "n_lines", F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines")).cast("long").alias("n_removed"),
                    F.coalesce(F.array_join("lines", ","), F.lit("")).alias("removed_lines")))


def _without(text: pd.Series, lines: pd.Series) -> pd.Series:
    out = []
    for t, gone in zip(text, lines):
        if isinstance(t, str) and gone is not None and len(gone):
            drop = set(int(x) for x in gone)
            t = "\n".join(line for k, line in enumerate(t.split("\n")) if k not in drop)
        out.append(t)
    return pd.Series(out, dtype=object)


def dedup_lines(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, min_words: int = 1) -> DataFrame:
    """``docs`` without the removed lines; documents that lose their last word go.  Columns as they are.

    Only documents that may lose a line (by a bitmap) meet the list in a shuffle.
    """
    gone = removed_lines(docs, width, percent, min_words)
    lines = "_lines"
    while lines in docs.columns:
        lines += "_"
    same, some = split_by_ids(docs, gone)
    some = some.join(gone.withColumnRenamed("lines", lines), "doc_id", "left")
    # not deterministic for the same reason as in lines_at
    without = F.pandas_udf(_without, "string").asNondeterministic()
    cut = some.withColumn("text", F.when(F.col(lines).isNull(), F.col("text")).otherwise(without("text", lines)))
    cut = cut.where(F.col(lines).isNull() | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(F.col(lines).isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast(docs.schema["n_chars"].dataType)))
    names = [F.col(f"`{c}`") for c in docs.columns]
    return same.select(names).union(cut.select(names))
