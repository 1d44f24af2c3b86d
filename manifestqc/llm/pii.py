"""Personal data: base patterns, and a semi-Markov conditional random field that adds spans.

The base patterns give emails, IP addresses, payment cards and phone numbers,
leftmost and non-overlapping per kind.  Beyond them, text around digits and
at-signs is cut into clusters of neighbouring tokens and these into atoms
(letters, digits, single marks).  Every run of at most ``MAX_ATOMS`` atoms that
could be an entity is a candidate segment, with features of the whole span per
kind: its shape, digit count, checksum, separators, and what stands before and
after it.  Dynamic programming over the atoms chooses boundaries and kinds
jointly; atoms outside a segment score zero.  The weights maximise the
conditional likelihood of the base spans (the weak labels) over a bounded sample:
for each kind the ``SAMPLE`` pieces of smallest hash that hold a base span of it, and
as many without any, so that a rare kind is learnt beside a frequent one.  A
cluster of up to ``PIECE`` characters is one piece; longer ones are cut outside base
spans, at a space where there is one, and all their pieces can be drawn.  Base spans over
``LONGEST`` characters are found by the patterns but not learnt from.  Features include no base pattern as such, so spans that look like the
labelled ones in most respects are found too; those that touch no base span are added.

Scoring takes time linear in the text: clusters are found by jumping from one
digit or at-sign to the next, candidates are bounded per atom, and the patterns
do not backtrack over long runs.

Defined results: null or empty text has no spans; offsets are code points, end
exclusive; equal starts cannot occur within a kind; repeated rows are each
handled; without a base span in any text nothing is added; an empty table gives no
rows; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from math import exp, log1p

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from manifestqc.llm.common import text_slices

KINDS = ("email", "ip", "card", "phone")
MAX_ATOMS = 24
MAX_DIGITS = 19
SAMPLE = 400
PIECE = 200
LONGEST = 2_000
EPOCHS, RATE, PULL = 8, 0.3, 1e-3
MARGIN = 2.0  # a segment has to beat leaving its atoms out by this much
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a run of digits matches from its start or not at all, so starts inside a run need no trial
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SEED = re.compile(r"[0-9@]")
_ATOM = re.compile(r"[0-9]+|[^\W\d_]+|\s+|.", re.S)
_NOT_DIGIT = re.compile(r"[^0-9]+")
_SPACE = " \t\n"
_BREAK = re.compile(r"[ \t\n]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Local parts are found backwards from each at-sign, never beyond the match before."""
    done = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > done and _LOCAL.match(text, start - 1):
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
            done = at = m.end()
        else:
            done = at = at + 1  # the at-sign ends any later local part


def small_number(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start."""
    out = [("email", a, z) for a, z in emails(text)] if "@" in text else []
    if _SEED.search(text):
        out += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(small_number, m.groups()))]
        for m in _CARD.finditer(text):
            digits = _NOT_DIGIT.sub("", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        if "+" in text:
            out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return out


def clusters(text: str) -> Iterator[tuple[int, int]]:
    """Runs of neighbouring tokens, one space or tab apart, that each hold a digit or an at-sign."""
    done, m = 0, _SEED.search(text)
    while m:
        start, end = max(done, *(text.rfind(c, done, m.start()) + 1 for c in _SPACE)), m.start()
        while True:
            end = _next_space(text, end, len(text))
            follow = _next_space(text, end + 1, min(len(text), end + 200))
            if end >= len(text) or text[end] == "\n" or not _SEED.search(text, end + 1, follow):
                break
            end += 1
        yield start, end
        done = end
        m = _SEED.search(text, end)


def _next_space(text: str, at: int, end: int) -> int:
    m = _BREAK.search(text, at, end)
    return m.start() if m else end


class Atoms:
    """Atoms of text[start:end] with prefix counts of digits and at-signs."""

    def __init__(self, text: str, start: int, end: int):
        self.text = text
        self.bounds = [m.start() for m in _ATOM.finditer(text, start, end)] + [end]
        self.digits, self.ats = [0], [0]
        for a, z in zip(self.bounds, self.bounds[1:]):
            self.digits.append(self.digits[-1] + (z - a if "0" <= text[a] <= "9" else 0))
            self.ats.append(self.ats[-1] + (text[a] == "@"))

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def candidates(self) -> Iterator[tuple[int, int]]:
        """(i, j) of atom runs that may be entities: one at-sign, or 4 to 19 digits; letters, digits, + or ( first, letters or digits last."""
        first = [self.text[a].isalnum() or self.text[a] in "+(" for a in self.bounds[:-1]]
        last = [self.text[z - 1].isalnum() for z in self.bounds[1:]]
        for i in range(len(self)):
            if first[i]:
                for j in range(i + 1, min(i + MAX_ATOMS, len(self)) + 1):
                    digits, ats = self.digits[j] - self.digits[i], self.ats[j] - self.ats[i]
                    if digits > MAX_DIGITS or ats > 1:
                        break
                    if last[j - 1] and (ats or digits >= 4):
                        yield i, j

    def span(self, i: int, j: int) -> tuple[int, int]:
        return self.bounds[i], self.bounds[j]


def beside(text: str, at: int) -> str:
    """Class of the character at a place."""
    if not 0 <= at < len(text):
        return "edge"
    c = text[at]
    return "9" if c.isdigit() else "a" if c.isalpha() else "_" if c.isspace() else c if c in "+@.-()/:" else "!"


def features(text: str, start: int, end: int) -> list[str]:
    """Features of a whole span."""
    span = text[start:end]
    digits = _NOT_DIGIT.sub("", span)
    groups = [len(g) for g in _NOT_DIGIT.split(span) if g]
    local, at, domain = span.partition("@")
    marks = "".join(sorted({c for c in span if not c.isalnum()}))
    shape = "@" if at else re.sub(r"[0-9]+", "9", re.sub(r"[^\W\d_]+", "a", span))[:24]
    out = ["always", f"digits {len(digits)}", f"groups {len(groups)}", f"marks {marks[:8]}", f"before {beside(text, start - 1)}", f"after {beside(text, end)}",
           f"inside-left {beside(text, start)}", f"shape {shape}", f"letters {any(c.isalpha() for c in span)}", f"widest {max(groups, default=0)}"]
    if at:
        out += [f"labels {min(domain.count('.'), 3)}", f"local {bool(local)}", f"domain-end {domain[-1:].isalpha()}", f"spaces {any(c.isspace() for c in span)}"]
    else:
        out += [f"luhn {luhn(digits) if len(digits) > 11 else None}", f"small {all(small_number(g) for g in _NOT_DIGIT.split(span) if g)} {len(groups)}"]
    return out


class Model:
    """Weights of (kind, feature)."""

    def __init__(self):
        self.weights: dict[tuple[str, str], float] = {}

    def segments(self, text: str, start: int, end: int) -> list[tuple[str, int, int]]:
        """Best joint choice of boundaries and kinds in one cluster."""
        atoms = Atoms(text, start, end)
        ending: dict[int, list[tuple[int, str, float]]] = {}
        for i, j in atoms.candidates():
            found = features(text, *atoms.span(i, j))
            for kind in KINDS:
                s = sum(self.weights.get((kind, f), 0.0) for f in found) - MARGIN
                if s > 0:
                    ending.setdefault(j, []).append((i, kind, s))
        best: list[float] = [0.0]
        back: list[tuple[int, str] | None] = [None]
        for j in range(1, len(atoms) + 1):
            score, how = best[j - 1], None
            for i, kind, s in ending.get(j, ()):
                if best[i] + s > score:
                    score, how = best[i] + s, (i, kind)
            best.append(score)
            back.append(how)
        out, j = [], len(atoms)
        while j > 0:
            if back[j] is None:
                j -= 1
            else:
                i, kind = back[j]
                out.append((kind, *atoms.span(i, j)))
                j = i
        return out[::-1]


def _log_add(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a + log1p(exp(b - a)) if b > a - 40 else a


def train(samples: list[tuple], epochs: int = EPOCHS) -> Model:
    """Conditional maximum likelihood by AdaGrad.

    A sample is a piece of text, the bounds of its cluster and, where the piece
    is a part of one, the base spans in it; otherwise those of the piece are taken.
    """
    model = Model()
    number: dict[tuple[str, str], int] = {}
    lattices = []
    for text, start, end, *known in samples:
        atoms = Atoms(text, start, end)
        gold = {(a, z): kind for kind, a, z in reversed(known[0] if known else base_spans(text))}
        arcs = []
        for i, j in atoms.candidates():
            span = atoms.span(i, j)
            found = features(text, *span)
            for kind in KINDS:
                arcs.append((i, j, [number.setdefault((kind, f), len(number)) for f in found], gold.get(span) == kind))
        arcs.sort(key=lambda x: x[1])
        if arcs:
            lattices.append((len(atoms), arcs))
    weight, squares = [0.0] * len(number), [1e-6] * len(number)
    for _ in range(epochs):
        for n, arcs in lattices:
            scores = [sum([weight[f] for f in fs]) for _, _, fs, _ in arcs]
            forward, k = [0.0] * (n + 1), 0
            for j in range(1, n + 1):
                value = forward[j - 1]
                while k < len(arcs) and arcs[k][1] == j:
                    value = _log_add(value, forward[arcs[k][0]] + scores[k])
                    k += 1
                forward[j] = value
            backward, by_start = [0.0] * (n + 1), {}
            for k, (i, j, _, _) in enumerate(arcs):
                by_start.setdefault(i, []).append((j, scores[k]))
            for i in range(n - 1, -1, -1):
                value = backward[i + 1]
                for j, s in by_start.get(i, ()):
                    value = _log_add(value, s + backward[j])
                backward[i] = value
            for (i, j, fs, is_gold), s in zip(arcs, scores):
                gap = is_gold - exp(min(0.0, forward[i] + s + backward[j] - forward[n]))
                if abs(gap) > 1e-4:
                    for f in fs:
                        g = gap - PULL * weight[f]
                        squares[f] += g * g
                        weight[f] += RATE * g / squares[f] ** 0.5
    model.weights = {key: weight[i] for key, i in number.items() if weight[i]}
    return model


def pieces(text: str, start: int, end: int, base: list[tuple[str, int, int]], most: int = PIECE) -> Iterator[tuple[int, int]]:
    """A cluster in pieces of about ``most`` characters, none of which cuts a base span."""
    whole: list[list[int]] = []  # base spans of all kinds, overlapping ones as one
    for a, z in sorted((a, z) for _, a, z in base):
        if whole and a < whole[-1][1]:
            whole[-1][1] = max(whole[-1][1], z)
        else:
            whole.append([a, z])
    firsts = [a for a, _ in whole]
    while end - start > most:
        space = max(text.rfind(c, start + 1, start + most) for c in _SPACE)
        cut = space if space > 0 else start + most
        k = bisect_right(firsts, cut) - 1
        if k >= 0 and whole[k][0] < cut < whole[k][1]:
            cut = whole[k][1]
        yield start, min(cut, end)
        start = cut
    if start < end:
        yield start, end


def training_pieces(docs: DataFrame, sample: int = SAMPLE) -> list[tuple[str, int, int, list[tuple[str, int, int]]]]:
    """Per kind the ``sample`` pieces of smallest hash that hold a base span of it, and as many without one, each piece once."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, texts in text_slices(frames):
            rows = set()
            for text in texts:
                for start, end in clusters(text):
                    base = [(kind, start + a, start + z) for kind, a, z in base_spans(text[start:end])]
                    for a, z in pieces(text, start, end, base):
                        inside = [x for x in base if a <= x[1] and x[2] <= z] if base else []
                        if z - a <= LONGEST:
                            left = max(0, a - 1)
                            spans = joined([(kind, x - left, y - left) for kind, x, y in inside])
                            rows.update((kind, text[left:z + 1], a - left, z - left, spans) for kind in {kind for kind, _, _ in inside} or {"none"})
            yield pd.DataFrame(list(rows), columns=["kind", "piece", "a", "z", "spans"])

    found = docs.select("text").mapInPandas(run, "kind string, piece string, a int, z int, spans string").distinct()
    # a rank with a limit: every task passes on its first ``sample`` rows of each kind only
    order = Window.partitionBy("kind").orderBy(F.xxhash64("piece"), "piece", "a", "z", "spans")
    drawn = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= sample).drop("rank").collect()
    once = {(r["piece"], r["a"], r["z"], r["spans"]) for r in drawn}
    if not any(spans for *_, spans in once):
        return []
    ordered = sorted(once, key=lambda r: (hashlib.md5(r[0].encode("utf-8", "surrogatepass")).digest(), r))
    return [(piece, a, z, [(kind, int(x), int(y)) for kind, x, y in (s.split(":") for s in spans.split(",") if s)]) for piece, a, z, spans in ordered]


def added_spans(text: str, base: list[tuple[str, int, int]], model: Model) -> list[tuple[str, int, int]]:
    """Segments of the model that touch no base span."""
    if not model.weights:
        return []
    taken = sorted((a, z) for _, a, z in base)
    out, k = [], 0
    for start, end in clusters(text):
        for kind, a, z in model.segments(text, start, end):
            while k < len(taken) and taken[k][1] <= a:
                k += 1
            if all(x[0] >= z or x[1] <= a for x in taken[max(0, k - 4):k + 4]):
                out.append((kind, a, z))
    return out


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{a}:{z}" for kind, a, z in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1])))


FOUND = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def personal_data(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id and FOUND of every document; the counts and the digest are those of the base patterns."""
    held = docs.sparkSession.sparkContext.broadcast(train(training_pieces(docs, sample)))

    @F.pandas_udf(FOUND)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text in texts:
                text = text if isinstance(text, str) else ""
                base = base_spans(text)
                more = added_spans(text, base, held.value)
                counts = [sum(kind == k for kind, _, _ in base) for k in KINDS]
                rows.append((*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + more), len(more)))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in FOUND.split(", ")])

    return docs.select("doc_id", run(F.col("text")).alias("r")).select("doc_id", "r.*")
