"""Token ids of whole texts from a public tokenizer file, with a per-worker cache of words.

The tokenizer (word_bpe_49k.json) never merges across a space or a line break,
so the ids of a text are the concatenated ids of its pieces between these.  The
marks behind a letter or digit are a piece of their own, as the tokenizer parts
them too.  Pieces are found, told apart and looked up as arrays, a slice of texts at
a time: the cache holds the very bytes of each piece beside its ids, so a hash only
finds a piece and never stands for it.  Unknown pieces are encoded many to a call.
Words are told apart by the ids that end a word, other pieces by a
control character that has one id of its own; pieces that hold this character or
a special token are encoded alone.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np

from manifestqc.llm.common import RELEASE, mix

TOKENIZER = "word_bpe_49k.json"
CACHED_LETTERS = 600_000
CACHED_PIECES = 50_000
APART = "\x01"
LATIN_END = "\u0250"
MARKS = ".,;:!?|%$&*#)\""
#: Marks behind a word that are looked at; a piece that ends in more of them stays whole.
MOST_MARKS = 8
#: Longest piece of the array cache, in bytes (three times eight); longer ones are kept in a dict.
LONGEST = 24
_MUL = np.uint64(0x9E3779B97F4A7C15)
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)  # masks of the first bytes of eight
_BREAK, _MARK, _ALNUM = (np.zeros(256, bool) for _ in range(3))
_BREAK[[10, 32]] = True
_MARK[list(MARKS.encode())] = True
_ALNUM[list(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def load(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def _gathered(ids: np.ndarray, at: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The stretches ids[at:at + count], one after the other."""
    before = np.cumsum(count) - count
    return ids[np.repeat(at - before, count) + np.arange(int(count.sum()))]


def _starts_and_sizes(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and size of each piece: what stands between breaks, the marks behind a letter or digit apart."""
    inside = np.zeros(len(b) + 2, np.int8)
    inside[1:-1] = ~_BREAK[b]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    marks = np.zeros(len(starts), np.int64)
    some = np.flatnonzero(_MARK[b[ends - 1]])
    while len(some):
        marks[some] += 1
        some = some[ends[some] - starts[some] > marks[some]]
        some = some[_MARK[b[ends[some] - 1 - marks[some]]] & (marks[some] <= MOST_MARKS)]
    last = ends - 1 - marks  # of the part before the marks
    letter = _ALNUM[b[last]] & (last >= starts)
    wide = np.flatnonzero((marks > 0) & (last > starts) & (b[last] >= 0x80))  # two bytes: Latin letters up to U+024F
    one, two = b[last[wide] - 1], b[last[wide]]
    letter[wide] = ((one == 0xC3) & (two != 0x97) & (two != 0xB7)) | ((one >= 0xC4) & (one <= 0xC8)) | ((one == 0xC9) & (two <= 0x8F))
    letter[wide[(one == 0xC4) & (two == 0xB0)]] = False  # in lower case it ends in a dot above, which is no letter
    marks[~letter | (marks > MOST_MARKS)] = 0
    parts = 1 + (marks > 0)
    tail = (np.cumsum(parts) - 1)[marks > 0]
    size = np.repeat(ends - starts - marks, parts)
    at = np.repeat(starts, parts)
    at[tail], size[tail] = (ends - marks)[marks > 0], marks[marks > 0]
    return at, size


class Known:
    """Pieces of up to LONGEST bytes and their ids: keys in order, each with the row that holds the piece."""

    COLUMNS = {"one": np.uint64, "two": np.uint64, "three": np.uint64, "size": np.uint8, "at": np.int64, "count": np.int32, "seen": np.int32}

    def __init__(self):
        self.key, self.row, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, "<u4")
        self.columns = {c: np.zeros(0, t) for c, t in self.COLUMNS.items()}
        self.slices = 0

    def find(self, key: np.ndarray, piece: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(row, whether the key is here) of each of the ordered keys; row -1 where the piece is unknown, or another one has its key."""
        self.slices += 1
        place = np.searchsorted(self.key, key)
        here = np.zeros(len(key), bool)
        inside = np.flatnonzero(place < len(self.key))
        here[inside] = self.key[place[inside]] == key[inside]
        row = np.full(len(key), -1, np.int64)
        row[here] = self.row[place[here]]
        for c, v in piece.items():
            same = self.columns[c][row[here]] == v[here]
            if not same.all():
                row[np.flatnonzero(here)[~same]] = -1
        self.columns["seen"][row[row >= 0]] = self.slices
        return row, here

    def add(self, key: np.ndarray, piece: dict[str, np.ndarray], ids: np.ndarray, count: np.ndarray) -> None:
        """Adds pieces whose keys (ordered) are not here."""
        place = np.searchsorted(self.key, key)
        self.row = np.insert(self.row, place, np.arange(len(self.row), len(self.row) + len(key), dtype=np.int32))
        self.key = np.insert(self.key, place, key)
        new = {**piece, "at": len(self.ids) + np.cumsum(count) - count, "count": count, "seen": np.full(len(key), self.slices)}
        for c, t in self.COLUMNS.items():
            self.columns[c] = np.concatenate([self.columns[c], new[c].astype(t)])
        self.ids = np.concatenate([self.ids, ids])

    def shrink(self) -> None:
        """Keeps the pieces met last, half of them at most."""
        seen = self.columns["seen"]
        kept = seen > np.partition(seen, len(seen) // 2)[len(seen) // 2]
        at, count = self.columns["at"][kept], self.columns["count"][kept].astype(np.int64)
        self.ids = _gathered(self.ids, at, count)
        number = (np.cumsum(kept) - 1).astype(np.int32)
        self.columns = {c: v[kept] for c, v in self.columns.items()}
        self.columns["at"] = np.cumsum(count) - count
        still = kept[self.row]
        self.key, self.row = self.key[still], number[self.row[still]]


class PieceIds:
    """ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, end_id: int | None = None):
        self.tokenizer = load(path)
        self.known = Known()
        self.whole: dict[bytes, np.ndarray] = {}  # longer pieces
        self.end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
        apart = self.tokenizer.encode(APART, add_special_tokens=False).ids
        if len(apart) != 1:
            raise ValueError("the separator must be one id of its own")
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.is_apart, self.ends_word = np.zeros(size, bool), np.zeros(size, bool)
        self.is_apart[apart[0]] = True
        self.ends_word[[i for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items() if token.endswith("</w>")]] = True

    def forget(self) -> None:
        self.known = Known()
        self.whole.clear()

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _encode(self, pieces: list[str], between: str, is_last: np.ndarray, drop: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of all pieces and how many each has, many pieces to a call; ``is_last`` marks the ids that end a piece, ``drop`` says
        how many of these belong to no piece."""
        found, counts = [], []
        for i in range(0, len(pieces), 1000):
            part = pieces[i:i + 1000]
            ids = self._ids(between.join(part) + between)
            cuts = np.flatnonzero(is_last[ids]) + 1
            if len(cuts) == len(part):
                found.append(ids[~is_last[ids]] if drop else ids)
                counts.append(np.diff(cuts, prepend=0) - drop)
            else:
                alone = [self._ids(p) for p in part]
                found += alone
                counts.append(np.array([len(x) for x in alone], np.int64))
        return found, counts

    def _learn(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, one after the other, and how many each has."""
        kinds: list[list[int]] = [[], [], []]
        for k, p in enumerate(pieces):  # beyond Latin letters lower() may differ from the tokenizer's own
            if p.isalpha() and (p.isascii() or (max(p) < LATIN_END and p.lower().isalpha())):
                kinds[0].append(k)
            else:
                kinds[2 if APART in p or "<|" in p else 1].append(k)
        words, other, alone = ([pieces[k] for k in kind] for kind in kinds)
        found, counts = self._encode(words, " ", self.ends_word, 0)
        more = self._encode(other, f" {APART} ", self.is_apart, 1)
        single = [self._ids(p) for p in alone]
        ids = np.concatenate([np.zeros(0, "<u4"), *found, *more[0], *single])
        count = np.concatenate([np.zeros(0, np.int64), *counts, *more[1], np.array([len(x) for x in single], np.int64)])
        back = np.argsort(np.array(kinds[0] + kinds[1] + kinds[2], np.int64))
        at = (np.cumsum(count) - count)[back]
        return _gathered(ids, at, count[back]), count[back]

    def _long(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of pieces that the array cache does not take."""
        new = list(set(pieces).difference(self.whole))
        if new:
            ids, count = self._learn([p.decode() for p in new])
            self.whole.update(zip(new, np.split(ids, np.cumsum(count)[:-1])))
        return [self.whole[p] for p in pieces]

    def encode(self, texts: list[str]) -> list[bytes]:
        if not RELEASE:
            RELEASE.append(self.forget)
        if len(self.known.key) > CACHED_LETTERS:
            self.known.shrink()
        if len(self.whole) > CACHED_PIECES:
            self.whole.clear()
        parts = [_lowered(t).encode() for t in texts]
        raw = b" ".join(parts)
        b = np.frombuffer(raw, np.uint8)
        start, size = _starts_and_sizes(b)
        head = np.cumsum([0] + [len(p) + 1 for p in parts])
        del parts
        eight = np.ndarray(len(raw), "<u8", raw + bytes(8), strides=(1,))  # the eight bytes from each place on
        lanes = [eight[start] & _FIRST[np.minimum(size, 8)], np.zeros(len(start), np.uint64), np.zeros(len(start), np.uint64)]
        key = mix(lanes[0]) + size.astype(np.uint64)
        for k in (1, 2):
            more = np.flatnonzero(size > 8 * k)
            lanes[k][more] = eight[start[more] + 8 * k] & _FIRST[np.minimum(size[more] - 8 * k, 8)]
            key[more] = mix(key[more] * _MUL + lanes[k][more])
        # every distinct piece once, by key
        distinct, first, number = np.unique(key, return_index=True, return_inverse=True)
        piece = {"one": lanes[0][first], "two": lanes[1][first], "three": lanes[2][first], "size": size[first]}
        apart = size > LONGEST
        for lane, v in zip(lanes, piece.values()):
            apart |= lane != v[number]
        apart |= size != piece["size"][number]
        del lanes, key
        row, here = self.known.find(distinct, piece)
        row[apart[first]] = -2
        other = apart | ((row == -1) & here)[number]  # too long, or another piece has the key
        new = np.flatnonzero((row == -1) & ~here)
        if len(new):
            at, end = start[first[new]], (start + size)[first[new]]
            ids, count = self._learn([raw[i:z].decode() for i, z in zip(at.tolist(), end.tolist())])
            self.known.add(distinct[new], {c: v[new] for c, v in piece.items()}, ids, count)
            row[new] = np.arange(len(self.known.row) - len(new), len(self.known.row))
        # ids of the distinct pieces, then of the others, then of all pieces of the texts
        row = np.maximum(row, 0)
        if len(self.known.row):
            at, count = self.known.columns["at"][row], self.known.columns["count"][row].astype(np.int64)
        else:
            at, count = np.zeros(len(row), np.int64), np.zeros(len(row), np.int64)
        ids = _gathered(self.known.ids, at, count)
        others = np.flatnonzero(other)
        if len(others):
            found = self._long([raw[i:z] for i, z in zip(start[others].tolist(), (start + size)[others].tolist())])
            number[others] = len(count) + np.arange(len(others))
            count = np.concatenate([count, np.array([len(x) for x in found], np.int64)])
            ids = np.concatenate([ids, *found])
        at, count = (np.cumsum(count) - count)[number], count[number]
        out = _gathered(ids, at, count)
        ends = np.concatenate([[0], np.cumsum(count)])[np.searchsorted(start, head)].tolist()
        return [out[i:z].tobytes() + self.end for i, z in zip(ends, ends[1:])]


def _lowered(text: str) -> str:
    """Latin text in lower case, which is all that the tokenizer sees of it; other text as it is."""
    if not text.isascii():
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text
    return text if "<|" in text else text.lower()


@lru_cache(maxsize=2)
def piece_ids(path: str, end_id: int | None = None) -> PieceIds:
    """One cache per Python worker."""
    return PieceIds(path, end_id)
