import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from llm_cases import corpus, docs_of, words
from manifestqc.llm import packing
from manifestqc.llm.tokens import PieceIds, load, tokenizer_path

END = packing.END_ID


def ids_of(text):
    return load(tokenizer_path()).encode(text or "", add_special_tokens=False).ids + [END]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


HOSTILE = ["", "  a  b", "It's 'S don't <|endoftext|> x<|startoftext|>y \x01 z\x01", "ËÅÉ café́ İstanbul ΣΑΣ ς Kelvin K 12,5% a...",
           " x y\tq\r\nz\x1cw", "日本語テキスト 한국어 हिन्दी 🎉🎉", "ǅ ﬁ ß ẞ 'll I'LL,! we've|", "ab\x00c </w> <| |> word<|", "...,!? ***### )) \"quoted.\""]


@pytest.mark.parametrize("bound", [packing.CAPACITY * 1000, 3])
def test_piece_cache_equals_the_tokenizer(monkeypatch, bound):
    from manifestqc.llm import tokens
    monkeypatch.setattr(tokens, "CACHED_LETTERS", bound)
    monkeypatch.setattr(tokens, "CACHED_PIECES", bound)
    r = random.Random(1)
    alphabet = list("aébcdÉ.,!|*'’ \n\t\x01<") + ["<|endoftext|>", "'s", "ß", "Σ", "İ", "ﬁ", "日", "9"]
    texts = HOSTILE + ["".join(r.choices(alphabet, k=r.randint(0, 40))) for _ in range(400)]
    got = PieceIds(tokenizer_path(), END)
    for i in range(0, len(texts), 50):
        part = texts[i:i + 50]
        assert got.encode(part) == [np.array(ids_of(t), "<u4").tobytes() for t in part]


def check(packed, rows, capacity=packing.CAPACITY):
    pieces = defaultdict(list)
    sequences = defaultdict(list)
    for r in packed:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for i, text in rows:
        ids = ids_of(text)
        at = 0
        for p in sorted(pieces[i], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids) and p.ids_crc32 == crc(ids[at:at + p.length])
            at += p.length
        assert at == len(ids)
    for s, parts in sequences.items():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at and p.sequence_tokens == sum(q.length for q in parts)
            at += p.length
        assert 0 < at <= capacity
        assert {p.padded_to for p in parts} == {at if at & (at - 1) == 0 else capacity}
    assert sorted(sequences) == list(range(len(sequences)))
    return sequences


def test_every_id_in_one_piece_and_little_padding(docs_of):
    rows = corpus() + [(1000 + i, t) for i, t in enumerate(HOSTILE)] + [(2000, None)]
    sequences = check(packing.pack_documents(docs_of(rows)).collect(), rows)
    total = sum(len(ids_of(t)) for _, t in rows)
    assert len(sequences) <= total / packing.CAPACITY * 1.2 + 1


def test_small_capacity_fills_well(docs_of):
    r = random.Random(4)
    rows = [(i, " ".join(words(r, r.randint(1, 25)))) for i in range(600)]
    sequences = check(packing.pack_documents(docs_of(rows), capacity=128).collect(), rows, 128)
    assert sum(len(ids_of(t)) for _, t in rows) / (len(sequences) * 128) > 0.97


def test_histogram_patterns():
    for seed in range(30):
        r = random.Random(seed)
        counts = {r.randint(1, 100): r.randint(1, 500) for _ in range(r.randint(0, 40))}
        patterns = packing.pack_histogram(counts, 100)
        placed = defaultdict(int)
        for n, lengths in patterns:
            assert sum(lengths) <= 100 and n > 0 and list(lengths) == sorted(lengths, reverse=True)
            for x in lengths:
                placed[x] += n
        assert placed == counts
        ranks = defaultdict(list)
        for length, lo, hi, *_ in packing.placements(patterns):
            ranks[length].append((lo, hi))
        for length, runs in ranks.items():
            runs.sort()
            assert runs[0][0] == 0 and runs[-1][1] == counts[length] and all(a[1] == b[0] for a, b in zip(runs, runs[1:]))


def test_repeats_nulls_and_empty(spark, docs_of):
    rows = [(1, "same text here")] * 3 + [(None, "x y"), (2, None)]
    df = spark.createDataFrame([(i, t, 7, "q") for i, t in rows], "doc_id long, text string, start int, sequence_id string")
    got = packing.pack_documents(df).collect()
    assert len(got) == 5 and len({(r.sequence_id, r.offset) for r in got}) == 5
    assert sum(r.doc_id is None for r in got) == 1
    assert packing.pack_documents(docs_of([])).count() == 0


def test_sequences_hold_the_ids(docs_of):
    rows = corpus(3, 30)
    df = docs_of(rows)
    packed = packing.pack_documents(df)
    texts = dict(rows)
    where = {(r.sequence_id, r.offset): r for r in packed.collect()}
    for s in packing.sequences(df, packed).collect():
        for i, offset, raw in zip(s.doc_ids, s.offsets, s.ids):
            p = where[s.sequence_id, offset]
            assert list(np.frombuffer(raw, "<u4")) == ids_of(texts[i])[p.start:p.start + p.length]


def test_marks_behind_every_latin_letter():
    """A mark is a piece of its own behind a letter or digit only, and İ does not end in one."""
    latin = [chr(i) for i in [*range(0x30, 0x7F), *range(0xA0, 0x260)]]
    texts = [" ".join(f"ab{c}{m} {c}{m} {c}" for c in latin) for m in (".", "...", "?!\"", "." * 9, "." * 40, "'.")]
    texts += [" ".join("x" * n + m for n in range(60) for m in ("", ",")), "\x00a a \x00 a\x00. a\x00\x00", "é" * 12 + ". " + "é" * 13 + "."]
    got = PieceIds(tokenizer_path(), END)
    for _ in range(2):
        assert got.encode(texts) == [np.array(ids_of(t), "<u4").tobytes() for t in texts]


def test_pieces_of_one_key_stay_apart(monkeypatch):
    from manifestqc.llm import tokens
    monkeypatch.setattr(tokens, "mix", lambda h: np.zeros_like(h))  # keys of equal length are equal
    texts = ["the cat sat on the mat", "a dog ate the pie, and the fox", "", "cat the dog"]
    got = PieceIds(tokenizer_path(), END)
    for part in (texts[:1], texts[1:], texts):
        assert got.encode(part) == [np.array(ids_of(t), "<u4").tobytes() for t in part]


def test_a_known_word_takes_few_bytes():
    """What a worker keeps of 60,000 words: the dicts of before took about 200 bytes a word."""
    import tracemalloc
    text = " ".join("".join(chr(97 + k // 26 ** i % 26) for i in range(4)) + "ing" for k in range(60_000))
    ids = PieceIds(tokenizer_path(), END)
    ids.encode(["warm up"])
    tracemalloc.start()
    ids.encode([text])
    kept = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert kept < 100 * 60_000
