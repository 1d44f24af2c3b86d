from collections import defaultdict

import numpy as np
import pytest

from llm_cases import corpus, docs_of
from manifestqc.llm import line_dedup


def brute_force(rows, width=5, percent=80, min_words=1):
    seen, gone = [], defaultdict(list)
    for i, text in sorted((r for r in rows if r[0] is not None and r[1] is not None), key=lambda r: r[0]):
        for k, line in enumerate(text.split("\n")):
            w = line.encode().lower().split()
            if len(w) < min_words or not w:
                continue
            s = {tuple(w[j:j + width]) for j in range(max(1, len(w) - width + 1))}
            if any(100 * len(s & t) >= percent * len(s | t) for t in seen):
                gone[i].append(k)
            seen.append(s)
    return dict(gone)


@pytest.mark.parametrize("seed,min_words", [(1, 1), (2, 1), (1, 5), (2, 3)])
def test_matches_brute_force(docs_of, seed, min_words):
    rows = corpus(seed, 80)
    want = brute_force(rows, min_words=min_words)
    got = {r.doc_id: r for r in line_dedup.line_report(docs_of(rows), min_words=min_words).collect()}
    assert len(got) == len(rows) and want
    for i, text in rows:
        assert got[i].removed_lines == ",".join(map(str, want.get(i, []))), i
        assert (got[i].n_removed, got[i].n_lines) == (len(want.get(i, [])), len(text.split("\n")))


def test_group_of_variants_and_repeated_tokens(docs_of):
    base = [f"t{k}" for k in range(60)]
    lines = []
    for i in range(40):
        w = list(base)
        w[i] = f"v{i}"
        lines.append(" ".join(w))
    lines += ["a b c d e a b c d e a b c d e", "b c d e a b c d e a", "a a a a a a a a"]
    rows = [(i, line) for i, line in enumerate(lines)]
    want = brute_force(rows)
    got = {r.doc_id: [int(x) for x in r.removed_lines.split(",")] for r in line_dedup.line_report(docs_of(rows)).collect() if r.n_removed}
    assert got == want


def test_dedup_lines_texts_and_columns(spark):
    line = "this line has more than five words in it"
    rows = [(1, f"{line}\nfirst own line with some more words", 9), (2, f"{line.upper()}\n\nSecond, with its own line of words", 9), (3, line, 9),
            (4, None, None), (5, "", 0), (None, line, 1), (6, "the\nthe\nthe", 11)]
    df = spark.createDataFrame([(i, t, n, "l", "b") for i, t, n in rows], "doc_id long, text string, n_chars long, lines string, bins string")
    got = {r.doc_id: r for r in line_dedup.dedup_lines(df).collect()}
    assert line_dedup.dedup_lines(df).columns == df.columns
    assert set(got) == {1, 2, 4, 5, None, 6}  # 3 lost its last word
    assert got[2].text == "\nSecond, with its own line of words" and got[2].n_chars == len(got[2].text)
    assert got[1].text == rows[0][1] and got[1].n_chars == 9
    assert got[6].text == "the" and got[None].text == line
    assert {r.doc_id: r.text for r in line_dedup.dedup_lines(df, min_words=5).collect()}[6] == "the\nthe\nthe"


def test_empty_table_and_no_lines(docs_of):
    assert line_dedup.line_report(docs_of([])).count() == 0
    assert line_dedup.dedup_lines(docs_of([(1, None), (2, "")])).count() == 2


def test_prefix_order_is_a_bijection():
    ranks = np.random.default_rng(0).permutation(line_dedup.BINS).astype(np.uint64)
    token = np.random.default_rng(1).integers(0, 2**63, 1000, np.uint64)
    moved = (ranks[(token >> np.uint64(48)).astype(int)] << np.uint64(48)) | (token & np.uint64((1 << 48) - 1))
    assert len(set(moved.tolist())) == len(set(token.tolist()))


def test_short_lines_as_one_token(docs_of):
    rows = corpus(3, 60) + [(100, "Home\nAbout us\n\n \nfig. 1 of\na b c d"), (101, "about  US\na b c d e\nd c b a\n\nhome"), (102, "HOME"), (103, "a a\na\na a a\na b c d")]
    want, seen = brute_force(rows, min_words=5), set()
    for i, text in rows:
        for k, line in enumerate(text.split("\n")):
            w = tuple(line.encode().lower().split())
            if 0 < len(w) < 5:
                if w in seen:
                    want.setdefault(i, []).append(k)
                seen.add(w)
    assert want[101] == [0, 4] and want[102] == [0] and want[103] == [3] and 100 not in want
    got = {r.doc_id: [int(x) for x in r.removed_lines.split(",")] for r in line_dedup.line_report(docs_of(rows)).collect() if r.n_removed}
    assert got == {i: sorted(v) for i, v in want.items()}
    kept = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs_of(rows)).collect()}
    assert kept[101] == "a b c d e\nd c b a\n" and 102 not in kept and kept[100] == rows[-4][1]


def test_pipeline_stage_removes_short_lines(spark, docs_of):
    import corpus_pipeline
    stage = dict(corpus_pipeline.STAGES)["line_dedup"]
    kept = {r.doc_id: r.text for r in stage(spark, docs_of([(1, "Home\nfirst text"), (2, "home\nsecond text")]), "").collect()}
    assert kept == {1: "Home\nfirst text", 2: "second text"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_python_step_a_task(spark, docs_of):
    """Every step in a row takes a worker of its own, and idle workers keep their memory."""
    docs = docs_of([(k, "a b c d e f g\nx y z w q") for k in range(3)])
    places = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 5, 2)], "doc_id long, line long, id long")
    found = line_dedup.lines_at(docs, places)
    assert _plan(found).count("ArrowEvalPython") == 1
    assert sorted((r.doc_id, r.line, r.content) for r in found.collect()) == [(1, 1, "x y z w q"), (2, 0, "a b c d e f g")]
    assert _plan(line_dedup.dedup_lines(docs)).count("ArrowEvalPython [_without") == 1


def test_only_lines_of_pairs_are_taken(docs_of, monkeypatch):
    """Every token of the second line is in another one too, but neither has the length that a similar set needs."""
    taken = []
    whole = line_dedup.lines_at
    monkeypatch.setattr(line_dedup, "lines_at", lambda docs, places: taken.append(places.count()) or whole(docs, places))
    words = [f"w{k}" for k in range(40)]
    rows = [(1, " ".join(words[:14])), (2, " ".join(words)), (3, " ".join(words[10:]))]
    assert [r.n_removed for r in line_dedup.line_report(docs_of(rows)).collect()] == [0, 0, 0]
    assert max(taken) == 0
    near = [(1, " ".join(words)), (2, " ".join(words) + " end")]
    assert {r.doc_id: r.n_removed for r in line_dedup.line_report(docs_of(near)).collect()} == {1: 0, 2: 1}
    assert max(taken) == 2


def test_records_come_back():
    rows = np.zeros(3, line_dedup.RECORD)
    rows["token"], rows["s1"], rows["n"], rows["pos"] = [-5, 7, 9], [1, -2, 3], [2**32 - 1, 5, 6], [0, 70_000, 2]
    assert (line_dedup.unpacked(line_dedup.packed([rows[c] for c in rows.dtype.names])) == rows).all()
    again = rows[[0, 1, 1, 2]]
    again["s1"][2] = 8
    assert sorted(line_dedup._met_again([again[:2], again[2:]])["s1"].tolist()) == [-2, 8]


def test_second_pass_takes_new_pairs_only(docs_of, monkeypatch):
    """A pair that did not verify with the earliest set of its tokens is not taken again; a match of a later set is still found."""
    taken = []
    whole = line_dedup.lines_at
    monkeypatch.setattr(line_dedup, "lines_at", lambda docs, places: taken.append(places.count()) or whole(docs, places))
    words = [f"w{k}" for k in range(40)]
    apart = [(1, " ".join(words)), (2, " ".join([*words[:20], "x", *words[21:]])), (3, " ".join([*words[:13], "x", "y", *words[15:]]))]
    for rows in (apart, apart[:2], [*apart, (4, " ".join([*words[:13], "x", "y", *words[15:38], "z", "q"]))]):
        want = {i: len(v) for i, v in brute_force(rows).items()}
        assert {r.doc_id: r.n_removed for r in line_dedup.line_report(docs_of(rows)).collect() if r.n_removed} == want
    near = [f"s{k}" for k in range(12)]
    del taken[:]
    rows = [(1, " ".join(near)), (2, " ".join([*near[:5], "b", *near[6:]]))]  # a token in common, too few for the similarity
    assert [r.n_removed for r in line_dedup.line_report(docs_of(rows)).collect()] == [0, 0]
    assert len(taken) == 2 and taken[1] == 0
