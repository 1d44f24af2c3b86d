"""Records with quoted cells over separators, lines and splits, against a plain sequential reader."""

import random

import pytest
from conftest import rows

from manifestqc.sources import records as rec
from manifestqc.sources.manifest import read_manifest, write_manifest


def sequential(lines, sep="\t"):
    """The rule as it stands: try to close each open cell with the lines that follow; if that fails the line is a record of its own."""
    out, i = [], 0
    while i < len(lines):
        if lines[i] in ("", "\r"):
            i += 1
            continue
        end, text = i, lines[i].removesuffix("\r")
        while rec.line_map(text.rsplit("\n", 1)[-1], sep).opens if end == i else open_end:
            j = end + 1
            while j < len(lines) and rec.line_map(lines[j].removesuffix("\r"), sep).meets == rec.PASSES:
                j += 1
            if j == len(lines) or rec.line_map(lines[j].removesuffix("\r"), sep).meets == rec.BREAKS:
                break
            text = "\n".join([*lines[i:j], lines[j].removesuffix("\r")])
            open_end = rec.line_map(lines[j].removesuffix("\r"), sep).reopens
            end = j
        out.append(text)
        i = end + 1
    return out


@pytest.mark.parametrize("text,cells,broken", [
    ("a\tb", ["a", "b"], False), ('"a\tb"\tc', ["a\tb", "c"], False), ('a\t"5 inch\tHomo', ["a", '"5 inch', "Homo"], True), ('"a""b"', ['a"b'], False),
    ('"x"y\tz', ['"x"y', "z"], True), ('5" x\t', ['5" x', ""], False), ('""', [""], False), ('"a\nb"\t"c"', ["a\nb", "c"], False), ("", [""], False), ('"', ['"'], True),
    ('"""', ['"""'], True), ('""""', ['"'], False), ('\t"a"', ["", "a"], False)])
def test_cells(text, cells, broken):
    assert rec.cells_of(text) == (cells, broken)


def random_lines(r, n):
    cell = ['x', 'yy', '', '"q"', '"a\tb"', '"open', 'shut"', '"', '""', '"a""b"', '5" z', '"5 inch', 'mid"dle', '"x"y']
    return ["\t".join(r.choice(cell) for _ in range(r.randint(1, 4))) if r.random() < 0.5 else r.choice(["", "plain\tline", "\r", "other\r"]) for _ in range(n)]


def test_every_split_of_random_lines():
    """Splits mapped on their own and composed give what one pass gives (the prefix scan, in plain Python)."""
    import pyarrow as pa
    r = random.Random(5)
    for _ in range(400):
        lines = random_lines(r, r.randint(1, 14))
        cuts = sorted(r.sample(range(len(lines) + 1), r.randint(0, min(3, len(lines)))))
        parts = [lines[a:b] for a, b in zip([0, *cuts], [*cuts, len(lines)])]
        splits = [rec._Split(pa.chunked_array([pa.array(p, pa.string())]), "\t") for p in parts]
        got, state = [], False
        for k, (s, part) in enumerate(zip(splits, parts)):
            meets = [m for m in (x.first_meeting() for x in splits[k:]) if m]
            after = [m for m in (x.first_meeting() for x in splits[k + 1:]) if m]
            closes, valid = meets[:1] == [1], after[:1] == [1]
            end, n, waiting = s.summary(state)
            starts, more, _ = s.cut(state and closes, valid)
            assert starts.sum() == n + (waiting if end and not valid else 0)
            for line, a, b in zip(part, starts, more):
                if a:
                    got.append(line)
                elif b:
                    got[-1] += "\n" + line
            state = end
        assert [g.removesuffix("\r") for g in got] == sequential(lines), lines


def small_splits(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")


@pytest.fixture
def split_bytes(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    yield lambda size: small_splits(spark, size)
    spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
    spark.conf.set("spark.sql.files.openCostInBytes", old[1])


@pytest.mark.parametrize("seed,size", [(1, 40), (2, 200), (3, 10**6)])
def test_reader_over_splits(spark, tmp_path, split_bytes, seed, size):
    r = random.Random(seed)
    files = {}
    for name in ("a.txt", "b.txt", "c.txt"):
        lines = random_lines(r, 60) + ["\t".join(["long"] * 3), '"cell over', "", 'many\tlines"\tend', "last\tline"]
        r.shuffle(lines)
        files[name] = lines
        (tmp_path / name).write_bytes(("h1\th2\n" + "\n".join(lines) + "\n").encode())
    split_bytes(size)
    got = [tuple(x) for x in read_manifest(spark, str(tmp_path), open_quotes=True).orderBy("_row").collect()]
    texts = [t for name in sorted(files) for t in sequential(files[name])]
    want = []
    for i, t in enumerate(texts):
        cells, broken = rec.cells_of(t)
        want.append((*[(c or None) for c in (cells + ["", ""])[:2]], i, len(cells), broken))
    assert got == want


def test_the_unclosed_quote_stays_in_its_cell(spark, tmp_path):
    (tmp_path / "m.txt").write_text('sample_name\ttitle\thost\na\t"5 inch\tHomo\nb\t"x y"\tMus\nc\t"two\nlines"\t"t\tt"\n')
    got = read_manifest(spark, str(tmp_path / "m.txt"), open_quotes=True)
    assert rows(got, "sample_name", "title", "host", "_row", "_width", "_open_quote") == [
        ("a", '"5 inch', "Homo", 0, 3, True), ("b", "x y", "Mus", 1, 3, False), ("c", "two\nlines", "t\tt", 2, 3, False)]


def test_breaks_are_written_in_quotes_and_read_back(spark, tmp_path):
    cells = ['say "hi"', ' "q"', "a\tb", "line\nbreak\r", "two\r\nlines\n\nmore", '"', '""', '"\n"', "plain", '\n', 'end "']
    df = spark.createDataFrame([(f"s{i}", c, i) for i, c in enumerate(cells)], "sample_name string, title string, _row long")
    out = str(tmp_path / "quoted")
    write_manifest(df, out, breaks="quote")
    assert rows(read_manifest(spark, out), "sample_name", "title", "_row", "_width") == sorted((f"s{i}", c, i, 2) for i, c in enumerate(cells))


@pytest.mark.parametrize("bits", [0, 1, 3])
def test_reader_over_parts_of_splits(spark, tmp_path, monkeypatch, bits):
    """A worker holds a part of a split at a time, and what it reads does not depend on where a part ends."""
    monkeypatch.setattr(rec, "PART_BITS", bits)
    r = random.Random(bits)
    lines = random_lines(r, 120) + ['"cell over', *["many"] * 9, 'lines"\tend', '"never closed', *["plain"] * 5]
    (tmp_path / "m.txt").write_bytes(("h1\th2\n" + "\n".join(lines) + "\n").encode())
    read = rec.read_lines(spark, str(tmp_path / "m.txt")).localCheckpoint()
    plain, _, _ = rec.plain_splits(read)
    assert plain.count() > 1 and plain.groupBy(rec.PART).count().where("count > 1").isEmpty()
    got = [tuple(x) for x in read_manifest(spark, str(tmp_path / "m.txt"), open_quotes=True).orderBy("_row").collect()]
    want = []
    for i, t in enumerate(sequential(lines)):
        cells, broken = rec.cells_of(t)
        want.append((*[(c or None) for c in (cells + ["", ""])[:2]], i, len(cells), broken))
    assert got == want
