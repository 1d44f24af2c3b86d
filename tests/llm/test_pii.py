import hashlib
import random
import re

from llm_cases import docs_of
from manifestqc.llm import pii

PATTERNS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s, d: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s, d: all(int(x) <= 255 for x in s.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda s, d: 13 <= len(d) <= 19 and sum(sum(map(int, str(int(c) * (1 + k % 2)))) for k, c in enumerate(d[::-1])) % 10 == 0),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s, d: 9 <= len(d) <= 15),
}


def brute_force(text):
    return [(kind, *m.span()) for kind, (p, ok) in PATTERNS.items() for m in re.finditer(p, text or "") if ok(m[0], re.sub("[^0-9]", "", m[0]))]


def number(r):
    d = "".join(r.choices("0123456789", k=15))
    return d + next(c for c in "0123456789" if pii.luhn(d + c))


def test_base_spans_match_the_patterns():
    r = random.Random(3)
    parts = ["a", "@", "b.c", "1.2.3.4", "256.1.1.1", "+", "12", " ", "-", "(", ")", ".", "x@y.zz", "é", "\n", "@@", "0000255", "+1 (555) 010-9999", "..", "%"]
    for _ in range(6000):
        text = "".join(number(r) if r.random() < 0.05 else r.choice(parts) for _ in range(r.randint(0, 14)))
        assert pii.base_spans(text) == brute_force(text), repr(text)


def test_long_runs_do_not_backtrack():
    for text in ("9" * 200_000, "a" * 200_000, "@" * 50_000, "+" * 50_000 + "1" * 50_000, "1." * 50_000, "1 " * 50_000, "a@" * 50_000):
        base = pii.base_spans(text)
        pii.added_spans(text, base, pii.Model())
        list(pii.clusters(text))


def rows_with_spans(n=240):
    r = random.Random(8)
    rows = []
    for i in range(n):
        w = ["word"] * r.randint(3, 30)
        for _ in range(r.randint(0, 3)):
            w.insert(r.randrange(len(w)), r.choice([number(r), f"user{r.randint(1, 99)}@mail{r.randint(1, 9)}.example.com", f"10.{r.randint(0, 255)}.{r.randint(0, 255)}.7",
                                                    f"+1 ({r.randint(200, 999)}) 555-{r.randint(1000, 9999)}", str(r.randint(1, 10**9)), f"{r.randint(1, 9)}.{r.randint(1, 9)}", "300.400.1.1"]))
        rows.append((i, " ".join(w)))
    return rows


def test_query_rows_keep_base_spans(spark, docs_of):
    card = "4465758382889437"
    rows = rows_with_spans() + [(1000, None), (1001, ""), (None, "x@y.zz"), (1, rows_with_spans()[1][1]), (1002, f"é {card} {card}"), (1003, "7 " * 30_000)]
    df = spark.createDataFrame([(i, t, "s", 1) for i, t in rows], "doc_id long, text string, spans string, n_email int")
    got = pii.personal_data(df).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i, text in rows:
        base, r = brute_force(text), by[i]
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{z}" for k, a, z in base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for x, _, _ in base) for k in pii.KINDS]
        spans = [(k, int(a), int(z)) for k, a, z in (x.split(":") for x in r.spans.split(",") if x)]
        assert set(base) <= set(spans) and len(spans) == len(base) + r.n_added
        extra = sorted((a, z) for k, a, z in spans if (k, a, z) not in base)
        assert all(z <= x for (_, z), (x, _) in zip(extra, extra[1:]))
        assert all(z <= a2 or z2 <= a for a, z in extra for _, a2, z2 in base)
    # numbers that the pattern runs together are found by the model
    assert by[1002].n_card == 0 and by[1002].n_added >= 1
    assert pii.personal_data(df.limit(0)).count() == 0


def test_model_tells_kinds_apart():
    samples = [(t, a, z) for _, t in rows_with_spans() for a, z in pii.clusters(t)]
    model = pii.train(samples)
    found = {kind for _, t in rows_with_spans() for a, z in pii.clusters(t) for kind, _, _ in model.segments(t, a, z)}
    assert found == set(pii.KINDS)
    for text in ("version 3.5 of 2024", "costs 19.99", "id 12345678", "300.400.1.1"):
        assert pii.added_spans(text, [], model) == []


def test_joint_choice_is_the_best_of_all():
    model = pii.train([(t, a, z) for _, t in rows_with_spans() for a, z in pii.clusters(t)])

    def best(text, start, end):
        atoms = pii.Atoms(text, start, end)
        arcs = [(i, j, max(sum(model.weights.get((k, f), 0.0) for f in pii.features(text, *atoms.span(i, j))) for k in pii.KINDS) - pii.MARGIN) for i, j in atoms.candidates()]

        def go(at):
            return max([0.0] + [s + go(j) for i, j, s in arcs if i >= at and s > 0])
        return go(0)

    for text in ("10.1.2.7 user1@mail2.example.com", "+1 (555) 555-1234 4465758382889437", "user5@mail1.example.com"):
        total = 0.0
        for kind, a, z in model.segments(text, 0, len(text)):
            total += sum(model.weights.get((kind, f), 0.0) for f in pii.features(text, a, z)) - pii.MARGIN
        assert abs(total - best(text, 0, len(text))) < 1e-9


def test_pieces_cut_no_span():
    r = random.Random(12)
    for _ in range(200):
        text = " ".join(r.choice([number(r), f"u{r.randint(1, 9)}@m.example", "10.1.2.7", "1" * r.randint(1, 60), "7"]) for _ in range(r.randint(1, 40)))
        for start, end in pii.clusters(text):
            base = pii.base_spans(text[start:end])
            base = [(k, start + a, start + z) for k, a, z in base]
            cut = list(pii.pieces(text, start, end, base, 50))
            assert cut[0][0] == start and cut[-1][1] == end and all(z == a for (_, z), (a, _) in zip(cut, cut[1:])) and all(a < z for a, z in cut)
            assert all(any(a <= x and y <= z for a, z in cut) for _, x, y in base)
    assert [z - a for a, z in pii.pieces("9" * 1000, 0, 1000, [], 200)] == [200] * 5


def test_sample_is_drawn_per_kind(spark, docs_of):
    r = random.Random(4)
    rows = [(i, f"mail user{i}@mail.example.com now") for i in range(300)] + [(1000 + i, f"at 10.0.{i}.7 here") for i in range(3)]
    rows += [(2000, "word " + "7 " * 400 + f"{number(r)}x"), (2001, "call +1 (555) 555-0199 today " + "x1 " * 200)]
    drawn = pii.training_pieces(docs_of(rows), sample=20)
    count = {k: sum(any(kind == k for kind, _, _ in spans) for *_, spans in drawn) for k in pii.KINDS}
    assert count["email"] == 20 and count["ip"] == 3 and count["phone"] == 1
    assert 0 < sum(not spans for *_, spans in drawn) <= 20
    for piece, a, z, spans in drawn:
        assert z - a <= pii.LONGEST and all(a <= x and y <= z for _, x, y in spans)
        assert all((kind, x, y) in pii.base_spans(piece) for kind, x, y in spans)
    assert pii.training_pieces(docs_of([(1, "only 12345 here")])) == []
