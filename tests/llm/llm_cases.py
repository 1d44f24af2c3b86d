"""Shared inputs of the tests in this folder (a module of its own name, as the folder above has the conftest)."""

import os
import random
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(p for p in (ROOT, os.environ.get("PYTHONPATH")) if p)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """DataFrame of documents from (doc_id, text) pairs."""
    def make(rows):
        return spark.createDataFrame([(i, t, "en", "src", None if t is None else len(t)) for i, t in rows], DOCS)
    return make


def words(r: random.Random, n: int, vocabulary: int = 4000) -> list[str]:
    return ["w" + "".join(chr(97 + int(c)) for c in str(r.randrange(vocabulary))) for _ in range(n)]


def corpus(seed: int = 7, n: int = 120) -> list[tuple[int, str]]:
    """Texts with exact copies, near copies, shared lines, hostile and empty texts."""
    r = random.Random(seed)
    shared = " ".join(words(r, 60))
    rows = []
    for i in range(n):
        lines = [" ".join(words(r, r.randint(1, 40))) for _ in range(r.randint(1, 8))]
        if i % 5 == 0:
            lines.insert(r.randrange(len(lines) + 1), shared)
        if i > 10 and i % 4 == 0:
            lines = rows[r.randrange(len(rows))][1].split("\n")
            if i % 8 == 0:  # a near copy
                at = r.randrange(len(lines))
                lines[at] = " ".join(lines[at].split(" ")[1:] + ["changed"])
        rows.append((i, "\n".join(lines)))
    rows += [(n, ""), (n + 1, " \t\n "), (n + 2, "one"), (n + 3, "Ünïcode É ñ 日本 \x1c  end"), (n + 4, " ".join(words(r, 30_000)))]
    return rows
