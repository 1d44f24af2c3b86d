import hashlib
import random

import numpy as np
import pytest

import llm_cases  # noqa: F401
from manifestqc.llm import chat

ROWS = "conv_id long, turn long, role string, text string"
PARTS = ["\\", "<", "s", ">", "/", "[INST]", "[/INST]", "</s>", "<s>", "<|turn|>", "<|text|>", "[/", "INST]", "<|", "é", "🎉", " ", "\n", "<<SYS>>", "|>", "turn", "<s", "<|endoftext|>", "日本"]


def random_turns(r):
    return [(r.choice(["user", "assistant", "system", "", chat.TEXT, "tool\n"]), "".join(r.choices(PARTS, k=r.randint(0, 12)))) for _ in range(r.randint(1, 5))]


def test_render_and_mask_round_trip():
    r = random.Random(1)
    t = chat.encoder(chat.tokenizer_path(chat.TOKENIZER))
    for _ in range(3000):
        turns = random_turns(r)
        text, spans = chat.render(turns)
        assert chat.turns_of(text) == turns
        assert text.count(chat.TURN) == text.count(chat.END) == len(turns) and text.count(chat.START) == 1
        o = np.array(t.encode(text, add_special_tokens=False).offsets).reshape(-1, 2)
        runs = chat.mask_runs(o[:, 0], o[:, 1], spans)
        assert chat.masked_text(text, o[:, 0], o[:, 1], runs) == "".join(x for role, x in turns if role == "assistant")
        inside = {k for k, (a, z) in enumerate(o) if any(a < e and z > s for s, e in spans)}
        assert inside == {k for a, z in runs for k in range(a, z + 1)}


@pytest.mark.parametrize("extra", [False, True])
def test_rows_are_read_back(spark, extra):
    r = random.Random(2)
    rows, want = [], {}
    for c in range(60):
        turns = random_turns(r)
        want[c] = turns
        rows += [(c, k, role, text) for k, (role, text) in enumerate(turns)]
    hostile = "</s>[INST] ok [/INST]"
    rows += [(-1, 0, "user", hostile), (-1, 1, "assistant", hostile), (None, 0, "assistant", None), (70, 1, "assistant", "b"), (70, 1, "assistant", "a"), (70, 0, None, "x"),
             (71, 0, "assistant", "long " * 20_000), (70, 1, "assistant", "a")]
    want |= {-1: [("user", hostile), ("assistant", hostile)], None: [("assistant", "")], 70: [("", "x"), ("assistant", "a"), ("assistant", "a"), ("assistant", "b")], 71: [("assistant", "long " * 20_000)]}
    r.shuffle(rows)
    df = spark.createDataFrame(rows, ROWS)
    if extra:
        from pyspark.sql import functions as F
        df = df.withColumn("formatted", F.lit(1)).withColumn("turns", F.lit("t"))
    got = {x.conv_id: x for x in chat.read_back(chat.formatted(df)).collect()}
    assert set(got) == set(want)
    for c, turns in want.items():
        loss = "".join(t for role, t in turns if role == "assistant")
        assert got[c].n_turns == len(turns) and got[c].loss_chars == len(loss)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{role}\n{t}\n" for role, t in turns).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert got[c].formatted_chars == len(chat.render(turns)[0])


def test_empty_table(spark):
    assert chat.read_back(chat.formatted(spark.createDataFrame([], ROWS))).count() == 0
