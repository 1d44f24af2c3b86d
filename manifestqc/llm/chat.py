"""Chat formatting with offset-aligned loss masks.

A conversation is rendered as

    <s> then for every turn  <|turn|>ROLE<|text|>TEXT</s>

ROLE and TEXT are escaped: a backslash is doubled, and every control string in
them gets a backslash after its first character, so that no control string is
left inside a text and a reader can undo it.  The rendered conversation is
encoded once, with offsets, by a public byte-level tokenizer to which the
control strings are added as tokens of their own (texts and marks therefore
never share a token).  The character spans of assistant texts are sorted, and
tokens are matched with them by binary search: a token is under the loss if it
overlaps a span.

The output rows hold the rendered text, ids, token offsets and the masked runs;
``read_back`` parses them again.

Defined results: turns are ordered by turn, ties by role, then text, nulls first;
null text is empty, a null role is the role "" and never assistant; equal rows
are turns of their own; rows with a null conv_id form one conversation; a
conversation without assistant text has an empty mask; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from manifestqc.llm.common import exact_ids, id_array, id_list
from manifestqc.llm.tokens import tokenizer_path

TOKENIZER = "byte_bpe_50k.json"
START, END, TURN, TEXT = "<s>", "</s>", "<|turn|>", "<|text|>"
CONTROL = [START, END, TURN, TEXT, "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|startoftext|>", "<|endoftext|>"]
_CONTROL = re.compile("|".join(re.escape(c) for c in sorted(CONTROL, key=len, reverse=True)))
_ESCAPED = re.compile(r"\\(\\?)")
_TURN = re.compile(re.escape(TURN) + "(.*?)" + re.escape(TEXT) + "(.*?)" + re.escape(END), re.S)
FORMATTED = ("conv_id long, formatted string, input_ids array<int>, token_start array<int>, token_end array<int>, "
             "loss_runs array<struct<first:int,last:int>>")


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    """A doubled backslash is one, a single one goes."""
    return _ESCAPED.sub(lambda m: m[1], text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The conversation and the spans (start, end) of its assistant texts, escaped as they stand there."""
    parts, spans, at = [START], [], len(START)
    for role, text in turns:
        head, body = TURN + escape(role) + TEXT, escape(text)
        at += len(head)
        if role == "assistant" and body:
            spans.append((at, at + len(body)))
        at += len(body) + len(END)
        parts += [head, body, END]
    return "".join(parts), spans


@lru_cache(maxsize=2)
def encoder(path: str):
    from tokenizers import AddedToken, Tokenizer
    t = Tokenizer.from_file(path)
    t.add_special_tokens([AddedToken(c, normalized=False, special=True) for c in (START, END, TURN, TEXT)])
    return t


def mask_runs(token_start: np.ndarray, token_end: np.ndarray, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """First and last token of each span, by binary search over both sorted lists."""
    starts, ends = (np.array([s[k] for s in spans], np.int64) for k in (0, 1))
    first = np.searchsorted(token_end, starts, "right")
    last = np.searchsorted(token_start, ends, "left") - 1
    return [(int(a), int(z)) for a, z in zip(first, last) if a <= z]


def formatted(conversations: DataFrame, path: str | None = None) -> DataFrame:
    """One row of FORMATTED per conversation."""
    path = path or tokenizer_path(TOKENIZER)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = encoder(path)
        for pdf in frames:
            for i in range(0, len(pdf), 64):
                part = pdf.iloc[i:i + 64]
                made = [render([(x["role"] or "", x["text"] or "") for x in turns]) for turns in part["turns"]]
                rows = []
                for conv, (text, spans), enc in zip(id_list(part["conv_id"]), made, t.encode_batch([m[0] for m in made], add_special_tokens=False)):
                    offsets = np.array(enc.offsets, np.int32).reshape(-1, 2)
                    runs = mask_runs(offsets[:, 0], offsets[:, 1], spans)
                    rows.append((conv, text, np.array(enc.ids, np.int32), offsets[:, 0], offsets[:, 1], [{"first": a, "last": z} for a, z in runs]))
                out = pd.DataFrame(rows, columns=["conv_id", "formatted", "input_ids", "token_start", "token_end", "loss_runs"])
                yield out.assign(conv_id=id_array([r[0] for r in rows]))

    turns = (conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")))
    return exact_ids(turns, "conv_id").select("conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns")).mapInPandas(run, FORMATTED)


def turns_of(text: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a rendered conversation."""
    return [(unescape(role), unescape(body)) for role, body in _TURN.findall(text)]


def masked_text(text: str, token_start, token_end, runs: list[tuple[int, int]]) -> str:
    """What the masked tokens cover; bytes of one character share its offsets, so runs are taken from end to end."""
    return unescape("".join(text[token_start[a]:token_end[z]] for a, z in runs))


READ = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long, loss_tokens long"


def read_back(rows: DataFrame) -> DataFrame:
    """conv_id and READ, from formatted rows alone."""
    @F.pandas_udf(READ)
    def run(text: pd.Series, start: pd.Series, end: pd.Series, runs: pd.Series) -> pd.DataFrame:
        out = []
        for t, s, e, found in zip(text, start, end, runs):
            turns = turns_of(t)
            pairs = [(r["first"], r["last"]) for r in found]
            loss = masked_text(t, s, e, pairs)
            digest = hashlib.sha256("".join(f"{role}\n{body}\n" for role, body in turns).encode("utf-8", "surrogatepass"))
            out.append((len(turns), digest.hexdigest(), len(loss), hashlib.sha256(loss.encode("utf-8", "surrogatepass")).hexdigest(), len(t), len(s), sum(z - a + 1 for a, z in pairs)))
        return pd.DataFrame(out, columns=[c.split()[0] for c in READ.split(", ")])

    return rows.select("conv_id", run("formatted", "token_start", "token_end", "loss_runs").alias("r")).select("conv_id", "r.*")
