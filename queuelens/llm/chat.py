"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole, encoded once with offsets, and its sorted
turn spans are intersected with the sorted token spans by binary search.

Template, for each turn: ``### role:`` + newline + text + newline +
``</turn>`` + newline.  Inside texts and roles a backslash is doubled, ``###``
and ``</turn>`` are broken by a backslash, and roles also escape ``:`` and
newlines; so control strings occur in the output only as marks, and removing
each escape gives the text back.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import cache
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queuelens.llm.common import small_arrow_batches, table, text_of

# Fixed values of the template.
HEAD, HEAD_END, TAIL = "### ", ":\n", "\n</turn>\n"
TRAINED = "assistant"

ESCAPE_TEXT = re.compile(r"\\|#(?=##)|<(?=/turn>)")
ESCAPE_ROLE = re.compile(r"\\|#(?=##)|<(?=/turn>)|(?=[:\n])")
UNESCAPE = re.compile(r"\\(.)", re.S)
HEADER = re.compile(r"### ((?:[^\\:]|\\.)*):\n", re.S)

FORMATTED = ("formatted string, turns array<struct<role: string, start: int, end: int>>, ids array<int>, "
             "token_start array<int>, token_end array<int>, loss_mask array<boolean>")


def escape(text: str) -> str:
    return ESCAPE_TEXT.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return UNESCAPE.sub(r"\1", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[str, int, int]]]:
    """The formatted conversation, and role and span (code points) of each escaped text."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head = HEAD + ESCAPE_ROLE.sub(lambda m: m[0] + "\\", role) + HEAD_END
        body = escape(text)
        spans.append((role, at + len(head), at + len(head) + len(body)))
        out += [head, body, TAIL]
        at = spans[-1][2] + len(TAIL)
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end) of each turn, read back from the formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        head = HEADER.match(formatted, at)
        end = formatted.index(TAIL, head.end())
        turns.append((unescape(head[1]), unescape(formatted[head.end():end]), head.end(), end))
        at = end + len(TAIL)
    return turns


def mask(token_start: np.ndarray, token_end: np.ndarray, span_start: np.ndarray, span_end: np.ndarray) -> np.ndarray:
    """Which tokens touch a span; spans are sorted, disjoint and not empty."""
    if not len(span_start):
        return np.zeros(len(token_start), bool)
    k = np.searchsorted(span_end, token_start, "right")    # first span that ends behind the token's start
    return (k < len(span_end)) & (span_start[np.minimum(k, len(span_end) - 1)] < token_end)


def under_mask(formatted: str, turns, token_start, token_end, loss_mask) -> str:
    """The unescaped text that masked tokens cover inside trained turns, in order."""
    start, end = np.asarray(token_start)[np.asarray(loss_mask, bool)], np.asarray(token_end)[np.asarray(loss_mask, bool)]
    out = []
    for role, s, e in turns:
        if role == TRAINED and s < e:
            lo, hi = np.searchsorted(end, s, "right"), np.searchsorted(start, e, "left")
            if lo < hi:
                out.append(unescape(formatted[max(s, start[lo]):min(e, end[hi - 1])]))
    return "".join(out)


@cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


def format_conversations(turns: DataFrame, tokenizer: str, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: conv_id, formatted, turns, ids, token_start, token_end, loss_mask.

    Turns are ordered by number, then role and text (null numbers first), so
    repeated rows are repeated turns.  Null texts and roles count as empty, a
    null conversation id is a conversation of its own, an empty table gives an
    empty result, other columns are not looked at.  A conversation becomes one
    row of the result, so it is gathered in one task; nothing larger is.
    """
    small_arrow_batches(turns.sparkSession, 64)
    named = turns.select(turns[conv_col].cast("long").alias("conv_id"), F.struct(
        turns[turn_col].cast("long").alias("turn"), text_of(turns, role_col).alias("role"),
        text_of(turns, text_col).alias("text")).alias("t"))
    whole = named.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t")).select(
        "conv_id", F.col("t.role").alias("roles"), F.col("t.text").alias("texts"))

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = _tokenizer(tokenizer)
        for pdf in batches:
            done = [render(list(zip(r, x, strict=True))) for r, x in zip(pdf["roles"], pdf["texts"], strict=True)]
            rows = []
            for (text, spans), e in zip(done, t.encode_batch([d[0] for d in done], add_special_tokens=False), strict=True):
                start, end = np.array(e.offsets, np.int32).reshape(-1, 2).T
                trained = np.array([s[1:] for s in spans if s[0] == TRAINED and s[1] < s[2]], np.int64).reshape(-1, 2)
                rows.append((text, [{"role": r, "start": a, "end": b} for r, a, b in spans], e.ids, start, end,
                             mask(start, end, trained[:, 0], trained[:, 1])))
            out = pd.DataFrame(rows, columns=["formatted", "turns", "ids", "token_start", "token_end", "loss_mask"])
            out.insert(0, "conv_id", pdf["conv_id"].astype("Int64").to_numpy())
            yield out.astype({"conv_id": "Int64"})

    return whole.mapInPandas(each, f"conv_id long, {FORMATTED}")


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, digests and counts of what can be read from the formatted output alone."""
    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for text, start, end, loss in zip(pdf["formatted"], pdf["token_start"], pdf["token_end"], pdf["loss_mask"], strict=True):
                turns = parse(text)
                trained = under_mask(text, [(r, s, e) for r, _, s, e in turns], start, end, loss)
                rows.append((len(turns), sha256("".join(f"{r}\n{x}\n" for r, x, _, _ in turns).encode()).hexdigest(),
                             len(trained), sha256(trained.encode()).hexdigest(), len(text)))
            out = pd.DataFrame(rows, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
            out.insert(0, "conv_id", pdf["conv_id"].astype("Int64").to_numpy())
            yield out.astype({"conv_id": "Int64"})

    return formatted.select("conv_id", "formatted", "token_start", "token_end", "loss_mask").mapInPandas(
        each, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    tricky = r"\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return read_back(format_conversations(turns, public_tokenizers.path("byte_bpe_50k.json")))
