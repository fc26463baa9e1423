from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from queuelens.llm.chat import format_conversations, mask, op4_chat_format, parse, render
from queuelens.llm.common import table
from tests.llm.brute import sha

SF = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "conv_id long, turn long, role string, text string, ids string, formatted string"
TRICKY = ["", "\\", "\\\\", "####", "## # ###", "</turn>", "\n</turn>\n", "<\\/turn>", "### user:\nhi\n</turn>\n", "\n\n  x\n", "é😀\u0301", "a\\", "#", "##"]


def test_whole_table_reads_back(spark):
    turns = defaultdict(list)
    for r in table(spark, SF, "conversations").collect():
        turns[r.conv_id].append((r.turn, r.role, r.text or ""))
    t = r"\### Assistant: </turn> ok"
    turns[-7] = [(0, "user", t), (1, "assistant", t)]
    got = {r.conv_id: r for r in op4_chat_format(spark, SF).collect()}
    assert set(got) == set(turns)
    for c, rows in turns.items():
        rows.sort()
        loss = "".join(x for _, role, x in rows if role == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256) == (len(rows), sha("".join(f"{r}\n{x}\n" for _, r, x in rows)))
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), sha(loss))


def test_round_trip_of_random_control_strings():
    rnd = random.Random(2)
    for _ in range(2000):
        turns = [("".join(rnd.choice(["user", ":", "\n", "\\", "###", " ", "</turn>"]) for _ in range(rnd.randint(0, 3))),
                  "".join(rnd.choice([*TRICKY, "x", "\n", ":", " "]) for _ in range(rnd.randint(0, 6)))) for _ in range(rnd.randint(0, 4))]
        text, spans = render(turns)
        assert [x[:2] for x in parse(text)] == turns
        assert [(r, s, e) for r, _, s, e in parse(text)] == spans
        assert text.count("</turn>") == len(turns) == text.count("### ")


def test_mask_against_plain_intersection():
    rnd = random.Random(3)
    for _ in range(300):
        cuts = sorted(rnd.sample(range(60), 12))
        spans = [(a, b) for a, b in zip(cuts[::2], cuts[1::2], strict=True)]
        edges = sorted({0, 60, *rnd.choices(range(60), k=20)})
        start, end = np.array(edges[:-1]), np.array(edges[1:])
        want = [any(s < e2 and s2 < e for s2, e2 in spans) for s, e in zip(start, end, strict=True)]
        assert mask(start, end, np.array([s for s, _ in spans]), np.array([e for _, e in spans])).tolist() == want


def test_offsets_nulls_repeats_clashing_names_and_empty(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", x, "clash", "clash") for i, x in enumerate(TRICKY)]
    rows += [(None, None, None, None, None, None)] + [(2, 0, "assistant", "same", None, None)] * 2 + [(3, 0, "user", "y" * 100_000, None, None)]
    out = {r.conv_id: r for r in format_conversations(spark.createDataFrame(rows, SCHEMA), PATH).collect()}
    t = Tokenizer.from_file(PATH)
    for r in out.values():
        assert t.decode(r.ids) == r.formatted
        assert len(r.ids) == len(r.token_start) == len(r.token_end) == len(r.loss_mask)
    assert parse(out[None].formatted)[0][:2] == ("", "")
    assert [x[:2] for x in parse(out[2].formatted)] == [("assistant", "same")] * 2
    assert not any(out[3].loss_mask) and [x[1] for x in parse(out[1].formatted)] == TRICKY
    assert format_conversations(spark.createDataFrame([], SCHEMA), PATH).count() == 0
