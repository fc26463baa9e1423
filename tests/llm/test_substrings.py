from __future__ import annotations

import random
import re

from queuelens.llm import substrings
from queuelens.llm.common import table
from queuelens.llm.substrings import op2_substring_dedup, remove_repeats
from tests.llm.brute import sha
from tests.llm.conftest import DOCS

SF = "/root/testdata/sf0.01"


def brute(rows, size=20):
    """(doc_id, n_words, n_removed, digest) of rows (doc_id, text), judged in id order."""
    seen, out = set(), []
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = [False] * len(words)
        for s in range(len(words) - size + 1):
            w = tuple(words[s:s + size])
            if w in seen:
                gone[s:s + size] = [True] * size
            seen.add(w)
        out.append((i, len(words), sum(gone), sha(" ".join(w for w, g in zip(words, gone, strict=True) if not g))))
    return sorted(out, key=str)


def answers(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str)


def test_whole_table_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    assert answers(op2_substring_dedup(spark, SF)) == brute(rows)


def odd():
    rnd = random.Random(6)
    passage = " ".join(f"p{i}" for i in range(60))
    words = lambda n: " ".join(rnd.choice("abcdefghij") + str(rnd.randint(0, 400)) for _ in range(n))
    rows = [(0, None), (1, ""), (2, " \n\t"), (3, "For " * 500), (4, "For " * 19), (5, "For " * 20), (6, passage), (7, passage),
            (8, passage.replace(" ", "\n")), (9, words(30_000) + " " + passage), (10, "É x " + passage[:100])]
    rows += [(11 + i, words(rnd.randint(0, 60)) + " " + " ".join(passage.split()[rnd.randint(0, 20):rnd.randint(30, 60)]) + " " + words(40))
             for i in range(120)]
    base = words(200).split()
    for i in range(60):
        w = list(base)
        for _ in range(rnd.randint(0, 4)):
            w[rnd.randint(0, 199)] = f"edit{i}"
        rows.append((200 + i, " ".join(w)))
    return rows


def test_passages_near_copies_and_long_prefixes(spark, tables, monkeypatch):
    rows = odd()
    d = tables(documents=([(i, t, None, None, None) for i, t in rows], DOCS))
    want = brute(rows)
    assert answers(op2_substring_dedup(spark, d)) == want
    for group in (1, 30):     # every, or every hot, prefix is lengthened to the whole window
        monkeypatch.setattr(substrings, "GROUP", group)
        assert answers(op2_substring_dedup(spark, d)) == want


def test_nulls_repeats_clashing_names_and_empty(spark):
    schema = "doc_id long, text string, doc string, tie string, n_words string"
    text = " ".join(map(str, range(30)))
    rows = [(5, text, "x", "y", "z"), (5, text, "x", "y", "z"), (5, text + " more", None, None, None), (None, text, None, None, None), (None, "a b", None, None, None)]
    got = sorted(((r.doc_id, r.n_words, r.n_removed) for r in remove_repeats(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert got == sorted([(5, 30, 0), (5, 30, 30), (5, 31, 30), (None, 30, 30), (None, 2, 0)], key=str) or \
        got == sorted([(5, 30, 30), (5, 30, 30), (5, 31, 0), (None, 30, 30), (None, 2, 0)], key=str)
    assert remove_repeats(spark.createDataFrame([], schema)).count() == 0
