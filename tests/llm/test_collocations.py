from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np

from queuelens.llm import collocations as C
from queuelens.llm.doublearray import build
from tests.llm.conftest import DOCS


def brute(rows):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang if lang is not None else "und"
        folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", folded):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i:i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
    often = {p: a for p, a in f.items() if a >= 30}
    hidden = {p[:1] + p[i:i + k] for p, a in often.items() for k in range(2, len(p) - 1) for i in range(1, len(p) - k + 1)
              if 100 * a >= 80 * f[p[:1] + p[i:i + k]]}
    out = []
    for lang in n:
        found = []
        for p, a in often.items():
            if p[0] == lang and len(p) > 2 and p not in hidden:
                score, _, left, right = min((2_000_000 * a // (f[p[:k + 1]] + f[(lang, *p[k + 1:])]), k, f[p[:k + 1]], f[(lang, *p[k + 1:])])
                                            for k in range(1, len(p) - 1))
                found.append((-score, -a, " ".join(p[1:]).encode(), left, right))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(found)[:2000])]
    return sorted(out)


def texts():
    rng = random.Random(5)
    words = ["New", "york", "ünder", "the", "a\x1cb", "NUL\x00", "x"]
    rows = [("en", " ".join(rng.choice(words) + rng.choice(["", "", "", ".", ",", "\r\n", "\t"]) for _ in range(400))) for _ in range(12)]
    rows += [(None, "One two one two three. " * 80), ("und", "one two; ONE two one two"), ("fr", None), ("de", ""), (None, ". , ;")]
    return rows + [("en", "new york city hall " * 35), ("en", "ha " * 300)]


def run(spark, rows, **more):
    docs = spark.createDataFrame([(i, t, lang, "s", 7) for i, (lang, t) in enumerate(rows)], DOCS)
    got = C.collocations(docs.withColumnsRenamed({"n_chars": "n", "source": "phrase"}), **more).collect()
    assert len(got) == 0 or got[0].asDict().keys() == {"lang", "rank", "phrase", "a", "l", "r", "n", "score"}
    return sorted(tuple(r) for r in got)


def test_odd_texts_equal_brute_force(spark):
    want = brute(texts())
    assert any(len(r[2].split(" ")) == 4 for r in want) and {r[0] for r in want} == {"en", "und"}
    assert run(spark, texts()) == want


def test_several_dictionary_blocks_trie_shards_and_flushes(spark, monkeypatch):
    for name, small in (("WORDS_AT_ONCE", 3), ("SHARD", 4), ("HELD", 5), ("HELD_WORDS", 5), ("ROW", 50)):
        monkeypatch.setattr(C, name, small)
    assert run(spark, texts()) == brute(texts())
    assert run(spark, texts(), top=1) == [r for r in brute(texts()) if r[1] == 1]


def test_nothing_frequent_and_empty(spark):
    assert run(spark, [("en", "a b c"), (None, None)]) == [] == run(spark, [])
    assert run(spark, [("en", "a. " * 40)]) == []


def test_compact_keeps_stretches_apart():
    words = np.array([0, 0, 5, 6, 7, 0, 8, 9, 0, 0, 0], np.int32)
    w, s = C.compact(words, words, 1)
    assert w.tolist() == s.tolist() == [5, 6, 7, 0, 8, 9, 0]
    w, s = C.compact(words, np.array([0, 0, 3, 0, 0, 0, 4, 0, 0, 0, 0], np.int32), 2)
    assert (w.tolist(), s.tolist()) == ([5, 6, 0, 8, 9, 0], [3, 0, 0, 4, 0, 0])


def test_double_array_equals_a_dictionary():
    rng = np.random.default_rng(3)
    pairs = np.unique(np.column_stack([rng.integers(5, 400, 5000) ** 2 // 100, rng.integers(1, 900, 5000)]), axis=0)
    children = np.arange(1, len(pairs) + 1)
    trie = build(pairs[:, 0], pairs[:, 1], children)
    known = {tuple(p): c for p, c in zip(pairs.tolist(), children.tolist(), strict=True)}
    states, symbols = rng.integers(0, 2000, 100_000), rng.integers(0, 1000, 100_000)
    states[:5000], symbols[:5000] = pairs[rng.integers(0, len(pairs), 5000)].T
    got = trie.advance(states, symbols)
    assert got.tolist() == [known.get(x, 0) for x in zip(states.tolist(), symbols.tolist(), strict=True)]


def test_result_looks_up_no_level_again(spark):
    """Counts of parts come with the phrases: a plan of a join for each part and level took 200 MB of the driver's memory."""
    docs = spark.createDataFrame([(i, t, lang, "s", 7) for i, (lang, t) in enumerate(texts())], DOCS)
    plan = C.collocations(docs)._jdf.queryExecution().optimizedPlan().toString()
    joins = re.findall(r"Join \w+", plan)
    assert len(joins) == 2, joins   # the phrases one word longer, and the languages' totals
