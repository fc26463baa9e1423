from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np

from queuelens.llm import lexical as L
from queuelens.llm.treap import Treap
from tests.llm.conftest import DOCS

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, top=20):
    held = [(d, Counter(t), len(t)) for d, t in ((d, terms(t)) for d, t in docs) if t]
    count, length = len(held), sum(n for *_, n in held)
    out = []
    for item, text in items:
        scored = []
        for d, tf, n in held:
            m = 100 - 25 + 25 * n * count // length
            score = 0
            for t in terms(text):
                if t in tf:
                    df = sum(t in c for _, c, _ in held)
                    score += math.floor(1000 * math.log((2 * count + 2) / (2 * df + 1))) * (10 ** 9 * tf[t] // (1000 * tf[t] + 12 * m))
            if score > 0:
                scored.append((-score, d is None, d))
        out += [(item, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:top])]
    return sorted(out, key=str)


def run(spark, docs, items, **more):
    d = spark.createDataFrame([(i, t, "rank", "s", 1) for i, t in docs], DOCS).withColumnsRenamed({"lang": "score", "source": "n", "n_chars": "row"})
    i = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, rank string")
    return sorted((tuple(r) for r in L.lexical_search(d, i, **more).collect()), key=str)


def tables(n=150):
    rng = random.Random(4)
    words = ["Straße", "ÄPFEL", "äpfel", "the", "The", "a1", "x_y", "中文", "中", "é", "1234", "\x00nul", "q"] + [f"t{i}" for i in range(30)]
    text = lambda k: " ".join(rng.choice(words) for _ in range(k)) + rng.choice(["", ".", "--", "\x7f"])
    docs = [(rng.randrange(300), text(rng.randrange(1, 40))) for _ in range(n)]
    docs += [(None, "t1 t2 t3 the"), (None, "t1 t2 t3 the"), (400, None), (401, ""), (402, "-- !"), (403, "t5 " * 50_000), (1, "rare"), (1, "rare")]
    items = [(k, text(rng.randrange(1, 25))) for k in range(12)] + [(3, "t1 t1 t2"), (None, "t4"), (90, None), (91, "?!"), (92, "nowhere"), (93, "RARE")]
    return docs, items


def test_odd_texts_ties_and_nulls_equal_brute_force(spark):
    docs, items = tables()
    assert run(spark, docs, items) == brute(docs, items)
    assert run(spark, docs, items, top=3) == brute(docs, items, 3)
    assert run(spark, [], items) == [] == run(spark, docs, [])


def test_several_blocks_and_ranges(spark, monkeypatch):
    docs, items = tables(60)
    monkeypatch.setattr(L, "RANGE", 16)
    monkeypatch.setattr(L, "BLOCK_TERMS", 40)
    assert run(spark, docs, items) == brute(docs, items)


def test_treap_cells_hold_maxima_and_search_is_exact_with_any_beam():
    rng = np.random.default_rng(1)
    terms_, docs = 37, 900
    cells = np.unique(np.column_stack([rng.integers(0, terms_, 5000), rng.integers(0, docs, 5000)]), axis=0)
    impact = rng.integers(1, 1 << 40, len(cells))
    grid = np.zeros((terms_, docs), np.int64)
    grid[cells[:, 0], cells[:, 1]] = impact
    treap = Treap(cells[:, 0], cells[:, 1], impact, terms_, docs)
    assert treap.most[0].tolist() == [impact.max()] and len(treap.most[-1]) == len(cells)
    want_terms, times = np.array([0, 5, 36, 12]), np.array([1, 2, 1, 3])
    whole = times @ grid[want_terms]
    for beam in (1, 7, 256):
        best: list = []
        opened = 0

        def offer(columns, scores):
            nonlocal best, opened
            opened += len(columns)
            best = sorted(best + [(-s, c) for s, c in zip(scores.tolist(), columns.tolist(), strict=True)])[:10]
            return -best[-1][0] if len(best) == 10 else 1

        treap.search(want_terms, times, offer, 1, beam)
        assert best == sorted((-s, c) for c, s in enumerate(whole.tolist()) if s)[:10]
        assert opened < docs
    Treap(*np.zeros((3, 0), np.int64), 5, 5).search(want_terms, times, None, 1)
