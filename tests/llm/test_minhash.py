from __future__ import annotations

import random

import numpy as np

from queuelens.llm import minhash as M
from tests.llm.conftest import DOCS


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(rows, k=2):
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    key = lambda r: tuple(map(str, r))
    return sorted(((d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=key)


def run(spark, rows, **more):
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], DOCS).withColumnsRenamed({"lang": "n_shingles", "source": "root"})
    return sorted((tuple(r) for r in M.minhash_groups(docs, **more).collect()), key=lambda r: tuple(map(str, r)))


def edited(rng, words, n):
    out = list(words)
    for i in rng.sample(range(len(out)), n):
        out[i] = f"e{rng.random()}"
    return " ".join(out)


def corpus():
    rng = random.Random(11)
    rows = []
    for _ in range(30):   # templates with copies at many distances, from far below to far above the threshold
        words = [f"w{rng.randrange(4000)}" for _ in range(rng.choice([40, 120, 300]))]
        rows += [(rng.randrange(10_000), edited(rng, words, rng.randrange(0, 1 + len(words) // 8))) for _ in range(rng.randrange(1, 12))]
    words = [f"v{i}" for i in range(120)]
    for _ in range(30):   # a chain: each a little further from the first, so that only neighbours are linked
        rows.append((rng.randrange(10_000), " ".join(words)))
        words[rng.randrange(120)] = f"n{rng.random()}"
    rows += [(5, None), (6, ""), (7, " \n\t"), (8, "word"), (9, "WORD "), (10, "word word"), (None, "word"), (None, "alone here"), (None, None)]
    rows += [(3, "a b c d"), (3, "a b c d"), (4, "long " * 60_000), (2, "long long long"), (11, "\x1cx y"), (12, "\x1cX Y")]
    return rows


def test_odd_texts_chains_and_copies_equal_brute_force(spark):
    assert run(spark, corpus(), shingle=2) == brute(corpus())
    assert run(spark, corpus()[:150]) == brute(corpus()[:150], 5)
    assert run(spark, []) == []


def test_large_buckets_are_compared_in_blocks(spark, monkeypatch):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(60)]   # a family whose members mostly miss the threshold: many components share buckets
    rows = [(i, edited(rng, words, rng.randrange(1, 5))) for i in range(120)]
    monkeypatch.setattr(M, "BLOCK_BYTES", 9000)
    want = brute(rows)
    assert 2 < len({r[2] for r in want}) < 110 and run(spark, rows, shingle=2) == want


def test_sequential_test_keeps_similar_pairs_and_prunes_others():
    rng = np.random.default_rng(0)

    def pairs(similarity, n=20_000):
        a = rng.integers(0, 1 << 32, (n, M.HASHES), np.uint32)
        return a, np.where(rng.random(a.shape) < similarity, a, a + np.uint32(1))

    assert len(M.plausible(*pairs(0.8))) >= 20_000 - 2
    assert len(M.plausible(*pairs(0.5))) < 200 and len(M.plausible(*pairs(0.1))) == 0
    least = M.least_matches()
    assert len(least) == M.HASHES // M.BATCH and list(least) == sorted(least) and 0 < least[-1] < 0.8 * M.HASHES


def test_signatures_estimate_the_similarity():
    x = M.shingle_hashes(" ".join(f"w{i}" for i in range(3000)).encode(), 2)
    y = M.shingle_hashes(" ".join(f"w{i}" for i in range(300, 3300)).encode(), 2)
    true = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
    assert abs((M.signature(x) == M.signature(y)).mean() - true) < 0.12
