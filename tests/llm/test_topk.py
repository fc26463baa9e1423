from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from queuelens.llm import topk
from queuelens.llm.common import table
from queuelens.llm.topk import _products, best_in_block, op6_top_k, top_k, whole_vectors

SF = "/root/testdata/sf0.01"


def brute(ids, m, is_query, k=10):
    out = []
    s = m @ m.T
    for q in np.flatnonzero(is_query):
        rest = np.array([i for i in range(len(ids)) if i != q])
        best = rest[np.lexsort((ids[rest], -s[q, rest]))[:k]]
        out += [(ids[q], r + 1, ids[b], s[q, b]) for r, b in enumerate(best)]
    return sorted(tuple(map(int, x)) for x in out)


def test_whole_table_against_brute_force(spark):
    rows = table(spark, SF, "embeddings").collect()
    ids = np.array([r.vec_id for r in rows])
    m = np.array([np.floor(1024 * np.array(r.embedding, float)) for r in rows]).astype(np.int64)
    assert sorted(tuple(r) for r in op6_top_k(spark, SF).collect()) == brute(ids, m, ids % 100 == 0)


def test_many_blocks_of_many_lengths_ties_and_copies(spark, monkeypatch):
    monkeypatch.setattr(topk, "BUCKET_ROWS", 40)
    monkeypatch.setattr(topk, "QUERY_ROWS", 7)
    rng = np.random.default_rng(4)
    m = rng.normal(size=(600, 6)) * rng.lognormal(0, 1.5, (600, 1))
    m[100:220] = m[100]            # one vector a fifth of all
    m[300:310] = 0
    ids = rng.permutation(600)
    docs = spark.createDataFrame([(int(i), [float(x) for x in v], "clash") for i, v in zip(ids, m, strict=True)],
                                 "vec_id long, embedding array<double>, score string").repartition(5)
    v = topk.written(whole_vectors(docs), "t")
    got = top_k(v, v.where("vec_id % 20 = 0")).select("query_id", "rank", "vec_id", "score")
    assert sorted(tuple(r) for r in got.collect()) == brute(ids, np.floor(1024 * m).astype(np.int64), ids % 20 == 0)


def test_pruning_keeps_every_answer():
    rng = np.random.default_rng(8)
    c = rng.normal(size=(800, 5))
    c = np.floor(1024 * c / np.linalg.norm(c, axis=1)[:, None] * rng.uniform(0.5, 1.5, (800, 1))).astype(np.int64)
    q = c[:50]
    block = pd.DataFrame({"row": range(800), "vec_id": range(800), "v": list(c), "length2": (c.astype(float) ** 2).sum(1)})
    s = q @ c.T
    s[np.arange(50), np.arange(50)] = -10**15
    for place in (10, 30, 300):    # thresholds from high to low
        least = np.sort(s, axis=1)[:, -place]
        queries = pd.DataFrame({"row": range(50), "vec_id": range(50), "v": list(q), "least": least})
        got = best_in_block(queries, block, 10)
        for n in range(50):
            assert got.vec_id[got.query_row == n].tolist() == np.lexsort((np.arange(800), -s[n]))[:10].tolist()


def test_bad_vectors_few_rows_repeats_and_empty(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (100, [0.5]), (5, None), (6, [1.0, None]), (7, [nan]), (8, [inf, 0.0]), (None, [1.0]), (9, [])]
    v = topk.written(whole_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")), "t")
    assert sorted(r.vec_id for r in v.collect()) == [0, 0, 9, 100]
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in top_k(v, v.where("vec_id % 100 = 0")).collect())
    big, small = 5 * 2**20, 2**19
    assert got == sorted([(0, 1, 0, big), (0, 2, 100, small), (0, 3, 9, 0)] * 2 + [(100, 1, 0, small), (100, 2, 0, small), (100, 3, 9, 0)])
    none = v.where(F.lit(False))
    assert top_k(none, none).count() == 0 and top_k(v, none).count() == 0


def test_large_components_stay_exact():
    assert topk._products(np.array([[2**30, 1]]), np.array([[2**30, 1]])).tolist() == [[2**60 + 1]]


def test_products_that_may_wrap_are_an_error():
    with pytest.raises(OverflowError):
        _products(np.array([[3_000_000_000]]), np.array([[4_000_000_000]]))
    assert _products(np.array([[1 << 40]]), np.array([[1 << 20]])).tolist() == [[1 << 60]]
