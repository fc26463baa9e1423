from __future__ import annotations

from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from queuelens.llm.common import table
from queuelens.llm import toxicity
from queuelens.llm.toxicity import (WIDTHS, best_threshold, counted, fit, fit_all, labelled_rows, labelled_sample, logit, op8_toxicity,
                                    score_toxicity, windows)

SF = "/root/testdata/sf0.1"


def test_held_out_quality_on_whole_table(spark):
    got = {r.doc_id: r for r in op8_toxicity(spark, SF).collect()}
    assert len(got) == table(spark, SF, "documents").count()
    assert all(r.held_out == (crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
               for i, r in got.items())
    marked = [(r.toxic, got[r.doc_id].predicted) for r in table(spark, SF, "labels").where("toxic is not null").collect() if got[r.doc_id].held_out]
    hit, found, toxic = sum(a and b for a, b in marked), sum(b for _, b in marked), sum(a for a, _ in marked)
    assert toxic > 20 and hit / toxic > 0.85 and hit / found > 0.85


def small():
    clean = [f"the weather is fine on day {'abcdefghij'[i % 10]} of the week" for i in range(60)]
    bad = [f"the vilest word {'abcdefghij'[i % 10]} is vilexy here" for i in range(60)]
    return pd.DataFrame({"text": clean + bad, "toxic": [0] * 60 + [1] * 60, "lang": ["en"] * 120})


def test_odd_texts_ties_and_clashing_names(spark):
    model = fit(small().sample(frac=1, random_state=1))
    odd = ["the vilest thing", "fine weather", "", None, "123 !!", "the week " * 30_000 + "vilexy", "vilezz"]
    docs = spark.createDataFrame([(i % 6, t, "clash") for i, t in enumerate(odd)], "doc_id long, text string, score string")
    got = [r.toxicity for r in score_toxicity(docs, model).collect()]
    assert got[0] > 0.7 > got[1] and min(got[5:]) > got[1]     # the stem is known by its first characters
    assert got[2] == got[3] == got[4]
    assert score_toxicity(docs.where(F.lit(False)), model).count() == 0


def test_without_labels_and_with_one_class(spark):
    docs = spark.createDataFrame([(1, "a b", None), (2, None, "en")], "doc_id long, text string, lang string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for labels in (none, spark.createDataFrame([(1, 1, 1), (1, 1, 1), (2, 0, None), (None, 0, 1)], none.schema)):
        sample, weight = labelled_sample(docs, labels)
        assert weight == 1.0 and len(sample) == (0 if labels is none else 1)
        assert all(0 <= r.toxicity <= 1 for r in score_toxicity(docs, fit(sample, weight)).collect())


def test_windows_and_thresholds_against_plain_loops():
    rng = np.random.default_rng(0)
    x, f = rng.normal(size=(7, 16)), rng.normal(size=(16, sum(WIDTHS) * 8))
    at = 0
    for k, width in enumerate(WIDTHS):
        for t in range(7):
            want = sum(x[t + j] @ f[:, at + 8 * j:at + 8 * j + 8] for j in range(width) if t + j < 7)
            assert np.allclose(windows(x, f)[k][t], want)
        at += 8 * width
    assert best_threshold(np.array([3.0, 2, 1, 0]), np.array([1, 1, 0, 0]), 1, 0) == 1.5
    assert best_threshold(np.array([3.0, 2]), np.array([1, 1]), 1, 9.0) == 9.0
    assert logit(fit(small()), np.zeros((0, 16))) == fit(small()).offset


def test_words_are_runs_of_letters(spark):
    """The words are those of the language model: numbers that are no digits split them."""
    model = fit(small())
    docs = spark.createDataFrame([(0, "the vilexy thing"), (1, "the\u00bdvilexy 12 thing\u2167"), (2, "\u00bd \u00b2 12")], "doc_id long, text string")
    got = [r.toxicity for r in score_toxicity(docs, model).orderBy("doc_id").collect()]
    assert got[0] == got[1] != got[2]


def test_every_labelled_document_is_used(spark, monkeypatch):
    """No sample: the counts are those of a plain loop over all rows, long texts too, and several tasks train."""
    monkeypatch.setattr(toxicity, "TASK_DOCS", 40)
    monkeypatch.setattr(toxicity, "SAMPLE", 1)
    texts = small()
    docs = spark.createDataFrame([(i, t * (2500 if i == 3 else 1), "en" if i % 2 else None) for i, t in enumerate(texts["text"])],
                                 "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, int(y)) for i, y in enumerate(texts["toxic"])], "doc_id long, quality int, toxic int")
    rows = labelled_rows(docs, labels)
    seen, n, names, words_in = counted(rows)
    assert rows.count() == 120 and rows.where("length(text) > 50000").count() == 1 and names == ["en"]
    fits = rows.where("not tuning").collect()
    assert list(n) == [sum(r.toxic == y for r in fits) for y in (0, 1)]
    for word in ("vilest", "weather"):
        at = toxicity.buckets_of(word)[0]
        assert [seen[y, at] for y in (0, 1)] == [sum(word in r.text.split() for r in fits if r.toxic == y) for y in (0, 1)]
        assert words_in[at, 0] == sum(r.text.split().count(word) for r in rows.where("lang = 'en'").collect())
    got = {r.doc_id: r.toxicity for r in score_toxicity(docs, fit_all(docs, labels)).collect()}
    assert all((got[i] >= 0.7) == (i >= 60) for i in got)
    empty = fit_all(docs, labels.where("false"))
    assert list(empty.thresholds) == [0.0] and all(0 <= r.toxicity <= 1 for r in score_toxicity(docs, empty).collect())


def test_words_are_hashed_once_and_as_one_by_one(spark, monkeypatch):
    """The passes read word codes, no texts; a text's codes are its words' buckets, in order, also where caches overflow."""
    monkeypatch.setattr(toxicity, "CACHED", 3)
    texts = ["", "Word word, wor (WORD) 12", "a½ß Ⅷ ΑΣ. ΑΣ ΟΔΟΣ", "  İstanbul a1b2\nﬁx ", "x" * 300, "日本 語"]
    want = [[toxicity.buckets_of(w) for w in toxicity.words_of(t)] for t in texts]
    toxicity.coder.cache_clear()
    docs, words = toxicity.numbered_words(texts * 2)
    toxicity.coder.cache_clear()
    assert [words[d].tolist() for d in docs] == want * 2
    rows = spark.createDataFrame([(i, t, 0, "en", False) for i, t in enumerate(texts)], "i int, text string, toxic int, lang string, tuning boolean")
    got = toxicity.coded(rows).orderBy("i").toPandas()
    docs, words = toxicity.coded_words(got["codes"])
    assert [words[d].tolist() for d in docs] == want and "text" not in got and toxicity.coded(toxicity.coded(rows)).columns == list(got.columns)
    monkeypatch.setattr(toxicity, "TOGETHER", 60)
    some = toxicity.slices(pa.array(texts))
    found = [(toxicity.buckets_in(c), at[a:b]) for x in some for c, at, ends in [toxicity.coder()(x)] for a, b in zip(ends, ends[1:], strict=False)]
    assert len(some) > 2 and [b[at].tolist() for b, at in found] == want
