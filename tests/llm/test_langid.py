from __future__ import annotations

import math
from collections import Counter
from zlib import crc32

import regex

from queuelens.llm.common import table
from queuelens.llm.langid import drop_unidentified, fit, identify, op7_language_id

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, lang_pred string, score string"
EN, DE = "the cat and the dog sat on the mat ", "der hund und die katze auf dem tisch "


def small(spark):
    rows = [(i, EN * 3, "en", None, None) for i in range(20)] + [(100 + i, DE * 3, "de", None, None) for i in range(20)]
    return spark.createDataFrame(rows, SCHEMA)


def test_held_out_accuracy_on_whole_table(spark):
    docs = {r.doc_id: r for r in table(spark, SF, "documents").collect()}
    got = op7_language_id(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    out = [r for r in got if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in out) > 0.97 * len(out) > 0


def test_words_first_then_ngrams_and_odd_texts(spark):
    model = fit(small(spark))
    assert model.languages == ["de", "en"] and "the" in model.words and " th" in model.grams
    odd = ["the dog", "THE DOG", "katzen hunde tische", "thee cats mats", "", None, "123 !?", "中文", "the " * 60_000,
           " ".join(f"x{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}" for i in range(100))]
    docs = spark.createDataFrame([(i, t, None, "clash", "clash") for i, t in enumerate(odd)], SCHEMA)
    got = [(r.lang_pred, r.lang_score) for r in identify(docs, model).orderBy("doc_id").collect()]
    assert [g[0] for g in got[:7]] == ["en", "en", "de", "en", "und", "und", "und"]
    assert [g[1] for g in got[4:7]] == [0, 0, 0] and got[7][1] < 0.7 and got[8][0] == "en"


def test_no_labels_empty_tables_and_pipeline_stage(spark):
    none = spark.createDataFrame([(1, "abc", None, None, None)], SCHEMA)
    assert fit(none).languages == [] and identify(none, fit(none)).first().lang_pred == "und"
    empty = spark.createDataFrame([], SCHEMA)
    assert identify(empty, fit(empty)).count() == 0 and drop_unidentified(empty).count() == 0
    more = spark.createDataFrame([(None, EN, None, "p", "s"), (None, EN, None, "p", "s"), (900, "-- 12", "en", None, None),
                                  (901, None, "en", None, None)], SCHEMA)
    left = drop_unidentified(small(spark).union(more))
    assert left.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ")
    rows = left.collect()
    assert len(rows) == 42 and [(r.lang, r.lang_pred) for r in rows if r.doc_id is None] == [("en", "p")] * 2


def test_numbers_are_no_letters(spark):
    odd = ["½ ² Ⅷ ①", "½the dog²and", "１２ ٣", "the½cat ª"]
    docs = spark.createDataFrame([(i, t, None, "clash", "clash") for i, t in enumerate(odd)], SCHEMA)
    got = [(r.lang_pred, r.lang_score) for r in identify(docs, fit(small(spark))).orderBy("doc_id").collect()]
    assert got[0] == got[2] == ("und", 0.0) and got[1][0] == got[3][0] == "en"


def test_every_score_equals_a_plain_recomputation(spark):
    """Fitting and predicting from the rules alone: counts, log frequencies, backoff at each place, softmax."""
    rows = [(i, t, lang) for i, (t, lang) in enumerate([(EN * 2, "en"), (DE * 2, "de"), ("Les chats et ½ les chiens l'été", "fr"), ("the été", "fr"), ("Ölberg über", "de")] * 3)]
    rows += [(90, "thecat unddog étés xyz", None), (91, "the " * 40 + "katze", None), (92, "ÜBER", None)]
    words, grams = {}, {}
    for _, text, lang in rows:
        for w in regex.findall(r"\p{L}+", text.lower()) if lang else []:
            words.setdefault(w, Counter())[lang] += 1
            p = f" {w} "
            for k in range(1, 5):
                for i in range(len(p) - k + 1):
                    grams.setdefault(p[i:i + k], Counter())[lang] += 1
    langs = ["de", "en", "fr"]

    def logs(counts):
        kept = {x: c for x, c in counts.items() if sum(c.values()) >= 2}
        total = {g: sum(c[g] for c in kept.values()) for g in langs}
        out = {}
        for x, c in kept.items():
            v = [math.log((c[g] + 1) / (total[g] + len(kept))) for g in langs]
            out[x] = [a - sum(v) / 3 for a in v]
        return out

    words, grams = logs(words), logs(grams)

    def of(word):
        if word in words:
            return words[word]
        p, got = f" {word} ", []
        for i in range(len(p)):
            got += [grams[p[i:i + k]] for k in range(min(4, len(p) - i), 0, -1) if p[i:i + k] in grams][:1]
        return [sum(g[j] for g in got) / max(1, len(got)) for j in range(3)]

    docs = spark.createDataFrame([(i, t, g, None, None) for i, t, g in rows], SCHEMA)
    for r in identify(docs, fit(docs)).collect():
        found = [of(w) for w in regex.findall(r"\p{L}+", rows[r.doc_id if r.doc_id < 90 else r.doc_id - 90 + 15][1].lower())]
        total = [sum(f[j] for f in found) * min(1, 10 / len(found)) for j in range(3)]
        soft = [math.exp(x - max(total)) for x in total]
        assert r.lang_pred == langs[soft.index(1)] and abs(r.lang_score - 1 / sum(soft)) < 1e-9
