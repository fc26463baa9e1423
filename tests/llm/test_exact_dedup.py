from __future__ import annotations

import hashlib
from collections import defaultdict

from queuelens.llm.exact_dedup import drop_exact_duplicates, exact_duplicates

SCHEMA = "doc_id long, text string, keep_id string, run string, digest long"


def fold(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (t or ""))


def test_against_brute_force(spark):
    texts = ["Abc", "aBC", "É", "é", "", None, "x" * 200_000, "abc "]
    rows = [(i * 7 % 101, texts[i * i % len(texts)], "clash", "clash", 1) for i in range(101)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(9)
    groups = defaultdict(list)
    for r in rows:
        groups[fold(r[1])].append(r[0])
    want = sorted((i, max(g), len(g), i == max(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g)
    got = sorted((r.doc_id, r.keep_id, r.group_size, r.kept, r.digest.hex()) for r in exact_duplicates(docs).collect())
    assert got == want
    small = {r.doc_id for r in exact_duplicates(docs, keep="min").where("kept").collect()}
    assert small == {min(g) for g in groups.values()}


def test_hot_group_ties_nulls_and_repeats(spark):
    rows = [(i, "same", None, None, None) for i in range(400)] + [(399, "same", "a", "b", 2), (None, "same", None, None, 1),
                                                                   (None, "alone", None, None, 1), (None, "alone", None, None, 1)]
    got = exact_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert len(got) == len(rows)
    assert [r.doc_id for r in got if r.kept and r.group_size > 2] == [399]
    assert sum(r.kept for r in got) == 2
    kept = drop_exact_duplicates(spark.createDataFrame(rows, SCHEMA))
    assert kept.columns == ["doc_id", "text", "keep_id", "run", "digest"]
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == [("399", "same"), ("None", "alone")]


def test_empty_table(spark):
    assert exact_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
