from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from queuelens.llm.common import table
from queuelens.llm.components import components
from queuelens.llm.covering import anchors
from queuelens.llm.simhash import drop_near_duplicates, fingerprint, links, op10_simhash, simhash_groups
from tests.conftest import explain_text
from tests.llm.conftest import DOCS

SF = "/root/testdata/sf0.01"


def plain(text) -> int:
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(fp: dict) -> dict:
    ids, root = sorted(fp), {}
    f = np.array([fp[i] for i in ids], np.uint64)
    for k, i in enumerate(ids):  # label propagation from each unseen smallest id
        if i in root:
            continue
        todo = [k]
        while todo:
            j = todo.pop()
            if ids[j] not in root:
                root[ids[j]] = i
                todo += np.flatnonzero(np.bitwise_count(f ^ f[j]) <= 2).tolist()
    return root


def test_whole_table_and_odd_texts_against_brute_force(spark, tables):
    rows = [(r.doc_id, r.text, None, None, 1) for r in table(spark, SF, "documents").limit(150).collect()]
    base = "one two three four five six seven eight nine ten eleven twelve " * 40
    odd = ["", None, " \t\n", "A", "a b", "A  B", "a b c d", "Été İx y z", "w " * 40_000,
           base, base + "x", base + "y z", "pre " + base]
    rows += [(5000 - i, t, None, None, None) for i, t in enumerate(odd)]
    got = {r.doc_id: r for r in op10_simhash(spark, tables(documents=(rows, DOCS))).collect()}
    fp = {r[0]: plain(r[1]) for r in rows}
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{x:016x}" for i, x in fp.items()}
    assert {i: r.component_id for i, r in got.items()} == groups(fp)


def test_anchors_are_a_cover():
    f = np.random.default_rng(7).integers(0, 2**64, 300, dtype=np.uint64)
    at, home = anchors(f, 0)
    assert at.tolist() == list(range(300))
    reach = set(zip(*(x.tolist() for x in anchors(f, 2)), strict=True))
    for i in range(64):
        for j in range(i, 64):
            k = (i * 64 + j) % 300
            _, h = anchors(f[k:k + 1] ^ np.uint64(1 << i | 1 << j), 0)
            assert (k, int(h[0])) in reach


def test_links_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    f = {int(x) for x in rng.integers(0, 2**63, 60)}
    for x in list(f):
        for n in (1, 2, 2, 3):
            f.add(x ^ sum(1 << int(b) for b in rng.choice(62, n, replace=False)))
    df = spark.createDataFrame([(x,) for x in f], "fp long")
    want = {(a, b) for a in f for b in f if a < b and (a ^ b).bit_count() <= 2}
    got = [(r.a, r.b) for r in links(df).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_links_broadcast_no_side_however_small_the_fingerprints(spark):
    plan = explain_text(links(spark.range(100).withColumnRenamed("id", "fp")))
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_components_of_chains_and_stars(spark):
    e = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(50)] + [(7, 7), (300, 299), (299, 300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(e, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, **{200 + i: 100 for i in range(50)}, 299: 299, 300: 299}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_kept_rows_nulls_repeats_extra_columns_and_empty(spark):
    schema = "doc_id long, text string, fp string, root long, kept string"
    rows = [(3, "a b c d", "x", 1, None), (2, "a b c d", "x", 1, None), (2, "a b c d", "x", 1, None),
            (None, None, None, None, None), (9, "", None, None, None), (4, "other words stand here", None, None, "k")]
    docs = spark.createDataFrame(rows, schema)
    got = simhash_groups(docs).select("doc_id", "component_id", "kept").collect()
    assert len(got) == len(rows)
    assert sorted((r.doc_id, r.component_id) for r in got if r.kept) == [(2, 2), (4, 4), (9, 9)]
    left = drop_near_duplicates(docs)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [2, 4, 9]
    assert simhash_groups(spark.createDataFrame([], schema)).count() == 0
    assert drop_near_duplicates(docs.where(F.lit(False))).count() == 0


def test_fingerprint_of_few_words():
    assert fingerprint(b"") == 0 == fingerprint(b" \n")
    assert fingerprint(b"A  b") == plain("a b")
