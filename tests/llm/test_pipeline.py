from __future__ import annotations

import corpus_pipeline
from queuelens.llm import simhash
from queuelens.llm.common import table
from tests.conftest import explain_text
from tests.llm import brute
from tests.llm.test_simhash import groups, plain

SF = "/root/testdata/sf0.001"


def test_pipeline_against_brute_force(spark):
    docs = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    letters = {i: t for i, t in docs.items() if t and any(c.isalpha() for c in t)}
    last = {}
    for i, t in sorted(letters.items()):
        last["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)] = i
    exact = {i: letters[i] for i in last.values()}
    root = groups({i: plain(t) for i, t in exact.items()})
    near = {i: t for i, t in exact.items() if root[i] == i}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in got} == set(near)
    # texts without any base span are packed unchanged
    clean = [(i, t) for i, t in near.items() if brute.base_secrets(t)[:3] == (0, 0, 0)]
    assert clean
    keep = {i for i, _ in clean}
    assert {r.doc_id: r.doc_tokens for r in got if r.doc_id in keep} == tokens(clean)
    assert len({(r.sequence_id, r.offset) for r in got}) == len(got)


def tokens(rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return {i: len(t.encode(x, add_special_tokens=False).ids) + 1 for i, x in rows}


def test_stages_keep_the_columns_of_documents(spark):
    docs = table(spark, SF, "documents")
    out = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, out.limit(60), SF)
        assert out.columns == docs.columns


def test_near_copies_are_linked_without_a_broadcast(spark, monkeypatch):
    """Spark sizes the anchors, some 150 a fingerprint, like the fingerprints, whatever their number."""
    plans = []
    monkeypatch.setattr(simhash, "components", lambda edges, f=simhash.components: (plans.append(explain_text(edges)), f(edges))[1])
    docs = spark.createDataFrame([(i, f"text number {i} of a few") for i in range(9)], "doc_id long, text string")
    assert corpus_pipeline.simhash_near_dedup(spark, docs, SF).count() > 0
    assert len(plans) == 1 and "SortMergeJoin" in plans[0] and "Broadcast" not in plans[0]
