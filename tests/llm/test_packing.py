from __future__ import annotations

import random
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from queuelens.llm.common import table
from queuelens.llm.packing import combinations_filling, nnls, op5_packing, pack_documents, plan
from queuelens.llm.wordtokens import encoder
from tests.llm.conftest import DOCS

SF = "/root/testdata/sf0.01"
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", None, "İ Σας ΣΑΣ <|endoftext|> <|ENDOFTEXT|> it's I'LL x.. a.,b é́ Å 12 3a   z q w\x1cq \x85 中文 字 áb ʼn ﬁ",
       "ǅ ß ẞ K Å .x. a.' b.'s '", "word " * 9000, "tail", "J\u030c x", "H\u0331 T\u0308 W\u030a Y\u030a J\u030c! ELLE Elle. <b>", "中文字符没有空格" * 500]


def check(rows, got):
    tokenizer = Tokenizer.from_file(WORDS)
    ids = {i: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for i, t in rows}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        assert r.doc_tokens == len(ids[r.doc_id]) and 0 < r.length <= 2048
        assert r.ids_crc32 == crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes())
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts, whole in [(pieces[i], len(x)) for i, x in ids.items()] + [(s, None) for s in sequences.values()]:
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == whole if whole else at <= 2048
    return sum(map(len, ids.values())) / (2048 * len(sequences))


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    assert check(rows, op5_packing(spark, SF).collect()) > 0.97


def test_odd_texts_and_one_hot_length(spark, tables):
    rows = [(i, "same words here " * 30) for i in range(300)] + [(1000 + i, t) for i, t in enumerate(ODD)]
    d = tables(documents=([(i, t, None, None, None) for i, t in rows], DOCS))
    assert check(rows, op5_packing(spark, d).collect()) > 0.9


def test_repeats_nulls_clashing_names_and_empty(spark):
    schema = "doc_id long, text string, length string, sequence_id string"
    rows = [(5, "a b", "x", "y"), (5, "a b", "x", "y"), (None, "c", None, None)]
    got = pack_documents(spark.createDataFrame(rows, schema), WORDS).collect()
    assert sorted((str(r.doc_id), r.length) for r in got) == [("5", 3), ("5", 3), ("None", 2)]
    assert len({(r.sequence_id, r.offset) for r in got}) == 3 and len({r.row for r in got}) == 3
    assert pack_documents(spark.createDataFrame([], schema), WORDS).count() == 0


def test_cached_encoder_equals_the_library():
    tokenizer, encode = Tokenizer.from_file(WORDS), encoder(WORDS)
    for text, raw in zip(ODD, encode([(t or "").encode() for t in ODD]), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids


def test_random_marks_and_unspaced_texts_equal_the_library_in_bounded_memory(monkeypatch):
    from queuelens.llm import wordtokens

    monkeypatch.setattr(wordtokens, "CACHED_BYTES", 20_000)
    tokenizer, encode, rnd = Tokenizer.from_file(WORDS), encoder.__wrapped__(WORDS), random.Random(3)
    some = "JHTWYaAbÇçé 's.,:!?\u0331\u030c\u0308\u030a\u0301 İΣσςßẞǅﬁK1２½中文<|endoftext|>'x  \n"
    for _ in range(40):
        texts = ["".join(rnd.choice(some) for _ in range(rnd.randint(1, 60))) for _ in range(100)] + ["字" * 3000]
        for text, raw in zip(texts, encode([t.encode() for t in texts]), strict=True):
            assert np.frombuffer(raw, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    known = next(c.cell_contents for c in encode.__closure__ if isinstance(c.cell_contents, dict))
    assert max(map(len, known)) <= wordtokens.LONGEST_KEPT and len(known) * wordtokens.ENTRY_BYTES < 10 * 20_000


def test_plan_uses_the_histogram_up():
    rng = np.random.default_rng(0)
    h = {int(c): int(n) for c, n in zip(range(1, 129), rng.integers(0, 900, 128), strict=True)}
    p = plan(h)
    used = Counter()
    for shape, n in p:
        assert sum(shape) <= 128 and n > 0
        used.update({c: m * n for c, m in Counter(shape).items()})
    assert used == Counter({c: n for c, n in h.items() if n})
    assert sum(c * n for c, n in h.items()) / (128 * sum(n for _, n in p)) > 0.95
    assert plan({}) == []


def test_nnls_solves_a_known_system():
    rng = np.random.default_rng(1)
    a = rng.random((20, 8))
    x = np.array([0, 3.0, 0, 1, 0, 0, 2, 0])
    assert np.allclose(nnls(a, a @ x), x, atol=1e-6)
    assert all(sum(s) == 12 for s in combinations_filling(12, 3)) and len(combinations_filling(12, 3)) == 19
