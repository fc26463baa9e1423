from __future__ import annotations

import base64
import random

import public_tokenizers as P
import pyarrow as pa
import tiktoken

from queuelens.llm import bpe
from queuelens.llm.bpe import decode_ids, encode_texts, encoder, merge_many, merge_one, op3_byte_bpe, vocabulary
from queuelens.llm.common import table
from tests.llm.brute import sha
from tests.llm.conftest import DOCS

SF = "/root/testdata/sf0.01"
PATH = P.path("byte_bpe_50k.tiktoken")
ODD = ["", None, " ", "  ", "a  b", "a \n b", "\n\n x  ", "x" * 300 + "abcdef" * 100, "é   ü  \x1c\x1d a", "😀😀 ' 's it's  ", "a\n", "a \n",
       "  \n", " a b ", "!!!???  ---" * 50, "日本語テキスト" * 30, "aaaa" * 3000, "<|endoftext|>", "\x00\x01"]


def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_whole_table_and_odd_texts_equal_the_library(spark, tables):
    t = reference()
    rows = [(r.doc_id, r.text, None, None, 1) for r in table(spark, SF, "documents").collect()]
    rows += [(10_000 + i, x, None, None, None) for i, x in enumerate(ODD)]
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in op3_byte_bpe(spark, tables(documents=(rows, DOCS))).collect()}
    want = {}
    for r in rows:
        ids = t.encode_ordinary(r[1] or "")
        want[r[0]] = (len(ids), sha(" ".join(map(str, ids))), sha(r[1] or ""))
    assert got == want


def test_random_texts_and_bytes():
    t, rnd, vocab = reference(), random.Random(5), vocabulary(PATH)
    texts = ["".join(rnd.choice(" \n\tab'sé1!😀 Thein") for _ in range(rnd.randint(1, 90))) for _ in range(1500)]
    assert [x.tolist() for x in encoder(PATH, P.PATTERN)(texts)] == [t.encode_ordinary(x) for x in texts]
    words = [bytes(rnd.choice(b"theinaro ") for _ in range(rnd.randint(2, 32))) for _ in range(500)]
    want = [t._core_bpe.encode_single_piece(w) for w in words]
    whole = [len(x) == 1 for x in want]
    for got in ([merge_one(vocab, w) for w in words], [x.tolist() for x in merge_many(vocab, words, 32)]):
        assert all(g == w or one for g, w, one in zip(got, want, whole, strict=True))


def test_repeats_nulls_clashing_names_and_empty(spark):
    schema = "doc_id long, text string, ids string, decoded string"
    docs = spark.createDataFrame([(None, "a b", "x", "y"), (1, "a b", "x", "y"), (1, "a b", "x", "y"), (2, None, None, None)], schema)
    out = decode_ids(encode_texts(docs, PATH, P.PATTERN), PATH)
    assert sorted((bytes(r.decoded), len(r.ids)) for r in out.collect()) == [(b"", 0)] + [(b"a b", 2)] * 3
    assert encode_texts(spark.createDataFrame([], schema), PATH, P.PATTERN).count() == 0


def test_unspaced_texts_are_not_kept():
    t, encode = reference(), encoder.__wrapped__(PATH, P.PATTERN)
    texts = ["".join(chr(0x4E00 + (i * j) % 2000) for j in range(1, 400)) for i in range(1, 60)] + ["a b", "x" * 5000]
    assert [x.tolist() for x in encode(texts)] == [t.encode_ordinary(x) for x in texts]
    caches = [c.cell_contents for c in encode.__closure__ if isinstance(c.cell_contents, dict)]
    assert max((len(k) for c in caches for k in c), default=0) <= 64


def test_distinct_parts_are_split_once(monkeypatch):
    """Parts between spaces that repeat in a batch, first parts and texts with touching white space, as Arrow or as a list."""
    seen, old = [], bpe.merged
    monkeypatch.setattr(bpe, "merged", lambda vocab, words, size: seen.extend(words) or old(vocab, words, size))
    t, encode = reference(), encoder.__wrapped__(PATH, P.PATTERN)
    texts = ["zqxjk vwpfq, zqxjk vwpfq zqxjk", "vwpfq zqxjk", "", " ", "zqxjk", " zqxjk ", "vwpfq\u0085\u0085 zqxjk", "zqxjk\x1c\x1d vwpfq",
             "a\x0b\x0b b", "a　 b", "vwpfq\n zqxjk's"] * 40
    want = [t.encode_ordinary(x) for x in texts]
    assert [x.tolist() for x in encode(pa.array(texts))] == want == [x.tolist() for x in encode(texts)]
    assert b" zqxjk" in seen and len(seen) == len(set(seen))
    assert encode([]) == [] and [x.tolist() for x in encode([""])] == [[]]
    ids = pa.array([*want, None], pa.list_(pa.int32()))
    assert vocabulary(PATH).decode(ids).to_pylist() == [*[x.encode() for x in texts], b""]
    assert vocabulary(PATH).decode(ids[3:9]).to_pylist() == [x.encode() for x in texts[3:9]]
