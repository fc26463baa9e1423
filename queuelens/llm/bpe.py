"""Byte-level BPE with a segment tree over byte positions.

A pre-token's live parts sit at the leaves; each leaf holds the rank of the
pair that starts there, each inner node the smallest rank below it, the
leftmost on a tie.  A merge takes the root's pair, joins its right part into
the left one, and updates two leaves and the paths above them.

Short pre-tokens of one length class are merged side by side: one numpy step
performs the next merge of every pre-token in the batch.  Long ones use the
same tree one at a time.

A batch's texts are cut at their spaces by Arrow, and only its distinct parts
are split into pre-tokens.
"""

from __future__ import annotations

import base64
from collections.abc import Callable
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queuelens.llm.common import list_places, small_arrow_batches, table, text_of

NONE = np.int64(1 << 40)   # rank of a pair that does not merge
LONGEST_BATCHED = 64       # bytes; longer pre-tokens are merged one at a time
CACHED_BYTES = 256 << 20   # of remembered chunks and pre-tokens in a Python worker; then it starts anew
ENTRY_BYTES = 400          # of a chunk's and its pre-tokens' entries, besides 16 times the chunk's own bytes
LONGEST_KEPT = 64          # bytes; longer chunks (a text without spaces, say) are forgotten after their batch
TOGETHER = 1 << 13         # pre-tokens merged side by side

TOUCHING_SPACES = r"[\s\v\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]{2}"   # in Arrow's syntax


class Vocabulary:
    """Ranks of byte strings, and of pairs of them: left << 20 | right -> rank of the joined string."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.byte = np.array([self.rank[bytes([i])] for i in range(256)], np.int64)
        pairs = {}
        for token, r in self.rank.items():
            for i in range(1, len(token)):
                left, right = self.rank.get(token[:i]), self.rank.get(token[i:])
                if left is not None and right is not None:
                    pairs[left << 20 | right] = r
        self.pairs = pairs
        self.keys = np.array(sorted(pairs), np.int64)
        self.values = np.array([pairs[k] for k in self.keys.tolist()], np.int64)
        least = self.byte.max() + 1
        self.of_bytes = self.pair_ranks(*np.indices((least, least)))   # of two bytes' ranks
        size = max(self.rank.values()) + 1
        self.lengths = np.zeros(size, np.int64)
        for token, r in self.rank.items():
            self.lengths[r] = len(token)
        by_rank = [b""] * size
        for token, r in self.rank.items():
            by_rank[r] = token
        self.tokens = pa.array(by_rank, pa.large_binary())

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 20 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.values[at], NONE)

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """The bytes of each list's tokens."""
        return pc.binary_join(pa.LargeListArray.from_arrays(ids.offsets.cast("int64"), self.tokens.take(ids.values)), pa.scalar(b"", pa.large_binary()))


def merge_one(vocab: Vocabulary, word: bytes) -> list[int]:
    """Ids of one pre-token: a segment tree of (rank, place) in two flat lists."""
    n = len(word)
    size = 1 << (n - 1).bit_length()
    pairs, huge = vocab.pairs, 1 << 62
    part = vocab.byte[np.frombuffer(word, np.uint8)].tolist()
    right = list(range(1, n + 1))     # next live place
    left = list(range(-1, n - 1))
    tree = [huge] * (2 * size)        # rank << 32 | place, so that min is the leftmost smallest
    for i in range(n - 1):
        r = pairs.get(part[i] << 20 | part[i + 1])
        if r is not None:
            tree[size + i] = r << 32 | i
    for i in range(size - 1, 0, -1):
        tree[i] = min(tree[2 * i], tree[2 * i + 1])

    def update(i: int, value: int) -> None:
        i += size
        tree[i] = value
        while i > 1:
            i >>= 1
            a, b = tree[2 * i], tree[2 * i + 1]
            low = a if a < b else b
            if tree[i] == low:
                break
            tree[i] = low

    def rank(i: int) -> int:
        j = right[i]
        r = pairs.get(part[i] << 20 | part[j]) if j < n else None
        return huge if r is None else r << 32 | i

    while tree[1] < huge:
        r, i = tree[1] >> 32, tree[1] & 0xFFFFFFFF
        j = right[i]
        part[i] = r
        right[i] = right[j]
        if right[j] < n:
            left[right[j]] = i
        part[j] = -1
        update(j, huge)
        update(i, rank(i))
        if left[i] >= 0:
            update(left[i], rank(left[i]))
    return [p for p in part if p >= 0]


def merge_many(vocab: Vocabulary, words: list[bytes], size: int) -> list[np.ndarray]:
    """Ids of many pre-tokens of at most ``size`` (a power of two) bytes."""
    ids, ends = merged(vocab, words, size)
    return np.split(ids, ends[:-1])


def merged(vocab: Vocabulary, words: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all the pre-tokens and where each one's end: one tree a row, all merged in step."""
    m = len(words)
    raw = np.frombuffer(b"".join(w.ljust(size, b"\0") for w in words), np.uint8).reshape(m, size)
    n = np.fromiter(map(len, words), np.int64, m)
    place = np.arange(size)
    part = np.where(place < n[:, None], vocab.byte[raw], -1)
    right = np.broadcast_to(place + 1, (m, size)).copy()
    left = np.broadcast_to(place - 1, (m, size)).copy()
    none = NONE << 8
    tree = np.full((m, 2 * size), none)
    if size > 1:
        r = np.where(place[1:] < n[:, None], vocab.of_bytes[vocab.byte[raw[:, :-1]], vocab.byte[raw[:, 1:]]], NONE)
        tree[:, size:-1] = np.where(r < NONE, r << 8 | place[:-1], none)
    level = size
    while level > 1:
        level >>= 1
        tree[:, level:2 * level] = np.minimum(tree[:, 2 * level:4 * level:2], tree[:, 2 * level + 1:4 * level:2])
    # one flat array each, and the places of a row's entries in it
    part, right, left, tree = (x.ravel() for x in (part, right, left, tree))

    def update(rows: np.ndarray, at: np.ndarray, value) -> None:
        base, at = rows * (2 * size), at + size
        tree[base + at] = value
        level = size
        while level > 1:
            level >>= 1
            at = at >> 1
            below = base + 2 * at
            tree[base + at] = np.minimum(tree.take(below), tree.take(below + 1))

    def rank(rows: np.ndarray, i: np.ndarray) -> np.ndarray:
        base = rows * size
        j = right.take(base + i)
        r = vocab.pair_ranks(part.take(base + i), np.where(j < size, part.take(base + np.minimum(j, size - 1)), -1))
        return np.where(r < NONE, r << 8 | i, none)

    rows = np.flatnonzero(tree[1::2 * size] < none)
    while rows.size:
        top = tree.take(rows * (2 * size) + 1)
        i = top & 0xFF
        base = rows * size
        j = right.take(base + i)
        part[base + i] = top >> 8
        part[base + j] = -1
        after = right.take(base + j)
        right[base + i] = after
        live = after < size
        left[base[live] + after[live]] = i[live]
        update(rows, j, none)
        update(rows, i, rank(rows, i))
        before = left.take(base + i)
        has = before >= 0
        update(rows[has], before[has], rank(rows[has], before[has]))
        rows = rows[tree.take(rows * (2 * size) + 1) < none]
    part = part.reshape(m, size)
    alive = part >= 0
    return part[alive], np.cumsum(alive.sum(1))


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@cache
def encoder(path: str, pattern: str) -> Callable[[str], np.ndarray]:
    """A function from a list of texts to their ids."""
    import regex

    vocab = vocabulary(path)
    split = regex.compile(pattern)
    words: dict[str, bytes] = {}     # ids, four bytes each
    chunks: dict[str, bytes] = {}

    def learn(new: set[str]) -> None:
        sizes: dict[int, list[str]] = {}
        raw = {w: w.encode() for w in new}
        for w, b in raw.items():
            if b in vocab.rank:
                words[w] = np.array([vocab.rank[b]], "<i4").tobytes()
            elif len(b) > LONGEST_BATCHED:
                words[w] = np.array(merge_one(vocab, b), "<i4").tobytes()
            else:
                sizes.setdefault(max(2, 1 << (len(b) - 1).bit_length()), []).append(w)
        for size, each in sizes.items():
            for i in range(0, len(each), TOGETHER):
                part = each[i:i + TOGETHER]
                ids, ends = merged(vocab, [raw[w] for w in part], size)
                ids, a = ids.astype("<i4").tobytes(), 0
                for w, b in zip(part, (4 * ends).tolist(), strict=True):
                    words[w] = ids[a:b]
                    a = b

    def cut(chunk: str) -> list[str]:
        """Its pre-tokens; a space and letters alone are one."""
        return [chunk] if chunk[:1] == " " and chunk[1:].isalpha() else split.findall(chunk)

    held = 0   # bytes of chunks and words

    def encode(texts: list[str] | pa.Array) -> list[np.ndarray]:
        """Where no two white-space characters touch, a space starts its word's pre-token, so a text is cut before each
        space; others are one chunk."""
        nonlocal held
        if held > CACHED_BYTES:
            chunks.clear()
            words.clear()
            held = 0
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        spaced = pc.if_else(pc.match_substring_regex(texts, TOUCHING_SPACES), "", texts)
        parts = pc.split_pattern(spaced, " ")
        starts = parts.offsets.to_numpy()
        numbered = parts.flatten().dictionary_encode()
        distinct = [" " + x for x in numbered.dictionary.to_numpy(zero_copy_only=False)]
        # a text's first part has no space before it
        firsts = [t if not s else s.partition(" ")[0] for s, t in zip(spaced.to_pylist(), texts.to_pylist(), strict=True)]
        numbers = numbered.indices.to_numpy().copy()
        numbers[starts[:-1]] = len(distinct) + np.arange(len(firsts))
        # parts that only come first are not needed with a space
        used = np.bincount(numbers, minlength=len(distinct) + len(firsts)) > 0
        all_chunks = distinct + firsts
        ids = [chunks.get(c) if u else b"" for c, u in zip(all_chunks, used.tolist(), strict=True)]
        new = {all_chunks[i]: None for i, x in enumerate(ids) if x is None}
        pieces = {c: cut(c) for c in new}
        fresh = {p for ps in pieces.values() for p in ps}.difference(words)
        learn(fresh)
        made = {c: b"".join([words[p] for p in ps]) if len(ps) != 1 else words[ps[0]] for c, ps in pieces.items()}
        ids = [made[c] if x is None else x for c, x in zip(all_chunks, ids, strict=True)]
        at, ends = list_places(np.fromiter(map(len, ids), np.int64, len(ids)) // 4, numbers)
        out = np.split(np.frombuffer(b"".join(ids), "<i4")[at], ends[starts[1:-1]])[:len(texts)]
        for c, x in made.items():
            if len(c) <= LONGEST_KEPT:
                chunks[c] = x
                held += 16 * len(c) + ENTRY_BYTES
        for w in fresh:
            if len(w) > LONGEST_KEPT:
                del words[w]
        return out

    return encode


def encode_texts(docs: DataFrame, ranks: str, pattern: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` plus the ids (array<int>) of the whole text; null counts as empty and has no ids.

    ``ranks``: path of a file of base64 tokens and ranks, the same on every executor.
    """
    small_arrow_batches(docs.sparkSession)

    @F.arrow_udf("array<int>")
    def of(texts: pa.Array) -> pa.Array:
        ids = encoder(ranks, pattern)(texts)
        ends = np.cumsum([0, *map(len, ids)])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, "<i4"), *ids])))

    return docs.withColumn(out, of(text_of(docs, text_col)))


def decode_ids(docs: DataFrame, ranks: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` plus the bytes that the ids stand for; null ids give empty bytes."""
    @F.arrow_udf("binary")
    def of(ids: pa.Array) -> pa.Array:
        return vocabulary(ranks).decode(ids).cast(pa.binary())

    return docs.withColumn(out, of(docs[ids_col]))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    ranks = P.path("byte_bpe_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = decode_ids(encode_texts(docs, ranks, P.PATTERN), ranks)
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
