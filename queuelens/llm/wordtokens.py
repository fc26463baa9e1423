"""Word-level cache around a public tokenizer whose pre-tokens never cross white space.

The tokenizer lower-cases, drops white space and ends each word's last token
with ``</w>``; so a text's ids are its words' ids, one after the other.  Ids
are kept as little-endian bytes: a text is one join over a dictionary.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable
from functools import cache

import numpy as np

CACHED_BYTES = 96 << 20   # of remembered words and their ids in a Python worker; then it starts anew
ENTRY_BYTES = 170         # of an entry besides its word and ids
LONGEST_KEPT = 64         # bytes; a longer word (a text without spaces, say) is forgotten after its batch
TOGETHER = 64             # words encoded in one call

# What the tokenizer's own pattern cuts a lower-case ASCII word into, and the printable ASCII
# characters, which its byte alphabet leaves as they are.
ASCII_PIECES = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
PRINTABLE = bytes(range(33, 127))


@cache
def encoder(path: str) -> Callable[[list[bytes]], list[bytes]]:
    """A function from UTF-8 texts to their ids as 32-bit bytes, little-endian like the machines Spark runs on."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        suffix = json.load(f)["model"]["end_of_word_suffix"]
    ends = np.zeros(tokenizer.get_vocab_size(), bool)
    for token, i in tokenizer.get_vocab().items():
        ends[i] = token.endswith(suffix)
    known: dict[bytes, bytes] = {}
    held = 0   # bytes of known
    word_model = tokenizer.model

    def one_by_one(words: list[bytes]) -> None:
        for word, e in zip(words, tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False), strict=True):
            known[word] = array("I", e.ids).tobytes()

    def letters(words: list[bytes]) -> None:
        """Words of letters alone are one pre-token each: encode many together and cut behind each end of word."""
        parts = [words[i:i + TOGETHER] for i in range(0, len(words), TOGETHER)]
        together = tokenizer.encode_batch_fast([b" ".join(p).decode() for p in parts], add_special_tokens=False)
        for part, e in zip(parts, together, strict=True):
            ids = np.array(e.ids, "<u4")
            cuts = np.flatnonzero(ends[ids]) + 1
            if len(cuts) != len(part) or cuts[-1] != len(ids):
                one_by_one(part)
                continue
            raw, at = ids.tobytes(), 0
            for word, c in zip(part, (4 * cuts).tolist(), strict=True):
                known[word] = raw[at:c]
                at = c

    def merges(letters_: bytes) -> bytes:
        """Ids of one ASCII piece: nothing to normalise or split, the merges alone."""
        return array("I", [x.id for x in word_model.tokenize(letters_.decode())]).tobytes()

    def learn(new: set[bytes]) -> None:
        plain, other = [], []
        for w in new:
            if not w.isascii():
                (plain if w.decode().isalpha() else other).append(w)
            elif b"<" in w or w.translate(None, PRINTABLE):   # perhaps a special token, or a control character
                other.append(w)
            else:
                low = w.lower()
                known[w] = merges(low) if low.isalpha() else b"".join([known.get(p) or merges(p) for p in ASCII_PIECES.findall(low)])
        letters(plain)
        one_by_one(other)

    def encode(texts: list[bytes]) -> list[bytes]:
        nonlocal held
        if held > CACHED_BYTES:
            known.clear()
            held = 0
        # A-Z may be folded first only in ASCII texts (the tokenizer composes before it folds), and not
        # where a special token could arise from it
        words = [(t.lower() if t.isascii() and b"<|" not in t else t).split() for t in texts]
        new = set().union(*words).difference(known)
        if new:
            learn(new)
        out = [b"".join(map(known.__getitem__, w)) for w in words]
        for w in new:
            if len(w) > LONGEST_KEPT:
                del known[w]
            else:
                held += len(w) + len(known[w]) + ENTRY_BYTES
        return out

    return encode
