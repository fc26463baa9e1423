"""Covering-code anchors for 64-bit fingerprints.

The anchors are the words of a direct product of perfect codes: two binary
Golay codes of length 23 (covering radius 3) and a Hamming code of length 15
(radius 1) over 61 of the bits, 2**35 anchors of covering radius 7.  A perfect
code puts every word within its radius of exactly one code word, so each
fingerprint has one home anchor.  For two fingerprints that differ in at most
``t`` bits, the second lies within radius + t of the first one's home, block
by block with at most ``t`` bits of excess in sum.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

# Length, generator polynomial (of degree check bits) and covering radius of each block's cyclic code.
BLOCKS = [(23, 0b101011100011, 3), (23, 0b101011100011, 3), (15, 0b10011, 1)]


def _remainders(length: int, poly: int) -> np.ndarray:
    """x**i mod poly for each bit i: a word is a code word when the sum over its bits is 0."""
    degree, out, r = poly.bit_length() - 1, [], 1
    for _ in range(length):
        out.append(r)
        r <<= 1
        if r >> degree:
            r ^= poly
    return np.array(out, np.int64)


@cache
def block_tables(length: int, poly: int, radius: int, threshold: int):
    """Error patterns by syndrome: (syndrome table of the low and high half, starts, patterns, excess).

    ``patterns[starts[s]:starts[s + 1]]`` are the differences to all code words
    within radius + threshold of a word of syndrome s; excess says by how many
    bits each lies beyond the radius.
    """
    rem = _remainders(length, poly)
    half = length // 2
    syndromes = []
    for bits in (rem[:half], rem[half:]):
        s = np.zeros(1, np.int64)
        for r in bits:
            s = np.concatenate([s, s ^ r])
        syndromes.append(s)
    words, weights = [], []
    for w in range(radius + threshold + 1):
        for c in combinations(range(length), w):
            words.append(sum(1 << i for i in c))
            weights.append(w)
    words, weights = np.array(words, np.int64), np.array(weights)
    s = syndromes[0][words & ((1 << half) - 1)] ^ syndromes[1][words >> half]
    order = np.lexsort((weights, s))
    starts = np.searchsorted(s[order], np.arange((1 << (poly.bit_length() - 1)) + 1))
    return half, syndromes, starts, words[order], np.maximum(weights[order] - radius, 0)


def anchors(fingerprints: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``fingerprints``, anchor) of each anchor within reach; threshold 0 gives the home anchors."""
    at = np.arange(len(fingerprints))
    anchor = np.zeros(len(at), np.int64)
    excess = np.zeros(len(at), np.int64)
    shift = 0
    for length, poly, radius in BLOCKS:
        half, syndromes, starts, patterns, beyond = block_tables(length, poly, radius, threshold)
        word = ((fingerprints >> np.uint64(shift)) & np.uint64((1 << length) - 1)).astype(np.int64)[at]
        s = syndromes[0][word & ((1 << half) - 1)] ^ syndromes[1][word >> half]
        n = starts[s + 1] - starts[s]
        again = np.repeat(np.arange(len(at)), n)
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + starts[s][again]
        total = excess[again] + beyond[k]
        near = total <= threshold
        again, k = again[near], k[near]
        at, excess = at[again], total[near]
        anchor = anchor[again] | ((word[again] ^ patterns[k]) << shift)
        shift += length
    return at, anchor
