"""Double-array trie over words: each word's number is spelled in bytes, high byte first.

The child of a node by byte ``c`` lies at ``base[node] + c``, and ``check``
there names the node.  Looking up any number of (state, word) pairs is two
array reads a byte, so numpy advances them all at once.  As no node has more
than 256 children, it never needs more than 256 slots of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

NONE = -1
TRIES = 24   # random places tried for a node before it gets slots of its own


@dataclass
class Transitions:
    """Transitions out of the states ``first``, ``first`` + 1, ...; nodes between two bytes of a word follow them."""

    first: int
    states: int          # how many states there are
    digits: int          # bytes of a word's number
    base: np.ndarray     # by node: where its children are counted from
    check: np.ndarray    # by slot: the node that owns it, or NONE
    child: np.ndarray    # by slot: the node behind it, or after the last byte the state

    def advance(self, states: np.ndarray, words: np.ndarray) -> np.ndarray:
        """The states reached, 0 where there is no such transition."""
        node = states - self.first
        ok = (node >= 0) & (node < self.states) & (words >> 8 * self.digits == 0)
        node = np.where(ok, node, 0)
        for d in reversed(range(self.digits)):
            slot = self.base[node] + (words >> 8 * d & 255)
            ok &= self.check[slot] == node
            node = np.where(ok, self.child[slot], 0)
        return node


def build(states: np.ndarray, words: np.ndarray, children: np.ndarray) -> Transitions:
    """From distinct (state, word) pairs, at least one; words are numbers from 1 on."""
    first, states_ = int(states.min()), int(states.max() - states.min()) + 1
    digits = max(1, (int(words.max()).bit_length() + 7) // 8)
    node, words, top = states.astype(np.int64) - first, words.astype(np.int64), states_
    parents, bytes_, targets = [], [], []
    for d in reversed(range(digits)):
        edge = node << 8 | (words >> 8 * d & 255)
        if d:
            edge, node = np.unique(edge, return_inverse=True)
            node = node + top
            targets.append(top + np.arange(len(edge)))
            top += len(edge)
        else:
            targets.append(children)
        parents.append(edge >> 8)
        bytes_.append(edge & 255)
    parent, byte, target = (np.concatenate(x) for x in (parents, bytes_, targets))
    order = np.argsort(parent, kind="stable")
    parent, byte, target = parent[order], byte[order], target[order]
    owners, start, size = np.unique(parent, return_index=True, return_counts=True)
    place, slots = _placed(start, size, byte)
    base = np.zeros(top, np.int32)
    base[owners] = place
    check, child = np.full(slots, NONE, np.int32), np.zeros(slots, np.int32)
    at = np.repeat(place, size) + byte
    check[at], child[at] = parent, target
    return Transitions(first, states_, digits, base, check, child)


def _placed(start: np.ndarray, size: np.ndarray, byte: np.ndarray) -> tuple[np.ndarray, int]:
    """A base for each node such that no two children share a slot, and the number of slots.

    Nodes of many children first: all nodes of about the same size try random
    bases together, those that find free slots keep them, and after ``TRIES``
    rounds the rest get slots behind all others.  A single child fits any slot,
    so those fill the gaps in one step.
    """
    rng = np.random.default_rng(7)
    used = np.zeros(2 * len(byte) + 1024, bool)
    owner = np.zeros(len(used), np.int64)
    place = np.zeros(len(start), np.int64)
    high = 256
    while high > 1:
        left = np.flatnonzero((size <= high) & (size > max(1, high // 2)))
        high //= 2
        for turn in range(TRIES + 1):
            if not len(left):
                break
            n = size[left]
            rows = np.repeat(np.arange(len(left)), n)
            cuts = np.cumsum(n) - n
            flat = byte[np.arange(len(rows)) - np.repeat(cuts - start[left], n)]
            if turn == TRIES:
                end = len(used)
                used = np.concatenate([used, np.zeros(256 * len(left), bool)])
                owner = np.concatenate([owner, np.zeros(256 * len(left), np.int64)])
                base = end + 256 * np.arange(len(left))
            else:
                base = rng.integers(1, len(used) - 256, len(left))
            at = base[rows] + flat
            owner[at] = rows   # of several on one slot the last stays
            fits = np.logical_and.reduceat(~used[at] & (owner[at] == rows), cuts)
            used[at[fits[rows]]] = True
            place[left[fits]] = base[fits]
            left = left[~fits]
    single = np.flatnonzero(size == 1)
    gaps = np.flatnonzero(~used[256:])[:len(single)] + 256
    gaps = np.concatenate([gaps, len(used) + np.arange(len(single) - len(gaps))])
    place[single] = gaps - byte[start[single]]
    return place, max(len(used), int(gaps[-1]) + 1 if len(gaps) else 0) + 256
