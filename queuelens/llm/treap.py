"""K2-treap: a compressed quadtree over a (term, document) grid whose cells hold the greatest impact below them."""

from __future__ import annotations

import numpy as np


def _spread(x: np.ndarray, bits: int) -> np.ndarray:
    """Each number with its bits moved to the even places."""
    out = np.zeros(len(x), np.int64)
    for b in range(bits):
        out |= (x >> b & 1) << 2 * b
    return out


class Treap:
    """Levels 0 (the whole grid) to ``height`` (single cells); only cells with an impact exist.

    ``bits[l]`` marks which of the four quadrants of each cell of level l exist
    and ``rank[l]`` counts the marks, so the child in quadrant q of cell c is
    number ``rank[l][4 * c + q]`` of the next level.  ``most[l]`` holds the
    greatest impact inside each cell.
    """

    def __init__(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, terms: int, docs: int):
        self.height = max(1, (max(terms, docs, 2) - 1).bit_length())
        code = _spread(np.asarray(term, np.int64), self.height) << 1 | _spread(np.asarray(doc, np.int64), self.height)
        order = np.argsort(code, kind="stable")
        code, most = code[order], np.asarray(impact, np.int64)[order]
        self.most, self.bits, self.rank = [most], [], []
        for _ in range(self.height):
            up, first = np.unique(code >> 2, return_index=True)
            parent = np.repeat(np.arange(len(up)), np.diff([*first, len(code)]))
            mark = np.zeros(4 * len(up), bool)
            mark[4 * parent + (code & 3)] = True
            self.bits.insert(0, mark)
            self.rank.insert(0, np.cumsum(mark, dtype=np.int32) - mark)
            most = np.maximum.reduceat(most, first) if len(first) else most
            self.most.insert(0, most)
            code = up

    def down(self, level: int, cells: np.ndarray, quadrant: np.ndarray) -> np.ndarray:
        """The children of ``cells`` (-1: none) in their quadrants, -1 where there is none."""
        at = 4 * np.maximum(cells, 0) + quadrant
        there = (cells >= 0) & self.bits[level][at]
        return np.where(there, self.rank[level][at], -1)

    def bound(self, level: int, cells: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """For each row of ``cells``: the weighted sum of the greatest impacts."""
        return np.where(cells >= 0, self.most[level][np.maximum(cells, 0)], 0) @ weight

    def search(self, terms: np.ndarray, weight: np.ndarray, offer, least: int, beam: int = 256) -> None:
        """Offer documents best-first until no range of documents can reach ``least``.

        A node is a range of documents with the cell that each term's row path
        has reached there; its bound is the weighted sum of the cells' maxima.
        Each step takes the level with the best open node and opens its ``beam``
        best nodes together, both halves of each.  ``offer(documents, scores)``
        takes single documents, whose bound is exact, and returns the new ``least``.
        """
        if not len(self.most[-1]):
            return
        start = np.zeros((1, len(terms)), np.int64)
        open_: dict[int, tuple] = {0: (self.bound(0, start, weight), np.zeros(1, np.int64), start)}
        while open_:
            level = max(open_, key=lambda i: open_[i][0].max())
            bound, column, cells = open_.pop(level)
            if bound.max() < least:
                return
            order = np.argsort(-bound, kind="stable")
            order = order[bound[order] >= least]
            now, later = order[:beam], order[beam:]
            if len(later):
                open_[level] = (bound[later], column[later], cells[later])
            row = (terms >> (self.height - 1 - level) & 1) << 1
            both = np.concatenate([self.down(level, cells[now], row), self.down(level, cells[now], row | 1)])
            columns = np.concatenate([2 * column[now], 2 * column[now] + 1])
            bounds = self.bound(level + 1, both, weight)
            keep = bounds >= max(least, 1)
            bounds, columns, both = bounds[keep], columns[keep], both[keep]
            if not len(bounds):
                continue
            if level + 1 == self.height:
                least = offer(columns, bounds)
            elif level + 1 in open_:
                old = open_[level + 1]
                open_[level + 1] = tuple(np.concatenate(x) for x in zip(old, (bounds, columns, both), strict=True))
            else:
                open_[level + 1] = (bounds, columns, both)
