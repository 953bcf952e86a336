"""A block of vectors as an inverted multi-index, searched until a window is certified. Numpy only."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np

#: Codes of each half-space codebook.
CODES = 16
ROUNDS = 10
#: Sums of products below this are exact in double precision.
EXACT = 2.0**53
#: Rows of the first cells that are scored at once, and of later ones at most.
FIRST, MOST = 128, 4096


def fit_codebooks(sample: np.ndarray, codes: int = CODES, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of the first and of the second half of the components, by k-means."""
    half = sample.shape[1] // 2
    return tuple(_centroids(part.astype(float), codes, seed) for part in (sample[:, :half], sample[:, half:]))


def _centroids(points: np.ndarray, codes: int, seed: int) -> np.ndarray:
    if not points.shape[0] or not points.shape[1]:
        return np.zeros((1, points.shape[1]))
    distinct = np.unique(points, axis=0)
    rng = np.random.default_rng(seed)
    centres = distinct[rng.permutation(len(distinct))[:codes]]
    for _ in range(ROUNDS):
        nearest = assign(points, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        held = np.bincount(nearest, minlength=len(centres))
        centres = np.where(held[:, None] > 0, sums / np.maximum(held, 1)[:, None], centres)
    return centres


def assign(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The nearest centre of every point."""
    return np.argmin((centres**2).sum(axis=1) - 2 * points @ centres.T, axis=1)


def products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products of large integers; beyond 64 bits the nearest 64-bit number."""
    ends = np.iinfo(np.int64)
    whole = [sum(int(a) * int(b) for a, b in zip(row, query)) for row in vectors]
    return np.array([min(max(s, ends.min), ends.max) for s in whole], np.int64)


class MultiIndex:
    """Vectors in cells, one for each pair of half codes.

    The score of a vector in cell (i, j) is at most the sum of two half-score bounds:
    the query half's product with the centroid, plus its length times the radius, which
    is the largest distance from the centroid among this block's members.
    """

    def __init__(self, vectors: np.ndarray, books: tuple[np.ndarray, np.ndarray]):
        self.books = books
        half = books[0].shape[1]
        halves = vectors[:, :half].astype(float), vectors[:, half:].astype(float)
        codes = [assign(part, book) for part, book in zip(halves, books)]
        self.radii = []
        for part, book, code in zip(halves, books, codes):
            radius = np.full(len(book), -1.0)  # codes without members
            np.maximum.at(radius, code, np.sqrt(((part - book[code]) ** 2).sum(axis=1)))
            self.radii.append(radius)
        cells = codes[0] * len(books[1]) + codes[1]
        self.order = np.argsort(cells, kind="stable")
        count = len(books[0]) * len(books[1])
        self.starts = np.searchsorted(cells[self.order], np.arange(count + 1)).tolist()
        self.vectors = vectors[self.order].astype(np.int64)
        self.doubles = self.vectors.astype(float)
        self.largest = float(np.abs(self.doubles).max(initial=0)) * vectors.shape[1]

    def _scores(self, places: np.ndarray, query: np.ndarray) -> np.ndarray:
        if self.largest * float(np.abs(query).max(initial=0)) < EXACT:
            return (self.doubles[places] @ query.astype(float)).astype(np.int64)
        return products(self.vectors[places], query)

    def _bounds(self, half: int, query: np.ndarray) -> tuple[np.ndarray, list[float]]:
        """Codes with members in falling order of their half-score bounds, and the bounds."""
        codes = np.flatnonzero(self.radii[half] >= 0)
        found = self.books[half][codes] @ query + np.sqrt((query**2).sum()) * self.radii[half][codes]
        found += 1e-9 * (1 + np.abs(found))  # rounding
        order = np.argsort(-found, kind="stable")
        return codes[order], found[order].tolist()

    def visit(self, query: np.ndarray) -> Iterator[tuple[float, np.ndarray, np.ndarray]]:
        """(bound, rows, scores) of the cells with members, in falling order of bound.

        Multi-sequence search: both lists of half codes are sorted by their bounds, and a
        heap holds the borders of what has been visited. A cell is pushed when the cells
        before it in both lists are out. Cells are scored some at a time, twice as many
        rows each time; the bound is the one of the first of them.
        """
        whole = query.astype(float)
        half = self.books[0].shape[1]
        orders, lists = zip(self._bounds(0, whole[:half]), self._bounds(1, whole[half:]))
        if not lists[0] or not lists[1]:
            return
        width = len(self.books[1])
        ones, others = lists
        codes = [o.tolist() for o in orders]
        heap, done = [(-(ones[0] + others[0]), 0, 0)], [0] * len(ones)  # cells out in each line
        cells, held, limit, top = [], 0, FIRST, None
        while heap:
            bound, i, j = heapq.heappop(heap)
            done[i] = j + 1
            cell = codes[0][i] * width + codes[1][j]
            first, last = (self.starts[cell], self.starts[cell + 1])
            if last > first:
                top = -bound if top is None else top
                cells.append(np.arange(first, last))
                held += last - first
                if held >= limit:
                    places = np.concatenate(cells)
                    yield top, self.order[places], self._scores(places, query)
                    cells, held, limit, top = [], 0, min(2 * limit, MOST), None
            # a line goes on below what the line before it has out; the next line starts with it
            if j + 1 < len(others) and (i == 0 or done[i - 1] > j + 1):
                heapq.heappush(heap, (-(ones[i] + others[j + 1]), i, j + 1))
            if i + 1 < len(ones) and done[i + 1] == j:
                heapq.heappush(heap, (-(ones[i + 1] + others[j]), i + 1, j))
        if cells:
            places = np.concatenate(cells)
            yield top, self.order[places], self._scores(places, query)


class Window:
    """The best rows with low <= score <= high, by falling score and rising id."""

    def __init__(self, low: int | None, high: int | None, size: int):
        self.low, self.high, self.size = low, high, size
        self.best: list[tuple[int, int]] = []

    def least(self) -> float:
        """A score below this one cannot enter; the window is certified below such a bound."""
        low = -np.inf if self.low is None else self.low
        return max(low, -self.best[-1][0]) if len(self.best) == self.size else low

    def add(self, scores: np.ndarray, rows: np.ndarray, members: list[list[int]]) -> None:
        inside = scores >= self.least()
        if self.high is not None:
            inside &= scores <= self.high
        at = np.flatnonzero(inside)
        if len(at):
            found = [(-int(scores[i]), m) for i in at for m in members[rows[i]]]
            self.best = heapq.nsmallest(self.size, self.best + found)


def fill(index: MultiIndex, query: np.ndarray, windows: list[Window], allowed, members) -> int:
    """Visit cells until every window is certified; returns the number of rows scored.

    ``allowed`` marks the rows of the block that count, ``members`` has their ids.
    """
    scored = 0
    for bound, rows, scores in index.visit(query):
        open_ = [w for w in windows if bound >= w.least()]
        if not open_:
            break
        scored += len(rows)
        kept = allowed[rows]
        if kept.any():
            rows, scores = rows[kept], scores[kept]
            for window in open_:
                window.add(scores, rows, members)
    return scored
