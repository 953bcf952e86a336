"""Learned partitions of a sample of vectors, and a classifier that routes to them.

The neighbour graph of the sample is cut into parts of equal size with few edges between
them; a network with one hidden layer learns which parts hold a vector's neighbours.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

NEIGHBOURS = 20
HIDDEN = 128
#: Vectors of the sample to a part; the sample's size bounds the number of parts.
PART_VECTORS = 256
SWEEPS = 12
SLACK = 1.05


def neighbour_graph(vectors: np.ndarray, k: int = NEIGHBOURS) -> np.ndarray:
    """Rows of the k others with the largest inner products."""
    n = len(vectors)
    k = min(k, n - 1)
    found = np.empty((n, k), np.int64)
    for at in range(0, n, 1024):
        scores = vectors[at : at + 1024] @ vectors.T
        scores[np.arange(len(scores)), np.arange(at, at + len(scores))] = -np.inf
        found[at : at + 1024] = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    return found


def halved(vectors: np.ndarray, parts: int) -> np.ndarray:
    """A first balanced partition: cut at quantiles along main directions, again and again."""
    labels = np.zeros(len(vectors), np.int64)
    work = [(np.arange(len(vectors)), 0, parts)]
    while work:
        rows, first, n = work.pop()
        if n == 1:
            labels[rows] = first
            continue
        centred = vectors[rows] - vectors[rows].mean(axis=0)
        direction = np.linalg.eigh(centred.T @ centred)[1][:, -1]
        order = np.argsort(centred @ direction, kind="stable")
        left = n // 2
        cut = len(rows) * left // n
        work += [(rows[order[:cut]], first, left), (rows[order[cut:]], first + left, n - left)]
    return labels


def balanced_cut(graph: np.ndarray, labels: np.ndarray, parts: int) -> np.ndarray:
    """Move vertices to the part of most neighbours while parts stay within SLACK."""
    n, limit = len(labels), int(np.ceil(len(labels) / parts * SLACK))
    labels = labels.copy()
    back: list[list[int]] = [[] for _ in range(n)]
    for i, row in enumerate(graph.tolist()):
        for j in row:
            back[j].append(i)
    around = [np.array(row + back[i]) for i, row in enumerate(graph.tolist())]
    sizes = np.bincount(labels, minlength=parts)
    for _ in range(SWEEPS):
        moved = 0
        for i in range(n):
            near = np.bincount(labels[around[i]], minlength=parts)
            own = labels[i]
            near[sizes >= limit] = -1
            best = int(near.argmax())
            if near[best] > np.count_nonzero(labels[around[i]] == own):
                sizes[own] -= 1
                sizes[best] += 1
                labels[i] = best
                moved += 1
        if moved < n / 500:
            break
    return labels


@dataclass
class Router:
    """Probabilities of the parts for vectors, and how many parts to search."""

    layers: list[np.ndarray]
    scale: float
    probes: int = 1

    def chances(self, vectors: np.ndarray) -> np.ndarray:
        first, shift, second, bias = self.layers
        hidden = np.maximum(vectors.astype(np.float32) / self.scale @ first + shift, 0)
        logits = hidden @ second + bias
        logits = np.exp(logits - logits.max(axis=1, keepdims=True))
        return logits / logits.sum(axis=1, keepdims=True)


def train_router(vectors, goals, rounds: int = 800, batch: int = 256, rate: float = 0.003, seed: int = 0) -> Router:
    """Cross-entropy against the shares of a vector's neighbours in the parts, by Adam."""
    rng = np.random.default_rng(seed)
    width, parts = vectors.shape[1], goals.shape[1]
    scale = float(np.sqrt((vectors.astype(float) ** 2).mean())) or 1.0
    layers = [
        (rng.standard_normal((width, HIDDEN)) / np.sqrt(width)).astype(np.float32),
        np.zeros(HIDDEN, np.float32),
        (rng.standard_normal((HIDDEN, parts)) / np.sqrt(HIDDEN)).astype(np.float32),
        np.zeros(parts, np.float32),
    ]
    means, squares = [np.zeros_like(x) for x in layers], [np.zeros_like(x) for x in layers]
    inputs = (vectors / scale).astype(np.float32)
    for step in range(1, rounds + 1):
        rows = rng.integers(0, len(inputs), batch)
        given = inputs[rows]
        hidden = np.maximum(given @ layers[0] + layers[1], 0)
        logits = hidden @ layers[2] + layers[3]
        chance = np.exp(logits - logits.max(axis=1, keepdims=True))
        chance /= chance.sum(axis=1, keepdims=True)
        wrong = (chance - goals[rows]) / batch
        before = (wrong @ layers[2].T) * (hidden > 0)
        now = rate * min(1.0, 2 * (1 - step / (rounds + 1)))
        for i, g in enumerate((given.T @ before, before.sum(axis=0), hidden.T @ wrong, wrong.sum(axis=0))):
            means[i] += 0.1 * (g - means[i])
            squares[i] += 0.01 * (g * g - squares[i])
            layers[i] -= now * (means[i] / (1 - 0.9**step)) / (np.sqrt(squares[i] / (1 - 0.99**step)) + 1e-8)
    return Router(layers, scale)


def fit(vectors: np.ndarray, recall: float, seed: int = 0) -> Router:
    """Cut the sample's neighbour graph, train the router, and set the number of probes.

    A fifth of the sample is left out of training; probes are the fewest with which the
    left-out vectors find the share ``recall`` of their true neighbours.
    """
    parts = max(1, len(vectors) // PART_VECTORS)
    if parts == 1:
        return Router([np.zeros((vectors.shape[1], 1), np.float32), np.zeros(1, np.float32),
                       np.zeros((1, 1), np.float32), np.zeros(1, np.float32)], 1.0)
    graph = neighbour_graph(vectors)
    labels = balanced_cut(graph, halved(vectors, parts), parts)
    goals = np.zeros((len(vectors), parts), np.float32)
    for column in graph.T:
        goals[np.arange(len(vectors)), labels[column]] += 1 / graph.shape[1]
    held = np.arange(len(vectors)) % 5 == 0
    router = train_router(vectors[~held], goals[~held], seed=seed)
    chances = router.chances(vectors)
    home = chances.argmax(axis=1)
    order = np.argsort(-chances[held], axis=1)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(parts)[None, :], axis=1)
    needed = np.take_along_axis(place, home[graph[held]], axis=1)
    found = np.cumsum(np.bincount(needed.ravel(), minlength=parts)) / needed.size
    router.probes = int(np.argmax(found >= recall)) + 1
    return router
