"""A bidirectional gated recurrent network over bytes that labels every position.

One layer each way, trained by backpropagation through time. Arrays are
(features, sequences), so that gates are contiguous blocks; sequences are columns of
``codes``, an array of (steps, sequences) bytes. A gate is 0.5 + 0.5 tanh(a) with its
weights stored at half scale, which saves a pass over the data.
"""

from __future__ import annotations

import numpy as np

BYTES = 256


def init(hidden: int, classes: int, seed: int = 0) -> dict[str, np.ndarray]:
    draw = np.random.default_rng(seed).standard_normal
    model = {"bias": np.zeros((classes, 1), np.float32)}
    for way in ("forward", "backward"):
        model[f"{way}_input"] = (0.3 * draw((3 * hidden, BYTES))).astype(np.float32)
        model[f"{way}_state"] = (draw((3 * hidden, hidden)) / np.sqrt(hidden)).astype(np.float32)
        model[f"{way}_output"] = (draw((classes, hidden)) / np.sqrt(hidden)).astype(np.float32)
    return model


def _step(given, state_weights, state):
    """New state and what the backward pass needs. ``given``: input weights of the bytes."""
    hidden = len(state)
    moved = state_weights @ state
    gates = given[: 2 * hidden]
    gates += moved[: 2 * hidden]
    np.tanh(gates, out=gates)
    reset, update, passed = gates[:hidden], gates[hidden:], moved[2 * hidden :]
    new = reset * passed
    new += passed
    new *= 0.5
    new += given[2 * hidden :]
    np.tanh(new, out=new)
    half = state - new
    half *= 0.5
    out = update * half
    out += half
    out += new
    return out, (gates, passed, new)


def _run(model, way, codes, keep=False):
    steps, sequences = codes.shape
    table, weights, output = (model[f"{way}_{part}"] for part in ("input", "state", "output"))
    state = np.zeros((weights.shape[1], sequences), np.float32)
    logits = np.empty((steps, len(output), sequences), np.float32)
    kept = []
    for t in range(steps) if way == "forward" else range(steps - 1, -1, -1):
        before = state
        state, inner = _step(np.take(table, codes[t], axis=1), weights, state)
        np.matmul(output, state, out=logits[t])
        if keep:
            kept.append((t, before, state, inner))
    return logits, kept


def probabilities(model, codes: np.ndarray) -> np.ndarray:
    """Class probabilities of every position: (steps, classes, sequences)."""
    logits = _run(model, "forward", codes)[0]
    logits += _run(model, "backward", codes)[0]
    logits += model["bias"]
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def gradients(model, codes, labels, weights) -> tuple[float, dict[str, np.ndarray]]:
    """Loss and gradients; labels and weights are per sequence and hold for its positions."""
    runs = {way: _run(model, way, codes, keep=True) for way in ("forward", "backward")}
    logits = runs["forward"][0] + runs["backward"][0] + model["bias"]
    logits -= logits.max(axis=1, keepdims=True)
    chance = np.exp(logits)
    chance /= chance.sum(axis=1, keepdims=True)
    steps, _, sequences = chance.shape
    place = (labels, np.arange(sequences))
    share = (weights / (weights.sum() * steps)).astype(np.float32)
    loss = float(-(np.log(chance[:, place[0], place[1]] + 1e-9) * share).sum())
    wrong = chance
    wrong[:, place[0], place[1]] -= 1
    wrong *= share
    found = {"bias": wrong.sum(axis=(0, 2))[:, None]}
    for way, (_, kept) in runs.items():
        state_weights, output = model[f"{way}_state"], model[f"{way}_output"]
        hidden = state_weights.shape[1]
        d_input, d_state = np.zeros_like(model[f"{way}_input"]), np.zeros_like(state_weights)
        d_output, carried = np.zeros_like(output), np.zeros((hidden, sequences), np.float32)
        for t, before, state, (gates, passed, new) in reversed(kept):
            d_output += wrong[t] @ state.T
            grown = output.T @ wrong[t] + carried
            reset, update = gates[:hidden], gates[hidden:]
            keep = 0.5 + 0.5 * update
            d_new = grown * (1 - keep) * (1 - new * new)
            d_update = grown * 0.5 * (before - new) * (1 - update * update)
            d_reset = d_new * 0.5 * passed * (1 - reset * reset)
            d_moved = np.concatenate([d_reset, d_update, d_new * (0.5 + 0.5 * reset)])
            d_given = np.concatenate([d_reset, d_update, d_new])
            d_state += d_moved @ before.T
            _add_columns(d_input, codes[t], d_given)
            carried = grown * keep + state_weights.T @ d_moved
        found |= {f"{way}_input": d_input, f"{way}_state": d_state, f"{way}_output": d_output}
    return loss, found


def _add_columns(table, codes, values):
    """table[:, codes] += values, repeated codes added up."""
    order = np.argsort(codes, kind="stable")
    names, starts = np.unique(codes[order], return_index=True)
    table[:, names] += np.add.reduceat(values[:, order], starts, axis=1)


def train(codes, labels, classes, hidden, rounds, batch, rate=0.02, seed=0):
    """Adam over random batches; classes weigh the same however many sequences they have."""
    model = init(hidden, classes, seed)
    mean = {name: np.zeros_like(value) for name, value in model.items()}
    square = {name: np.zeros_like(value) for name, value in model.items()}
    weight = 1 / np.maximum(np.bincount(labels, minlength=classes), 1)[labels]
    rng = np.random.default_rng(seed)
    for step in range(1, rounds + 1):
        chosen = rng.integers(0, codes.shape[1], batch)
        _, found = gradients(model, codes[:, chosen], labels[chosen], weight[chosen])
        size = np.sqrt(sum(float((g * g).sum()) for g in found.values()))
        now = rate * min(1.0, 2 * (1 - step / (rounds + 1)))
        for name, g in found.items():
            g = g * min(1.0, 1 / (size + 1e-9))
            mean[name] += 0.1 * (g - mean[name])
            square[name] += 0.01 * (g * g - square[name])
            fixed = mean[name] / (1 - 0.9**step)
            model[name] -= now * fixed / (np.sqrt(square[name] / (1 - 0.99**step)) + 1e-8)
    return model
