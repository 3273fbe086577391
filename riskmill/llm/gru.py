"""A bidirectional gated recurrent network with attention pooling, in numpy.

Inputs are (steps, rows, features) with a mask of real steps; the result is one logit
per row. ``loss_and_gradients`` is back-propagation through time written out by hand; the tests hold it
against finite differences.
"""

from __future__ import annotations

import numpy as np

Weights = dict[str, np.ndarray]


def new_weights(features: int, hidden: int, seed: int = 3) -> Weights:
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    weights = {}
    for side in ("f", "b"):
        weights[f"W{side}"] = draw(features, 3 * hidden)
        weights[f"U{side}"] = draw(hidden, 3 * hidden)
        weights[f"c{side}"] = np.zeros(3 * hidden, np.float32)
    weights["A"], weights["a"] = draw(2 * hidden, hidden), np.zeros(hidden, np.float32)
    weights["v"], weights["o"] = draw(hidden, 1)[:, 0], draw(2 * hidden, 1)[:, 0]
    weights["o0"] = np.zeros(1, np.float32)
    return weights


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _scan(w: Weights, side: str, x: np.ndarray, mask: np.ndarray, trace: list | None) -> np.ndarray:
    """States of one direction in the order of ``x``; masked steps keep the state before them."""
    steps, rows, _ = x.shape
    size = w[f"U{side}"].shape[0]
    given = x @ w[f"W{side}"] + w[f"c{side}"]
    recurrent, state = w[f"U{side}"], np.zeros((rows, size), x.dtype)
    out = np.empty((steps, rows, size), x.dtype)
    for t in range(steps):
        pushed = state @ recurrent
        gates = _sigmoid(given[t, :, : 2 * size] + pushed[:, : 2 * size])
        update, reset = gates[:, :size], gates[:, size:]
        fresh = np.tanh(given[t, :, 2 * size :] + reset * pushed[:, 2 * size :])
        step = (1 - update) * (fresh - state) * mask[t][:, None]
        if trace is not None:
            trace.append((state, update, reset, fresh, pushed[:, 2 * size :]))
        state = state + step
        out[t] = state
    return out


def _unscan(w: Weights, side: str, x: np.ndarray, mask: np.ndarray, trace: list, upstream: np.ndarray, grads: Weights) -> None:
    size = w[f"U{side}"].shape[0]
    W, U, c = np.zeros_like(w[f"W{side}"]), np.zeros_like(w[f"U{side}"]), np.zeros_like(w[f"c{side}"])
    later = np.zeros_like(upstream[0])
    for t in range(len(x) - 1, -1, -1):
        state, update, reset, fresh, pushed = trace[t]
        total = upstream[t] + later
        step = total * mask[t][:, None]
        d_fresh = step * (1 - update) * (1 - fresh * fresh)
        d_update = -step * (fresh - state) * update * (1 - update)
        d_reset = d_fresh * pushed * reset * (1 - reset)
        to_given = np.concatenate([d_update, d_reset, d_fresh], axis=1)
        to_pushed = np.concatenate([d_update, d_reset, d_fresh * reset], axis=1)
        W += x[t].T @ to_given
        c += to_given.sum(axis=0)
        U += state.T @ to_pushed
        later = total - step * (1 - update) + to_pushed @ w[f"U{side}"].T
    grads[f"W{side}"], grads[f"U{side}"], grads[f"c{side}"] = W, U, c


def _forward(w: Weights, x: np.ndarray, mask: np.ndarray, traces: list | None = None):
    ahead = _scan(w, "f", x, mask, traces[0] if traces else None)
    back = _scan(w, "b", x[::-1], mask[::-1], traces[1] if traces else None)[::-1]
    states = np.concatenate([ahead, back], axis=2)
    looked = np.tanh(states @ w["A"] + w["a"])
    marks = np.where(mask > 0, looked @ w["v"], -1e9)
    share = np.exp(marks - marks.max(axis=0))
    share = share / share.sum(axis=0)
    pooled = (share[:, :, None] * states).sum(axis=0)
    return pooled @ w["o"] + w["o0"][0], states, looked, share, pooled


def logits(w: Weights, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
    return _forward(w, x, mask)[0]


def loss_and_gradients(w: Weights, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, Weights]:
    """Mean cross entropy of labels ``y`` and its gradient for every weight."""
    traces = [[], []]
    out, states, looked, share, pooled = _forward(w, x, mask, traces)
    loss = float(np.mean(np.logaddexp(0, out) - y * out))
    d_out = ((_sigmoid(out) - y) / len(y)).astype(x.dtype)
    grads: Weights = {"o": pooled.T @ d_out, "o0": np.array([d_out.sum()])}
    d_pooled = d_out[:, None] * w["o"]
    d_share = (states * d_pooled).sum(axis=2)
    d_marks = share * (d_share - (share * d_share).sum(axis=0))
    d_looked = d_marks[:, :, None] * w["v"] * (1 - looked * looked)
    grads["v"] = (looked * d_marks[:, :, None]).sum(axis=(0, 1))
    grads["A"] = np.tensordot(states, d_looked, axes=([0, 1], [0, 1]))
    grads["a"] = d_looked.sum(axis=(0, 1))
    d_states = share[:, :, None] * d_pooled + d_looked @ w["A"].T
    size = w["Uf"].shape[0]
    _unscan(w, "f", x, mask, traces[0], d_states[:, :, :size], grads)
    _unscan(w, "b", x[::-1], mask[::-1], traces[1], d_states[::-1, :, size:], grads)
    return loss, grads


def train(x: np.ndarray, mask: np.ndarray, y: np.ndarray, hidden: int, epochs: int, batch: int = 256, rate: float = 0.01) -> Weights:
    """Adam over shuffled batches of rows; the same input gives the same weights."""
    w = new_weights(x.shape[2], hidden)
    rng, step = np.random.default_rng(5), 0
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            _, grads = loss_and_gradients(w, x[:, rows], mask[:, rows], y[rows])
            step += 1
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
                w[k] = (w[k] - rate * move).astype(np.float32)
    return w
