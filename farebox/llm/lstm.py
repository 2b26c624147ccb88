"""A small bidirectional LSTM that labels every item of a sequence, in numpy."""

from __future__ import annotations

import numpy as np

Weights = dict[str, np.ndarray]


def initial(inputs: int, dense: int, hidden: int, seed: int) -> Weights:
    rng = np.random.default_rng(seed)

    def matrix(rows: int, columns: int) -> np.ndarray:
        return (rng.standard_normal((rows, columns)) / np.sqrt(rows)).astype(np.float32)

    weights = {"dense": matrix(inputs, dense), "dense_bias": np.zeros(dense, dtype=np.float32)}
    for side in ("f", "b"):
        weights[f"{side}_in"] = matrix(dense, 4 * hidden)
        weights[f"{side}_own"] = matrix(hidden, 4 * hidden)
        bias = np.zeros(4 * hidden, dtype=np.float32)
        bias[hidden : 2 * hidden] = 1  # forget gates start open
        weights[f"{side}_bias"] = bias
    weights["out"] = matrix(2 * hidden + dense, 1)
    weights["out_bias"] = np.zeros(1, dtype=np.float32)
    return weights


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _run(weights: Weights, side: str, gates_in: np.ndarray, mask: np.ndarray, keep: bool):
    """Hidden states (time, batch, hidden) in the order of ``gates_in``; padding keeps the state."""
    steps, batch, four = gates_in.shape
    hidden = four // 4
    h = np.zeros((batch, hidden), dtype=np.float32)
    c = np.zeros_like(h)
    states = np.empty((steps, batch, hidden), dtype=np.float32)
    tape = []
    own = weights[f"{side}_own"]
    for t in range(steps):
        z = gates_in[t] + h @ own
        i, f, o = (_sigmoid(z[:, k * hidden : (k + 1) * hidden]) for k in (0, 1, 2))
        g = np.tanh(z[:, 3 * hidden :])
        m = mask[t][:, None]
        c_new = f * c + i * g
        squashed = np.tanh(c_new)
        if keep:
            tape.append((i, f, o, g, c, h, squashed, m))
        h = np.where(m, o * squashed, h)
        c = np.where(m, c_new, c)
        states[t] = h
    return states, tape


def scores(weights: Weights, items: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Probabilities (time, batch) of padded sequences (time, batch, inputs)."""
    return _forward(weights, items, mask, False)[0]


def _forward(weights: Weights, items: np.ndarray, mask: np.ndarray, keep: bool):
    dense = np.tanh(items @ weights["dense"] + weights["dense_bias"])
    ahead, tape_f = _run(weights, "f", dense @ weights["f_in"] + weights["f_bias"], mask, keep)
    back, tape_b = _run(weights, "b", (dense @ weights["b_in"] + weights["b_bias"])[::-1], mask[::-1], keep)
    joined = np.concatenate([ahead, back[::-1], dense], axis=2)
    out = _sigmoid((joined @ weights["out"])[..., 0] + weights["out_bias"])
    return out, (dense, joined, tape_f, tape_b)


def _unrun(weights: Weights, side: str, d_states: np.ndarray, tape: list, dense: np.ndarray, grads: Weights) -> np.ndarray:
    """Backward through ``_run``: adds to ``grads``, returns the gradient of its dense inputs."""
    steps, batch, hidden = d_states.shape
    own = weights[f"{side}_own"]
    d_h = np.zeros((batch, hidden), dtype=np.float32)
    d_c = np.zeros_like(d_h)
    d_z = np.zeros((steps, batch, 4 * hidden), dtype=np.float32)
    for t in reversed(range(steps)):
        i, f, o, g, c, h, squashed, m = tape[t]
        total = d_h + d_states[t]
        d_new = np.where(m, total, 0)
        d_cell = np.where(m, d_c, 0) + d_new * o * (1 - squashed**2)
        d_z[t] = np.concatenate(
            [d_cell * g * i * (1 - i), d_cell * c * f * (1 - f), d_new * squashed * o * (1 - o), d_cell * i * (1 - g**2)],
            axis=1,
        )
        grads[f"{side}_own"] += h.T @ d_z[t]
        d_h = d_z[t] @ own.T + np.where(m, 0, total)
        d_c = d_cell * f + np.where(m, 0, d_c)
    flat = d_z.reshape(-1, 4 * hidden)
    grads[f"{side}_in"] += dense.reshape(len(flat), -1).T @ flat
    grads[f"{side}_bias"] += flat.sum(axis=0)
    return d_z @ weights[f"{side}_in"].T


def gradients(weights: Weights, items: np.ndarray, mask: np.ndarray, labels: np.ndarray) -> Weights:
    """Of the mean cross entropy over the items that are not padding."""
    grads = {k: np.zeros_like(v) for k, v in weights.items()}
    out, (dense, joined, tape_f, tape_b) = _forward(weights, items, mask, True)
    hidden = weights["f_own"].shape[0]
    error = np.where(mask, out - labels, 0).astype(np.float32) / max(1, int(mask.sum()))
    grads["out"] += (joined.reshape(-1, joined.shape[2]).T @ error.reshape(-1, 1))
    grads["out_bias"] += error.sum()
    d_joined = error[..., None] * weights["out"][:, 0]
    d_dense = d_joined[..., 2 * hidden :].copy()
    d_dense += _unrun(weights, "f", d_joined[..., :hidden], tape_f, dense, grads)
    d_dense += _unrun(weights, "b", d_joined[..., hidden : 2 * hidden][::-1], tape_b, dense[::-1], grads)[::-1]
    d_pre = (d_dense * (1 - dense**2)).reshape(-1, dense.shape[2])
    grads["dense"] += items.reshape(len(d_pre), -1).T @ d_pre
    grads["dense_bias"] += d_pre.sum(axis=0)
    return grads


def padded(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(time, batch, inputs) and its mask."""
    steps = max(map(len, sequences))
    items = np.zeros((steps, len(sequences), sequences[0].shape[1]), dtype=np.float32)
    mask = np.zeros((steps, len(sequences)), dtype=bool)
    for b, sequence in enumerate(sequences):
        items[: len(sequence), b] = sequence
        mask[: len(sequence), b] = True
    return items, mask


def train(
    sequences: list[np.ndarray], labels: list[np.ndarray], dense: int, hidden: int, epochs: int, batch: int = 24,
    rate: float = 0.01, seed: int = 1,
) -> Weights:
    """Adam over shuffled batches of sequences of like length. The same input gives the same weights."""
    weights = initial(sequences[0].shape[1], dense, hidden, seed)
    first, second = ({k: np.zeros_like(v) for k, v in weights.items()} for _ in range(2))
    rng, step = np.random.default_rng(seed), 0
    by_size = sorted(range(len(sequences)), key=lambda i: len(sequences[i]))
    batches = [by_size[a : a + batch] for a in range(0, len(by_size), batch)]
    total = epochs * len(batches)
    for _ in range(epochs):
        for at in rng.permutation(len(batches)):
            items, mask = padded([sequences[i] for i in batches[at]])
            target = padded([labels[i][:, None] for i in batches[at]])[0][..., 0]
            grads = gradients(weights, items, mask, target)
            norm = np.sqrt(sum(float((g**2).sum()) for g in grads.values()))
            step += 1
            for k, g in grads.items():
                g = g / max(1.0, norm)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g**2
                slope = (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
                weights[k] = (weights[k] - rate * (1 - 0.9 * step / total) * slope).astype(np.float32)
    return weights
