"""Linear-chain conditional random fields over batches of sequences.

Sequences lie one after another in flat arrays. A step handles position t of
all sequences that are longer than t, so the loop runs over positions and the
work is done by array operations.
"""

from __future__ import annotations

import numpy as np


def _plan(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the sequences, longest first, and how many are longer than t."""
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    order = np.argsort(-lengths, kind="stable")
    ranked = lengths[order]
    longest = int(ranked[0]) if len(ranked) else 0
    alive = np.searchsorted(-ranked, -np.arange(longest), side="left")
    return starts[order], alive


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def marginals(scores: np.ndarray, moves: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Forward-backward. ``scores`` (positions x states) and ``moves`` (state
    to state) are log potentials; returns each position's state probabilities,
    the expected moves, and the sum of the log partition functions."""
    starts, alive = _plan(lengths)
    fwd, bwd = np.empty_like(scores), np.zeros_like(scores)
    expected, norm = np.zeros_like(moves), 0.0
    for t, n in enumerate(alive):
        p = starts[:n] + t
        fwd[p] = scores[p] + (_lse(fwd[p - 1][:, :, None] + moves[None], 1) if t else 0.0)
    last = np.concatenate([[0], np.cumsum(lengths)])[1:] - 1
    last = last[lengths > 0]
    norm = float(_lse(fwd[last], 1).sum()) if len(last) else 0.0
    for t in range(len(alive) - 1, 0, -1):
        p = starts[:alive[t]] + t
        out = scores[p] + bwd[p]
        both = fwd[p - 1][:, :, None] + moves[None] + out[:, None, :]
        flat = both.reshape(len(p), -1)
        expected += np.exp(flat - _lse(flat, 1)[:, None]).sum(axis=0).reshape(moves.shape)
        bwd[p - 1] = _lse(moves[None] + out[:, None, :], 2)
    total = fwd + bwd
    return np.exp(total - _lse(total, 1)[:, None]), expected, norm


def viterbi(scores: np.ndarray, moves: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The states of the best path of each sequence; ties go to the lower state."""
    starts, alive = _plan(lengths)
    best, back = scores.copy(), np.zeros(scores.shape, dtype=np.int8)
    for t, n in enumerate(alive):
        if t:
            p = starts[:n] + t
            both = best[p - 1][:, :, None] + moves[None]
            back[p] = both.argmax(axis=1)
            best[p] += both.max(axis=1)
    states = np.zeros(len(scores), dtype=np.int8)
    for t in range(len(alive) - 1, -1, -1):
        p = starts[:alive[t]] + t
        after = alive[t + 1] if t + 1 < len(alive) else 0
        states[p[after:]] = best[p[after:]].argmax(axis=1)
        if after:
            q = p[:after]
            states[q] = back[q + 1, states[q + 1]]
    return states


def fit(x: np.ndarray, states: np.ndarray, lengths: np.ndarray, n_states: int, steps: int = 60,
        rate: float = 0.1, l2: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Weights (features x states) and moves of largest penalised likelihood,
    by gradient steps with momentum and per-weight scale; deterministic."""
    n = len(x)
    gold = np.zeros((n, n_states))
    gold[np.arange(n), states] = 1
    inner = np.ones(n, dtype=bool)
    inner[np.concatenate([[0], np.cumsum(lengths)[:-1]])[lengths > 0]] = False
    at = np.flatnonzero(inner)
    gold_moves = np.zeros((n_states, n_states))
    np.add.at(gold_moves, (states[at - 1], states[at]), 1)
    theta = [np.zeros((x.shape[1], n_states)), np.zeros((n_states, n_states))]
    mean, var = [np.zeros_like(w) for w in theta], [np.zeros_like(w) for w in theta]
    for step in range(1, steps + 1):
        prob, moved, _ = marginals(x @ theta[0], theta[1], lengths)
        grads = [x.T @ (prob - gold) / n + l2 * theta[0], (moved - gold_moves) / n + l2 * theta[1]]
        for w, g, m, v in zip(theta, grads, mean, var):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return theta[0], theta[1]
