"""Two-label linear-chain conditional random fields over many sequences at once.

Sequences lie one after another; ``lengths`` tells where they end. ``node`` is the log potential of label 1 over label 0 at every position,
``step`` the 2x2 log potentials of neighbouring labels.
"""

from __future__ import annotations

import numpy as np


def _order(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First positions of the sequences, longest first, and how many reach each place."""
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    starts = (np.cumsum(lengths) - lengths)[order]
    longest = int(lengths.max(initial=0))
    active = np.searchsorted(-lengths[order], -np.arange(longest), side="left")
    return starts, active


def forward_backward(node: np.ndarray, lengths: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Marginals of label 1, expected counts of neighbouring labels, and the log partition function of all sequences."""
    starts, active = _order(lengths)
    n = len(node)
    potential = np.zeros((n, 2))
    potential[:, 1] = node
    forward, backward = np.empty((n, 2)), np.zeros((n, 2))
    for t, k in enumerate(active):
        at = starts[:k] + t
        if t == 0:
            forward[at] = potential[at]
        else:
            before = forward[at - 1]
            forward[at] = np.logaddexp(before[:, :1] + step[0], before[:, 1:] + step[1]) + potential[at]
    for t in range(len(active) - 1, 0, -1):
        at = starts[: active[t]] + t
        after = backward[at] + potential[at]
        backward[at - 1] = np.logaddexp(after[:, :1] + step[:, 0], after[:, 1:] + step[:, 1])
    both = forward + backward
    total = np.logaddexp(both[:, 0], both[:, 1])
    marginal = np.exp(both[:, 1] - total)
    first = np.zeros(n, dtype=bool)
    first[starts] = True
    later = np.flatnonzero(~first)
    joint = forward[later - 1][:, :, None] + step + (potential + backward)[later][:, None, :] - total[later][:, None, None]
    return marginal, np.exp(joint).sum(axis=0), float(total[first].sum())


def fit(features: np.ndarray, lengths: np.ndarray, labels: np.ndarray, ridge: float = 1e-3, rounds: int = 150) -> tuple[np.ndarray, np.ndarray]:
    """Weights and steps of greatest penalised conditional likelihood (Adam on the whole sample); ``labels`` per position."""
    n, width = features.shape
    later = np.ones(n, dtype=bool)
    later[(np.cumsum(lengths) - lengths)[lengths > 0]] = False
    at = np.flatnonzero(later)
    seen = np.zeros((2, 2))
    np.add.at(seen, (labels[at - 1], labels[at]), 1)
    value = np.zeros(width + 4)
    mean, square = np.zeros_like(value), np.zeros_like(value)
    for k in range(1, rounds + 1):
        weights, step = value[:width], value[width:].reshape(2, 2)
        marginal, pairs, _ = forward_backward(features @ weights, lengths, step)
        slope = np.concatenate([features.T @ (marginal - labels), (pairs - seen).ravel()]) / max(n, 1) + ridge * value
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        value = value - 0.1 * (mean / (1 - 0.9**k)) / (np.sqrt(square / (1 - 0.99**k)) + 1e-8)
    return value[:width], value[width:].reshape(2, 2)
