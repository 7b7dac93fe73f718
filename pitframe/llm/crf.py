"""A linear-chain conditional random field in numpy: trained by gradient ascent on padded batches, decoded by Viterbi.

Sequences come as flat arrays: ``features`` holds the feature numbers of all tokens one after another, ``starts`` where each
token's features begin (every token has at least one), and ``lengths`` how many tokens each sequence has.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Model:
    weights: np.ndarray  # features x labels
    transitions: np.ndarray  # from label x to label
    initial: np.ndarray  # labels


def _logsumexp(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(a - top).sum(axis=axis))


def emissions(model: Model, features: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(model.weights[features], starts, axis=0)


def padded(flat: np.ndarray, lengths: np.ndarray, fill=0.0) -> tuple[np.ndarray, np.ndarray]:
    """Tokens x ... to sequences x longest x ..., and the mask of real tokens."""
    mask = np.arange(lengths.max())[None, :] < lengths[:, None]
    out = np.full(mask.shape + flat.shape[1:], fill, flat.dtype)
    out[mask] = flat
    return out, mask


def log_likelihood(model: Model, score: np.ndarray, mask: np.ndarray, gold: np.ndarray):
    """Mean log likelihood of the gold labels and its gradients by emission, transition and initial score."""
    n, longest, labels = score.shape
    alpha = np.empty_like(score)
    alpha[:, 0] = model.initial + score[:, 0]
    for t in range(1, longest):
        step = _logsumexp(alpha[:, t - 1, :, None] + model.transitions, 1) + score[:, t]
        alpha[:, t] = np.where(mask[:, t, None], step, alpha[:, t - 1])
    z = _logsumexp(alpha[:, -1], 1)
    beta = np.zeros_like(score)
    pair = np.zeros_like(model.transitions)
    for t in range(longest - 2, -1, -1):
        ahead = model.transitions + (score[:, t + 1] + beta[:, t + 1])[:, None, :]
        on = mask[:, t + 1]
        beta[:, t] = np.where(on[:, None], _logsumexp(ahead, 2), beta[:, t + 1])
        both = np.exp(alpha[:, t, :, None] + ahead - z[:, None, None])
        pair += both[on].sum(0)
    marginal = np.exp(alpha + beta - z[:, None, None]) * mask[:, :, None]
    rows = np.arange(n)
    path = (model.initial[gold[:, 0]] + (np.take_along_axis(score, gold[:, :, None], 2)[:, :, 0] * mask).sum(1)
            + (model.transitions[gold[:, :-1], gold[:, 1:]] * mask[:, 1:]).sum(1))
    by_score = -marginal
    seen = np.zeros_like(score)
    np.put_along_axis(seen, gold[:, :, None], 1.0, 2)
    by_score += seen * mask[:, :, None]
    by_pair = -pair
    np.add.at(by_pair, (gold[:, :-1][mask[:, 1:]], gold[:, 1:][mask[:, 1:]]), 1.0)
    by_initial = -marginal[:, 0].sum(0)
    np.add.at(by_initial, gold[rows, 0], 1.0)
    return (path - z).mean(), by_score / n, by_pair / n, by_initial / n


def train(features: np.ndarray, starts: np.ndarray, lengths: np.ndarray, gold: np.ndarray, size: int, labels: int,
          steps: int = 150, rate: float = 0.1, decay: float = 1e-4) -> Model:
    """Adam on the mean log likelihood with a small L2 penalty; the whole labelled table is one batch."""
    model = Model(np.zeros((size, labels)), np.zeros((labels, labels)), np.zeros(labels))
    gold, _ = padded(gold, lengths, 0)
    token = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(features)]))
    parts = (model.weights, model.transitions, model.initial)
    first = [np.zeros_like(p) for p in parts]
    second = [np.zeros_like(p) for p in parts]
    for step in range(1, steps + 1):
        score, mask = padded(emissions(model, features, starts), lengths)
        _, by_score, by_pair, by_initial = log_likelihood(model, score, mask, gold)
        by_weight = np.zeros_like(model.weights)
        np.add.at(by_weight, features, by_score[mask][token])
        for p, g, m, v in zip(parts, (by_weight, by_pair, by_initial), first, second, strict=True):
            g = g - decay * p
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return model


def viterbi(model: Model, features: np.ndarray, starts: np.ndarray, lengths: np.ndarray, cells: int = 2_000_000) -> np.ndarray:
    """The best label of every token."""
    return decode(model, emissions(model, features, starts), lengths, cells)


def decode(model: Model, score: np.ndarray, lengths: np.ndarray, cells: int = 2_000_000) -> np.ndarray:
    """The best label of every token, from its emission scores. Sequences of like length are decoded together, so padding stays small."""
    begin = np.cumsum(lengths) - lengths
    result = np.zeros(len(score), np.int64)
    order = np.argsort(lengths, kind="stable")
    at = 0
    while at < len(order):
        longest = max(int(lengths[order[at]]) * 5 // 4, 8)
        end = int(np.searchsorted(lengths[order], longest, side="right"))
        end = min(end, at + max(1, cells // (longest * score.shape[1])))
        own = order[at:end]
        flat = np.concatenate([np.arange(begin[i], begin[i] + lengths[i]) for i in own])
        block, mask = padded(score[flat], lengths[own])
        n, steps, labels = block.shape
        back = np.zeros((n, steps, labels), np.int16)
        best = model.initial + block[:, 0]
        for t in range(1, steps):
            ways = best[:, :, None] + model.transitions
            back[:, t] = ways.argmax(1)
            best = np.where(mask[:, t, None], ways.max(1) + block[:, t], best)
        path = np.zeros((n, steps), np.int64)
        last = lengths[own] - 1
        current = best.argmax(1)
        for t in range(steps - 1, -1, -1):
            path[:, t] = current
            current = np.where(t <= last, back[np.arange(n), t, current] if t else current, current)
        result[flat] = path[mask]
        at = end
    return result
