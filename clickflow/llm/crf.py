"""A linear-chain conditional random field in numpy: training, Viterbi and forward-backward over many sequences at once.

A chunk of sequences is laid end to end; a sequence's first token has the same potential from every previous
label, so nothing passes from one sequence to the next. The long chain is then cut into blocks: products of the
label-by-label matrices within all blocks run side by side (``STEP`` vector steps), the blocks are joined one by
one, and every token gets its exact answer over its whole sequence, however long that is.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

STEP = 128


@dataclass
class Model:
    """``weights``: rows of label weights by hashed feature; ``trans``: from label to label; ``start``: of a first label."""

    weights: np.ndarray
    trans: np.ndarray
    start: np.ndarray

    @property
    def labels(self) -> int:
        return len(self.start)


class Types:
    """``width`` feature ids for each distinct token, made once while the table lasts; ``reset`` it once ``full``."""

    def __init__(self, make: Callable[[str], list[int]], width: int, most: int = 60_000):
        self.make, self.width, self.most = make, width, most
        self.reset()

    def reset(self) -> None:
        self.ids: dict[str, int] = {}
        self.flat = array("i")

    def of(self, tokens: list[str]) -> np.ndarray:
        ids, make, flat = self.ids, self.make, self.flat
        for t in set(tokens).difference(ids):
            ids[t] = len(ids)
            flat.extend(make(t))
        return np.fromiter(map(ids.__getitem__, tokens), dtype=np.int64, count=len(tokens))

    @property
    def full(self) -> bool:
        return len(self.ids) > self.most

    @property
    def rows(self) -> np.ndarray:
        return np.array(self.flat, dtype=np.int64).reshape(-1, self.width)


def _potentials(model: Model, emit: np.ndarray, first: np.ndarray) -> np.ndarray:
    """log psi[t, i, j]: of label j at token t after label i."""
    psi = model.trans[None] + emit[:, None, :]
    psi[first] = (model.start + emit[first])[:, None, :]
    return psi


def _blocked(psi: np.ndarray, blank: np.ndarray) -> tuple[np.ndarray, int]:
    """[STEP, blocks, L, L]; the tail is filled with ``blank``, which changes nothing."""
    n, size = len(psi), psi.shape[1]
    blocks = -(-n // STEP)
    full = np.empty((blocks * STEP, size, size))
    full[:n], full[n:] = psi, blank
    return np.ascontiguousarray(full.reshape(blocks, STEP, size, size).swapaxes(0, 1)), blocks


def marginals(model: Model, emit: np.ndarray, first: np.ndarray) -> np.ndarray:
    """P(label | sequence) of each token, [n, L]; ``first`` marks the first token of each sequence."""
    n, size = emit.shape
    if not n:
        return np.zeros((0, size))
    psi = _potentials(model, emit, first)
    psi = np.exp(psi - psi.max(axis=(1, 2), keepdims=True))
    m, blocks = _blocked(psi, np.eye(size))
    ahead, back = np.empty_like(m), np.empty_like(m)  # products up to a token, and of all after it
    ahead[0] = m[0]
    for t in range(1, STEP):
        x = sum(ahead[t - 1][:, :, k, None] * m[t][:, None, k, :] for k in range(size))
        ahead[t] = x / x.max(axis=(1, 2), keepdims=True)
    back[STEP - 1] = np.eye(size)
    for t in range(STEP - 2, -1, -1):
        x = sum(m[t + 1][:, :, k, None] * back[t + 1][:, None, k, :] for k in range(size))
        back[t] = x / x.max(axis=(1, 2), keepdims=True)
    into, out = np.empty((blocks, size)), np.empty((blocks, size))
    a = np.ones(size)
    for b in range(blocks):
        into[b] = a
        a = a @ ahead[-1, b]
        a = a / a.max()
    z, whole = np.ones(size), ahead[-1]
    for b in range(blocks - 1, -1, -1):
        out[b] = z
        z = whole[b] @ z
        z = z / z.max()
    alpha = np.einsum("bi,tbij->tbj", into, ahead)
    beta = np.einsum("tbij,bj->tbi", back, out)
    p = (alpha * beta).swapaxes(0, 1).reshape(-1, size)[:n]
    return p / p.sum(axis=1, keepdims=True)


def viterbi(model: Model, emit: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The best label of each token of each sequence; ties go to the smaller label."""
    n, size = emit.shape
    if not n:
        return np.zeros(0, dtype=np.int64)
    psi = _potentials(model, emit, first)
    blank = np.where(np.eye(size) > 0, 0.0, -np.inf)
    m, blocks = _blocked(psi, blank)
    best = np.empty_like(m)  # best way from each label before the block to each label at a token
    best[0] = m[0]
    for t in range(1, STEP):
        best[t] = (best[t - 1][:, :, :, None] + m[t][:, None, :, :]).max(axis=2)
    into = np.empty((blocks, size))
    a = np.zeros(size)
    for b in range(blocks):
        into[b] = a
        a = (a[:, None] + best[-1, b]).max(axis=0)
        a = a - a.max()
    delta = (into[None, :, :, None] + best).max(axis=2)  # [STEP, blocks, L]
    delta = delta.swapaxes(0, 1).reshape(-1, size)[:n]
    # the label before each label: then follow it back, all blocks at once, for each label a block may end in
    came = np.zeros((n, size), dtype=np.int64)
    came[1:] = (delta[:-1, :, None] + psi[1:]).argmax(axis=1)
    pad = blocks * STEP - n
    came = np.concatenate([came, np.tile(np.arange(size), (pad, 1))]).reshape(blocks, STEP, size)
    path = np.empty((blocks, STEP, size), dtype=np.int64)  # label at t if the block ends in the last index
    cur = np.tile(np.arange(size), (blocks, 1))
    for t in range(STEP - 1, -1, -1):
        path[:, t] = cur
        cur = np.take_along_axis(came[:, t], cur, axis=1)
    ends = np.empty(blocks, dtype=np.int64)
    at = int(delta[-1].argmax())
    for b in range(blocks - 1, -1, -1):
        ends[b] = at
        at = int(cur[b, at])
    return path[np.arange(blocks), :, ends].reshape(-1)[:n]


def train(features: np.ndarray, labels: np.ndarray, first: np.ndarray, size: int, dim: int, steps: int = 45,
          l2: float = 1e-4, rate: float = 0.2) -> Model:
    """Maximise the conditional likelihood by gradient steps (Adam) over all given tokens.

    ``features``: [n, width] feature ids under ``dim``; ``labels``: each token's label.
    """
    n = len(labels)
    if not n:
        return Model(np.zeros((dim, size)), np.zeros((size, size)), np.zeros(size))
    used, ix = np.unique(features, return_inverse=True)
    ix = ix.reshape(features.shape)
    later = np.flatnonzero(~first)
    one = np.eye(size)[labels]
    seen = np.zeros((size, size))
    np.add.at(seen, (labels[later - 1], labels[later]), 1)
    total = float(first.sum())
    params = [np.zeros((len(used), size)), np.zeros((size, size)), np.zeros(size)]
    mom, var = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for t in range(1, steps + 1):
        w, trans, start = params
        emit = np.stack([w[:, j][ix].sum(axis=1) for j in range(size)], axis=1)
        model = Model(w, trans, start)
        p = marginals(model, emit, first)
        # posterior of neighbours: psi scaled on both sides until it has the marginals of both tokens
        pair = _potentials(model, emit, first)[later]
        pair = np.exp(pair - pair.max(axis=(1, 2), keepdims=True))
        for _ in range(4):
            pair *= (p[later] / np.maximum(pair.sum(axis=1), 1e-300))[:, None, :]
            pair *= (p[later - 1] / np.maximum(pair.sum(axis=2), 1e-300))[:, :, None]
        gap = p - one
        g = [np.stack([np.bincount(ix.ravel(), np.repeat(gap[:, j], ix.shape[1]), len(used)) for j in range(size)], axis=1),
             pair.sum(axis=0) - seen, gap[first].sum(axis=0)]
        for k in range(3):
            grad = g[k] / total + l2 * params[k]
            mom[k], var[k] = 0.9 * mom[k] + 0.1 * grad, 0.99 * var[k] + 0.01 * grad * grad
            params[k] = params[k] - rate * (mom[k] / (1 - 0.9**t)) / (np.sqrt(var[k] / (1 - 0.99**t)) + 1e-8)
    full = np.zeros((dim, size))
    full[used] = params[0]
    return Model(full, params[1], params[2])


def chained(texts_tokens: list[list[str]]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """All tokens end to end, the owner of each, and whether it is the first of its sequence."""
    counts = np.fromiter(map(len, texts_tokens), dtype=np.int64, count=len(texts_tokens))
    owner = np.repeat(np.arange(len(counts)), counts)
    first = np.ones(len(owner), dtype=bool)
    first[1:] = owner[1:] != owner[:-1]
    return [t for x in texts_tokens for t in x], owner, first


def neighbours(ids: np.ndarray, first: np.ndarray, blank: int) -> tuple[np.ndarray, np.ndarray]:
    """The type before and after each token, ``blank`` at the ends of a sequence."""
    before, after = np.full(len(ids), blank), np.full(len(ids), blank)
    before[1:], after[:-1] = np.where(first[1:], blank, ids[:-1]), np.where(first[1:], blank, ids[1:])
    return before, after
