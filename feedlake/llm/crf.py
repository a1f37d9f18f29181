"""Linear-chain conditional random field over words, in numpy.

Scores are a word's feature weights plus a weight for each pair of neighbouring
labels. ``train`` fits both by AdaGrad on the conditional log-likelihood.
``posteriors`` runs forward-backward over many sequences at once: sequences are
cut into blocks, each block's transfer matrix is multiplied out for all blocks
together, the blocks of a sequence are chained, and forward and backward
messages are then filled in inside the blocks. The result is that of one pass
over the whole sequence, whatever its length.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BLOCK = 128
#: Numbers that are held at once: weights of a model; label pairs of a batch.
MOST_WEIGHTS, MOST_PAIRS = 24_000_000, 4_000_000
#: First squared gradient of AdaGrad: a smaller one lets rounding noise grow where gradients vanish.
_FIRST = 0.1
#: Longer letter runs are read as several words of this many letters.
LONGEST_WORD = 64


def features(word: str) -> list[str]:
    """Lexicon, affix and character n-gram features of a lower-case word."""
    s, n = f"^{word}$", len(word)
    return ["=" + word, "<" + word[:1], "<" + word[:2], "<" + word[:3], ">" + word[-1:], ">" + word[-2:],
            ">" + word[-3:], *[s[i:i + 2] for i in range(n + 1)], *[s[i:i + 3] for i in range(n)]]


@dataclass
class Model:
    labels: list
    index: dict          # feature -> row of weights
    weights: np.ndarray  # features x labels
    moves: np.ndarray    # label x next label

    def emissions(self, words: list[str]) -> np.ndarray:
        get = self.index.get
        rows, sizes = [], []
        for w in words:
            before = len(rows)
            rows += [j for j in map(get, features(w)) if j is not None]
            sizes.append(len(rows) - before)
        total = np.zeros((len(rows) + 1, len(self.labels)))
        np.cumsum(self.weights[rows], axis=0, out=total[1:])
        end = np.cumsum(sizes, dtype=np.int64)
        return total[end] - total[end - np.array(sizes, np.int64)]


def posteriors(e: np.ndarray, lengths: np.ndarray, moves: np.ndarray, block: int | None = None) -> np.ndarray:
    """Label probabilities of every word; ``e`` holds the emission scores of the
    words of all sequences one after the other, ``lengths`` (all above 0) their sizes.
    With many labels blocks are longer, as each holds a number for every pair of them."""
    block = block or BLOCK * max(1, len(moves) ** 2 // 256)
    e = np.maximum(np.exp(e - e.max(axis=1, keepdims=True)), 1e-30)
    a = np.exp(moves - moves.max())
    size, labels = e.shape
    blocks = -(-lengths // block)
    seq_first = np.cumsum(blocks) - blocks
    place = np.arange(blocks.sum()) - np.repeat(seq_first, blocks)  # block number in its sequence
    begin = np.repeat(np.cumsum(lengths) - lengths, blocks) + place * block
    width = np.minimum(np.repeat(lengths, blocks) - place * block, block)
    order = np.argsort(-width, kind="stable")
    begin, width, opens = begin[order], width[order], (place == 0)[order]
    active = np.searchsorted(-width, -np.arange(1, block + 1), "right")  # blocks wider than t
    spot = np.empty_like(order)
    spot[order] = np.arange(len(order))

    def normal(x):
        return x / x.reshape(len(x), -1).sum(axis=1).reshape(-1, *[1] * (x.ndim - 1))

    x = normal(np.where(opens[:, None, None], np.eye(labels), a) * e[begin][:, None, :])
    for t in range(1, block):
        n = active[t]
        if not n:
            break
        x[:n] = normal((x[:n].reshape(-1, labels) @ a).reshape(n, labels, labels) * e[begin[:n] + t][:, None, :])
    fore, back = np.ones((len(order), labels)), np.ones((len(order), labels))
    chains = np.argsort(-blocks, kind="stable")
    head, many = seq_first[chains], blocks[chains]
    for p in range(int(many[0]) - 1):
        n = int(np.searchsorted(-many, -(p + 1), "left"))  # sequences with a block after this one
        here = spot[head[:n] + p]
        fore[spot[head[:n] + p + 1]] = normal(np.einsum("ni,nij->nj", fore[here], x[here]))
    for p in range(int(many[0]) - 1, 0, -1):
        n = int(np.searchsorted(-many, -p, "left"))
        here = spot[head[:n] + p]
        back[spot[head[:n] + p - 1]] = normal(np.einsum("nij,nj->ni", x[here], back[here]))
    alpha, beta = np.empty((size, labels)), np.empty((size, labels))
    now = normal(np.where(opens[:, None], fore, fore @ a) * e[begin])
    alpha[begin] = now
    for t in range(1, block):
        n = active[t]
        if not n:
            break
        now = normal(now[:n] @ a * e[begin[:n] + t])
        alpha[begin[:n] + t] = now
    now = back
    beta[begin + width - 1] = back
    for t in range(block - 1, 0, -1):
        n = active[t]
        if n:
            at = begin[:n] + t
            beta[at - 1] = normal((e[at] * beta[at]) @ a.T)
    return normal(alpha * beta)


def train(sequences: list[tuple[list[str], list[int]]], labels: list, *, epochs: int = 10, batch: int = 32,
          rate: float = 0.2, decay: float = 1e-4, seed: int = 7, lexicon_least: int = 2,
          most_weights: int = MOST_WEIGHTS) -> Model:
    """Fit weights and transitions on ``(words, label numbers)`` sequences. With more
    than ``most_weights`` features x labels the features of the most words stay."""
    number: dict = {}
    words = [number.setdefault(w, len(number)) for ws, _ in sequences for w in ws]
    seen: dict = {}
    per_word = []
    counts = np.bincount(words, minlength=len(number)) if words else np.zeros(0, int)
    for w, i in number.items():
        f = features(w)
        per_word.append([seen.setdefault(x, len(seen)) for x in (f if counts[i] >= lexicon_least else f[1:])])
    nl = len(labels)
    if len(seen) * nl > most_weights:
        order = np.argsort(-np.bincount([j for f in per_word for j in f], minlength=len(seen)), kind="stable")
        rank = {int(j): r for r, j in enumerate(order[:max(1, most_weights // nl)])}
        seen = {x: rank[j] for x, j in seen.items() if j in rank}
        per_word = [[rank[j] for j in f if j in rank] for f in per_word]
    batch = max(1, min(batch, MOST_PAIRS // (64 * nl * nl) if nl else 1))
    model = Model(labels, seen, np.zeros((len(seen), nl)), np.zeros((nl, nl)))
    if not sequences:
        return model
    flat = np.array([j for f in per_word for j in f], np.int64)
    size = np.array([len(f) for f in per_word])
    start = np.cumsum(size) - size
    w2, m2 = np.full(model.weights.shape, _FIRST), np.full((nl, nl), _FIRST)
    ids = [np.array([number[w] for w in ws]) for ws, _ in sequences]
    ys = [np.array(y) for _, y in sequences]
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(len(ids)), max(1, len(ids) // batch)):
            own, inverse = np.unique(np.concatenate([ids[i] for i in part]), return_inverse=True)
            y = np.concatenate([ys[i] for i in part])
            length = np.array([len(ids[i]) for i in part])
            rows = np.concatenate([flat[start[i]:start[i] + size[i]] for i in own])
            of = np.repeat(np.arange(len(own)), size[own])
            score = np.zeros((len(own), nl))
            np.add.at(score, of, model.weights[rows])
            e = score[inverse]
            p = posteriors(e, length, model.moves)
            # pairs of neighbours: expected counts from the one-word messages
            last = np.cumsum(length) - 1
            left = np.setdiff1d(np.arange(len(y)), last, assume_unique=True)
            gm = _pair_sum(e, length, model.moves, left)
            np.add.at(gm, (y[left], y[left + 1]), -1)
            p[np.arange(len(y)), y] -= 1
            ge = np.zeros_like(score)
            np.add.at(ge, inverse, p)
            touched, back = np.unique(rows, return_inverse=True)
            gw = np.zeros((len(touched), nl))
            np.add.at(gw, back, ge[of])
            gw = gw / len(part) + decay * model.weights[touched]
            gm = gm / len(part) + decay * model.moves
            w2[touched] += gw * gw
            m2 += gm * gm
            model.weights[touched] -= rate * gw / np.sqrt(w2[touched])
            model.moves -= rate * gm / np.sqrt(m2)
    return model


def _pair_sum(e, lengths, moves, left):
    """Sum over ``left`` of the joint label probabilities of words ``left`` and ``left + 1``."""
    e = np.exp(e - e.max(axis=1, keepdims=True))
    a = np.exp(moves - moves.max())
    begin = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    begin, width = begin[order], lengths[order]
    alpha, beta = np.empty_like(e), np.ones_like(e)
    now = e[begin]
    alpha[begin] = now
    for t in range(1, int(width[0])):
        n = int(np.searchsorted(-width, -t, "left"))
        now = now[:n] @ a * e[begin[:n] + t]
        now = now / now.sum(axis=1, keepdims=True)
        alpha[begin[:n] + t] = now
    for t in range(int(width[0]) - 1, 0, -1):
        n = int(np.searchsorted(-width, -t, "left"))
        at = begin[:n] + t
        b = (e[at] * beta[at]) @ a.T
        beta[at - 1] = b / b.sum(axis=1, keepdims=True)
    total, most = np.zeros_like(a), max(1, MOST_PAIRS // a.size)
    for i in range(0, len(left), most):
        at = left[i:i + most]
        joint = alpha[at][:, :, None] * a * (e[at + 1] * beta[at + 1])[:, None, :]
        total += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    return total
