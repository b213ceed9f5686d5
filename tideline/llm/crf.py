"""A two-state linear-chain conditional random field over whole documents, in numpy.

States are 0 (clean) and 1 (toxic). A token's emission is the sum of the weights of
its features. Messages run along a document as the ratio of its two states, and a run of
tokens acts on them as a 2 x 2 matrix. Documents are therefore cut into windows: first the
matrices of all windows are multiplied up at once, then each document's windows pass
messages on to one another, and last all windows run inside at once from the right start.
The result is that of one chain a document; the windows only set how much runs in parallel.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

WINDOW = 128
#: Emissions are cut to this size, so that no ratio of states leaves the range of numbers.
CAP = 30.0


@dataclass
class Chain:
    """Transition log-potentials against 0 -> 0."""

    start: float = -3.0
    t01: float = -3.0
    t10: float = 0.0
    t11: float = 0.0


def windows(counts: np.ndarray, width: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, document) of every window, given the number of tokens of each document."""
    pieces = (counts + width - 1) // width
    doc = np.repeat(np.arange(len(counts)), pieces)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    starts = (np.cumsum(counts) - counts)[doc] + nth * width
    return starts, np.minimum(counts[doc] - nth * width, width), doc


def _step(ratio: np.ndarray, a01: float, a10: float, a11: float) -> np.ndarray:
    """Log-potential of state 1 at a token before its emission, from the log-ratio at the one before."""
    r = np.exp(ratio)
    return np.log((a01 + r * a11) / (1 + r * a10))


def _matrices(odds: np.ndarray, starts: np.ndarray, lengths: np.ndarray, a01: float, a10: float, a11: float) -> np.ndarray:
    """What each window does to a message (state 0, state 1) that enters it, up to a factor: (windows, 2, 2)."""
    out = np.broadcast_to(np.eye(2), (len(starts), 2, 2)).copy()
    for t in range(int(lengths.max(initial=0))):
        live = np.flatnonzero(lengths > t)
        e = np.exp(odds[starts[live] + t])
        now = out[live]
        zero, one = now[:, :, 0], now[:, :, 1]
        new = np.stack([zero + one * a10, (zero * a01 + one * a11) * e[:, None]], axis=2)
        out[live] = new / new.max(axis=(1, 2), keepdims=True)
    return out


def _between(
    odds: np.ndarray, starts: np.ndarray, lengths: np.ndarray, doc: np.ndarray, chain: Chain
) -> tuple[np.ndarray, np.ndarray]:
    """Per window: log-potential of state 1 at its first token, and the backward log-ratio at its last."""
    a01, a10, a11 = np.exp(chain.t01), np.exp(chain.t10), np.exp(chain.t11)
    into, beyond = np.full(len(starts), chain.start), np.zeros(len(starts))
    joined = np.flatnonzero(doc[1:] == doc[:-1])  # windows with a successor in their document
    if not len(joined):
        return into, beyond
    heads = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    nth = np.arange(len(doc)) - np.repeat(heads, np.diff(np.concatenate((heads, [len(doc)]))))
    part = np.unique(np.concatenate((joined, joined + 1)))
    made = np.zeros((len(starts), 2, 2))
    made[part] = _matrices(odds, starts[part], lengths[part], a01, a10, a11)
    order = joined[np.argsort(nth[joined], kind="stable")]
    rounds = np.split(order, np.flatnonzero(np.diff(nth[order])) + 1)
    # The first window starts from the start potential instead of a transition: its first token apart.
    ratio = np.zeros(len(starts))
    first = order[nth[order] == 0]
    own = odds[starts[first]] + chain.start
    rest = _matrices(odds, starts[first] + 1, lengths[first] - 1, a01, a10, a11)
    r = np.exp(own)
    ratio[first] = np.log((rest[:, 0, 1] + r * rest[:, 1, 1]) / (rest[:, 0, 0] + r * rest[:, 1, 0]))
    for some in rounds:
        if nth[some[0]]:
            r = np.exp(ratio[some - 1])
            m = made[some]
            ratio[some] = np.log((m[:, 0, 1] + r * m[:, 1, 1]) / (m[:, 0, 0] + r * m[:, 1, 0]))
        into[some + 1] = _step(ratio[some], a01, a10, a11)
    for some in reversed(rounds):
        s = np.exp(beyond[some + 1])
        m = made[some + 1]
        beyond[some] = np.log((m[:, 1, 0] + s * m[:, 1, 1]) / (m[:, 0, 0] + s * m[:, 0, 1]))
    return into, beyond


def forward_backward(
    emission: np.ndarray, starts: np.ndarray, lengths: np.ndarray, chain: Chain, doc: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per token: log-odds of state 1, and the forward and backward log-ratios it is the sum of.

    Windows of one ``doc`` are one chain; without ``doc`` each window is a chain of its own.
    """
    a01, a10, a11 = np.exp(chain.t01), np.exp(chain.t10), np.exp(chain.t11)
    emission = np.clip(emission, -CAP, CAP)
    fore, back = np.zeros(len(emission)), np.zeros(len(emission))
    if not len(starts):
        return fore, fore, back
    into, beyond = _between(emission, starts, lengths, np.arange(len(starts)) if doc is None else doc, chain)
    order = np.argsort(-lengths, kind="stable")
    starts, lengths, into, beyond = starts[order], lengths[order], into[order], beyond[order]
    ratio = np.zeros(0)
    alive_at = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right")
    for t, alive in enumerate(alive_at.tolist()):
        at = starts[:alive] + t
        enter = _step(ratio[:alive], a01, a10, a11) if t else into
        ratio = emission[at] + enter
        fore[at] = ratio
    back[starts + lengths - 1] = beyond
    for t in range(int(lengths[0]) - 2, -1, -1):
        alive = int(alive_at[t + 1])
        at = starts[:alive] + t
        s = np.exp(emission[at + 1] + back[at + 1])
        back[at] = np.log((a10 + a11 * s) / (1 + a01 * s))
    return fore + back, fore, back


def fit(
    types: np.ndarray, labels: np.ndarray, starts: np.ndarray, lengths: np.ndarray, owner: np.ndarray, flat: np.ndarray,
    n_types: int, n_features: int, steps: int = 60, rate: float = 0.3, l2: float = 0.02,
) -> tuple[np.ndarray, Chain]:
    """Weights (the last is the bias) and chain that maximise the likelihood of token labels.

    ``types[t]`` is the type of token t; type ``owner[k]`` has feature ``flat[k]``. The windows
    given by ``starts`` and ``lengths`` must cover the tokens without gaps and are chains of their own.
    Gradient ascent with per-parameter step sizes (Adam).
    """
    first = np.zeros(len(types), bool)
    first[starts] = True
    inner = ~first
    previous = np.flatnonzero(inner) - 1
    following = np.flatnonzero(inner)
    seen = np.array([
        labels[first].sum(),
        ((labels[previous] == 0) & (labels[following] == 1)).sum(),
        ((labels[previous] == 1) & (labels[following] == 0)).sum(),
        ((labels[previous] == 1) & (labels[following] == 1)).sum(),
    ], dtype=float)
    theta = np.concatenate([np.full(n_features, 1.0), [-4.0], [0.0, -1.0, 0.0, 0.0]])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    scale = max(1.0, labels.sum())
    for step in range(1, steps + 1):
        chain = Chain(*theta[n_features + 1 :])
        per_type = np.bincount(owner, theta[flat], n_types) + theta[n_features]
        emission = np.clip(per_type[types], -CAP, CAP)
        odds, fore, back = forward_backward(emission, starts, lengths, chain)
        p = 1 / (1 + np.exp(-np.clip(odds, -CAP, CAP)))
        per = np.bincount(types, labels - p, n_types)
        grad = np.zeros_like(theta)
        grad[:n_features] = np.bincount(flat, per[owner], n_features)
        grad[n_features] = per.sum()
        # Pairwise marginals of neighbours.
        r = np.exp(fore[previous])
        s = np.exp(emission[following] + back[following])
        w01, w10, w11 = np.exp(chain.t01) * s, np.exp(chain.t10) * r, np.exp(chain.t11) * r * s
        z = 1 + w01 + w10 + w11
        expected = np.array([p[first].sum(), (w01 / z).sum(), (w10 / z).sum(), (w11 / z).sum()])
        grad[n_features + 1 :] = seen - expected
        grad = grad / scale - l2 * theta / len(theta)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta = theta + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return theta[: n_features + 1], Chain(*(float(x) for x in theta[n_features + 1 :]))
