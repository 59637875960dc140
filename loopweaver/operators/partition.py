"""Balanced partition of a graph into parts with a small cut: multilevel, in numpy.

Bins are matched along their heaviest edges and merged until few are left; those are cut into parts along the chain, and on
the way back bins at the border of parts move where that lowers the cut and keeps every part within the allowed weight.
"""

from __future__ import annotations

import numpy as np


def _merged(u: np.ndarray, v: np.ndarray, w: np.ndarray, to: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges between merged nodes, loops left out and parallel ones summed."""
    a, b = to[u], to[v]
    low, high = np.minimum(a, b), np.maximum(a, b)
    ok = low != high
    keys, at = np.unique(low[ok].astype(np.int64) * n + high[ok], return_inverse=True)
    return keys // n, keys % n, np.bincount(at, weights=w[ok], minlength=len(keys))


def _match(u: np.ndarray, v: np.ndarray, w: np.ndarray, weight: np.ndarray, most: float) -> np.ndarray:
    """The merged node of each node: heaviest edges first, each node in one pair, none heavier than most. Merged nodes keep
    the order of their first members."""
    n = len(weight)
    mate = list(range(n))
    taken = [False] * n
    order = np.argsort(-w, kind="stable")
    heavy = weight.tolist()  # numbers of lists are read much faster one by one
    for a, b in zip(u[order].tolist(), v[order].tolist(), strict=True):
        if not taken[a] and not taken[b] and heavy[a] + heavy[b] <= most:
            taken[a] = taken[b] = True
            mate[max(a, b)] = min(a, b)
    _, to = np.unique(mate, return_inverse=True)
    return to


def _chunks(weight: np.ndarray, parts: int) -> np.ndarray:
    """Contiguous parts of about the same weight."""
    middle = np.cumsum(weight) - weight / 2
    return np.minimum((middle * parts / weight.sum()).astype(np.int64), parts - 1)


def cut_weight(u: np.ndarray, v: np.ndarray, w: np.ndarray, part: np.ndarray) -> float:
    return float(w[part[u] != part[v]].sum())


def _refine(u: np.ndarray, v: np.ndarray, w: np.ndarray, weight: np.ndarray, part: np.ndarray, parts: int, most: float, rounds: int) -> np.ndarray:
    """part after moves that lower the cut, or that take weight from parts over the limit."""
    n = len(weight)
    ends, other, both = np.concatenate([u, v]), np.concatenate([v, u]), np.concatenate([w, w])
    order = np.argsort(ends, kind="stable")
    start = np.searchsorted(ends[order], np.arange(n + 1)).tolist()
    near, pulls = other[order].tolist(), both[order].tolist()
    load = np.bincount(part, weights=weight, minlength=parts).tolist()
    heavy, now = weight.tolist(), part.tolist()
    for _ in range(rounds):
        border = np.unique(np.concatenate([u[part[u] != part[v]], v[part[u] != part[v]]]))
        if max(load) > most:
            border = np.union1d(border, np.flatnonzero(np.array(load)[part] > most))
        moved = 0
        for k in border.tolist():
            pull = [0.0] * parts
            for e in range(start[k], start[k + 1]):
                pull[now[near[e]]] += pulls[e]
            home, own = now[k], heavy[k]
            here, over = pull[home], load[home] > most
            gain, to = -np.inf, 0
            for q in range(parts):
                if q != home and load[q] + own <= most and pull[q] - here > gain:
                    gain, to = pull[q] - here, q
            if gain > 1e-12 or (over and gain > -np.inf) or (gain == 0 and load[to] + own < load[home] - 1e-9):
                load[home] -= own
                load[to] += own
                now[k] = to
                moved += 1
        part = np.array(now, np.int64)
        if not moved:
            break
    return part


def partition(u: np.ndarray, v: np.ndarray, n: int, parts: int, weights: np.ndarray | None = None, slack: float = 0.05, rounds: int = 8) -> np.ndarray:
    """The part of each of n bins. No part has over 1 + slack times its share, or one bin more than it where a share is small."""
    parts = max(1, min(parts, n))
    w = np.ones(len(u)) if weights is None else np.asarray(weights, float)
    most = max(np.ceil(n / parts), (1 + slack) * n / parts)
    levels = [(u, v, w, np.ones(n))]
    tos: list[np.ndarray] = []
    while len(levels[-1][3]) > max(8 * parts, 64):
        a, b, c, weight = levels[-1]
        to = _match(a, b, c, weight, max(2.0, most / 4))
        size = int(to.max()) + 1
        if size > 0.95 * len(weight):
            break
        tos.append(to)
        levels.append((*_merged(a, b, c, to, size), np.bincount(to, weights=weight, minlength=size)))
    part = _chunks(levels[-1][3], parts)
    for k in range(len(levels) - 1, -1, -1):
        part = _refine(*levels[k], part, parts, most, rounds)
        if k:
            part = part[tos[k - 1]]
    plain = _chunks(np.ones(n), parts)
    return part if cut_weight(u, v, w, part) <= cut_weight(u, v, w, plain) else plain
