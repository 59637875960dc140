"""Entries near the diagonal of the inverse of a sparse symmetric matrix, without the inverse.

A cell's graph is a chain with contacts, most of them short. The bins of a border are set apart so that no contact left is
longer than a block: from each longer one, one end goes to the border. What is left is block tridiagonal, and its inverse's
diagonal and neighbouring blocks follow by one sweep up and one down; the border's share is added through its Schur
complement. Memory is bins times (blocks' width + border), not bins squared; the width is chosen to make that small, and
where the border would be too large for any width the dense solve is the better one.
"""

from __future__ import annotations

import numpy as np


def cover(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Bins that hold an end of every pair: greedily those of the most pairs left."""
    if not len(i):
        return np.zeros(0, np.int64)
    left = np.ones(len(i), bool)
    chosen = []
    degree = np.bincount(i, minlength=n) + np.bincount(j, minlength=n)
    ends = np.argsort(np.concatenate([i, j]), kind="stable")
    starts = np.searchsorted(np.concatenate([i, j])[ends], np.arange(n + 1))
    # Bins by degree in rounds: pairs whose ends both have few others are decided by the larger degree, then the number.
    buckets: list[list[int]] = [[] for _ in range(int(degree.max()) + 1)]
    for b in np.flatnonzero(degree).tolist():
        buckets[degree[b]].append(b)
    for d in range(len(buckets) - 1, 0, -1):
        while buckets[d]:
            b = buckets[d].pop()
            if degree[b] != d:  # it lost pairs since, and stands further down
                if degree[b] > 0:
                    buckets[degree[b]].append(b)
                continue
            chosen.append(b)
            for e in (ends[starts[b] : starts[b + 1]] % len(i)).tolist():
                if left[e]:
                    left[e] = False
                    degree[i[e]] -= 1
                    degree[j[e]] -= 1
    return np.array(sorted(chosen), np.int64)


def choose(i: np.ndarray, j: np.ndarray, n: int, reach: int) -> tuple[int, np.ndarray] | None:
    """Width of blocks and border, by the numbers that are held: three blocks of n by width, two of n by border, and the
    border squared; None where a dense matrix is no larger."""
    best, least = None, float(n) * n * 3
    width = max(reach, 1)
    while width < n:
        far = j - i > width
        s = cover(i[far], j[far], n)
        held = n * (3.0 * width + 2.0 * len(s)) + 2.0 * len(s) ** 2
        if held < least:
            best, least = (width, s), held
        if not len(s):
            break
        width *= 2
    return best


def band_of_inverse(i: np.ndarray, j: np.ndarray, off: np.ndarray, diagonal: np.ndarray, bi: np.ndarray, bj: np.ndarray, width: int, border: np.ndarray) -> np.ndarray:
    """Entries (bi, bj), bi <= bj at most width apart, of the inverse of the symmetric positive definite matrix with this
    diagonal and the entries off at (i, j), i < j. Pairs left without the border's bins are at most width apart."""
    n, s = len(diagonal), len(border)
    inner = np.ones(n, bool)
    inner[border] = False
    place = np.empty(n, np.int64)  # among the inner bins, or in the border
    place[inner], place[border] = np.arange(n - s), np.arange(s)
    m = n - s
    blocks = max(1, -(-m // width))
    at = lambda k: slice(k * width, min((k + 1) * width, m))
    size = lambda k: at(k).stop - at(k).start
    both = inner[i] & inner[j]
    u, v, w = place[i[both]], place[j[both]], off[both]
    low, high = np.minimum(u, v), np.maximum(u, v)
    d = np.zeros((blocks, width, width))
    e = np.zeros((max(blocks - 1, 0), width, width))  # rows of block k, columns of block k + 1
    inside = low // width == high // width
    d[low[inside] // width, low[inside] % width, high[inside] % width] = w[inside]
    d[low[inside] // width, high[inside] % width, low[inside] % width] = w[inside]
    e[low[~inside] // width, low[~inside] % width, high[~inside] % width] = w[~inside]
    k = np.arange(m)
    d[k // width, k % width, k % width] = diagonal[inner]
    last = np.arange(m, blocks * width)
    d[last // width, last % width, last % width] = 1  # fills up the last block
    right = np.zeros((blocks * width, s))
    corner = np.zeros((s, s))
    corner[np.arange(s), np.arange(s)] = diagonal[border]
    for a, b in ((i, j), (j, i)):
        mixed = inner[a] & ~inner[b]
        right[place[a[mixed]], place[b[mixed]]] = off[mixed]
        outer = ~inner[a] & ~inner[b]
        corner[place[a[outer]], place[b[outer]]] = off[outer]
    # Down: pivots, in place as their inverses, and the right side; up: the inverse's blocks, in place of both.
    z = right.copy()
    sl = lambda k: slice(k * width, (k + 1) * width)
    for k in range(blocks):
        if k:
            step = e[k - 1].T @ d[k - 1]
            d[k] -= step @ e[k - 1]
            z[sl(k)] -= step @ z[sl(k - 1)]
        d[k] = np.linalg.inv(d[k])
        d[k] = (d[k] + d[k].T) / 2
    for k in range(blocks - 1, -1, -1):
        if k < blocks - 1:
            z[sl(k)] = d[k] @ (z[sl(k)] - e[k] @ z[sl(k + 1)])
            gain = d[k] @ e[k]
            e[k] = -gain @ d[k + 1]
            d[k] -= e[k] @ gain.T
        else:
            z[sl(k)] = d[k] @ z[sl(k)]
    out = np.empty(len(bi))
    if s:
        schur = np.linalg.inv(corner - right.T @ z)
        del right
    a, b = place[bi], place[bj]
    rr = inner[bi] & inner[bj]
    x, y = a[rr], b[rr]
    same = x // width == y // width
    value = np.empty(len(x))
    value[same] = d[x[same] // width, x[same] % width, y[same] % width]
    value[~same] = e[x[~same] // width, x[~same] % width, y[~same] % width]
    if s:
        # The border's share of a place: a row of z times the Schur complement's inverse times another row of z.
        order = np.argsort(x, kind="stable")
        cuts = np.searchsorted(x[order], np.arange(0, m + width, width))
        for k, (c, f) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if c < f:
                rows = order[c:f]
                top = min(m, (k + 2) * width)
                share = z[k * width : min(m, (k + 1) * width)] @ schur @ z[k * width : top].T
                value[rows] += share[x[rows] - k * width, y[rows] - k * width]
        rs, sr, ss = inner[bi] & ~inner[bj], ~inner[bi] & inner[bj], ~inner[bi] & ~inner[bj]
        for some, row, column in ((rs, a, b), (sr, b, a)):
            for c in range(0, int(some.sum()), 65_536):
                at_ = np.flatnonzero(some)[c : c + 65_536]
                out[at_] = -np.einsum("ij,ij->i", z[row[at_]], schur[:, column[at_]].T)
        out[ss] = schur[a[ss], b[ss]]
    out[rr] = value
    return out
