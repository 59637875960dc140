"""Contact graphs and random walks with restart.

Graph operators are plain DataFrames over the links of a cell's chromosome, which lie in one partition. The walk's dense solves
take one cell's chromosome (or a window of it) at a time, which is the unit of work: nothing is shared between them.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from loopweaver.operators import jobs, selected
from loopweaver.operators.partition import partition
from loopweaver.params import Params

#: Bins up to which the inverse is taken whole, and rows of a batch that a task passes on.
DENSE_BINS, BATCH = 2000, 250_000
#: Rows of a symmetric matrix up to which LAPACK inverts it; larger ones are halved.
LEAST_HALVED = 64
#: Further columns and powers of the range finder, and its seed.
OVERSAMPLE, POWERS, SEED = 16, 4, 20_240_601
#: Least ratio of squared singular values that are taken from a squared matrix.
LEAST_SQUARE = 1e-6

METHODS = ("inverse", "iterative", "nblin", "blin", "q1", "sliding_window")


def edges(binned: DataFrame, p: Params) -> DataFrame:
    """cell, chrom, u, v: contacts and the chain of neighbouring bins, both directions, distinct."""
    sizes = F.create_map(*(x for k in sorted(p.chrom_lengths) for x in (F.lit(k), F.lit(p.bins(k)))))
    placed = jobs.together(binned.select("cell", "chrom", "i", "j"))
    first = F.row_number().over(Window.partitionBy("cell", "chrom").orderBy("i", "j")) == 1
    first &= sizes[F.col("chrom")].isNotNull()
    both = lambda u, v: F.array(F.struct(u.alias("u"), v.alias("v")), F.struct(v.alias("u"), u.alias("v")))
    # A contact spans two bins or more, so it is never a link of the chain: no distinct is needed. The chain comes with a
    # cell's first contact, so that it is made where they lie.
    chain = F.flatten(F.transform(F.sequence(F.lit(0).cast("bigint"), sizes[F.col("chrom")].cast("bigint") - 2), lambda k: both(k, k + 1)))
    own = both(F.col("i"), F.col("j"))
    return placed.withColumn("first", first).select("cell", "chrom", F.explode(F.when(F.col("first"), F.concat(own, chain)).otherwise(own)).alias("e")).select("cell", "chrom", "e.u", "e.v")


def degree(e: DataFrame) -> DataFrame:
    return e.groupBy("cell", "chrom", "u").agg(F.count(F.lit(1)).alias("degree"))


def _degree_of(end: str) -> F.Column:
    """A bin's degree beside each of its links; where those of a cell's chromosome lie together nothing is shuffled."""
    return F.count(F.lit(1)).over(Window.partitionBy("cell", "chrom", end))


def transition_matrix(e: DataFrame) -> DataFrame:
    """cell, chrom, u, v, p: each row sums to one."""
    return e.select("cell", "chrom", "u", "v", (F.lit(1.0) / _degree_of("u")).alias("p"))


def laplacian_weights(e: DataFrame) -> DataFrame:
    """cell, chrom, u, v, w: the adjacency scaled by the roots of both degrees. Links are there in both directions."""
    both = e.select("cell", "chrom", "u", "v", _degree_of("u").alias("du"), _degree_of("v").alias("dv"))
    return both.select("cell", "chrom", "u", "v", (F.lit(1.0) / F.sqrt(F.col("du").cast("double") * F.col("dv"))).alias("w"))


def walked_steps(u: np.ndarray, v: np.ndarray, alpha: float, steps: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """i, j, s of the walk after some rounds on the links (u, v), both directions: sparse rows times sparse rows."""
    order = np.argsort(u, kind="stable")
    nodes, start, degree = np.unique(u[order], return_index=True, return_counts=True)
    n = len(nodes)
    u, v = np.searchsorted(nodes, u[order]), np.searchsorted(nodes, v[order])
    share = (1 - alpha) / degree[u]
    row, column, value = np.arange(n), np.arange(n), np.ones(n)

    def summed(row: np.ndarray, column: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys, at = np.unique(row * n + column, return_inverse=True)
        return keys // n, keys % n, np.bincount(at, weights=value, minlength=len(keys))

    for _ in range(steps):
        begin = np.searchsorted(row, np.arange(n + 1))  # entries are sorted by row
        size = np.diff(begin)[v]
        link = np.repeat(np.arange(len(u)), size)
        entry = begin[v[link]] + np.arange(len(link)) - np.repeat(np.cumsum(size) - size, size)
        row, column, value = summed(np.r_[u[link], np.arange(n)], np.r_[column[entry], np.arange(n)], np.r_[share[link] * value[entry], np.full(n, alpha)])
    row, column, value = summed(np.r_[row, column], np.r_[column, row], np.r_[value, value])
    return nodes[row], nodes[column], value


def rwr_iterative(e: DataFrame, p: Params, steps: int) -> DataFrame:
    """cell, chrom, u, v, s: `steps` rounds of A <- (1 - alpha) P A + alpha I from A = I, then A + A^T, on sparse entries.

    The reach grows by one link a round, so this suits few rounds; rwr() with method iterative runs to convergence. Links of a
    cell's chromosome make one group, whose entries never leave its task unsummed.
    """
    kind = e.schema["cell"].dataType

    def run(key: tuple[pa.Scalar, ...], g: pa.Table) -> pa.Table:
        i, j, s = walked_steps(g["u"].to_numpy(), g["v"].to_numpy(), p.alpha, steps)
        return pa.table({"cell": pa.repeat(key[0].cast(to_arrow_type(kind)), len(i)), "chrom": pa.repeat(key[1].as_py(), len(i)), "i": i, "j": j, "s": s})

    return e.groupBy("cell", "chrom").applyInArrow(run, f"cell {kind.simpleString()}, chrom string, i bigint, j bigint, s double")


# Dense kernels


def adjacency(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    m = np.zeros((n, n))
    m[i, j] = m[j, i] = 1
    k = np.arange(n - 1)
    m[k, k + 1] = m[k + 1, k] = 1
    return m


def _rows(m: np.ndarray) -> np.ndarray:
    return m / np.maximum(m.sum(1, keepdims=True), 1)


def _scaled(m: np.ndarray) -> np.ndarray:
    d = np.sqrt(np.maximum(m.sum(1), 1))
    return m / d[:, None] / d[None, :]


def solve_inverse(m: np.ndarray, alpha: float) -> np.ndarray:
    x = alpha * np.linalg.solve(np.eye(len(m)) - (1 - alpha) * _rows(m).T, np.eye(len(m)))
    return x + x.T


def solve_iterative(m: np.ndarray, alpha: float, max_iter: int, tolerance: float = 1e-6) -> np.ndarray:
    """max_iter rounds of A <- (1 - alpha) P A + alpha I from A = I, fewer where a round changes no entry by over tolerance.

    Round T + 1 changes A by (1 - alpha)^(T + 1) (P^(T + 1) - P^T), and what the rounds after T change in all is the inverse of
    I - (1 - alpha) P times that; so the inverse less this is A after T rounds. With the roots of both degrees P is similar to a
    symmetric matrix, half of whose powers' products are squares. A round's largest change falls by the factor 1 - alpha at
    least, as rows of P sum to one at most: where that of round T + 1 is above the tolerance times the factor, all T rounds were
    due. Else they are taken one by one.
    """
    c, n = 1 - alpha, len(m)
    one = np.eye(n)
    if max_iter > 2 and alpha > 0:
        root = np.sqrt(np.maximum(m.sum(1), 1))
        scale = root[None, :] / root[:, None]
        w = c * _scaled(m)
        power = _power(w, max_iter)
        change = w @ power
        change -= c * power
        if np.abs(change * scale).max() > max(tolerance * c, 1e-12):
            a = np.linalg.solve(one - w, alpha * one - change)
            a *= scale
            return a + a.T
    p = c * _rows(m)
    a = one
    for _ in range(max_iter):
        b = p @ a
        b[np.diag_indices(n)] += alpha
        gap, a = np.abs(b - a).max(), b
        if gap <= tolerance:
            break
    return a + a.T


def _power(x: np.ndarray, k: int) -> np.ndarray:
    """The k-th power of a symmetric matrix; BLAS takes a product with the own transpose at half the cost."""
    if k == 1:
        return x
    if k % 2 == 0:
        y = _power(x, k // 2)
        return y @ y.T
    if k % 3 == 0:
        y = _power(x, k // 3)
        return (y @ y.T) @ y
    return _power(x, k - 1) @ x


def solve_nblin(m: np.ndarray, alpha: float) -> np.ndarray:
    """Low-rank form over all singular vectors: alpha (I + (1 - alpha) U L V), each column scaled to sum to one. Over all of
    them L is what Woodbury's identity takes from the inverse of I - (1 - alpha) W, so the form is alpha times that inverse,
    which is taken without the vectors."""
    a = np.linalg.inv(np.eye(len(m)) - (1 - alpha) * _scaled(m))
    a /= a.sum(0)
    return a + a.T


def blocks(m: np.ndarray, parts: int, contiguous: bool = False) -> np.ndarray:
    """The block of each bin: parts of the graph with a small cut between them, or equal stretches of the chain."""
    n = len(m)
    if contiguous:
        return np.searchsorted(np.linspace(0, n, max(1, min(parts, n)) + 1).astype(int)[1:], np.arange(n), side="right")
    u, v = np.nonzero(np.triu(m, 1))
    return partition(u, v, n, parts, m[u, v])


def _inner(w: np.ndarray, alpha: float, block: np.ndarray) -> np.ndarray:
    """Inverses of I - (1 - alpha) W within the blocks; those of one size at once."""
    q = np.zeros_like(w)
    order = np.argsort(block, kind="stable")
    first = np.flatnonzero(np.r_[True, np.diff(block[order]) != 0])
    sizes = np.diff(np.r_[first, len(block)])
    for size in np.unique(sizes).tolist():
        bins = order[first[sizes == size][:, None] + np.arange(size)]
        at = bins[:, :, None], bins[:, None, :]
        q[at] = np.linalg.inv(np.eye(size) - (1 - alpha) * w[at])
    return q


def solve_q1(m: np.ndarray, alpha: float, parts: int, contiguous: bool = False) -> np.ndarray:
    """Walks on the transition matrix within blocks only, without the factor alpha and not scaled."""
    q = _inner(_rows(m), alpha, blocks(m, parts, contiguous))
    return q + q.T


def solve_blin(m: np.ndarray, alpha: float, parts: int, contiguous: bool = False) -> np.ndarray:
    """Walks on the scaled adjacency within blocks, corrected by the low-rank rest between blocks; not scaled by columns.
    The rest has rows and columns of the bins at borders only, which give it in factors without singular vectors."""
    w, block = _scaled(m), blocks(m, parts, contiguous)
    q = _inner(w, alpha, block)
    rest = np.where(block[:, None] == block[None, :], 0.0, w)
    border = np.flatnonzero(rest.any(1))
    if len(border):
        r, x = rest[np.ix_(border, border)], q[:, border]
        q = q + (1 - alpha) * (x @ np.linalg.solve(np.eye(len(border)) - (1 - alpha) * (r @ x[border]), r @ x.T))
    q = alpha * q
    return q + q.T


class ScaledGraph:
    """The adjacency scaled by the roots of both degrees, as a sparse matrix; contacts and chain."""

    def __init__(self, i: np.ndarray, j: np.ndarray, n: int):
        pairs = np.unique(np.concatenate([np.minimum(i, j) * n + np.maximum(i, j), np.arange(n - 1) * n + np.arange(1, n)]).astype(np.int64))
        self.n, self.i, self.j = n, pairs // n, pairs % n
        self.degree = np.maximum(np.bincount(self.i, minlength=n) + np.bincount(self.j, minlength=n), 1).astype(float)
        root = np.sqrt(self.degree)
        self.weight = 1 / (root[self.i] * root[self.j])
        row = np.concatenate([self.i, self.j])
        order = np.argsort(row, kind="stable")
        self._column, self._value = np.concatenate([self.j, self.i])[order], np.concatenate([self.weight] * 2)[order]
        self._rows, self._start = np.unique(row[order], return_index=True)
        self._whole: np.ndarray | None = None

    def __matmul__(self, x: np.ndarray) -> np.ndarray:
        if self.n <= DENSE_BINS:
            if self._whole is None:
                self._whole = np.zeros((self.n, self.n))
                self._whole[self.i, self.j] = self._whole[self.j, self.i] = self.weight
            return self._whole @ x
        out = np.zeros((self.n, x.shape[1]))
        if len(self._start):
            out[self._rows] = np.add.reduceat(x[self._column] * self._value[:, None], self._start, axis=0)
        return out

    def low_rank(self, rank: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """U, S, V of rank at most, and the residual: the Frobenius norm of what they leave, by a randomised range finder."""
        k = min(rank + OVERSAMPLE, self.n)
        q = _drawn(self.n, k)
        for done in range(1, POWERS + 1):
            q = self @ q
            if done % 2 == 0 or done == POWERS:  # two powers leave the columns far enough apart
                q, _ = np.linalg.qr(q)
        b = self @ q  # the matrix is symmetric
        # Singular vectors of b from the small matrix b^T b, unless squares of its values are lost in rounding.
        square, u = np.linalg.eigh(b.T @ b)
        if square[0] > LEAST_SQUARE * square[-1]:
            u, s = u[:, ::-1][:, :rank], np.sqrt(square[::-1][:rank])
            v = (b @ u).T / s[:, None]
        else:
            u, s, v = np.linalg.svd(b.T, full_matrices=False)
        keep = np.flatnonzero(s[:rank] > 1e-12)
        left = 2 * (self.weight**2).sum() - (s[keep] ** 2).sum()
        return q @ u[:, keep], s[keep], v[keep], float(np.sqrt(max(left, 0.0)))


@functools.lru_cache(maxsize=4)
def _drawn(n: int, k: int) -> np.ndarray:
    """The range finder's start, which is the same for all cells."""
    return np.random.default_rng(SEED).standard_normal((n, k))


def nblin_band(i: np.ndarray, j: np.ndarray, n: int, p: Params) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The band of solve_nblin() from the nblin_rank largest singular vectors, with no matrix of n by n. Before columns are
    scaled, no entry is off by more than (1 - alpha) / alpha times the residual, where the residual is below alpha."""
    u, s, v, _ = ScaledGraph(i, j, n).low_rank(p.nblin_rank)
    c = 1 - p.alpha
    core = np.linalg.inv(np.diag(1 / s) - c * (v @ u)) @ v
    sums = p.alpha * (1 + c * (u.sum(0) @ core))
    bi, bj = band_places(p, n)
    if n <= DENSE_BINS:
        whole = (u @ core) / sums[None, :]
        return bi, bj, p.alpha * c * (whole[bi, bj] + whole[bj, bi])
    out = np.empty(len(bi))
    for a in range(0, len(bi), 65_536):
        x, y = bi[a : a + 65_536], bj[a : a + 65_536]
        one, two = np.einsum("ij,ji->i", u[x], core[:, y]), np.einsum("ij,ji->i", u[y], core[:, x])
        out[a : a + 65_536] = p.alpha * c * (one / sums[y] + two / sums[x])
    return bi, bj, out


def walk(m: np.ndarray, p: Params) -> np.ndarray:
    """Symmetric proximities of one graph by the chosen method."""
    if p.rwr_method in ("inverse", "sliding_window"):
        return solve_inverse(m, p.alpha)
    if p.rwr_method == "iterative":
        return solve_iterative(m, p.alpha, p.max_iter)
    if p.rwr_method == "nblin":
        return solve_nblin(m, p.alpha)
    if p.rwr_method == "blin":
        return solve_blin(m, p.alpha, p.blin_partitions, p.blin_contiguous)
    if p.rwr_method == "q1":
        return solve_q1(m, p.alpha, p.blin_partitions, p.blin_contiguous)
    raise ValueError(f"no such method: {p.rwr_method}; there are {', '.join(METHODS)}")


def band_places(p: Params, n: int) -> tuple[np.ndarray, np.ndarray]:
    """i, j of the pairs that are kept: 1 to max_rwr_bins apart, off the margins at both ends. Cells of a chromosome that come
    after each other get the same arrays, which are not to be changed."""
    return _band_places(p.margin, p.max_rwr_bins, n)


@functools.lru_cache(maxsize=1)
def _band_places(margin: int, most: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    i, d = np.arange(margin, max(margin, n - margin))[:, None], np.arange(1, most + 1)[None, :]
    keep = i + d < n - margin
    i, j = np.broadcast_to(i, keep.shape)[keep], (i + d)[keep]
    i.flags.writeable = j.flags.writeable = False
    return i, j


def band(s: np.ndarray, p: Params, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    i, j = band_places(p, n)
    return i, j, s[i, j]


def inverse_band(i: np.ndarray, j: np.ndarray, n: int, p: Params) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The band of solve_inverse() without the matrices that it takes.

    With the degrees D, I - (1 - alpha) A / D is D - (1 - alpha) A, which is symmetric, over D, so that the inverse of this one
    gives x and its transpose at the band's places alone. Of more than DENSE_BINS bins only these entries are made, by blocks
    and a border (see selected), unless so many contacts are long that the inverse takes no more.
    """
    bi, bj = band_places(p, n)
    g = ScaledGraph(i, j, n) if n > DENSE_BINS else None
    found = selected.choose(g.i, g.j, n, p.max_rwr_bins) if g is not None else None
    if found is not None:
        y = selected.band_of_inverse(g.i, g.j, -(1 - p.alpha) * g.weight, np.ones(n), bi, bj, *found)
        root = np.sqrt(g.degree)
        ratio = root[bi] / root[bj]
        return bi, bj, p.alpha * y * (ratio + 1 / ratio)
    m = adjacency(i, j, n)
    degree = np.maximum(m.sum(1), 1)
    m *= p.alpha - 1
    m[np.diag_indices(n)] += degree
    y = _inverse(m).ravel().take(_flat(p.margin, p.max_rwr_bins, n))
    degree *= p.alpha
    y *= degree[bi] + degree[bj]
    return bi, bj, y


@functools.lru_cache(maxsize=1)
def _flat(margin: int, most: int, n: int) -> np.ndarray:
    """The places of the band in a matrix that lies row by row."""
    i, j = _band_places(margin, most, n)
    return i * n + j


def _inverse(m: np.ndarray) -> np.ndarray:
    """The inverse of a symmetric positive definite matrix, by halves: products of halves take less than LAPACK's general
    inverse, and no pivots are wanted. Where contacts are short the halves have links near the cut alone, from the bin a on and
    up to the bin b, and products keep to these."""
    n = len(m)
    if n <= LEAST_HALVED:
        return np.linalg.inv(m)
    h = n // 2
    links = m[:h, h:] != 0
    a, b = int(links.any(1).argmax()), h + int(np.flatnonzero(links.any(0)).max(initial=-1)) + 1
    out = np.empty_like(m)
    top, q = _inverse(m[:h, :h]), m[a:h, h:b]
    t = top[:, a:] @ q
    below = m[h:, h:].copy()
    below[: b - h, : b - h] -= q.T @ t[a:]
    out[h:, h:] = _inverse(below)
    side = t @ out[h:b, h:]
    top += side[:, : b - h] @ t.T
    out[:h, :h] = top
    np.negative(side, out=out[:h, h:])
    out[h:, :h] = out[:h, h:].T
    return out


def walked_band(i: np.ndarray, j: np.ndarray, n: int, p: Params) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """i, j and proximities of the band of one cell's chromosome with n bins, by the chosen method.

    The inverse, and nblin with a rank, take memory by bins times a few hundred to a few thousand numbers; the other methods
    are dense, and sliding windows are the method for less memory.
    """
    if p.rwr_method == "inverse":
        return inverse_band(i, j, n, p)
    if p.rwr_method == "nblin" and p.nblin_rank:
        return nblin_band(i, j, n, p)
    return band(walk(adjacency(i, j, n), p), p, n)


def rwr(binned: DataFrame, p: Params) -> DataFrame:
    """cell, chrom, i, j, v: imputed proximities of the band."""
    if p.rwr_method not in METHODS:
        raise ValueError(f"no such method: {p.rwr_method}; there are {', '.join(METHODS)}")
    if p.rwr_method == "sliding_window":
        return _windows(binned, p)
    return _by_cell(binned, lambda chrom, i, j: [walked_band(i, j, p.bins(chrom), p)])


def _by_cell(binned: DataFrame, work: Callable[[str, np.ndarray, np.ndarray], Iterable[tuple[np.ndarray, np.ndarray, np.ndarray]]]) -> DataFrame:
    """cell, chrom, i, j, v that work(chrom, i, j) gives for the contacts of each cell's chromosome, one at a time in a task."""
    kind = binned.schema["cell"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell, chrom, (i, j) in jobs.by_cell(batches):
            for bi, bj, v in work(chrom, i, j):
                for s in range(0, len(bi), BATCH):
                    t = slice(s, s + BATCH)
                    n = len(bi[t])
                    yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(cell, to_arrow_type(kind)), n), pa.repeat(chrom, n), *(pa.array(x[t]) for x in (bi, bj, v))], names=["cell", "chrom", "i", "j", "v"])

    return jobs.dealt(binned.select("cell", "chrom", "i", "j")).mapInArrow(run, f"cell {kind.simpleString()}, chrom string, i bigint, j bigint, v double")


def _windows(binned: DataFrame, p: Params) -> DataFrame:
    """The walk in windows of window_bins that start every half window, after each other.

    A window owns the pairs whose i + j, counted from its start, lies from half to one and a half windows; the first also
    owns the corner before that, and the last what follows. compat_windows leaves out the corner and the lines between.
    """
    step = max(1, (p.window_bins or 1000) // 2, p.max_rwr_bins)  # a window must hold the pairs it owns
    size = 2 * step

    def owned(w: int, start: int, end: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs that window w owns, counted from its start."""
        i, d = np.arange(end - start)[:, None], np.arange(1, p.max_rwr_bins + 1)[None, :]
        keep = i + d < end - start
        i, j = np.broadcast_to(i, keep.shape)[keep], (i + d)[keep]
        k = i + j
        if p.compat_windows:
            own = (k > step) & (k < size + step)
        else:
            own = ((k >= step) | (w == 0)) & ((k < size + step) | (end >= n))
        own &= (i + start >= p.margin) & (j + start < n - p.margin)
        return i[own], j[own]

    def work(chrom: str, i: np.ndarray, j: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        n = p.bins(chrom)
        # A cell's windows exist even where they hold no contact: the chain alone gives proximities.
        for w in range(max(0, math.ceil((n - size) / step)) + 1):
            start = w * step
            end = min(n, start + size)
            inside = (i >= start) & (j < end)
            s = walk(adjacency(i[inside] - start, j[inside] - start, end - start), p)
            x, y = owned(w, start, end, n)
            yield x + start, y + start, s[x, y]

    return _by_cell(binned, work)
