"""Local background: the mean of each pair's neighbourhood in its cell."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loopweaver.operators import jobs, runs
from loopweaver.params import Params


def local_background(z: DataFrame, p: Params, together: bool = False) -> DataFrame:
    """cell, chrom, i, j, z, nb of the pairs up to max_bins apart.

    nb is the mean over the square of local_upper_limit around a pair without that of local_lower_limit. Places on or
    below the diagonal or off the chromosome don't count; places that were not imputed count as 0. A place's counts follow
    from i, j and the chromosome alone, and the sums are taken along rows, then over rows, in arrays over one cell's band.
    z has a row for each place, or by runs (see runs) arrays. together: rows of a cell's chromosome come after each other in
    one partition, as analysis gives them, and stay there; others are brought there by one shuffle.
    """
    by_runs = isinstance(z.schema["z"].dataType, T.ArrayType)
    rows = z.select("cell", "chrom", "i", "j", *([F.size("z").alias("n")] if by_runs else []), "z")
    kind = rows.schema["cell"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple] = {}
        for cell, chrom, (*at, x) in jobs.by_cell(batches):
            have = known.get(chrom)
            if have is None or not all(np.array_equal(a, b) for a, b in zip(have[0], at, strict=True)):
                i, j = runs.places(*at) if by_runs else at
                around = Surroundings(i, j, p.chrom_lengths[chrom] // p.binsize, p)
                near = np.flatnonzero(~np.isnan(around.places))
                have = known[chrom] = at, i, j, around, near, runs.Runs(i[near], j[near])
            _, i, j, around, near, found = have
            nb = around.means(x)[near]
            ok = ~np.isnan(nb)
            if not ok.all():  # scores that are no numbers
                near, nb = near[ok], nb[ok]
                found = runs.Runs(i[near], j[near])
            yield from found.rows(cell, chrom, kind, z=x[near], nb=nb)

    placed = rows if together else jobs.dealt(rows)
    return runs.single(placed.mapInArrow(run, runs.schema(kind, "z", "nb")))


class Surroundings:
    """Local background of cells with scores at the places (i, j) of a chromosome whose last place is top.

    Row i and distance d = j - i hold a place, so that memory is bins times distances, never bins squared.
    """

    def __init__(self, i: np.ndarray, j: np.ndarray, top: int, p: Params):
        u, n, off, far = p.local_upper_limit, top + 1, 2 * p.local_upper_limit, p.max_bins + 2 * p.local_upper_limit
        self.u, self.lo = u, p.local_lower_limit
        self.shape = (n + 2 * u, off + far + u + 2)
        keep = (j <= top) & (j - i <= far)
        self.keep = None if keep.all() else np.flatnonzero(keep)
        self.at = ((i + u) * self.shape[1] + j - i + off)[keep]
        place = np.zeros(self.shape)
        d = np.arange(self.shape[1]) - off
        place[u : u + n] = (d[None, :] >= 1) & (np.arange(n)[:, None] + d[None, :] <= top)
        near = (j <= top) & (j - i <= p.max_bins) & (j > i)
        # Places beyond max_bins look at some other place, and their sums are divided by NaN.
        self.to = np.where(near, (i + u) * self.shape[1] + j - i + off, (u + 1) * self.shape[1]) - u * self.shape[1]
        self.places = np.where(near, np.maximum(self._ring(place)[self.to], 1), np.nan)

    def _ring(self, x: np.ndarray) -> np.ndarray:
        """Sums over the square of radius u around (i, d) without that of radius lo, from the first place of row 0 on. The place
        (i + a, j + b) lies a rows less a places, and b places further; off and the far columns keep them from wrapping."""
        x, u, lo, down = x.ravel(), self.u, self.lo, self.shape[1] - 1
        whole, inner = (_runs(row, 2 * r + 1, down) for r, row in zip((u, lo), (_runs(x, 2 * u + 1, 1), _runs(x, 2 * lo + 1, 1)), strict=True))
        size = x.size - 2 * u * self.shape[1]
        # A run's sum stands at its first place, r rows above and r places before.
        first = [u * self.shape[1] - r * down - r for r in (u, lo)]
        return whole[first[0] : first[0] + size] - inner[first[1] : first[1] + size]

    def means(self, z: np.ndarray) -> np.ndarray:
        """nb at the places, NaN beyond max_bins."""
        x = np.zeros(self.shape)
        x.ravel()[self.at] = z if self.keep is None else z[self.keep]
        out = self._ring(x).take(self.to)
        out /= self.places
        return out


def _runs(x: np.ndarray, size: int, step: int) -> np.ndarray:
    """Sums of `size` values that are `step` apart, from each on, by sums of twice as many."""
    out, done, power, length = None, 0, x, 1
    while True:
        if size & length:
            if out is None:
                out = power
            else:
                more = power[done * step :]
                n = min(len(out), len(more))
                out = out[:n] + more[:n]
            done += length
        length *= 2
        if length > size:
            return out
        power = power[: -length // 2 * step] + power[length // 2 * step :]


def background_pairs(i: np.ndarray, j: np.ndarray, z: np.ndarray, top: int, p: Params) -> np.ndarray:
    """nb of one cell's pairs up to max_bins apart, NaN for others."""
    return Surroundings(i, j, top, p).means(z)
