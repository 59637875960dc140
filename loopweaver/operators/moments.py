"""Moments of scores over cells, as arrays over stretches of the band that can be merged.

What the paired tests and the outlier counts need of a place is its number of cells, the means of score and background and
of their difference, the sum of squared deviations of that, and the number of outliers. A task folds the cells that it reads
into arrays over stretches of STRETCH bins by all distances, and passes on one packed row per stretch; packed rows of
different tasks, or of earlier runs, are merged by Chan's formulas. So what is shuffled grows with tasks times places, not
with cells times places, and cells that come later are added without reading the earlier ones again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bins of a stretch, and bytes of stretches that a task holds before it passes them on: more than the largest chromosome
#: takes at 10 kb and 2 Mb (290 MB). Where a chromosome takes more, cells are passed on unfolded.
STRETCH, HELD_BYTES = 64, 512 << 20
#: Cells that are folded at once at most, and bytes of their scores and backgrounds from which they are.
CELLS, WAITING_BYTES = 32, 8 << 20

#: Arrays of a stretch: cells with a score, outliers, cells with a background, the means of score, background and difference
#: over these, and the difference's squared deviations.
FIELDS = ("cells", "outliers", "n", "case", "control", "mean", "m2")
PACKED = "chrom string, stretch bigint, width int, " + ", ".join(f"{f} binary" for f in FIELDS)


class Stretch:
    """Moments of STRETCH bins by width distances."""

    def __init__(self, width: int, arrays: np.ndarray | None = None):
        self.width = width
        self.a = np.zeros((len(FIELDS), STRETCH * width)) if arrays is None else arrays

    def fold(self, at: np.ndarray, z: np.ndarray, nb: np.ndarray, outlier: float) -> None:
        """Add scores at places, each place once or more; nb is NaN where there is no background."""
        order = np.argsort(at, kind="stable")
        first = np.flatnonzero(np.r_[True, at[order][1:] != at[order][:-1]])
        if len(first) == len(at):
            return self.add(at, z, nb, outlier)
        # Rows of one place go in rounds of different places.
        rank = np.empty(len(at), np.int64)
        rank[order] = np.arange(len(at)) - np.repeat(first, np.diff(np.r_[first, len(at)]))
        for r in range(int(rank.max()) + 1):
            now = rank == r
            self.add(at[now], z[now], nb[now], outlier)
        return None

    def add(self, at: np.ndarray, z: np.ndarray, nb: np.ndarray, outlier: float) -> None:
        """Add one score at each of different places."""
        cells, outliers, n, case, control, mean, m2 = self.a
        cells[at] += ~np.isnan(z)
        outliers[at] += z > outlier
        both = ~(np.isnan(z) | np.isnan(nb))
        if not both.all():
            at, z, nb = at[both], z[both], nb[both]
        count = n[at] + 1
        n[at] = count
        case[at] += (z - case[at]) / count
        control[at] += (nb - control[at]) / count
        old = mean[at]
        off = z - nb - old
        new = old + off / count
        mean[at] = new
        m2[at] += off * (z - nb - new)

    def put(self, at: np.ndarray, z: np.ndarray, nb: np.ndarray, outlier: float) -> None:
        """Set different places to the moments of some cells' scores there, which are rows of z and nb."""
        off = z - nb
        have = ~np.isnan(off)
        n = have.sum(0)
        if ((n > 0) & (n < len(z))).any():  # gaps of some cells
            case, control, off = (np.where(have, x, 0.0) for x in (z, nb, off))
        else:
            case, control = z, nb
        count = np.maximum(n, 1)
        a = np.stack([len(z) - np.isnan(z).sum(0), (z > outlier).sum(0), n, *(x.sum(0) / count for x in (case, control, off)), n])
        off -= a[5]
        off *= off
        a[6] = np.where(have, off, 0.0).sum(0)
        a[3:, n == 0] = 0
        self.a[:, at] = a

    def merge(self, other: Stretch) -> None:
        """Chan's formulas; widths may differ, as new runs may reach further."""
        if other.width > self.width:
            self.a, self.width, other = other.a.copy(), other.width, Stretch(self.width, self.a)
        if other.width < self.width:
            wide = np.zeros((len(FIELDS), STRETCH, self.width))
            wide[:, :, : other.width] = other.a.reshape(len(FIELDS), STRETCH, other.width)
            other = Stretch(self.width, wide.reshape(len(FIELDS), -1))
        a, b = self.a, other.a
        n = a[2] + b[2]
        share = np.divide(b[2], n, out=np.zeros_like(n), where=n > 0)
        off = b[5] - a[5]
        a[6] += b[6] + off * off * a[2] * share
        for k in (3, 4, 5):
            a[k] += (b[k] - a[k]) * share
        a[:3] += b[:3]


def _pack(held: dict[tuple[str, int], Stretch]) -> Iterator[pa.RecordBatch]:
    names = ["chrom", "stretch", "width", *FIELDS]
    for (chrom, stretch), s in held.items():
        yield pa.RecordBatch.from_arrays([pa.array([chrom]), pa.array([stretch], pa.int64()), pa.array([s.width], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in s.a)], names=names)


def _unpack(b: pa.RecordBatch) -> Iterator[tuple[str, int, Stretch]]:
    for k in range(b.num_rows):
        row = [b.column(c)[k].as_py() for c in range(b.num_columns)]
        yield row[0], row[1], Stretch(row[2], np.array([np.frombuffer(x) for x in row[3:]]))


class Held:
    """The stretches that a task holds."""

    def __init__(self, width: int, outlier: float):
        self.width, self.outlier = width, outlier
        self.most = max(1, HELD_BYTES // (8 * len(FIELDS) * STRETCH * width))
        self._stretches: dict[tuple[str, int], Stretch] = {}
        self._passed: list[pa.RecordBatch] = []
        self._places: tuple = ()
        self._waiting: list[tuple[np.ndarray, np.ndarray]] = []

    @property
    def stretches(self) -> dict[tuple[str, int], Stretch]:
        """With the cells that waited."""
        self._fold()
        return self._stretches

    def take(self, chrom: str, i: np.ndarray, j: np.ndarray, z: np.ndarray, nb: np.ndarray, once: bool = False) -> Iterator[pa.RecordBatch]:
        """Fold rows of a chromosome; what had to be passed on for it. once: every place is there once, in the order of i; cells
        after each other with the very same i and j wait for each other, and their arrays must not change meanwhile."""
        if once:
            if self._waiting and not (chrom == self._places[0] and i is self._places[1] and j is self._places[2]):
                self._fold()
            self._places = chrom, i, j
            self._waiting.append((z, nb))
            if len(self._waiting) >= CELLS or len(self._waiting) * 2 * z.nbytes >= WAITING_BYTES:
                self._fold()
        else:
            self._fold()
            order = np.argsort(i // STRETCH, kind="stable")
            i, j, z, nb = (x[order] for x in (i, j, z, nb))
            for s, t, key in self._cuts(chrom, i):
                self._room(key)
                self._stretches.setdefault(key, Stretch(self.width)).fold(self._at(i[s:t], j[s:t]), z[s:t], nb[s:t], self.outlier)
        passed, self._passed = self._passed, []
        yield from passed

    def _fold(self) -> None:
        """Fold the cells that wait."""
        waiting, self._waiting = self._waiting, []
        if not waiting:
            return
        chrom, i, j = self._places
        for s, t, key in self._cuts(chrom, i):
            self._room(key)
            now = Stretch(self.width)
            now.put(self._at(i[s:t], j[s:t]), *(np.stack([cell[k][s:t] for cell in waiting]) for k in (0, 1)), self.outlier)
            if key in self._stretches:
                self._stretches[key].merge(now)
            else:
                self._stretches[key] = now

    def _cuts(self, chrom: str, i: np.ndarray) -> Iterator[tuple[int, int, tuple[str, int]]]:
        """Begin, end and key of each stretch of sorted bins."""
        group = i // STRETCH
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)] if len(group) else []
        for s, t in zip(cuts[:-1], cuts[1:], strict=True):
            yield s, t, (chrom, int(group[s]))

    def _at(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return (i % STRETCH) * self.width + j - i

    def _room(self, key: tuple[str, int]) -> None:
        """Pass the stretches on where one more would be too many."""
        if key not in self._stretches and len(self._stretches) >= self.most:
            held, self._stretches = self._stretches, {}
            self._passed.extend(_pack(held))

    def rest(self) -> Iterator[pa.RecordBatch]:
        self._fold()
        passed, self._passed = self._passed, []
        yield from passed
        held, self._stretches = self._stretches, {}
        yield from _pack(held)


def fold(z: DataFrame, width: int, outlier: float = 1.96) -> DataFrame:
    """Packed moments of each task's rows (chrom, i, j, z, nb), with 0 <= j - i < width; stretches of a place repeat between
    tasks. Nothing is shuffled. Nulls and NaNs count as no value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Held(width, outlier)
        for b in batches:
            names = b.column(0).dictionary_encode()
            code = names.indices.to_numpy(zero_copy_only=False)
            columns = [b.column(k).to_numpy(zero_copy_only=False).astype(t) for k, t in ((1, np.int64), (2, np.int64), (3, float), (4, float))]
            for c, chrom in enumerate(names.dictionary.to_pylist()):
                yield from held.take(chrom, *(x if len(names.dictionary) == 1 else x[code == c] for x in columns))
        yield from held.rest()

    return z.select("chrom", "i", "j", "z", "nb").mapInArrow(run, PACKED)


def merged(*packed: DataFrame) -> DataFrame:
    """One packed row per chrom and stretch. A task streams a stretch's rows and holds one."""
    rows = packed[0]
    for more in packed[1:]:
        rows = rows.unionByName(more)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, None
        for b in batches:
            for chrom, stretch, s in _unpack(b):
                if (chrom, stretch) != now:
                    if held is not None:
                        yield from _pack({now: held})
                    now, held = (chrom, stretch), s
                    held.a = held.a.copy()
                else:
                    held.merge(s)
        if held is not None:
            yield from _pack({now: held})

    return rows.repartition("chrom", "stretch").sortWithinPartitions("chrom", "stretch").mapInArrow(run, PACKED)


def places(packed: DataFrame) -> DataFrame:
    """chrom, i, j, n, case_avg, control_avg, mean, sd and outlier_count of the places that some cell has a score at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chrom, stretch, s in _unpack(b):
                cells, outliers, n, case, control, mean, m2 = s.a
                k = np.flatnonzero(cells)
                i = stretch * STRETCH + k // s.width
                null = n[k] == 0
                with np.errstate(invalid="ignore", divide="ignore"):
                    sd = np.sqrt(np.maximum(m2[k], 0) / (n[k] - 1))
                doubles = [pa.array(x[k] if x is not None else sd, mask=null | (n[k] < 2) if x is None else null) for x in (case, control, mean, None)]
                yield pa.RecordBatch.from_arrays([pa.array([chrom] * len(k)), pa.array(i), pa.array(i + k % s.width), pa.array(n[k].astype(np.int64)), *doubles, pa.array(outliers[k].astype(np.int64))], names=["chrom", "i", "j", "n", "case_avg", "control_avg", "mean", "sd", "outlier_count"])

    return packed.mapInArrow(run, "chrom string, i bigint, j bigint, n bigint, case_avg double, control_avg double, mean double, sd double, outlier_count bigint")


def pair_moments(z: DataFrame, width: int, outlier: float = 1.96) -> DataFrame:
    """places() of all rows at once."""
    return places(merged(fold(z, width, outlier)))
