"""Embedding near-dedup: subspace pigeonhole join.

Unit vectors with cosine >= t lie within squared distance D = 2 - 2t. After a rotation the vectors are cut into blocks; if
two are within D, then in some block they are within D * (dimensions of the block) / (all dimensions), as the blocks'
squared distances add up to the whole. In each block a range join finds the pairs within its budget: the block's leading
coordinates make a grid of cells at least two radii wide, a vector belongs to one cell and visits those of larger number
that its ball reaches, and each cell is compared in tiles. A pair is verified, with the cosine of the original vectors in
double precision, in the first block whose budget it meets, so that every link is counted once and no list of pairs has
to be made distinct. What leaves a cell is counts of links per vector and a spanning forest of its links, never all pairs.
Components come from the forests.

Equal vectors are grouped first, and a group takes part once with its weight. A cell's own vectors are dealt into chunks
of TASK_ROWS and its visitors, with its own ones, into chunks of OTHER_ROWS; a task holds one chunk of the first in memory
and streams one chunk of the second past it, so that a cell of any size is worked off in bounded tasks and visitors are
never compared with each other. In many dimensions every grid is coarse: the work falls by a constant factor against
comparing all pairs. `grid_axes` adds a gridded coordinate for each fivefold of rows; that changes the plan only, never
the links.

A vector is a different pair of vec_id and embedding: repeated rows are one vector, rows that share a vec_id but differ in
their embedding are each judged by their own (and link with each other where they meet the threshold). Vectors link with
those of their own number of dimensions only. Vectors that are null, zero, or that hold null or non-finite components, or
have a null vec_id, link with nothing and are their own component. Components of any finite size are scaled by a power of
two first, so that no norm overflows. An empty table gives an empty result; columns other than vec_id and embedding are
ignored.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loopweaver.llm.chunks import deal, work
from loopweaver.llm.common import stash, table, trimmed, unstash
from loopweaver.llm.components import connected_components

THRESHOLD = 0.95
BLOCK_DIMS = 8
#: Vectors of a cell that a task holds, and that it streams past them, at most about; more are dealt into chunks.
TASK_ROWS, OTHER_ROWS = 16_384, 262_144
TILE = 1024
#: Share of a tile's pairs from which it is judged by products of matrices.
DENSE = 1 / 16
SEED = 20_240_601


@functools.lru_cache(maxsize=16)
def rotation(dims: int) -> np.ndarray:
    """A fixed random rotation, so that no block holds most of the vectors' differences."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def blocks(dims: int) -> list[tuple[int, int]]:
    return [(a, min(a + BLOCK_DIMS, dims)) for a in range(0, dims, BLOCK_DIMS)]


def grid_axes(rows: int, dims: int) -> int:
    """Coordinates of a block that are gridded: one more for each fivefold of rows. The links are the same for any number."""
    return int(min(dims, max(1, round(math.log(max(rows, 1) / 20_000, 5)) + 1)))


def _cells(x: np.ndarray, axes: int, width: float, radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, cells and whether these are the rows' own: each row's own cell, and the larger-numbered ones its ball reaches."""
    own = np.floor(x[:, :axes] / width).astype(np.int16)
    below = x[:, :axes] - own * width
    row, step, gap = np.arange(len(x)), np.zeros((len(x), 0), np.int16), np.zeros(len(x))
    for k in range(axes):
        at = below[row, k]
        moves = []
        for move, far in ((0, 0.0), (-1, at), (1, width - at)):
            total = gap + far * far
            ok = total <= radius * radius if move else np.ones(len(row), bool)
            moves.append((row[ok], np.column_stack([step[ok], np.full(int(ok.sum()), move, np.int16)]), total[ok]))
        row, step, gap = (np.concatenate([m[i] for m in moves]) for i in range(3))
    first = step[np.arange(len(step)), (step != 0).argmax(1)]  # of the steps taken; 0 at home
    keep = first >= 0
    return row[keep], own[row[keep]] + step[keep], first[keep] == 0


def unit_rows(raw: np.ndarray) -> np.ndarray:
    return raw / np.linalg.norm(raw, axis=1, keepdims=True)


class Side:
    """Vectors as a task compares them: as they are, their norms, rotated unit vectors, and one block of those."""

    def __init__(self, raw: np.ndarray, block: int):
        self.raw, self.norms = raw, np.linalg.norm(raw, axis=1)
        self.x = (raw / self.norms[:, None]) @ rotation(raw.shape[1])
        lo, hi = blocks(raw.shape[1])[block]
        self.y = self.x[:, lo:hi].astype(np.float32)
        self.sq = (self.y * self.y).sum(1)


class Cell:
    """The vectors of one chunk of a cell in one block, and the links found among them and with others."""

    def __init__(self, block: int, ids: np.ndarray, weight: np.ndarray, raw: np.ndarray, threshold: float):
        self.block, self.threshold = block, threshold
        self.ids, self.weight = ids, weight
        self.mine = Side(raw, block)
        self.counts = np.zeros(len(ids), np.int64)
        self.forest = Forest(ids)
        parts = blocks(raw.shape[1])[: block + 1]
        self.parts = parts
        self.budget = np.array([(2 - 2 * threshold) * (b - a) / raw.shape[1] * (1 + 1e-9) + 1e-12 for a, b in parts])

    def _judged(self, other: Side, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        """Whether pairs are linked and this block is the first within budget. A pair gives the same in every task."""
        d = self.mine.x[u] - other.x[v]
        d *= d
        far = [d[:, a:b].sum(1) > limit for (a, b), limit in zip(self.parts, self.budget, strict=True)]
        ok = ~far[-1]
        for f in far[:-1]:
            ok &= f
        m = self.mine
        ok[ok] = (m.raw[u[ok]] * other.raw[v[ok]]).sum(1) / (m.norms[u[ok]] * other.norms[v[ok]]) >= self.threshold
        return ok

    def _dense(self, other: Side, s: slice, t: slice, near: np.ndarray) -> np.ndarray:
        """_judged() of a tile in which many pairs are near, by products of matrices; what those leave within rounding is
        judged pair by pair."""
        m, room = self.mine, 1e-9
        sure, open_ = near.copy(), np.zeros_like(near)
        for k, (a, b) in enumerate(self.parts):
            p, q = m.x[s, a:b], other.x[t, a:b]
            over = (p * p).sum(1)[:, None] + (q * q).sum(1)[None, :] - 2 * (p @ q.T) - self.budget[k]
            sure &= over > room if k < self.block else over < -room
            open_ |= np.abs(over) <= room
        cosine = m.raw[s] / m.norms[s, None] @ (other.raw[t] / other.norms[t, None]).T - self.threshold
        sure &= cosine > room
        open_ |= np.abs(cosine) <= room
        i, j = np.nonzero(open_ & near)
        sure[i, j] = self._judged(other, i + s.start, j + t.start)
        return sure

    def _tiles(self, other: Side, same: bool) -> Iterator[tuple[slice, slice, np.ndarray]]:
        """Tiles with their linked pairs (those above the diagonal where both sides are the same)."""
        limit = np.float32(self.budget[-1] + 1e-5)  # single precision only proposes
        m = self.mine
        for a in range(0, len(m.y), TILE):
            for b in range(a if same else 0, len(other.y), TILE):
                s, t = slice(a, min(a + TILE, len(m.y))), slice(b, min(b + TILE, len(other.y)))
                near = (m.y[s] * np.float32(-2)) @ other.y[t].T
                near += m.sq[s, None]
                near += other.sq[None, t]
                near = near <= limit
                if same and a == b:
                    near = np.triu(near, 1)
                n = np.count_nonzero(near)
                if n > near.size * DENSE:
                    linked = self._dense(other, s, t, near)
                elif n:
                    i, j = np.nonzero(near)
                    ok = np.concatenate([self._judged(other, i[o : o + 100_000] + a, j[o : o + 100_000] + b) for o in range(0, n, 100_000)])
                    linked = np.zeros_like(near)
                    linked[i[ok], j[ok]] = True
                else:
                    continue
                if linked.any():
                    yield s, t, linked

    def meet_own(self) -> None:
        w = self.weight.astype(float)
        for s, t, linked in self._tiles(self.mine, True):
            self.counts[s] += (linked @ w[t]).astype(np.int64)
            self.counts[t] += (w[s] @ linked).astype(np.int64)
            self.forest.add(s.start, t.start, linked)

    def meet(self, others: pa.RecordBatch) -> pa.RecordBatch:
        """Numbers of links of the others that have some."""
        ids, weight, raw = _rows_of(others)
        counts = np.zeros(len(ids), np.int64)
        w, v = self.weight.astype(float), weight.astype(float)
        base = self.forest.admit(ids)
        for s, t, linked in self._tiles(Side(raw, self.block), False):
            self.counts[s] += (linked @ v[t]).astype(np.int64)
            counts[t] += (w[s] @ linked).astype(np.int64)
            self.forest.add(s.start, base + t.start, linked)
        self.forest.dismiss()
        hit = np.flatnonzero(counts)
        return _found(ids[hit], [None] * len(hit), counts[hit])

    def result(self) -> pa.RecordBatch:
        """Numbers of links of the chunk's own vectors, and the forest's links."""
        hit = np.flatnonzero(self.counts)
        u, v = self.forest.links()
        return _found(np.concatenate([self.ids[hit], u]), [*[None] * len(hit), *v.tolist()], np.concatenate([self.counts[hit], np.zeros(len(u), np.int64)]))


class Forest:
    """The links that join trees, found with one label per vector: of a tile's links only those between different trees are
    looked at, and each round hooks every tree that has one onto a tree of a smaller label."""

    def __init__(self, ids: np.ndarray):
        self.ids = self.all = ids
        self.root = np.arange(len(ids))
        self.found: list[tuple[np.ndarray, np.ndarray]] = []

    def admit(self, ids: np.ndarray) -> int:
        """Others that are met for a while; where their numbers begin."""
        self.all = np.concatenate([self.ids, ids])
        self.root = np.concatenate([self.root, np.arange(len(self.ids), len(self.all))])
        return len(self.ids)

    def dismiss(self) -> None:
        """Trees of one's own have labels of one's own, as those are the smaller ones."""
        self.root = self.root[: len(self.ids)]

    def add(self, s: int, t: int, linked: np.ndarray) -> None:
        u, v = np.nonzero(linked & (self.root[s : s + linked.shape[0], None] != self.root[None, t : t + linked.shape[1]]))
        u, v = u + s, v + t
        while len(u):
            a, b = self.root[u], self.root[v]
            low, high = np.minimum(a, b), np.maximum(a, b)
            hooked, at = np.unique(high, return_index=True)
            self.found.append((self.all[u[at]], self.all[v[at]]))
            self.root[hooked] = low[at]
            while (self.root != (up := self.root[self.root])).any():
                self.root = up
            apart = self.root[u] != self.root[v]
            u, v = u[apart], v[apart]

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        none = [np.zeros(0, np.int64)]
        return np.concatenate([a for a, _ in self.found] or none), np.concatenate([b for _, b in self.found] or none)


def _found(u, v, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(n, pa.int64())], names=["u", "v", "n"])


def _rows_of(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return b.column(6).to_numpy(), b.column(7).to_numpy(), np.frombuffer(b"".join(b.column(8).to_pylist()), np.float64).reshape(b.num_rows, -1)


def _cell_of(threshold: float):
    def make(key: tuple, held: list[pa.RecordBatch]) -> Cell:
        rows = [_rows_of(b) for b in held]
        out = Cell(key[1], *(np.concatenate([r[k] for r in rows]) for k in range(3)), threshold)
        if key[-1] == 0:
            out.meet_own()
        return out

    return make


def links(groups: DataFrame, rows: int, threshold: float = THRESHOLD) -> DataFrame:
    """u, v, n: with v null, n links found of group u in some task; else a link of a spanning forest. groups: id, weight,
    dims, raw."""
    task_rows, other_rows = TASK_ROWS, OTHER_ROWS

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column(2).to_numpy()
            for dims in np.unique(every).tolist():  # vectors of one number of dimensions at a time
                b = batch.filter(pa.array(every == dims))
                x = unit_rows(np.frombuffer(b"".join(b.column(3).to_pylist()), np.float64).reshape(b.num_rows, -1)) @ rotation(dims)
                for k, (lo, hi) in enumerate(blocks(dims)):
                    reach = math.sqrt((2 - 2 * threshold) * (hi - lo) / dims) + 1e-6
                    # Cells two radii wide, at least one standard deviation of a coordinate.
                    row, cell, home = _cells(x[:, lo:hi], grid_axes(rows, hi - lo), max(2 * reach, 1 / math.sqrt(dims)), reach)
                    at = pa.array(row)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([c.tobytes() for c in cell], pa.binary()), pa.array([k] * len(row), pa.int32()), *(b.column(i).take(at) for i in range(4)), pa.array(home)], names=["cell", "block", "id", "weight", "dims", "raw", "home"]
                    )

    placed = stash(groups.select("id", "weight", "dims", "raw").mapInArrow(trimmed(place), "cell binary, block int, id bigint, weight bigint, dims int, raw binary, home boolean"), "cells")
    ordered, sizes = deal(placed.select("dims", "block", "cell", "id", "weight", "raw", "home"), ["dims", "block", "cell"], "id", F.col("home"), task_rows, other_rows)
    out = stash(ordered.drop("home").mapInArrow(trimmed(work(3, _cell_of(threshold))), "u bigint, v bigint, n bigint"), "found")
    unstash(placed)
    unstash(sizes)
    return out


def deduplicate(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id and kept of each row."""
    v = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    # No condition on an array's elements is evaluated for null arrays.
    sound = F.coalesce(F.col("vec_id").isNotNull() & (F.size("e") > 0) & F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("e", lambda x: x != 0), F.lit(False))
    both = v.select("vec_id", "e", sound.alias("sound"), F.xxhash64("e").alias("h1"), F.xxhash64(F.lit(1), F.col("e")).alias("h2"))
    rows = stash(both, "vectors")
    # One group for each different vector, and its different vec_ids.
    own = rows.where("sound").groupBy("h1", "h2", "e").agg(F.countDistinct("vec_id").alias("weight"), F.min("vec_id").alias("least"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = []
            for e in b.column(4):
                x = e.values.to_numpy()
                raw.append(np.ldexp(x, -int(np.frexp(np.abs(x).max())[1])).tobytes())  # the same cosines, and no overflow
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(4)), pa.array([len(e.values) for e in b.column(4)], pa.int32()), pa.array(raw, pa.binary())], names=["h1", "h2", "weight", "least", "dims", "raw"])

    made = own.select("h1", "h2", "weight", "least", "e").mapInArrow(pack, "h1 bigint, h2 bigint, weight bigint, least bigint, dims int, raw binary")
    packed = stash(made.withColumn("id", F.monotonically_increasing_id()), "groups")
    found = links(packed, packed.count(), threshold)
    counts = found.where("v is null").groupBy(F.col("u").alias("id")).agg(F.sum("n").alias("n"))
    comps = connected_components(found.where("v is not null").select("u", "v"))
    groups = packed.select("id", "h1", "h2", "weight", "least").join(counts, "id", "left").join(comps, F.col("id") == F.col("node"), "left").drop("node")
    groups = stash(groups.select("h1", "h2", "least", F.coalesce("component", "id").alias("component"), (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links")), "classes")
    named = groups.groupBy("component").agg(F.min("least").alias("component_id"))
    of = groups.join(named, "component").select(F.col("h1").alias("c1"), F.col("h2").alias("c2"), "n_links", "component_id")
    out = rows.select("vec_id", "sound", "h1", "h2").join(of, F.col("sound") & (F.col("h1") == F.col("c1")) & (F.col("h2") == F.col("c2")), "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    out = stash(out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))), "deduplicated")
    for x in (rows, packed, found, comps, groups):
        unstash(x)
    return out


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(table(spark, sf_dir, "embeddings"))
