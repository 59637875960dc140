"""Hard-negative mining by dual-tree search.

Components become integers, floor(256 x), and a score is an integer inner product. Anchors are the rows whose vec_id is
divisible by ANCHOR_EVERY. An anchor's positives are the POSITIVES other rows of its label with the highest scores; its
negatives for each of them are the NEGATIVES rows of other labels with the highest scores among those from 50 to 95 percent
of the positive's. Ties go to the smaller vec_id.

Two trees meet. Their upper level is shared and laid out by Spark: cells around pivots, with the radius of each as found over
all rows. Below it, a task builds a tree over the anchors that it holds and one over the candidates that stream past. The
inner products of two balls lie within an interval that follows from their centres and radii; a pair of nodes is dropped,
and with it a whole group of anchors, where that interval misses what any of the group's anchors can still use: at least the
worst score among its best so far and, for negatives, at most 95 percent of its best positive's. Pairs of leaves are scored
exactly, the most promising first.

A search starts from the best scores among SEEDS rows, so that groups are dropped from the start; the pivots come from these
rows too. That changes how much is compared, never what is found. A cell that holds much of the input is dealt into chunks
of HELD anchors and PART candidates, and what leaves a task is at most POSITIVES or NEGATIVES rows for each anchor and
positive. In many dimensions balls overlap, and the rows compared grow with anchors times rows, the shuffle with rows times
chunks of anchors.

Rows with a null vec_id or label, or with a vector that is null, empty, or holds null or non-finite components take no part,
nor do vectors with a component of 2^22 / sqrt(dimensions) or more, whose scores need not fit into a long. Labels are whole
numbers. Of rows that share a vec_id the first by label and vector takes part, so that repeated rows count once. Vectors meet
those of their own number of dimensions only. An anchor alone under its label has no positives and so no rows; negative
positive scores leave no room for negatives. An empty table gives an empty result; columns other than vec_id, label and
embedding are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loopweaver.llm.chunks import deal_sides, work
from loopweaver.llm.common import stash, table, trimmed, unstash
from loopweaver.llm.vector_codes import integers, matrix

ANCHOR_EVERY, POSITIVES, NEGATIVES = 50, 5, 3
#: Rows that start the search and give the pivots, those with the least hashes.
SEEDS = 4096
#: Rows to a cell, about, and cells at most.
CELL_ROWS, CELLS = 16_384, 2048
#: Anchors that a task holds, and candidates that it streams past them.
HELD, PART = 8192, 262_144
#: Rows of a leaf of the anchors' and of the candidates' tree.
LEAF_ANCHORS, LEAF_ROWS = 64, 512
NONE = np.iinfo(np.int64).min


@dataclass
class Tree:
    """A ball tree: rows are sorted so that every node has a stretch of them."""

    order: np.ndarray
    start: np.ndarray
    end: np.ndarray
    child: np.ndarray  # first of two, or -1
    centre: np.ndarray
    radius: np.ndarray
    norm: np.ndarray

    @staticmethod
    def of(x: np.ndarray, leaf: int) -> Tree:
        order = np.arange(len(x))
        nodes, child = [(0, len(x))], []
        for k, (s, t) in enumerate(nodes):  # grows while it is walked
            child.append(-1)
            if t - s > leaf:
                rows = order[s:t]
                axis = x[rows].var(0).argmax()
                order[s:t] = rows[np.argsort(x[rows, axis], kind="stable")]
                child[k] = len(nodes)
                nodes += [(s, (s + t) // 2), ((s + t) // 2, t)]
        centre = np.array([x[order[s:t]].mean(0) for s, t in nodes])
        radius = np.array([np.sqrt(((x[order[s:t]] - c) ** 2).sum(1).max()) for (s, t), c in zip(nodes, centre, strict=True)])
        start, end = np.array(nodes).T
        return Tree(order, start, end, np.array(child), centre, radius * (1 + 1e-9), np.linalg.norm(centre, axis=1))


def interval(dot: np.ndarray, norm: np.ndarray, radius: np.ndarray, norm2: np.ndarray, radius2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the inner products of two balls, with room for rounding. dot: of their centres."""
    reach = norm * radius2 + norm2 * radius + radius * radius2
    slack = 1 + 1e-9 * (norm + radius) * (norm2 + radius2)
    return dot - reach - slack, dot + reach + slack


def best(owner: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Rows of the k highest scores of each owner, by owner; ties go to the smaller id."""
    order = np.lexsort((ids, -score, owner))
    o = owner[order]
    first = np.r_[True, o[1:] != o[:-1]] if len(o) else np.zeros(0, bool)
    rank = np.arange(len(o)) - np.flatnonzero(first)[np.cumsum(first) - 1] if len(o) else o
    return order[rank < k]


class Search:
    """Anchors of one chunk, and the best candidates found so far for each of their wants.

    A want is an anchor's positives (low: what the seeds give), or its negatives for one positive (low to high).
    """

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, want_of: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, same: bool):
        self.tree = Tree.of(x, LEAF_ANCHORS)
        order = self.tree.order
        self.ids, self.labels, self.x = ids[order], labels[order], x[order]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        # Wants in the order of the sorted anchors, so that a node's wants are a stretch too.
        self.given = np.argsort(place[want_of], kind="stable")
        self.want_of, self.high, self.k, self.same = place[want_of][self.given], high[self.given], k, same
        self.low = low[self.given].copy()
        self.score, self.found = np.full((len(low), k), NONE), np.zeros((len(low), k), np.int64)
        self.cut = np.searchsorted(self.want_of, np.arange(len(ids) + 1))
        self.scored = 0

    def meet(self, ids: np.ndarray, labels: np.ndarray, y: np.ndarray) -> None:
        other = Tree.of(y, LEAF_ROWS)
        ids, labels, y = ids[other.order], labels[other.order], y[other.order]
        mine = self.tree
        a, b = np.zeros(1, np.int64), np.zeros(1, np.int64)
        leaves: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(a):
            low, high = self._bounds(mine, other, a, b)
            ok = self._useful(a, low, high)
            a, b, high = a[ok], b[ok], high[ok]
            done = (mine.child[a] < 0) & (other.child[b] < 0)
            leaves.append((a[done], b[done], high[done]))
            a, b = a[~done], b[~done]
            # The larger of two nodes that have children is opened.
            mine_first = (mine.child[a] >= 0) & ((other.child[b] < 0) | (mine.radius[a] >= other.radius[b]))
            c, d = mine.child[a[mine_first]], other.child[b[~mine_first]]
            a, b = np.concatenate([c, c + 1, a[~mine_first], a[~mine_first]]), np.concatenate([b[mine_first], b[mine_first], d, d + 1])
        a, b, high = (np.concatenate([x[i] for x in leaves]) for i in range(3))
        for k in np.argsort(-high, kind="stable").tolist():
            self._leaf(int(a[k]), int(b[k]), other, ids, labels, y)

    def _bounds(self, mine: Tree, other: Tree, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return interval(np.einsum("ij,ij->i", mine.centre[a], other.centre[b]), mine.norm[a], mine.radius[a], other.norm[b], other.radius[b])

    def _useful(self, a: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        s, t = self.cut[self.tree.start[a]], self.cut[self.tree.end[a]]
        some = s < t
        least, most = np.full(len(a), np.iinfo(np.int64).max), np.full(len(a), NONE)
        for node in np.unique(a[some]).tolist():
            u, v = self.cut[self.tree.start[node]], self.cut[self.tree.end[node]]
            at = a == node
            least[at], most[at] = self.low[u:v].min(), self.high[u:v].max()
        return some & (high >= least) & (low <= most)

    def _leaf(self, a: int, b: int, other: Tree, ids: np.ndarray, labels: np.ndarray, y: np.ndarray) -> None:
        one = np.array([a]), np.array([b])
        if not self._useful(one[0], *self._bounds(self.tree, other, *one))[0]:
            return  # others have raised the bar since
        s, t, u, v = self.tree.start[a], self.tree.end[a], other.start[b], other.end[b]
        mine, theirs = self.x[s:t], y[u:v]
        if np.linalg.norm(mine, axis=1).max() * np.linalg.norm(theirs, axis=1).max() >= 2.0**52:  # else whole numbers are exact as doubles
            mine, theirs = mine.astype(np.int64), theirs.astype(np.int64)
        scores = mine @ theirs.T
        self.scored += scores.size
        alike = self.labels[s:t, None] == labels[None, u:v]
        alike = alike & (self.ids[s:t, None] != ids[None, u:v]) if self.same else ~alike
        w = np.arange(self.cut[s], self.cut[t])
        per = self.want_of[w] - s
        i, j = np.nonzero(alike[per] & (scores[per] >= self.low[w, None]) & (scores[per] <= self.high[w, None]))
        if not len(i):
            return
        hit = np.unique(w[i])
        old, slot = np.nonzero(self.score[hit] != NONE)
        owner = np.concatenate([w[i], hit[old]])
        score = np.concatenate([scores[per[i], j].astype(np.int64), self.score[hit[old], slot]])
        found = np.concatenate([ids[u:v][j], self.found[hit[old], slot]])
        top = best(owner, score, found, self.k)
        owner, score, found = owner[top], score[top], found[top]
        rank = np.arange(len(owner)) - np.searchsorted(owner, owner)
        self.score[hit] = NONE
        self.score[owner, rank], self.found[owner, rank] = score, found
        self.low[hit] = np.maximum(self.low[hit], self.score[hit, self.k - 1])

    def results(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the want, id and score of all that was found."""
        w, slot = np.nonzero(self.score != NONE)
        return self.given[w], self.found[w, slot], self.score[w, slot]


# Cells


@dataclass
class Cells:
    """Pivots of one number of dimensions, the rows that start the search, and the cells' radii."""

    pivots: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    x: np.ndarray
    radius: np.ndarray | None = None

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell of each row and the distance to its pivot."""
        far = (self.pivots**2).sum(1)[None, :] - 2 * (x @ self.pivots.T)
        cell = far.argmin(1)
        return cell, np.sqrt(((x - self.pivots[cell]) ** 2).sum(1)) * (1 + 1e-9)


def _pivots(x: np.ndarray, n: int, rounds: int = 4) -> np.ndarray:
    """Means of n groups of near rows, from n evenly spread ones."""
    n = min(n, len(x))
    p = x[np.linspace(0, len(x) - 1, n).astype(int)].copy()
    for _ in range(rounds):
        near = ((p**2).sum(1)[None, :] - 2 * (x @ p.T)).argmin(1)
        for k in np.unique(near).tolist():
            p[k] = x[near == k].mean(0)
    return p


def _cells(rows: DataFrame, count: int) -> dict[int, Cells]:
    """Cells of each number of dimensions among the seeds."""
    seeds = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SEEDS).collect()
    out = {}
    for d in sorted({r["dims"] for r in seeds}):
        own = [r for r in seeds if r["dims"] == d]
        x = np.array([r["v"] for r in own], float)
        out[d] = Cells(_pivots(x, max(1, min(count // CELL_ROWS, CELLS))), np.array([r["vec_id"] for r in own]), np.array([r["label"] for r in own]), x)
    return out


_ROW = "dims int, cell int, label bigint, vec_id bigint, distance double, v array<bigint>"


def _placed(rows: DataFrame, cells: dict[int, Cells]) -> DataFrame:
    """Rows with their cells; those of a number of dimensions that no seed has are in one cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column("dims").to_numpy()
            for d in np.unique(every).tolist():
                b = batch.filter(pa.array(every == d))
                x = matrix(b.column("v"), d).astype(float)
                cell, distance = cells[d].nearest(x) if d in cells else (np.zeros(len(x), int), np.linalg.norm(x, axis=1))
                yield pa.RecordBatch.from_arrays([b.column("dims"), pa.array(cell, pa.int32()), b.column("label"), b.column("vec_id"), pa.array(distance), b.column("v")], names=[x.split(" ")[0] for x in _ROW.split(", ")])

    return rows.select("dims", "label", "vec_id", "v").mapInArrow(trimmed(run), _ROW)


_SENT = "dims int, cell int, label bigint, vec_id bigint, v array<bigint>, low array<bigint>, high array<bigint>"
_NAMES = [x.split(" ")[0] for x in _SENT.split(", ")]


def _sent(anchors: DataFrame, cells: dict[int, Cells], k: int, same: bool) -> DataFrame:
    """Anchors (dims, cell, label, vec_id, v, low, high) with every cell that can hold what they want. The upper level of both
    trees: anchors of one cell are a node, dropped as a whole where no anchor in it can use a cell."""

    def routed(d: int, home: np.ndarray, labels: np.ndarray, ids: np.ndarray, x: np.ndarray, want_of: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if d not in cells:
            return np.arange(len(x)), np.zeros(len(x), int), low
        c = cells[d]
        seeded = Search(ids, labels, x, want_of, low, high, k, same)
        seeded.meet(c.ids, c.labels, c.x)
        raised = np.empty_like(low)
        raised[seeded.given] = seeded.low
        norms = np.linalg.norm(c.pivots, axis=1)
        row, to = [], []
        for cell in np.unique(home).tolist():
            group = np.flatnonzero(home == cell)
            wants = np.flatnonzero(np.isin(want_of, group))
            if not len(wants):
                continue
            centre = x[group].mean(0)
            radius = np.sqrt(((x[group] - centre) ** 2).sum(1).max()) * (1 + 1e-9)
            lo, hi = interval(c.pivots @ centre, np.linalg.norm(centre), radius, norms, c.radius)
            left = np.flatnonzero((c.radius >= 0) & (hi >= raised[wants].min()) & (lo <= high[wants].max()))
            lo, hi = interval(x[want_of[wants]] @ c.pivots[left].T, np.linalg.norm(x[want_of[wants]], axis=1)[:, None], 0.0, norms[None, left], c.radius[None, left])
            w, at = np.nonzero((hi >= raised[wants, None]) & (lo <= high[wants, None]))
            pairs = np.unique(np.column_stack([want_of[wants[w]], left[at]]), axis=0)
            row.append(pairs[:, 0])
            to.append(pairs[:, 1])
        none = [np.zeros(0, np.int64)]
        return np.concatenate(row or none), np.concatenate(to or none), raised

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column("dims").to_numpy()
            for d in np.unique(every).tolist():
                b = batch.filter(pa.array(every == d))
                sizes = np.diff(b.column("low").offsets.to_numpy())
                flat = lambda c: b.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64)  # noqa: B023, E731
                row, to, raised = routed(d, *(b.column(c).to_numpy() for c in ("cell", "label", "vec_id")), matrix(b.column("v"), d).astype(float), np.repeat(np.arange(b.num_rows), sizes), flat("low"), flat("high"))
                low = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), pa.array(raised))
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays([b.column("dims").take(at), pa.array(to, pa.int32()), *(b.column(c).take(at) for c in ("label", "vec_id", "v")), low.take(at), b.column("high").take(at)], names=_NAMES)

    return anchors.select(*_NAMES).mapInArrow(trimmed(run), _SENT)


class _Task:
    """Anchors held by a task, as chunks.work() drives it. columns: where a row's own columns begin."""

    def __init__(self, held: list[pa.RecordBatch], dims: int, columns: int, k: int, same: bool):
        self.dims, self.columns = dims, columns
        ids, labels, x = (np.concatenate(c) for c in zip(*map(self._rows, held), strict=True))
        lists = [[b.column(columns + i).to_pylist() for b in held] for i in (3, 4)]
        low, high = ([v for part in side for v in part] for side in lists)
        self.anchor, self.slot = np.repeat(ids, [len(v) for v in low]), np.concatenate([np.arange(len(v)) for v in low])
        want_of = np.repeat(np.arange(len(ids)), [len(v) for v in low])
        self.search = Search(ids, labels, x, want_of, np.concatenate(low).astype(np.int64), np.concatenate(high).astype(np.int64), k, same)

    def _rows(self, b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        c = self.columns
        return b.column(c).to_numpy(), b.column(c + 1).to_numpy(), matrix(b.column(c + 2), self.dims).astype(float)

    def meet(self, b: pa.RecordBatch) -> None:
        if b.num_rows:
            self.search.meet(*self._rows(b))

    def result(self) -> pa.RecordBatch:
        want, found, score = self.search.results()
        return pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in (self.anchor[want], self.slot[want], found, score)], names=["anchor_id", "slot", "id", "score"])


def _searched(anchors: DataFrame, rows: DataFrame, cells: dict[int, Cells], k: int, same: bool) -> DataFrame:
    """anchor_id, slot, rank, id and score of the k best rows for each want (slot) of each anchor."""
    key = ["dims", "cell", "label"] if same else ["dims", "cell"]
    own = ["vec_id", "own_label", "v", "low", "high"]
    sent = stash(_sent(anchors, cells, k, same), "sent").withColumn("own_label", F.col("label")).select(*key, *own)
    none = F.lit(None).cast("array<bigint>")
    passing = rows.withColumn("own_label", F.col("label")).withColumns({"low": none, "high": none}).select(*key, *own)
    dealt = deal_sides(sent, passing, key, "vec_id", HELD, PART)
    make = functools.partial(_made, len(key), k, same)
    found = dealt.mapInArrow(trimmed(work(len(key), make)), "anchor_id bigint, slot bigint, id bigint, score bigint")
    place = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)


def _made(keys: int, k: int, same: bool, key: tuple, held: list[pa.RecordBatch]) -> _Task:
    return _Task(held, key[0], keys + 3, k, same)


def mine(vectors: DataFrame) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score."""
    sound = integers(vectors).where("vec_id is not null and label is not null").select("vec_id", F.col("label").cast("bigint").alias("label"), "dims", "v")
    rows = stash(sound.groupBy("vec_id").agg(F.min(F.struct("label", "dims", "v")).alias("r")).select("vec_id", "r.*"), "rows")
    cells = _cells(rows, rows.count())
    placed = stash(_placed(rows, cells), "placed")
    for r in placed.groupBy("dims", "cell").agg(F.max("distance").alias("radius")).collect():  # a row per cell
        if r["dims"] in cells:
            c = cells[r["dims"]]
            c.radius = np.full(len(c.pivots), -1.0) if c.radius is None else c.radius
            c.radius[r["cell"]] = r["radius"]
    placed = placed.drop("distance")
    anchors = placed.where(F.col("vec_id") % ANCHOR_EVERY == 0)
    every = anchors.withColumns({"low": F.array(F.lit(NONE + 1).cast("bigint")), "high": F.array(F.lit(-(NONE + 1)).cast("bigint"))})
    positives = stash(_searched(every, placed, cells, POSITIVES, True), "positives")
    low, high = F.expr("(score + 1) div 2"), F.expr("score - (score + 19) div 20")  # 50 p <= 100 n <= 95 p
    of = positives.where("score >= 0").groupBy(F.col("anchor_id").alias("vec_id")).agg(F.sort_array(F.collect_list(F.struct("rank", low.alias("low"), high.alias("high")))).alias("w"))
    wanting = anchors.join(of, "vec_id").withColumns({"low": F.col("w.low"), "high": F.col("w.high")})
    negatives = _searched(wanting, placed, cells, NEGATIVES, False)
    # Slots count an anchor's positives from 0 in the order of their ranks.
    named = positives.select("anchor_id", (F.col("rank") - 1).cast("bigint").alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = negatives.join(named, ["anchor_id", "slot"]).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    out = stash(out, "mined")
    for x in (rows, positives):
        unstash(x)
    return out


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "embeddings")
    return mine(t.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("bigint") + 1) % 10).otherwise(F.col("label"))))
