"""Density-peak clusters of candidates, their summits, and the summits' scores per cell."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loopweaver.operators import scan
from loopweaver.params import Params
from loopweaver.staging import staged

_TILE = 2048
#: Candidates of a chromosome up to which one task works them off; more are worked off by joins.
GROUP_ROWS = 20_000


def _within(points: DataFrame, radius2: float) -> DataFrame:
    """chrom, i, j and the number of points within a squared radius, the point included; an equi-join over offsets."""
    r = int(math.isqrt(int(radius2)))
    steps = [(a, b) for a in range(-r, r + 1) for b in range(-r, r + 1) if a * a + b * b <= radius2]
    around = F.explode(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in steps)))
    near = points.select("chrom", "i", "j", around.alias("s")).select("chrom", F.col("i").alias("ci"), F.col("j").alias("cj"), (F.col("i") + F.col("s.a")).alias("i"), (F.col("j") + F.col("s.b")).alias("j"))
    return near.join(points.select("chrom", "i", "j"), ["chrom", "i", "j"]).groupBy("chrom", F.col("ci").alias("i"), F.col("cj").alias("j")).agg(F.count(F.lit(1)).alias("n"))


def not_isolated(candidates: DataFrame) -> DataFrame:
    """Candidates with another one within sqrt(8) bins."""
    some = _within(candidates, 8).where("n > 1").select("chrom", "i", "j")
    return candidates.join(some, ["chrom", "i", "j"], "left_semi")


def density(candidates: DataFrame, p: Params) -> DataFrame:
    """Adds ro, the number of candidates within clustering_gap * sqrt(2) bins, itself included."""
    return candidates.join(_within(candidates, 2 * p.clustering_gap**2).withColumnRenamed("n", "ro"), ["chrom", "i", "j"])


def nearest_denser(points: np.ndarray, ro: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distance to, and row of, the nearest strictly denser point (the first of ties); the largest distance and the point
    itself where there is none. Distances are made in tiles."""
    n = len(points)
    delta, to = np.zeros(n), np.arange(n)
    for s in range(0, n, _TILE):
        d = np.hypot(*(points[s : s + _TILE, None, k] - points[None, :, k] for k in (0, 1)))
        denser = ro[None, :] > ro[s : s + _TILE, None]
        some = denser.any(1)
        masked = np.where(denser, d, np.inf)
        best = masked.argmin(1)
        delta[s : s + _TILE] = np.where(some, masked[np.arange(len(d)), best], d.max(1))
        to[s : s + _TILE] = np.where(some, best, np.arange(s, s + len(d)))
    return delta, to


def decide(g: pd.DataFrame) -> pd.DataFrame:
    """Ranks and clusters of one chromosome's candidates, sorted by place. Columns i, j, ro are given."""
    g = g.sort_values(["i", "j"]).reset_index(drop=True)
    delta, to = nearest_denser(g[["i", "j"]].to_numpy(float), g["ro"].to_numpy())
    g["rownum"] = np.arange(len(g))
    g["delta"], g["parent"] = delta, to
    g["eta"] = g["ro"] * delta
    levels = np.unique(-g["eta"].to_numpy(), return_inverse=True)[1] + 1
    g["rank"] = levels
    r, e = levels / levels.max(), g["eta"].to_numpy() / (g["eta"].max() or 1.0)
    g["turned_rank"], g["turned_eta"] = (r - e) / math.sqrt(2), (e + r) / math.sqrt(2)
    bend = g["eta"][g["turned_eta"].to_numpy().argmin()]
    cluster = np.full(len(g), -1)
    centre = g["eta"].to_numpy() > bend
    cluster[centre] = np.arange(1, centre.sum() + 1)
    # A parent is strictly denser, so from the densest down each one is settled before its children.
    for k in np.argsort(-g["ro"].to_numpy(), kind="stable"):
        if not centre[k]:
            cluster[k] = cluster[to[k]]
    g["eta_cluster"] = cluster
    return g


def summits(g: pd.DataFrame, gap: int) -> np.ndarray:
    """1 for the summits of one cluster: the smallest rate first, and none within the gap of one found before."""
    x, y = g["x1"].to_numpy(), g["y1"].to_numpy()
    left = np.ones(len(g), bool)
    out = np.zeros(len(g), int)
    order = np.lexsort((g["rownum"].to_numpy(), g["fdr_dist"].to_numpy()))
    for k in order:
        if left[k]:
            out[k] = 1
            left &= (np.abs(x - x[k]) > gap) | (np.abs(y - y[k]) > gap)
    return out


_ADDED = "rownum bigint, delta double, parent bigint, eta double, rank bigint, turned_rank double, turned_eta double, eta_cluster bigint"
_NAMES = [x.split(" ")[0] for x in _ADDED.split(", ")]


def clustered(candidates: DataFrame, p: Params, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Candidates with ro, delta, eta, ranks, eta_cluster, cluster_size, neg_log10_fdr and summit.

    Isolation and density are joins. What follows runs in one task per chromosome where no chromosome has over group_rows
    candidates, else as joins over the grid (by_joins); both give the same rows. Chromosomes with a single candidate, or only
    isolated ones, give no rows.
    """
    dense = staged(density(not_isolated(staged(candidates, "candidates")), p), "dense")
    most = dense.groupBy("chrom").count().agg(F.max("count")).first()[0] or 0
    out = by_groups(dense, p) if most <= group_rows else by_joins(dense, p)
    fdr = F.when(F.col("fdr_dist") == 0, float("inf")).otherwise(-F.log10(F.nullif("fdr_dist", F.lit(0.0))))
    sizes = out.groupBy("chrom", "eta_cluster").agg(F.count(F.lit(1)).alias("cluster_size"), F.sum(fdr).alias("neg_log10_fdr"))
    names = [*dense.columns, *_NAMES, "summit", "cluster_size", "neg_log10_fdr"]
    return out.join(sizes, ["chrom", "eta_cluster"]).select(*names)


def by_groups(dense: DataFrame, p: Params) -> DataFrame:
    """Clusters and summits, a chromosome in a task."""

    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = decide(g)
        g["x1"], g["y1"] = g["i"] * p.binsize, g["j"] * p.binsize
        g["summit"] = 0
        for _, part in g.groupby("eta_cluster"):
            g.loc[part.index, "summit"] = summits(part, p.gap)
        return g[names]

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dense.schema.fields) + ", " + _ADDED + ", summit int"
    names = [*dense.columns, *_NAMES, "summit"]
    return dense.groupBy("chrom").applyInPandas(run, schema)


# The same by joins


def _reach(points: DataFrame, size: int, around: bool) -> DataFrame:
    """points with the cell of this size that each lies in, or, around, with that and the eight about it."""
    cell = [F.floor(F.col(c) / size) for c in ("i", "j")]
    if not around:
        return points.withColumns({"ci": cell[0], "cj": cell[1]})
    steps = F.explode(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1))))
    return points.withColumn("_s", steps).withColumns({"ci": cell[0] + F.col("_s.a"), "cj": cell[1] + F.col("_s.b")}).drop("_s")


def farthest(tops: DataFrame, points: DataFrame) -> DataFrame:
    """chrom, rownum, d2: the squared distance of each of tops to the farthest point. That is a corner of the points' hull, which
    follows from the ends of each row of the grid; a chromosome has two for each bin at most."""
    ends = points.groupBy("chrom", "i").agg(F.min("j").alias("low"), F.max("j").alias("high"))

    def corners(g: pd.DataFrame) -> pd.DataFrame:
        at = sorted({(i, j) for c in ("low", "high") for i, j in zip(g["i"].tolist(), g[c].tolist(), strict=True)})
        hull: list[tuple[int, int]] = []
        for way in (at, at[::-1]):
            side: list[tuple[int, int]] = []
            for q in way:
                while len(side) > 1 and (side[-1][0] - side[-2][0]) * (q[1] - side[-2][1]) <= (side[-1][1] - side[-2][1]) * (q[0] - side[-2][0]):
                    side.pop()
                side.append(q)
            hull += side
        return pd.DataFrame({"chrom": g["chrom"].iloc[0], "hi": [[h[0] for h in hull]], "hj": [[h[1] for h in hull]]})

    hulls = ends.groupBy("chrom").applyInPandas(corners, "chrom string, hi array<bigint>, hj array<bigint>")
    far = F.array_max(F.zip_with("hi", "hj", lambda a, b: (a - F.col("i")) * (a - F.col("i")) + (b - F.col("j")) * (b - F.col("j"))))
    return tops.join(F.broadcast(hulls), "chrom").select("chrom", "rownum", far.alias("d2"))  # a row per chromosome


def denser(points: DataFrame) -> DataFrame:
    """chrom, rownum, d2 and ref of the nearest strictly denser point of each (the first of ties), itself and the farthest point's
    distance where there is none. points: chrom, i, j, ro, rownum.

    Points look into the cells about theirs; what lies within a cell's size is sure to be found, and those that found nothing
    so near go on with cells of four times the size.
    """
    top = points.groupBy("chrom").agg(F.max("ro").alias("top"))
    marked = staged(points.join(F.broadcast(top), "chrom").select("chrom", "i", "j", "ro", "rownum", (F.col("ro") == F.col("top")).alias("last")), "points")
    found = [farthest(marked.where("last"), marked).select("chrom", "rownum", "d2", F.col("rownum").alias("ref"))]
    left, size = marked.where("not last").drop("last"), 4
    right = marked.select("chrom", "i", "j", "ro", F.col("rownum").alias("ref"))
    while left.head(1):
        a, b = _reach(left, size, True).alias("a"), _reach(right, size, False).alias("b")
        d2 = F.expr("(a.i - b.i) * (a.i - b.i) + (a.j - b.j) * (a.j - b.j)")
        pairs = a.join(b, F.expr("a.chrom = b.chrom AND a.ci = b.ci AND a.cj = b.cj AND b.ro > a.ro")).select("a.chrom", "a.rownum", d2.alias("d2"), "b.ref").where(F.col("d2") <= size * size)
        near = staged(pairs.groupBy("chrom", "rownum").agg(F.min(F.struct("d2", "ref")).alias("m")).select("chrom", "rownum", "m.*"), "near")
        found.append(near)
        left = staged(left.join(near, ["chrom", "rownum"], "left_anti"), "left")
        size *= 4
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return staged(out, "denser")


def heads(links: DataFrame) -> DataFrame:
    """chrom, rownum and the end of the chain that starts there, by doubling. links: chrom, rownum, up; an end is its own up."""
    now = staged(links, "chains")
    while True:
        step = now.join(now.select("chrom", F.col("rownum").alias("up"), F.col("up").alias("further")), ["chrom", "up"])
        step = staged(step.select("chrom", "rownum", F.col("further").alias("up"), (F.col("further") != F.col("up")).alias("moved")), "chains")
        if not step.where("moved").head(1):
            return step.drop("moved")
        now = step.drop("moved")


def first_in_reach(points: DataFrame, reach: int) -> DataFrame:
    """chrom, eta_cluster, rownum of the summits: in rounds, every point takes itself if it is the least by rate and place of
    those left within reach in its cluster, and clears its reach. That is what taking the least one after another gives."""
    keys = ["chrom", "eta_cluster"]
    left, size, taken = staged(points.select(*keys, "i", "j", "rownum", F.col("fdr_dist").alias("fdr")), "open"), max(1, reach), []
    close = "a.chrom = b.chrom AND a.eta_cluster = b.eta_cluster AND a.ci = b.ci AND a.cj = b.cj AND abs(a.i - b.i) <= %d AND abs(a.j - b.j) <= %d" % (reach, reach)
    while left.head(1):
        a, b = _reach(left, size, True).alias("a"), _reach(left, size, False).alias("b")
        least = a.join(b, F.expr(close)).groupBy("a.chrom", "a.eta_cluster", "a.rownum").agg(F.min(F.struct("b.fdr", "b.rownum")).alias("m"))
        mine = staged(least.where("m.rownum = rownum").select(*keys, "rownum"), "taken")
        taken.append(mine)
        cleared = _reach(left.join(mine, [*keys, "rownum"]), size, True).alias("a").join(_reach(left, size, False).alias("b"), F.expr(close)).select("b.chrom", "b.eta_cluster", "b.rownum").distinct()
        left = staged(left.join(cleared, [*keys, "rownum"], "left_anti"), "open")
    out = points.select(*keys, "rownum").limit(0)
    for t in taken:
        out = out.unionByName(t)
    return out


def by_joins(dense: DataFrame, p: Params, ranges: int | None = None) -> DataFrame:
    """by_groups() for any number of candidates: no task holds a chromosome's."""
    numbered = scan.ranked(dense, ["chrom"], [F.col("i"), F.col("j")], "rownum", ranges).withColumn("rownum", F.col("rownum") - 1).select(*dense.columns, "rownum")
    numbered = staged(numbered, "numbered")
    near = denser(numbered.select("chrom", "i", "j", "ro", "rownum"))
    rows = numbered.join(near, ["chrom", "rownum"]).withColumn("delta", F.sqrt(F.col("d2").cast("double"))).withColumn("eta", F.col("ro") * F.col("delta"))
    rows = staged(rows.withColumnRenamed("ref", "parent").drop("d2"), "eta")
    levels = scan.ranked(rows.select("chrom", "eta").distinct(), ["chrom"], [F.desc("eta")], "rank", ranges).select("chrom", "eta", F.col("rank").cast("bigint").alias("rank"))
    rows = staged(rows.join(levels, ["chrom", "eta"]), "levels")
    tops = F.broadcast(rows.groupBy("chrom").agg(F.max("rank").alias("_ranks"), F.max("eta").alias("_etas")))  # a row per chromosome
    share, height = F.col("rank") / F.col("_ranks"), F.col("eta") / F.coalesce(F.nullif("_etas", F.lit(0.0)), F.lit(1.0))
    rows = rows.join(tops, "chrom").withColumns({"turned_rank": (share - height) / F.lit(math.sqrt(2)), "turned_eta": (height + share) / F.lit(math.sqrt(2))}).drop("_ranks", "_etas")
    rows = staged(rows, "turned")
    bends = F.broadcast(rows.groupBy("chrom").agg(F.min(F.struct("turned_eta", "rownum", "eta")).alias("b")).select("chrom", F.col("b.eta").alias("bend")))
    marked = rows.join(bends, "chrom").withColumn("centre", F.col("eta") > F.col("bend"))
    ids = scan.ranked(marked.where("centre").select("chrom", "rownum"), ["chrom"], [F.col("rownum")], "number", ranges).select("chrom", F.col("rownum").alias("up"), F.col("number").cast("bigint").alias("number"))
    ends = heads(marked.select("chrom", "rownum", F.when(F.col("centre"), F.col("rownum")).otherwise(F.col("parent")).alias("up")))
    named = ends.join(ids, ["chrom", "up"], "left").select("chrom", "rownum", F.coalesce("number", F.lit(-1).cast("bigint")).alias("eta_cluster"))
    rows = staged(rows.join(named, ["chrom", "rownum"]), "clusters")
    marks = first_in_reach(rows, p.gap // p.binsize).withColumn("summit", F.lit(1))
    return rows.join(marks, ["chrom", "eta_cluster", "rownum"], "left").withColumn("summit", F.coalesce("summit", F.lit(0)))


def final_summits(found: DataFrame) -> DataFrame:
    """Summits of clusters of two or more."""
    return found.where("summit = 1 AND cluster_size > 1")


def summit_scores(peaks: DataFrame, z: DataFrame) -> DataFrame:
    """chrom, i, j, cell, z of each summit and cell."""
    return peaks.select("chrom", "i", "j").distinct().join(z.select("chrom", "i", "j", "cell", "z"), ["chrom", "i", "j"])


def zscore_pivot(scores: DataFrame, cells: list[str] | None = None) -> DataFrame:
    """One row per summit and one column per cell, named by it; cells not given are looked up."""
    return scores.groupBy("chrom", "i", "j").pivot("cell", cells).agg(F.first("z"))


def connected(candidates: DataFrame, gap: int, group_rows: int = GROUP_ROWS) -> DataFrame:
    """chrom, i, j and cluster: components of candidates within gap * sqrt(2) bins, named by their first member. Chromosomes of
    more than group_rows candidates are worked off by joins."""
    radius2 = 2 * gap * gap
    if (candidates.groupBy("chrom").count().agg(F.max("count")).first()[0] or 0) > group_rows:
        return connected_by_joins(candidates, radius2)

    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["i", "j"]).reset_index(drop=True)
        at = {x: k for k, x in enumerate(zip(g["i"], g["j"], strict=True))}
        up = list(range(len(g)))

        def root(k: int) -> int:
            while up[k] != k:
                up[k] = up[up[k]]
                k = up[k]
            return k

        r = int(math.isqrt(radius2))
        for (i, j), k in at.items():
            for a in range(-r, r + 1):
                for b in range(-r, r + 1):
                    o = at.get((i + a, j + b))
                    if o is not None and a * a + b * b <= radius2:
                        x, y = root(k), root(o)
                        up[max(x, y)] = min(x, y)
        g["cluster"] = [root(k) for k in range(len(g))]
        return g[["chrom", "i", "j", "cluster"]]

    return candidates.select("chrom", "i", "j").groupBy("chrom").applyInPandas(run, "chrom string, i bigint, j bigint, cluster bigint")


def connected_by_joins(candidates: DataFrame, radius2: int, ranges: int | None = None) -> DataFrame:
    """connected() by links between near candidates, and stars: every node's neighbours are tied to the least of them, by turns
    those above it and those below."""
    rows = scan.ranked(candidates.select("chrom", "i", "j").distinct(), ["chrom"], [F.col("i"), F.col("j")], "node", ranges)
    rows = staged(rows.select("chrom", "i", "j", (F.col("node") - 1).alias("node")), "nodes")
    size = max(1, math.isqrt(radius2))
    a, b = _reach(rows, size, True).alias("a"), _reach(rows, size, False).alias("b")
    close = "a.chrom = b.chrom AND a.ci = b.ci AND a.cj = b.cj AND a.node > b.node AND (a.i - b.i) * (a.i - b.i) + (a.j - b.j) * (a.j - b.j) <= %d" % radius2
    ties = staged(a.join(b, F.expr(close)).select("a.chrom", F.col("a.node").alias("u"), F.col("b.node").alias("v")), "ties")
    before = None
    while (state := tuple(ties.agg(F.count(F.lit(1)), F.sum(F.hash("chrom", "u", "v").cast("bigint"))).first())) != before:
        before = state
        both = ties.union(ties.select("chrom", F.col("v").alias("u"), F.col("u").alias("v")))
        centre = both.groupBy("chrom", "u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        ties = both.where("v > u").join(centre, ["chrom", "u"]).select("chrom", F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = ties.groupBy("chrom", "u").agg(F.min("v").alias("m"))
        down = ties.join(least, ["chrom", "u"]).select("chrom", F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("chrom", "u", "m"))
        ties = staged(down.where("u <> v").distinct(), "ties")
    named = ties.select("chrom", F.col("u").alias("node"), F.col("v").alias("cluster"))
    return rows.join(named, ["chrom", "node"], "left").select("chrom", "i", "j", F.coalesce("cluster", "node").alias("cluster"))


def knee_clusters(candidates: DataFrame, p: Params, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Candidates with cluster, cluster_type, cluster_size, neg_log10_fdr and summit, by components and a knee.

    Components within clustering_gap * sqrt(2) bins are clusters, named cluster_0 on in the order of their first members, those
    of one candidate singleton_0 on. A cluster's weight is the sum of -log10 of its rates. Along the candidates of clusters by
    weight, both scaled to 1, the knee is where weight falls furthest below rank; clusters of less weight than there are
    SharpPeak, the others BroadPeak. An infinite weight, of a rate of 0, is a BroadPeak and stays out of the scaling.
    """
    found = staged(candidates, "candidates")
    rows = found.join(connected(found, p.clustering_gap, group_rows), ["chrom", "i", "j"]).withColumnRenamed("cluster", "first")
    weight = F.when(F.col("fdr_dist") == 0, float("inf")).otherwise(-F.log10(F.nullif("fdr_dist", F.lit(0.0))))
    groups = staged(rows.groupBy("chrom", "first").agg(F.count(F.lit(1)).alias("cluster_size"), F.sum(weight).alias("neg_log10_fdr")), "components")
    single = (F.col("cluster_size") == 1).alias("single")
    numbers = scan.ranked(groups.select("chrom", single, "first"), ["chrom", "single"], [F.col("first")], "number").select("chrom", "first", (F.col("number") - 1).cast("bigint").alias("number"), "single")
    rows = staged(rows.join(groups, ["chrom", "first"]).join(numbers, ["chrom", "first"]), "members")
    finite = rows.where((~F.col("single")) & (F.col("neg_log10_fdr") < float("inf"))).select("chrom", "i", "j", "neg_log10_fdr")
    along = scan.ranked(finite, ["chrom"], [F.col("neg_log10_fdr"), F.col("i"), F.col("j")], "rank")
    most = F.broadcast(finite.groupBy("chrom").agg(F.max("neg_log10_fdr").alias("most")))  # a row per chromosome
    below = F.struct((F.col("neg_log10_fdr") / F.nullif("most", F.lit(0.0)) - F.col("rank") / F.col("_of")).alias("height"), "rank", F.col("neg_log10_fdr").alias("knee"))
    knees = F.broadcast(along.join(most, "chrom").groupBy("chrom").agg(F.min(below).alias("k")).select("chrom", "k.knee"))
    kind = F.when(F.col("single"), "singleton").when(F.col("neg_log10_fdr") < F.col("knee"), "SharpPeak").otherwise("BroadPeak")
    name = F.concat(F.when(F.col("single"), "singleton_").otherwise("cluster_"), F.col("number").cast("string"))
    rows = rows.join(knees, "chrom", "left").select(*found.columns, name.alias("cluster"), kind.alias("cluster_type"), "cluster_size", "neg_log10_fdr")
    place = scan.ranked(rows.select("chrom", "i", "j").distinct(), ["chrom"], [F.col("i"), F.col("j")], "rownum").select("chrom", "i", "j", "rownum")
    rows = staged(rows.join(place, ["chrom", "i", "j"]), "knees")
    marks = first_in_reach(rows.withColumnRenamed("cluster", "eta_cluster"), p.gap // p.binsize).select("chrom", F.col("eta_cluster").alias("cluster"), "rownum", F.lit(1).alias("summit"))
    return rows.join(marks, ["chrom", "cluster", "rownum"], "left").select(*found.columns, "cluster", "cluster_type", "cluster_size", "neg_log10_fdr", F.coalesce("summit", F.lit(0)).alias("summit"))
