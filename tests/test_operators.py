"""Operators against brute force on small graphs, and the edge cases of FIXTURES.md."""

from dataclasses import replace

import numpy as np
import pytest

from loopweaver.functions.student import two_sided
from loopweaver.operators import background, binning, candidates, cluster, graph, jobs, moments, normalize, partition, runs, selected, stats
from loopweaver.params import Params

P = Params(dist=200_000, binsize=10_000, buffer=50_000, chrom_lengths={"chr1": 600_000})


def test_bins_keep_only_far_contacts_of_one_autosome(spark):
    rows = [("a", "chr1", 5, "chr1", 30_000), ("a", "chr1", 30_000, "chr1", 5), ("a", "chr1", 0, "chr1", 19_999), ("a", "chrX", 0, "chrX", 90_000), ("a", "chr1", 0, "chr2", 90_000), ("a", "chr1", 0, "chr1", 700_000), ("a", None, 0, "chr1", 9), ("a", "chr1", None, "chr1", 90_000)]
    got = binning.bin_contacts(spark.createDataFrame(rows, "cell string, chr1 string, pos1 bigint, chr2 string, pos2 bigint"), P).collect()
    assert [tuple(r) for r in got] == [("a", "chr1", 0, 3)]


def test_cutoff_is_inclusive_and_on_raw_positions(spark):
    p = replace(P, binsize=1_000, low_cutoff=5_000)
    rows = [("a", "chr1", 0, "chr1", 5_000), ("a", "chr1", 999, "chr1", 5_998)]
    assert binning.bin_contacts(spark.createDataFrame(rows, "cell string, chr1 string, pos1 bigint, chr2 string, pos2 bigint"), p).count() == 1


def small_graph(n=40, seed=0):
    rng = np.random.default_rng(seed)
    i = rng.integers(0, n - 3, 60)
    return i, np.minimum(n - 1, i + 2 + rng.integers(0, 15, 60)), n


def test_solvers_agree():
    i, j, n = small_graph()
    m = graph.adjacency(i, j, n)
    exact = graph.solve_inverse(m, 0.05)
    assert np.allclose(exact, exact.T)
    half = np.linalg.inv(np.eye(n) - 0.95 * (m / m.sum(1, keepdims=True)).T) * 0.05
    assert np.allclose(half.sum(0), 1)  # columns, not rows
    assert np.abs(graph.solve_iterative(m, 0.05, 2000, 1e-13) - exact).max() < 1e-9
    w = m / np.sqrt(m.sum(1))[:, None] / np.sqrt(m.sum(1))[None, :]
    walk = 0.05 * np.linalg.inv(np.eye(n) - 0.95 * w)
    assert np.allclose(graph.solve_blin(m, 0.05, 4), walk + walk.T)  # all singular vectors: exact
    walk = walk / walk.sum(0, keepdims=True)
    assert np.allclose(graph.solve_nblin(m, 0.05), walk + walk.T)


def test_q1_is_the_inverse_within_blocks():
    i, j, n = small_graph()
    m = graph.adjacency(i, j, n)
    step = m / m.sum(1, keepdims=True)
    whole = np.linalg.inv(np.eye(n) - 0.95 * step)
    assert np.allclose(graph.solve_q1(m, 0.05, 1), whole + whole.T)
    got, want = graph.solve_q1(m, 0.05, 4, True), np.zeros((n, n))
    for a in range(0, n, 10):
        want[a : a + 10, a : a + 10] = np.linalg.inv(np.eye(10) - 0.95 * step[a : a + 10, a : a + 10])
    assert np.allclose(got, want + want.T)


def test_inverse_solves_its_system():
    i, j, n = small_graph(60, 3)
    m = graph.adjacency(i, j, n)
    # The result is X + X' with (I - 0.95 P') X = 0.05 I, and X D is symmetric for the degrees D.
    s, d = graph.solve_inverse(m, 0.05), m.sum(1)
    x = s / (1 + d[None, :] / d[:, None])
    assert np.abs(x - 0.95 * (m / d[:, None]).T @ x - 0.05 * np.eye(n)).max() < 1e-9


def test_inverse_band_equals_the_dense_inverse():
    i, j, n = small_graph(150, 5)
    p = replace(P, chrom_lengths={"chr1": n * 10_000})
    want = graph.band(graph.solve_inverse(graph.adjacency(i, j, n), p.alpha), p, n)
    got = graph.walked_band(i, j, n, p)
    assert all(np.array_equal(a, b) for a, b in zip(got[:2], want[:2])) and np.abs(got[2] - want[2]).max() < 1e-12


def test_joined_walk_matches_dense(spark):
    i, j, n = small_graph()
    p = replace(P, chrom_lengths={"chr1": n * 10_000})
    pairs = spark.createDataFrame([("a", "chr1", int(x), int(y)) for x, y in set(zip(i.tolist(), j.tolist()))], "cell string, chrom string, i bigint, j bigint")
    got = {(r["i"], r["j"]): r["s"] for r in graph.rwr_iterative(graph.edges(pairs, p), p, 3).collect()}
    want = graph.solve_iterative(graph.adjacency(i, j, n), p.alpha, 3, 0)
    assert max(abs(got.get((a, b), 0) - want[a, b]) for a in range(n) for b in range(n)) < 1e-12


def test_windows_cover_the_band_once(spark):
    p = replace(P, rwr_method="sliding_window", window_bins=50, chrom_lengths={"chr1": 1_230_000})
    pairs = spark.createDataFrame([("a", "chr1", 20, 30), ("a", "chr1", 3, 9)], "cell string, chrom string, i bigint, j bigint")
    got = [(r["i"], r["j"]) for r in graph.rwr(pairs, p).collect()]
    i, j = graph.band_places(p, 123)
    assert sorted(got) == sorted(zip(i.tolist(), j.tolist()))
    assert graph.rwr(pairs, replace(p, compat_windows=True)).count() < len(got)


def test_unknown_method_is_refused(spark):
    with pytest.raises(ValueError):
        graph.rwr(spark.createDataFrame([], "cell string, chrom string, i bigint, j bigint"), replace(P, rwr_method="x"))


@pytest.mark.parametrize("n", [1, 49, 50, 51, 150, 250])
def test_zscores_drop_the_top(spark, n):
    v = np.random.default_rng(n).random(n)
    rest = np.sort(v)[::-1]
    k = round(0.01 * n)
    rest = rest[k - 1 :] if k else rest[-1:]
    want = np.zeros(n) if rest.std() < 1e-6 else (v - rest.mean()) / rest.std()
    assert np.allclose(normalize.zscore_rows(v), want)
    df = spark.createDataFrame([("a", "chr1", i, i + 3, float(x)) for i, x in enumerate(v)], "cell string, chrom string, i bigint, j bigint, v double")
    got = {r["i"]: r["z"] for r in normalize.diag_zscore(df).collect()}
    assert np.allclose([got[i] for i in range(n)], want)


def test_background_against_brute_force(spark):
    n, top = 60, 60
    i, j = graph.band_places(P, n)
    z = np.random.default_rng(1).normal(size=len(i))
    m = {(a, b): x for a, b, x in zip(i.tolist(), j.tolist(), z.tolist())}
    want = {}
    for a, b in m:
        if b - a <= P.max_bins:
            s = c = 0
            for da in range(-5, 6):
                for db in range(-5, 6):
                    if max(abs(da), abs(db)) > 2 and 0 <= a + da < b + db <= top:
                        s, c = s + m.get((a + da, b + db), 0.0), c + 1
            want[a, b] = s / c
    fused = background.background_pairs(i, j, z, top, P)
    assert all(abs(fused[k] - want[a, b]) < 1e-9 for k, (a, b) in enumerate(m) if (a, b) in want)
    assert sum(~np.isnan(fused)) == len(want)
    df = spark.createDataFrame([("a", "chr1", a, b, x) for (a, b), x in m.items()], "cell string, chrom string, i bigint, j bigint, z double")
    got = {(r["i"], r["j"]): r["nb"] for r in background.local_background(df, P).collect()}
    assert got.keys() == want.keys() and max(abs(got[k] - want[k]) for k in want) < 1e-9


def test_t_conventions(spark):
    rows = [("chr1", 6, 9, 1, 1.0, 1.0, 2.0, None, 1), ("chr1", 6, 10, 3, 1.0, 0.0, 2.0, 0.0, 1), ("chr1", 6, 11, 3, 0.0, 1.0, 0.0, 1.0, 1), ("chr1", 6, 12, 4, 1.0, 1.0, 1.0, 2.0, 1)]
    df = spark.createDataFrame(rows, "chrom string, i bigint, j bigint, n bigint, case_avg double, control_avg double, mean double, sd double, outlier_count bigint")
    got = {r["j"]: r for r in stats.p_values(stats.paired_t(df)).collect()}
    assert got[9]["tstat"] == -1000 and got[9]["pvalue"] == 1
    assert got[10]["tstat"] == stats.HUGE and got[10]["pvalue"] == 0 and got[10]["control_avg"] is None
    assert got[11]["tstat"] == -1000
    assert abs(got[12]["tstat"] - 1) < 1e-12 and abs(got[12]["pvalue"] - 0.39100221895577053) < 1e-9


def test_student_tail():
    # For 1 and 2 degrees of freedom the tail has closed forms.
    t = np.array([0.1, 1.0, 5.0, 40.0])
    assert np.allclose(two_sided(t, np.ones(4)), 1 - 2 / np.pi * np.arctan(t), rtol=1e-10)
    assert np.allclose(two_sided(t, np.full(4, 2.0)), 1 - t / np.sqrt(2 + t * t), rtol=1e-9)


def test_rates_with_ties(spark):
    p = [0.01, 0.02, 0.02, 0.5, 1.0]
    df = spark.createDataFrame([("chr1", k, k + 1, x) for k, x in enumerate(p)], "chrom string, i bigint, j bigint, pvalue double")
    got = [r["q"] for r in stats.bh_fdr(df, ["chrom"], "q").orderBy("i").collect()]
    want = np.minimum.accumulate((np.array(p) * 5 / np.arange(1, 6))[::-1])[::-1].clip(max=1)
    assert np.allclose(got, want)


def test_no_neighbours_give_zero_and_missing_kinds_null(spark):
    s = "chrom string, i bigint, j bigint, outlier_count bigint"
    sig = spark.createDataFrame([("chr1", 10, 30, 5), ("chr1", 50, 80, 5), ("chr1", 54, 80, 2)], s)
    got = {r["i"]: r for r in candidates.neighbor_means(sig.where("i in (10, 50)"), sig, P).collect()}
    assert [got[10][k] for k in candidates.MEANS] == [0.0] * 5
    assert got[50]["circle"] == got[50]["vertical"] == 2.0 and got[50]["donut"] is None
    assert candidates.enrichment_filter(candidates.neighbor_means(sig, sig, P), P).where("i = 50").count() == 0


def test_regions_must_start_a_bin(spark):
    c = spark.createDataFrame([("chr1", 1, 5), ("chr1", 2, 6)], "chrom string, i bigint, j bigint")
    regions = spark.createDataFrame([("chr1", 10_000), ("chr1", 20_001), ("chr2", 20_000)], "chrom string, start bigint")
    assert [r["i"] for r in candidates.blacklist_anti_join(c, regions, P).collect()] == [2]
    assert candidates.blacklist_anti_join(c, regions.limit(0), P).count() == 2


def test_clusters_and_summits(spark):
    rows = [("chr1", i, j, f) for i, j, f in [(10, 30, 0.01), (10, 31, 0.001), (11, 30, 0.02), (11, 31, 0.03), (40, 70, 0.01), (40, 71, 0.0), (41, 70, 0.02), (90, 95, 0.1)]] + [("chr2", 5, 9, 0.1)]
    got = cluster.clustered(spark.createDataFrame(rows, "chrom string, i bigint, j bigint, fdr_dist double"), P).collect()
    assert {(r["chrom"], r["i"]) for r in got} == {("chr1", 10), ("chr1", 11), ("chr1", 40), ("chr1", 41)}  # isolated ones go
    groups: dict = {}
    for r in got:
        groups.setdefault(r["eta_cluster"], []).append(r)
    for g in groups.values():
        assert all(r["cluster_size"] == len(g) for r in g)
        tops = [r for r in g if r["summit"]]
        assert min(g, key=lambda r: r["fdr_dist"])["summit"] == 1
        assert all(max(abs(a["i"] - b["i"]), abs(a["j"] - b["j"])) > 2 for a in tops for b in tops if a is not b)
    assert max(r["neg_log10_fdr"] for r in got) == float("inf")  # a rate of exactly 0


def test_nearest_denser_takes_the_first_of_ties():
    delta, to = cluster.nearest_denser(np.array([[0, 0], [0, 2], [2, 0], [9, 9]], float), np.array([1, 2, 2, 3]))
    assert to.tolist() == [1, 3, 3, 3] and delta[0] == 2 and delta[3] == np.hypot(9, 9)


def test_jobs(spark):
    b = spark.createDataFrame([(1, "chr1"), (2, "chr1"), (2, "chr1")], "cell int, chrom string")
    assert [r["cell"] for r in jobs.remaining_jobs(b, b.where("cell = 1")).collect()] == [2]


def test_moments_equal_plain_aggregates(spark, monkeypatch):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(1)
    rows = [(f"c{c}", f"chr{k}", i, i + d, float(rng.normal()), None if d > 5 else float(rng.normal())) for c in range(9) for k in (1, 2) for i in range(150) for d in range(1, 8) if rng.random() < 0.7]
    z = spark.createDataFrame(rows, "cell string, chrom string, i bigint, j bigint, z double, nb double").repartition(5)
    same = {(r["chrom"], r["i"], r["j"]): r for r in stats.pair_sums(z).collect()}
    for held in (moments.HELD_BYTES, 1):
        monkeypatch.setattr(moments, "HELD_BYTES", held)
        packed = moments.merged(moments.fold(z.where("cell < 'c4'"), 9), moments.merged(moments.fold(z.where("cell >= 'c4'"), 8)))
        got = {(r["chrom"], r["i"], r["j"]): r for r in moments.places(packed).collect()}
        assert got.keys() == same.keys() and packed.count() == 2 * len({r[2] // moments.STRETCH for r in rows})
        for k, r in got.items():
            for name in ("n", "mean", "sd", "outlier_count"):
                assert r[name] == same[k][name] or abs(r[name] - same[k][name]) < 1e-12, (k, name)
            if r["n"]:
                some = [x for x in rows if x[1:4] == k and x[5] is not None]
                assert abs(r["case_avg"] - np.mean([x[4] for x in some])) < 1e-12 and abs(r["control_avg"] - np.mean([x[5] for x in some])) < 1e-12
    # A place with repeated rows, NaN and a single cell; and no rows at all.
    odd = spark.createDataFrame([("chr1", 0, 1, 1.0, 2.0), ("chr1", 0, 1, 3.0, 2.0), ("chr1", 0, 1, float("nan"), 2.0), ("chr1", 0, 2, 5.0, 1.0)], "chrom string, i bigint, j bigint, z double, nb double")
    got = {r["j"]: r for r in moments.pair_moments(odd, 4).collect()}
    assert (got[1]["n"], got[1]["case_avg"], got[1]["sd"], got[1]["outlier_count"]) == (2, 2.0, 2**0.5, 1) and got[2]["sd"] is None
    assert moments.pair_moments(odd.where(F.lit(False)), 4).count() == 0


def test_longest_first_deals_evenly(spark):
    lengths = [249, 243, 198, 191, 181, 171, 159, 146, 141, 136, 135, 134, 115, 107, 103, 90, 81, 78, 59, 63, 48, 51]  # chr1 to chr22, megabases
    costs = [float(n) ** 3 for n in lengths for _ in range(64)]
    task = jobs.longest_first(costs, 40)
    load = np.bincount(task, weights=costs)
    assert load.max() < 1.05 * load.mean() and jobs.longest_first(costs, 40) == task
    p = Params(chrom_lengths={"chr1": 2_000_000, "chr2": 400_000})
    binned = spark.createDataFrame([(f"c{c}", f"chr{k}", 10, 20 + c % 5) for c in range(60) for k in (1, 2)], "cell string, chrom string, i bigint, j bigint")
    at = jobs.dealt(binned, jobs.group_costs(binned, p), 4).selectExpr("*", "spark_partition_id() t").collect()
    bins = {"chr1": 200.0**3, "chr2": 40.0**3}
    load = np.bincount([r["t"] for r in at], weights=[bins[r["chrom"]] for r in at])
    assert len(at) == 120 and len(load) == 4 and load.max() < 1.3 * load.mean()
    assert {(r["cell"], r["chrom"]) for r in at} == {(f"c{c}", f"chr{k}") for c in range(60) for k in (1, 2)}
    assert sorted(map(tuple, (r[:4] for r in at))) == sorted(map(tuple, binned.collect()))


def contacts_of(n, m, scale, far, seed=0):
    """Pairs of bins, most of them near, a share of them at any distance."""
    rng = np.random.default_rng(seed)
    i = rng.integers(0, n, m)
    j = i + np.where(rng.random(m) < far, rng.integers(2, n, m), 2 + rng.exponential(scale, m).astype(int))
    return i[j < n], j[j < n]


@pytest.mark.parametrize(("n", "m", "far", "reach"), [(60, 50, 0.1, 10), (301, 200, 0.1, 20), (500, 3000, 0.1, 20), (400, 300, 0.0, 25), (7, 0, 0.0, 3), (300, 100, 1.0, 8)])
def test_band_of_inverse_equals_the_whole_inverse(monkeypatch, n, m, far, reach):
    monkeypatch.setattr(graph, "DENSE_BINS", 0)
    p = replace(P, dist=reach * 10_000, buffer=0, chrom_lengths={"chr1": n * 10_000})
    i, j = contacts_of(n, m, 6, far)
    whole = graph.solve_inverse(graph.adjacency(i, j, n), p.alpha)
    bi, bj, v = graph.inverse_band(i, j, n, p)
    assert len(bi) == sum(n - d for d in range(1, reach + 1)) if n > reach else True
    assert np.abs(v - whole[bi, bj]).max(initial=0) < 1e-9
    g = graph.ScaledGraph(i, j, n)
    for width in (reach, 3 * reach):
        long = g.j - g.i > width
        border = selected.cover(g.i[long], g.j[long], n)
        assert not (long & ~np.isin(g.i, border) & ~np.isin(g.j, border)).any()
        if width < n:
            got = selected.band_of_inverse(g.i, g.j, -0.95 * g.weight, np.ones(n), bi, bj, width, border)
            dense = np.eye(n)
            dense[g.i, g.j] = dense[g.j, g.i] = -0.95 * g.weight
            assert np.abs(got - np.linalg.inv(dense)[bi, bj]).max() < 1e-9


def test_memory_of_the_band_grows_with_width_and_border():
    import tracemalloc

    n, reach = 6000, 60
    p = replace(P, dist=reach * 10_000, buffer=0, chrom_lengths={"chr1": n * 10_000})
    i, j = contacts_of(n, 3000, 15, 0.02)
    tracemalloc.start()
    graph.inverse_band(i, j, n, p)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < n * n * 8 / 2


def test_partition_finds_planted_parts():
    rng = np.random.default_rng(3)
    n, parts = 2000, 10
    label = rng.permutation(np.repeat(np.arange(parts), n // parts))
    pairs = [(rng.choice(np.flatnonzero(label == k), 1500), rng.choice(np.flatnonzero(label == k), 1500)) for k in range(parts)] + [(rng.integers(0, n, 500), rng.integers(0, n, 500)), (np.arange(n - 1), np.arange(1, n))]
    u, v = (np.concatenate(x) for x in zip(*pairs, strict=True))
    u, v = u[u != v], v[u != v]
    part = partition.partition(u, v, n, parts)
    w = np.ones(len(u))
    stretches = np.arange(n) * parts // n
    assert partition.cut_weight(u, v, w, part) < 1.1 * partition.cut_weight(u, v, w, label) < 0.3 * partition.cut_weight(u, v, w, stretches)
    assert np.bincount(part).max() <= 1.05 * n / parts and set(part) == set(range(parts))
    for n, parts in ((1, 1), (2, 5), (50, 7), (50, 50), (200, 3)):
        part = partition.partition(np.arange(n - 1), np.arange(1, n), n, parts)
        assert len(part) == n and np.bincount(part).max() <= max(np.ceil(n / min(parts, n)), 1.05 * n / min(parts, n))


def test_blin_is_exact_for_any_blocks():
    i, j, n = small_graph(60)
    m = graph.adjacency(i, j, n)
    w = graph._scaled(m)
    exact = 0.05 * np.linalg.inv(np.eye(n) - 0.95 * w)
    for contiguous in (True, False):
        assert np.abs(graph.solve_blin(m, 0.05, 4, contiguous) - exact - exact.T).max() < 1e-9
    assert graph.blocks(m, 4, True).tolist() == np.repeat(np.arange(4), 15).tolist() and len(set(graph.blocks(m, 4))) == 4
    q = graph.solve_q1(m, 0.05, 20, True)
    at = graph.blocks(m, 20, True)
    assert (q[at[:, None] != at[None, :]] == 0).all()


def test_low_rank_walk(monkeypatch):
    n = 120
    i, j = contacts_of(n, 150, 10, 0.2)
    p = replace(P, dist=200_000, buffer=0, chrom_lengths={"chr1": n * 10_000}, rwr_method="nblin")
    full = graph.solve_nblin(graph.adjacency(i, j, n), p.alpha)
    bi, bj, v = graph.nblin_band(i, j, n, replace(p, nblin_rank=n))
    assert np.abs(v - full[bi, bj]).max() < 1e-9
    g = graph.ScaledGraph(i, j, n)
    w = g @ np.eye(n)
    exact = 0.05 * np.linalg.inv(np.eye(n) - 0.95 * w)
    before = None
    for rank in (20, 60, 110):
        u, s, t, residual = g.low_rank(rank)
        assert abs(np.linalg.norm(w - u @ np.diag(s) @ t) - residual) < 1e-6 * n and (before is None or residual < before)
        before = residual
        near = 0.05 * (np.eye(n) + 0.95 * u @ np.linalg.inv(np.diag(1 / s) - 0.95 * t @ u) @ t)
        assert np.abs(near - exact).max() <= 0.95 / 0.05 * residual


@pytest.fixture(scope="module")
def many_points(spark):
    """Clumps with ties of rate, density and distance, far ones, and a chromosome with two candidates."""
    rng = np.random.default_rng(5)
    at = {(int(a), int(b)) for c in rng.integers(0, 300, (14, 2)) for a, b in c + rng.integers(-6, 7, (25, 2))}
    rows = [("chr1", i + 10, j + 10, float(rng.integers(0, 6)) / 100) for i, j in sorted(at)] + [("chr2", 5, 9, 0.0), ("chr2", 6, 10, 0.01), ("chr3", 1, 1, 0.5)]
    return spark.createDataFrame(rows, "chrom string, i bigint, j bigint, fdr_dist double")


def test_clusters_by_joins_equal_those_by_groups(spark, many_points):
    p = replace(P, clustering_gap=1, summit_gap=20_000)
    names = ["chrom", "i", "j", "ro", "rownum", "delta", "parent", "eta", "rank", "turned_rank", "turned_eta", "eta_cluster", "summit", "cluster_size", "neg_log10_fdr"]
    both = [{(r["chrom"], r["i"], r["j"]): r for r in cluster.clustered(many_points, p, k).collect()} for k in (10**6, 0)]
    assert both[0].keys() == both[1].keys() and len(both[0]) > 150
    for k, r in both[0].items():
        for name in names:
            assert r[name] == both[1][k][name] or abs(r[name] - both[1][k][name]) < 1e-9, (k, name)
    assert len({r["eta_cluster"] for r in both[0].values()}) > 3


def test_components_by_joins(spark, many_points):
    for gap in (1, 3):
        a, b = ({(r["chrom"], r["i"], r["j"], r["cluster"]) for r in cluster.connected(many_points, gap, k).collect()} for k in (10**6, 0))
        assert a == b and len(a) == many_points.count()


@pytest.mark.parametrize("ranges", [1, 7])
def test_rates_by_ranges(spark, ranges):
    rng = np.random.default_rng(2)
    rows = [(f"chr{1 + k % 2}", k, k + 1, float(rng.integers(0, 40)) / 40) for k in range(500)] + [("chr3", 1, 2, 0.2)]
    t = spark.createDataFrame(rows, "chrom string, i bigint, j bigint, pvalue double")
    a, b = (sorted(map(tuple, f.select("chrom", "i", "j", "q").collect())) for f in (stats.bh_fdr(t, ["chrom"], "q"), stats.bh_fdr_ranged(t, ["chrom"], "q", ranges)))
    assert a == b
    assert stats.bh_fdr_ranged(t.limit(0), ["chrom"], "q").count() == 0


def _shuffled_last(df) -> bool:
    """Whether rows are shuffled or joined after the last generator has made them."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "Exchange" in plan[: plan.index("Generate")] or "Join" in plan


@pytest.mark.parametrize("by_value", [False, True])
def test_zscores_of_values_equal_those_of_the_band(spark, by_value):
    """Of values of either sign, explicit zeros and nulls among them; the band is never shuffled."""
    p = replace(P, chrom_lengths={"chr1": 2_100_000, "chr2": 900_000})
    rng = np.random.default_rng(7)
    rows = []
    for cell, low, count in (("a", 0, 900), ("b", -3, 4000), ("c", -3, 30_000), ("d", 5, 1)):
        for chrom in ("chr1", "chr2"):
            n = p.bins(chrom)
            at = {(int(i), int(i + d)) for i, d in zip(rng.integers(0, n, count), rng.integers(-2, p.max_rwr_bins + 4, count))}
            rows += [(cell, chrom, i, j, None if i % 17 == 3 else float(rng.integers(low, low + 6))) for i, j in sorted(at)]
    values = spark.createDataFrame(rows, "cell string, chrom string, i bigint, j bigint, v double")
    have = {r[:4]: r[4] or 0.0 for r in rows}
    full = {(c, k, int(i), int(j)): have.get((c, k, int(i), int(j)), 0.0) for c in "abcd" for k in p.chrom_lengths for i, j in zip(*graph.band_places(p, p.bins(k)))}
    dense = normalize.on_grid(values, p)
    got = [tuple(r) for r in dense.collect()]
    assert len(got) == len(full) and {r[:4]: r[4] for r in got} == full
    scored = normalize.diag_zscore_of_values(values, p, by_value)
    assert not _shuffled_last(dense) and not _shuffled_last(scored)
    want = {tuple(r)[:4]: r["z"] for r in (normalize.diag_zscore_by_value if by_value else normalize.diag_zscore)(dense).collect()}
    found = {tuple(r)[:4]: r["z"] for r in scored.collect()}
    assert found.keys() == want.keys() and max(abs(found[k] - want[k]) for k in want) < 1e-9


def test_background_of_rows_that_lie_together_is_not_shuffled(spark):
    """Cells whose places differ, split over batches; brought together first or not, the same, and in the latter case by no
    shuffle at all."""
    rng = np.random.default_rng(3)
    i, j = graph.band_places(P, 60)
    rows, want = [], {}
    for cell in ("a", "b", "c"):
        some = np.flatnonzero(rng.random(len(i)) < 0.8)
        z = rng.normal(size=len(some))
        nb = background.background_pairs(i[some], j[some], z, 60, P)
        rows += [(cell, "chr1", int(a), int(b), float(x)) for a, b, x in zip(i[some], j[some], z)]
        want |= {(cell, int(a), int(b)): v for a, b, v in zip(i[some], j[some], nb) if not np.isnan(v)}
    df = spark.createDataFrame(rows, "cell string, chrom string, i bigint, j bigint, z double")
    there = background.local_background(df.coalesce(1), P, together=True)
    assert "Exchange" not in there._jdf.queryExecution().executedPlan().toString()
    for made in (there, background.local_background(df.repartition(3), P)):
        got = {(r["cell"], r["i"], r["j"]): r["nb"] for r in made.collect()}
        assert got.keys() == want.keys() and max(abs(got[k] - want[k]) for k in want) < 1e-9


def test_links_are_made_where_the_contacts_lie(spark):
    """Chains come with a cell's first contact, after the only shuffle, and degrees and walks need no other; partitions are as
    many as the session's, however few bytes the contacts have."""
    i, j, n = small_graph()
    pairs = sorted({(cell, "chr1", int(a), int(b)) for cell in ("a", "b") for a, b in zip(i, j) if b - a >= 2 and (cell == "a" or a > 20)})
    p = replace(P, chrom_lengths={"chr1": n * 10_000})
    binned = spark.createDataFrame(pairs, "cell string, chrom string, i bigint, j bigint")
    e = graph.edges(binned, p)
    want = {cell: graph.adjacency(np.array([x[2] for x in pairs if x[0] == cell]), np.array([x[3] for x in pairs if x[0] == cell]), n) for cell in ("a", "b")}
    assert sorted((r["cell"], r["u"], r["v"]) for r in e.collect()) == sorted((c, u, v) for c, m in want.items() for u, v in zip(*(x.tolist() for x in np.nonzero(m))))
    made = {"degree": graph.degree(e), "p": graph.transition_matrix(e), "w": graph.laplacian_weights(e), "s": graph.rwr_iterative(e, p, 2)}
    for name, df in made.items():
        assert not _shuffled_last(df), name
        for r in df.collect():
            m = want[r["cell"]]
            d = m.sum(1)
            exact = {"degree": lambda: d[r["u"]], "p": lambda: 1 / d[r["u"]], "w": lambda: 1 / np.sqrt(d[r["u"]] * d[r["v"]]), "s": lambda: graph.solve_iterative(m, p.alpha, 2, 0)[r["i"], r["j"]]}[name]()
            assert abs(r[name] - exact) < 1e-12
    for rows in (e, jobs.dealt(binned)):
        assert rows.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_solves_equal_their_plain_forms_without_singular_vectors(monkeypatch):
    """iterative by doubling, also where it may stop early; nblin and blin without a singular value decomposition."""
    i, j, n = small_graph(seed=4)
    m = graph.adjacency(i, j, n)
    for alpha, rounds, tolerance in ((0.05, 30, 1e-6), (0.05, 1, 1e-6), (0.05, 2, 0), (0.05, 31, 0), (0.5, 40, 1e-6), (0.5, 19, 1e-6), (0.05, 500, 1e-4)):
        p, a = m / m.sum(1, keepdims=True), np.eye(n)
        for _ in range(rounds):
            b = (1 - alpha) * (p @ a) + alpha * np.eye(n)
            gap, a = np.abs(b - a).max(), b
            if gap <= tolerance:
                break
        assert np.abs(graph.solve_iterative(m, alpha, rounds, tolerance) - a - a.T).max() < 1e-12
    products = []
    real = graph._rows

    class Counted(np.ndarray):
        def __matmul__(self, other):
            products.append(1)
            return np.matmul(np.asarray(self), np.asarray(other)).view(Counted)

    monkeypatch.setattr(graph, "_rows", lambda x: real(x).view(Counted))
    graph.solve_iterative(m, 0.05, 30)
    assert len(products) < 15
    monkeypatch.setattr(graph, "_rows", real)
    w = graph._scaled(m)
    exact = 0.05 * np.linalg.inv(np.eye(n) - 0.95 * w)
    scaled = exact / exact.sum(0)
    monkeypatch.setattr(np.linalg, "svd", None)
    assert np.abs(graph.solve_nblin(m, 0.05) - scaled - scaled.T).max() < 1e-12
    for parts in (2, 4, 13):
        assert np.abs(graph.solve_blin(m, 0.05, parts) - exact - exact.T).max() < 1e-12


def test_nblin_takes_the_inverse_without_any_vectors(monkeypatch):
    i, j, n = small_graph(seed=6)
    m = graph.adjacency(i, j, n)
    u, s, v = np.linalg.svd(graph._scaled(m))
    want = 0.05 * (np.eye(n) + 0.95 * u @ np.linalg.inv(np.diag(1 / s) - 0.95 * v @ u) @ v)
    want /= want.sum(0)
    monkeypatch.setattr(np.linalg, "eigh", None)
    monkeypatch.setattr(np.linalg, "svd", None)
    assert np.abs(graph.solve_nblin(m, 0.05) - want - want.T).max() < 1e-12


def test_range_finder_takes_small_steps(monkeypatch):
    """Of each cell two orthogonal bases and the vectors of a small matrix; the start is drawn once."""
    n = 120
    i, j = contacts_of(n, 150, 10, 0.2)
    g = graph.ScaledGraph(i, j, n)
    q = np.random.default_rng(graph.SEED).standard_normal((n, 60 + graph.OVERSAMPLE))
    for _ in range(graph.POWERS):
        q, _ = np.linalg.qr(g @ q)
    u, s, v = np.linalg.svd((g @ q).T, full_matrices=False)
    want = (q @ u[:, :60] * s[:60]) @ v[:60]
    calls, real = [], np.linalg.qr
    monkeypatch.setattr(np.linalg, "qr", lambda x: calls.append(x.shape) or real(x))
    monkeypatch.setattr(np.linalg, "svd", None)
    u, s, v, _ = g.low_rank(60)
    assert np.abs((u * s) @ v - want).max() < 1e-9 and len(calls) == 2
    start = graph._drawn(n, 76)
    assert graph._drawn(n, 76) is start


def test_range_finder_of_few_values(monkeypatch):
    """Where squares would lose small singular values, those of the matrix itself are taken."""
    i = np.zeros(37, np.int64)
    g = graph.ScaledGraph(i, np.arange(2, 39), 40)
    w = g @ np.eye(40)
    u, s, v, residual = g.low_rank(40)
    assert np.abs((u * s) @ v - w).max() < 1e-9 and residual < 1e-6


def test_iterative_takes_few_products_and_one_solve(monkeypatch):
    """A power of a symmetric matrix, half of its products squares, in place of doubled sums."""
    i, j, n = small_graph(seed=7)
    m = graph.adjacency(i, j, n)
    p, a = m / m.sum(1, keepdims=True), np.eye(n)
    for _ in range(30):
        a = 0.95 * (p @ a) + 0.05 * np.eye(n)
    products = []

    class Counted(np.ndarray):
        def __matmul__(self, other):
            products.append(1)
            return np.matmul(np.asarray(self), np.asarray(other)).view(Counted)

    for name in ("_rows", "_scaled"):
        real = getattr(graph, name)
        monkeypatch.setattr(graph, name, lambda x, real=real: real(x).view(Counted))
    assert np.abs(np.asarray(graph.solve_iterative(m, 0.05, 30)) - a - a.T).max() < 1e-12
    assert len(products) <= 7
    x = graph._scaled(m)
    for k in (1, 2, 3, 7, 9, 30, 31):
        assert np.abs(graph._power(x, k) - np.linalg.matrix_power(np.asarray(x), k)).max() < 1e-13
    # An isolated bin, no way on, and alpha of 0 and 1.
    m = np.zeros((4, 4))
    m[0, 1] = m[1, 0] = 1
    for alpha in (0.0, 0.05, 1.0):
        a = np.eye(4)
        for _ in range(30):
            a = (1 - alpha) * (m @ a) + alpha * np.eye(4)
        assert np.abs(np.asarray(graph.solve_iterative(m, alpha, 30, 0)) - a - a.T).max() < 1e-12


def test_inverse_by_halves():
    """Links near the cut, across the whole, and none; pairs that repeat are one link."""
    rng = np.random.default_rng(3)
    for n, reach in ((30, 5), (129, 20), (200, 60), (201, 199), (150, 2)):
        i = rng.integers(0, n - 2, 2 * n)
        j = np.minimum(i + rng.integers(2, reach + 1, 2 * n), n - 1)
        i, j = i[j - i >= 2], j[j - i >= 2]
        m = np.diag(graph.adjacency(i, j, n).sum(1)) - 0.95 * graph.adjacency(i, j, n)
        want = np.linalg.inv(m)
        assert np.abs(graph._inverse(m) - want).max() < 1e-12 * np.abs(want).max()
        p = replace(P, chrom_lengths={"chr1": n * P.binsize})
        once, twice = graph.walked_band(i, j, n, p), graph.walked_band(np.r_[i, i], np.r_[j, j], n, p)
        assert np.array_equal(once[2], twice[2])
        assert np.allclose(once[2], graph.solve_inverse(graph.adjacency(i, j, n), p.alpha)[once[0], once[1]], rtol=1e-10, atol=0)
        assert once[0] is twice[0]  # what follows from the places is kept from cell to cell
    none = np.diag(np.arange(1.0, 131))
    assert np.allclose(graph._inverse(none), np.linalg.inv(none))


def test_cells_fold_together(monkeypatch):
    """As many merges as cells made before; moments of cells at once equal those of one after another, gaps included."""
    i, j = graph.band_places(P, 60)
    rng = np.random.default_rng(4)
    z, nb = rng.normal(1, 2, (70, len(i))), rng.normal(0, 1, (70, len(i)))
    z[rng.random(z.shape) < 0.05] = np.nan
    nb[:, j - i > P.max_bins] = np.nan
    nb[3:9, 40] = np.nan
    puts = []
    real = moments.Stretch.put
    monkeypatch.setattr(moments.Stretch, "put", lambda self, *a: puts.append(1) or real(self, *a))
    held, one = moments.Held(P.max_rwr_bins + 1, 1.96), moments.Stretch(P.max_rwr_bins + 1)
    for a, b in zip(z, nb, strict=True):
        assert not list(held.take("chr1", i, j, a, b, once=True))
        one.add(i * one.width + j - i, a, b, 1.96)
    [(key, got)] = held.stretches.items()
    assert key == ("chr1", 0) and np.array_equal(got.a[:3], one.a[:3]) and np.abs(got.a - one.a).max() < 1e-10
    assert 1 <= len(puts) <= 3


def test_stretches_past_the_most_are_passed_on():
    """Cells that wait are passed on whole, whichever call makes room for them."""
    p = replace(P, chrom_lengths={"chr1": 3_000_000})
    i, j = graph.band_places(p, 300)
    held = moments.Held(p.max_rwr_bins + 1, 1.96)
    held.most = 2
    out = [b for k in range(40) for b in held.take("chr1", i, j, np.full(len(i), float(k)), np.zeros(len(i)), once=True)]
    out += held.rest()
    cells = {}
    for b in out:
        for chrom, stretch, s in moments._unpack(b):
            cells[stretch] = cells.get(stretch, 0) + s.a[0].max()
    assert cells == {k: 40 for k in range(5)}


@pytest.mark.parametrize("most", [1, 7, 250_000])
def test_runs_of_places(spark, monkeypatch, most):
    """Any places come back as they went, each once, with gaps, repeats and in any order, in batches of few."""
    monkeypatch.setattr(runs, "BATCH", most)
    rng = np.random.default_rng(1)
    i, j = graph.band_places(P, 40)
    shuffled = rng.permutation(len(i))
    kind = spark.createDataFrame([], "cell string").schema["cell"].dataType
    for some, count in ((np.arange(len(i)), 29), (np.flatnonzero(rng.random(len(i)) < 0.7), None), (shuffled, None), (np.repeat(np.arange(9), 3), 19), (np.zeros(0, int), 0)):
        a, b, x = i[some], j[some], rng.normal(size=len(some))
        nb = np.where(b - a > 3, np.nan, x)
        out = list(runs.Runs(a, b).rows("c", "chr1", kind, z=x, nb=nb))
        assert count is None or sum(r.num_rows for r in out) == count
        assert all(len(r.column(4).flatten()) <= max(most, P.max_rwr_bins) for r in out)
        first, last, n, z = (np.concatenate([f(r) for r in out]) if out else np.zeros(0, int) for f in (lambda r: r.column(2), lambda r: r.column(3), lambda r: r.column(4).value_lengths(), lambda r: r.column(4).flatten()))
        got = runs.places(first, last, n)
        assert np.array_equal(got[0], a) and np.array_equal(got[1], b) and np.array_equal(z, x)
        rows = runs.single(spark.createDataFrame([tuple(r.values()) for t in out for r in t.to_pylist()], runs.schema(kind, "z", "nb"))).collect()
        assert sorted((r["i"], r["j"], r["z"], r["nb"]) for r in rows if r["nb"] is not None) == sorted((*map(int, t[:2]), t[2], t[2]) for t in zip(a, b, x) if t[1] - t[0] <= 3)
        assert len(rows) == len(a)


def test_background_of_runs(spark):
    """From runs as from rows, cells with other places and a score that is no number among them."""
    rng = np.random.default_rng(5)
    i, j = graph.band_places(P, 60)
    rows, by_runs = [], []
    for cell in range(4):
        some = np.arange(len(i)) if cell % 2 else np.flatnonzero(rng.random(len(i)) < 0.8)
        a, b, z = i[some], j[some], rng.normal(size=len(some))
        if cell == 3:
            z[100] = np.nan
        rows += [(cell, "chr1", int(x), int(y), float(v)) for x, y, v in zip(a, b, z)]
        ends = runs.Runs(a, b)
        by_runs += [(cell, "chr1", int(x), int(y), z[s:t].tolist()) for x, y, s, t in zip(ends.i, ends.j, ends.ends[:-1], ends.ends[1:])]
    one = background.local_background(spark.createDataFrame(rows, "cell bigint, chrom string, i bigint, j bigint, z double"), P)
    other = background.local_background(spark.createDataFrame(by_runs, "cell bigint, chrom string, i bigint, j bigint, z array<double>").repartition(2), P)
    assert one.schema == other.schema
    want, got = ({tuple(r)[:4]: (r["z"], r["nb"]) for r in x.collect()} for x in (one, other))
    assert want.keys() == got.keys() and want and max(abs(x - y) for k in want for x, y in zip(want[k], got[k])) < 1e-9
    assert len([k for k in got if k[0] == 3]) < len([k for k in got if k[0] == 1])
