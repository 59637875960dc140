"""Queries over the driver's tables, and their SQL.

The contacts come from `lineitem` (see sources.fixture). Operators that SQL can check run on counts of contacts instead of
proximities, as no linear solve is needed for those; the solves themselves are checked in the tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loopweaver.operators import background, binning, candidates, cluster, combine, graph, jobs, moments, normalize, stats
from loopweaver.params import Params
from loopweaver.plans import analysis
from loopweaver.sources import fixture
from loopweaver.staging import staged

P: Params = fixture.PARAMS
DIGITS = 6
#: Cells that the pivot has columns for; all if none are given, but SQL must name them.
PIVOT_CELLS = range(10)
#: Distances that cut the fixture's chromosomes, for the shares of near pairs.
NEAR = range(100_000, 1_000_001, 100_000)
#: Moves values that lie halfway between two roundings, as products of 0.95 and 1/2 do, off the tie.
OFF_TIE = 3.3e-9


def _rounded(df: DataFrame, *names: str, digits: int = DIGITS) -> DataFrame:
    return df.withColumns({n: _round(F.col(n), digits) + F.lit(0.0) for n in names})


def _round(x: F.Column, digits: int) -> F.Column:
    """x rounded half away from zero, as SQL's round is in DuckDB, by arithmetic: Spark's round makes a decimal of each value,
    which takes longer than all else that is done for it. What is too large to be scaled has no such digits, or is left to Spark's."""
    scale = 10.0**digits
    size = F.abs(x) * scale
    # The largest double below a half: with a half itself, what is just below it would be rounded up.
    return F.when(size < 2.0**52, F.signum(x) * F.floor(size + 0.49999999999999994) / scale).otherwise(F.round(x, digits))


def _contacts(spark, d):
    return fixture.contacts(spark, d)


def _binned(spark, d):
    return binning.bin_contacts(_contacts(spark, d), P)


def _edges(spark, d):
    return graph.edges(_binned(spark, d), P)


def _counts(spark, d):
    """Contacts in each pair of bins, as values in place of proximities."""
    return binning.pair_bins(_contacts(spark, d), P).groupBy("cell", "chrom", "i", "j").agg(F.count(F.lit(1)).cast("double").alias("v"))


def _z(spark, d):
    """z and background of the counts, by the fused kernel."""
    return analysis.from_values(_counts(spark, d), P)


def _scored(spark, d, by_runs: bool = False):
    """z of the counts alone."""
    return analysis.from_values(_counts(spark, d), P, background=False, by_runs=by_runs)


def _sums(spark, d):
    """Sums over cells, folded in the tasks that score them."""
    return analysis.tested_places(analysis.from_values(_counts(spark, d), P, folded=True))


def _outliers(spark, d):
    """Outliers of every place, folded in the tasks that score."""
    packed = analysis.from_values(_counts(spark, d), P, folded=True, background=False)
    return moments.places(moments.merged(packed)).select("chrom", "i", "j", F.col("outlier_count").alias("outliers"))


def _cells(spark, d):
    return combine.cell_counts(binning.pair_bins(_contacts(spark, d), P))


def _significances(spark, d):
    return stats.significances(_sums(spark, d), P)


def _regions(spark):
    """Regions that start at a third of the bins."""
    return spark.range(200).where("id % 3 = 0").select(F.lit("chr1").alias("chrom"), (F.col("id") * P.binsize).alias("start"))


def _found(spark, d):
    found = staged(_significances(spark, d), "significances")
    return candidates.neighbor_means(candidates.candidate_filter(found, _cells(spark, d), P), found, P)


def _candidates(spark, d):
    return staged(candidates.candidate_filter(_significances(spark, d), _cells(spark, d), P), "candidates")


def _clustered(spark, d, group_rows: int = cluster.GROUP_ROWS):
    return cluster.clustered(candidates.enrichment_filter(_found(spark, d), P), P, group_rows)


def _scores(spark, d):
    """Scores of the final summits in every cell."""
    peaks = staged(cluster.final_summits(_clustered(spark, d)).select("chrom", "i", "j"), "summits")
    return staged(analysis.scores_at(_counts(spark, d), peaks, P), "scores")


def _pivot(spark, d):
    """The same with a column for each of some cells, as SQL must name them; summit_scores has all."""
    return _rounded(cluster.zscore_pivot(_scores(spark, d), list(PIVOT_CELLS)), *map(str, PIVOT_CELLS)).withColumnsRenamed({str(c): f"cell_{c}" for c in PIVOT_CELLS})


def _method(name: str, **params):
    def run(spark: SparkSession, d: str) -> DataFrame:
        from dataclasses import replace

        return graph.rwr(_binned(spark, d), replace(P, rwr_method=name, **({"blin_partitions": 4} | params)))

    return run


def _rated(df: DataFrame) -> DataFrame:
    """A p-like value of every pair, with ties."""
    p = ((F.col("i") * 7919 + F.col("j") * 104_729 + F.col("n") * 31) % 997) / F.lit(997.0)
    return df.groupBy("chrom", "i", "j").agg(F.count(F.lit(1)).alias("n")).withColumn("pvalue", p).withColumn("d", F.col("j") - F.col("i"))


QUERIES = {
    "bin_contacts": _binned,
    "distance_histogram": lambda s, d: binning.distance_histogram(_binned(s, d)),
    "binned_bedpe": lambda s, d: binning.bedpe(_binned(s, d), P, "cell"),
    "window_size_fractions": lambda s, d: _rounded(binning.window_size_fractions(_contacts(s, d), P, NEAR), "share"),
    "graph_edges": _edges,
    "graph_degree": lambda s, d: graph.degree(_edges(s, d)),
    "transition_matrix": lambda s, d: _rounded(graph.transition_matrix(_edges(s, d)), "p", digits=9),
    "laplacian_weights": lambda s, d: _rounded(graph.laplacian_weights(_edges(s, d)), "w", digits=9),
    "rwr_iterative_k2": lambda s, d: _rounded(graph.rwr_iterative(_edges(s, d), P, 2).withColumn("s", F.col("s") + OFF_TIE), "s"),
    "rwr_inverse": _method("inverse"),
    "rwr_iterative": _method("iterative"),
    "rwr_sliding_window": _method("sliding_window", window_bins=2 * P.max_rwr_bins),  # several windows in each chromosome
    "rwr_nblin": _method("nblin"),
    "rwr_nblin_rank": _method("nblin", nblin_rank=60),
    "rwr_blin": _method("blin"),
    "rwr_q1": lambda s, d: _rounded(_method("q1", blin_partitions=100, blin_contiguous=True)(s, d), "v", digits=9),  # blocks of two bins, which SQL can invert
    "diag_trimmed_zscore": lambda s, d: _rounded(normalize.diag_zscore_of_values(_counts(s, d), P), "z"),
    "diag_zscore_by_value": lambda s, d: _rounded(normalize.diag_zscore_of_values(_counts(s, d), P, by_value=True), "z"),
    "fused_zscore": lambda s, d: _rounded(_scored(s, d), "z"),
    "outlier_count": _outliers,
    "outlier_count_from_rows": lambda s, d: combine.outlier_count(_scored(s, d), P.outlier),
    "hic_score": lambda s, d: combine.hic_score(_outliers(s, d), _cells(s, d)),
    "hic_input": lambda s, d: combine.hic_input(combine.hic_score(_outliers(s, d), _cells(s, d)), P),
    "hic_input_all": lambda s, d: combine.hic_input(combine.hic_score(_outliers(s, d), _cells(s, d)), P, positive=False),
    "hic_input_from_fdr": lambda s, d: combine.hic_input_from_fdr(_significances(s, d), P),
    "local_background": lambda s, d: _rounded(background.local_background(_scored(s, d, by_runs=True), P, together=True), "z", "nb"),
    "fused_background": lambda s, d: _rounded(_z(s, d).where("nb is not null"), "z", "nb"),
    "paired_tstat": lambda s, d: _rounded(stats.paired_t(_sums(s, d)).select("chrom", "i", "j", "n", "outlier_count", "case_avg", "control_avg", "tstat"), "case_avg", "control_avg", "tstat"),
    "paired_tstat_from_rows": lambda s, d: _rounded(stats.paired_t(analysis.sums(_z(s, d), P)).select("chrom", "i", "j", "n", "outlier_count", "case_avg", "control_avg", "tstat"), "case_avg", "control_avg", "tstat"),
    "student_p_values": lambda s, d: _rounded(_rounded(stats.p_values(stats.paired_t(_sums(s, d))).select("chrom", "i", "j", "tstat", "pvalue"), "tstat"), "pvalue", digits=8),
    "bh_fdr_by_distance": lambda s, d: _rounded(stats.bh_fdr(_rated(_binned(s, d)), ["chrom", "d"], "fdr").select("chrom", "i", "j", "fdr"), "fdr", digits=9),
    "bh_fdr_chrom": lambda s, d: _rounded(stats.bh_fdr(_rated(_binned(s, d)), ["chrom"], "fdr").select("chrom", "i", "j", "fdr"), "fdr", digits=9),
    "bh_fdr_chrom_ranged": lambda s, d: _rounded(stats.bh_fdr_ranged(_rated(_binned(s, d)), ["chrom"], "fdr", 16).select("chrom", "i", "j", "fdr"), "fdr", digits=9),
    "significances": lambda s, d: _rounded(_significances(s, d), "case_avg", "control_avg", "pvalue", "tstat", "fdr_dist", "fdr_chrom"),
    "candidate_filter": lambda s, d: candidates.candidate_filter(_significances(s, d), _cells(s, d), P).select("chrom", "i", "j", "outlier_count"),
    "neighbor_means": lambda s, d: _rounded(_found(s, d).select("chrom", "i", "j", "outlier_count", *candidates.MEANS), *candidates.MEANS),
    "enrichment_filter": lambda s, d: candidates.enrichment_filter(_found(s, d), P).select("chrom", "i", "j", "outlier_count"),
    "blacklist_anti_join": lambda s, d: candidates.blacklist_anti_join(_binned(s, d), _regions(s), P),
    "density_rho": lambda s, d: cluster.density(cluster.not_isolated(_candidates(s, d)), P).select("chrom", "i", "j", "ro"),
    "density_clusters": lambda s, d: _rounded(_clustered(s, d).select("chrom", "i", "j", "ro", "delta", "eta", "rank", "eta_cluster", "cluster_size"), "delta", "eta"),
    "summit_nms": lambda s, d: cluster.final_summits(_clustered(s, d)).select("chrom", "i", "j", "eta_cluster", "cluster_size"),
    "connected_candidates": lambda s, d: cluster.connected(_candidates(s, d), P.clustering_gap),
    # The same where a chromosome has more candidates than a task should hold.
    "density_clusters_by_joins": lambda s, d: _rounded(_clustered(s, d, 0).select("chrom", "i", "j", "ro", "delta", "eta", "rank", "eta_cluster", "cluster_size"), "delta", "eta"),
    "summits_by_rounds": lambda s, d: cluster.final_summits(_clustered(s, d, 0)).select("chrom", "i", "j", "eta_cluster", "cluster_size"),
    "connected_by_stars": lambda s, d: cluster.connected(_candidates(s, d), P.clustering_gap, 0),
    "zscore_pivot": lambda s, d: _pivot(s, d),
    "knee_clusters": lambda s, d: _rounded(cluster.knee_clusters(_candidates(s, d), P).select("chrom", "i", "j", "cluster", "cluster_type", "cluster_size", "neg_log10_fdr", "summit"), "neg_log10_fdr"),
    "summit_scores": lambda s, d: _rounded(_scores(s, d), "z"),
    "completed_jobs_antijoin": lambda s, d: jobs.remaining_jobs(_binned(s, d), _binned(s, d).where("cell % 3 = 0")),
    "validate_counts": lambda s, d: jobs.validate_counts(_scored(s, d), P),
    "validate_incomplete": lambda s, d: jobs.validate_counts(_scored(s, d).where(F.col("z") <= P.outlier), P),  # a table that lacks its outliers
    "loops": lambda s, d: analysis.loops(_contacts(s, d), P).select("chrom", "i", "j", "outlier_count", "eta_cluster", "cluster_size", "summit"),
}

# SQL: common tables, each on top of those before it.

_TABLES = {
    "base": fixture.SQL,
    "pairs": f"""pairs AS (SELECT cell, chrom, LEAST(pos1, pos2) // {P.binsize} AS i, GREATEST(pos1, pos2) // {P.binsize} AS j FROM contacts
  WHERE abs(pos1 - pos2) >= {P.low_cutoff} AND GREATEST(pos1, pos2) // {P.binsize} - LEAST(pos1, pos2) // {P.binsize} >= 2)""",
    "binned": "binned AS (SELECT DISTINCT cell, chrom, i, j FROM pairs)",
    "ncells": "ncells AS (SELECT chrom, count(DISTINCT cell) AS cells FROM binned GROUP BY chrom)",
    "edges": """links AS (SELECT cell, chrom, i AS u, j AS v FROM binned UNION
    SELECT g.cell, g.chrom, k.k AS u, k.k + 1 AS v FROM (SELECT DISTINCT cell, chrom FROM binned) AS g, (SELECT CAST(range AS BIGINT) AS k FROM range(0, 199)) AS k),
  edges AS (SELECT cell, chrom, u, v FROM links UNION SELECT cell, chrom, v, u FROM links)""",
    "deg": "deg AS (SELECT cell, chrom, u, count(*) AS degree FROM edges GROUP BY ALL)",
    "vals": f"""cells AS (SELECT DISTINCT cell, chrom FROM binned),
  grid AS (SELECT c.chrom, CAST(a.range AS BIGINT) AS i, CAST(b.range AS BIGINT) AS j FROM (SELECT DISTINCT chrom FROM binned) AS c, range(5, 195) AS a, range(5, 195) AS b
    WHERE b.range > a.range AND b.range - a.range <= {P.max_rwr_bins}),
  counts AS (SELECT cell, chrom, i, j, CAST(count(*) AS DOUBLE) AS v FROM pairs GROUP BY ALL),
  vals AS (SELECT c.cell, g.chrom, g.i, g.j, coalesce(k.v, 0) AS v FROM cells AS c JOIN grid AS g ON g.chrom = c.chrom
    LEFT JOIN counts AS k ON k.cell = c.cell AND k.chrom = g.chrom AND k.i = g.i AND k.j = g.j)""",
    "zs": """ranked AS (SELECT *, row_number() OVER (PARTITION BY cell, chrom, j - i ORDER BY v DESC) AS rn, count(*) OVER (PARTITION BY cell, chrom, j - i) AS n FROM vals),
  marked AS (SELECT *, CASE WHEN (CASE WHEN round_even(CAST(0.01 AS DOUBLE) * n, 0) >= 1 THEN rn >= round_even(CAST(0.01 AS DOUBLE) * n, 0) ELSE rn = n END) THEN v END AS x FROM ranked),
  stat AS (SELECT chrom, cell, j - i AS d, avg(x) AS mu, stddev_pop(x) AS sd FROM marked GROUP BY ALL),
  zs AS (SELECT m.cell, m.chrom, m.i, m.j, CASE WHEN s.sd < 1e-6 THEN 0 ELSE (m.v - s.mu) / s.sd END AS z FROM marked AS m JOIN stat AS s ON s.cell = m.cell AND s.chrom = m.chrom AND s.d = m.j - m.i)""",
    "nbs": f"""offsets AS (SELECT a.range AS a, b.range AS b FROM range(-5, 6) AS a, range(-5, 6) AS b WHERE greatest(abs(a.range), abs(b.range)) > {P.local_lower_limit}),
  places AS (SELECT g.chrom, g.i, g.j, count(*) AS places FROM grid AS g, offsets AS o
    WHERE g.j - g.i <= {P.max_bins} AND g.i + o.a >= 0 AND g.j + o.b <= 200 AND g.j + o.b > g.i + o.a GROUP BY ALL),
  frame AS (SELECT c.cell, c.chrom, CAST(a.range AS BIGINT) AS i, CAST(a.range + d.range AS BIGINT) AS j FROM cells AS c, range(0, 200) AS a, range(-4, {P.max_rwr_bins + 1}) AS d),
  filled AS (SELECT f.*, coalesce(zs.z, 0) AS z FROM frame AS f LEFT JOIN zs ON zs.cell = f.cell AND zs.chrom = f.chrom AND zs.i = f.i AND zs.j = f.j),
  across AS (SELECT cell, chrom, i, j, z, sum(z) OVER (w RANGE BETWEEN 5 PRECEDING AND 5 FOLLOWING) AS big, sum(z) OVER (w RANGE BETWEEN {P.local_lower_limit} PRECEDING AND {P.local_lower_limit} FOLLOWING) AS small FROM filled WINDOW w AS (PARTITION BY cell, chrom, i ORDER BY j)),
  boxes AS (SELECT cell, chrom, i, j, z, sum(big) OVER (w RANGE BETWEEN 5 PRECEDING AND 5 FOLLOWING) - sum(small) OVER (w RANGE BETWEEN {P.local_lower_limit} PRECEDING AND {P.local_lower_limit} FOLLOWING) AS s FROM across WINDOW w AS (PARTITION BY cell, chrom, j ORDER BY i)),
  nbs AS (SELECT b.cell, b.chrom, b.i, b.j, b.z, b.s / p.places AS nb FROM boxes AS b JOIN places AS p ON p.chrom = b.chrom AND p.i = b.i AND p.j = b.j)""",
    "tested": f"""sums AS (SELECT chrom, i, j, count(*) AS n, avg(z) AS ca, avg(nb) AS co, avg(z - nb) AS m, stddev_samp(z - nb) AS sd, count(*) FILTER (WHERE z > {P.outlier}) AS outlier_count FROM nbs GROUP BY ALL),
  tested AS (SELECT chrom, i, j, n, outlier_count, nullif(ca, 0) AS case_avg, nullif(co, 0) AS control_avg,
    CASE WHEN n < 2 THEN -1000 WHEN sd = 0 THEN (CASE WHEN m > 0 THEN 1.7976931348623157e308 WHEN m < 0 THEN -1.7976931348623157e308 ELSE -1000 END)
         WHEN m = 0 THEN -1000 ELSE m / sd * sqrt(n) END AS tstat FROM sums)""",
    # Two-sided tail of Student's t: x^a (1 - x)^(1/2) / (a B(a, 1/2)) times a series of positive terms far out, the finite
    # series in sine and cosine near 0.
    "tail": """param AS (SELECT *, n - 1 AS df, CAST(n - 1 AS DOUBLE) / (n - 1 + tstat * tstat) AS x, atan(abs(tstat) / sqrt(n - 1)) AS th FROM tested WHERE tstat <> -1000 AND abs(tstat) < 1e300),
  far AS (SELECT chrom, i, j, sum(exp(lgamma(h + 0.5 + k.range) - lgamma(h + 1 + k.range) + (h + k.range) * ln(x))) * sqrt(1 - x) / sqrt(pi()) AS p FROM (SELECT *, CAST(df AS DOUBLE) / 2 AS h FROM param WHERE abs(tstat) > 3) AS t, range(0, 600) AS k GROUP BY chrom, i, j, df, x),
  even AS (SELECT k, exp(coalesce(sum(ln(CAST(2 * k - 1 AS DOUBLE) / (2 * k))) FILTER (WHERE k > 0) OVER (ORDER BY k), 0)) AS c FROM (SELECT range AS k FROM range(0, 5000))),
  odd AS (SELECT k, exp(coalesce(sum(ln(CAST(2 * k AS DOUBLE) / (2 * k + 1))) FILTER (WHERE k > 0) OVER (ORDER BY k), 0)) AS c FROM (SELECT range AS k FROM range(0, 5000))),
  nigh AS (SELECT chrom, i, j, CASE WHEN df % 2 = 0 THEN 1 - sin(th) * coalesce(s, 0) ELSE 1 - 2 / pi() * (th + sin(th) * coalesce(s, 0)) END AS p FROM (
    SELECT t.chrom, t.i, t.j, t.df, t.th, sum(CASE WHEN t.df % 2 = 0 THEN e.c * pow(cos(t.th), 2 * e.k) ELSE o.c * pow(cos(t.th), 2 * e.k + 1) END) AS s FROM param AS t LEFT JOIN even AS e ON 2 * e.k <= t.df - 2 - t.df % 2 LEFT JOIN odd AS o ON o.k = e.k
    WHERE abs(t.tstat) <= 3 GROUP BY t.chrom, t.i, t.j, t.df, t.th) AS q),
  student AS (SELECT t.*, CASE WHEN t.tstat = -1000 THEN 1 WHEN abs(t.tstat) >= 1e300 THEN 0 ELSE coalesce(f.p, r.p) END AS pvalue FROM tested AS t LEFT JOIN far AS f ON f.chrom = t.chrom AND f.i = t.i AND f.j = t.j LEFT JOIN nigh AS r ON r.chrom = t.chrom AND r.i = t.i AND r.j = t.j)""",
    "sig": f"""universe AS (SELECT c.chrom, CAST(a.range AS BIGINT) AS i, CAST(b.range AS BIGINT) AS j FROM (SELECT 'chr1' AS chrom UNION ALL SELECT 'chr2') AS c, range(5, 195) AS a, range(5, 196) AS b
    WHERE b.range > a.range AND b.range - a.range <= {P.max_bins}),
  pv AS (SELECT u.chrom, u.i, u.j, u.j - u.i AS d, t.n, t.outlier_count, t.case_avg, t.control_avg, t.tstat,
    coalesce(t.pvalue, 1) AS pvalue FROM universe AS u LEFT JOIN student AS t ON t.chrom = u.chrom AND t.i = u.i AND t.j = u.j),
  r1 AS (SELECT *, pvalue * count(*) OVER (PARTITION BY chrom, d) / row_number() OVER (PARTITION BY chrom, d ORDER BY pvalue, i, j) AS q1,
    pvalue * count(*) OVER (PARTITION BY chrom) / row_number() OVER (PARTITION BY chrom ORDER BY pvalue, i, j) AS q2 FROM pv),
  r2 AS (SELECT *, least(1, min(q1) OVER (PARTITION BY chrom, d ORDER BY pvalue DESC, i DESC, j DESC ROWS UNBOUNDED PRECEDING)) AS fdr_dist,
    least(1, min(q2) OVER (PARTITION BY chrom ORDER BY pvalue DESC, i DESC, j DESC ROWS UNBOUNDED PRECEDING)) AS fdr_chrom FROM r1),
  sig AS (SELECT chrom, i, j, outlier_count, case_avg, control_avg, pvalue, tstat, fdr_dist, fdr_chrom FROM r2 WHERE n IS NOT NULL)""",
    "cand": f"""cand AS (SELECT s.* FROM sig AS s JOIN ncells AS c ON c.chrom = s.chrom WHERE (s.j - s.i) * {P.binsize} BETWEEN {P.candidate_lower_distance} AND {P.candidate_upper_distance}
    AND s.case_avg > 0 AND s.tstat > {P.tstat_threshold} AND s.fdr_dist < CAST({P.fdr_threshold} AS DOUBLE) AND s.outlier_count > CAST({P.outlier_threshold_multiplier} AS DOUBLE) * c.cells)""",
    "means": """near AS (SELECT c.chrom, c.i, c.j, s.outlier_count AS o, s.i - c.i AS a, s.j - c.j AS b FROM cand AS c JOIN sig AS s ON s.chrom = c.chrom AND abs(s.i - c.i) <= 5 AND abs(s.j - c.j) <= 5 AND greatest(abs(s.i - c.i), abs(s.j - c.j)) > 2),
  avgs AS (SELECT chrom, i, j, avg(o) AS circle, avg(o) FILTER (WHERE a <> 0 AND b <> 0 AND NOT (a < 0 AND b < 0)) AS donut, avg(o) FILTER (WHERE a = 0) AS horizontal, avg(o) FILTER (WHERE b = 0) AS vertical,
    avg(o) FILTER (WHERE a < 0 AND b < 0) AS lower_left FROM near GROUP BY ALL),
  means AS (SELECT c.*, coalesce(v.circle, 0) AS circle, CASE WHEN v.circle IS NULL THEN 0 ELSE v.donut END AS donut, CASE WHEN v.circle IS NULL THEN 0 ELSE v.horizontal END AS horizontal,
    CASE WHEN v.circle IS NULL THEN 0 ELSE v.vertical END AS vertical, CASE WHEN v.circle IS NULL THEN 0 ELSE v.lower_left END AS lower_left FROM cand AS c LEFT JOIN avgs AS v ON v.chrom = c.chrom AND v.i = c.i AND v.j = c.j)""",
    "enriched": f"""enriched AS (SELECT * FROM means WHERE outlier_count > circle * CAST({P.circle_multiplier} AS DOUBLE) AND outlier_count > donut * CAST({P.donut_multiplier} AS DOUBLE) AND outlier_count > lower_left * CAST({P.lower_left_multiplier} AS DOUBLE)
    AND outlier_count > horizontal * CAST({P.horizontal_multiplier} AS DOUBLE) AND outlier_count > vertical * CAST({P.vertical_multiplier} AS DOUBLE))""",
}


def _density(source: str) -> str:
    return f"""pts AS (SELECT a.* FROM {source} AS a WHERE EXISTS (SELECT 1 FROM {source} AS b WHERE b.chrom = a.chrom AND (b.i <> a.i OR b.j <> a.j) AND (a.i - b.i) * (a.i - b.i) + (a.j - b.j) * (a.j - b.j) <= 8)),
  rho AS (SELECT a.chrom, a.i, a.j, any_value(a.fdr_dist) AS fdr_dist, count(*) AS ro FROM pts AS a JOIN pts AS b ON b.chrom = a.chrom AND (a.i - b.i) * (a.i - b.i) + (a.j - b.j) * (a.j - b.j) <= 2 GROUP BY a.chrom, a.i, a.j)"""


_CLUSTERS = """num AS (SELECT *, row_number() OVER (PARTITION BY chrom ORDER BY i, j) - 1 AS rownum FROM rho),
  dist AS (SELECT a.chrom, a.rownum, b.rownum AS other, b.ro > a.ro AS denser, sqrt(CAST((a.i - b.i) * (a.i - b.i) + (a.j - b.j) * (a.j - b.j) AS DOUBLE)) AS d FROM num AS a JOIN num AS b ON b.chrom = a.chrom),
  par AS (SELECT chrom, rownum, coalesce(min(d) FILTER (WHERE denser), max(d)) AS delta, coalesce(arg_min(other, d * 1e7 + other) FILTER (WHERE denser), rownum) AS parent FROM dist GROUP BY chrom, rownum),
  eta AS (SELECT n.chrom, n.i, n.j, n.fdr_dist, n.ro, n.rownum, p.delta, p.parent, n.ro * p.delta AS eta, dense_rank() OVER (PARTITION BY n.chrom ORDER BY n.ro * p.delta DESC) AS rank FROM num AS n JOIN par AS p ON p.chrom = n.chrom AND p.rownum = n.rownum),
  turned AS (SELECT *, (eta / max(eta) OVER (PARTITION BY chrom) + CAST(rank AS DOUBLE) / max(rank) OVER (PARTITION BY chrom)) / sqrt(2) AS te FROM eta),
  bend AS (SELECT chrom, eta AS bend FROM (SELECT *, row_number() OVER (PARTITION BY chrom ORDER BY te, rownum) AS k FROM turned) AS q WHERE k = 1),
  centre AS (SELECT t.chrom, t.rownum, row_number() OVER (PARTITION BY t.chrom ORDER BY t.rownum) AS eta_cluster FROM turned AS t JOIN bend AS b ON b.chrom = t.chrom WHERE t.eta > b.bend),
  tree AS (SELECT chrom, rownum, eta_cluster FROM centre UNION ALL
    SELECT t.chrom, t.rownum, r.eta_cluster FROM tree AS r JOIN turned AS t ON t.chrom = r.chrom AND t.parent = r.rownum AND t.rownum <> r.rownum JOIN bend AS b ON b.chrom = t.chrom WHERE t.eta <= b.bend),
  named AS (SELECT t.chrom, t.i, t.j, t.ro, t.delta, t.eta, t.rank, coalesce(r.eta_cluster, -1) AS eta_cluster FROM turned AS t LEFT JOIN tree AS r ON r.chrom = t.chrom AND r.rownum = t.rownum)"""


#: Each cluster's members from the smallest rate on, and those taken so far: none within the gap of one taken before.
_SUMMITS = f"""lists AS (SELECT n.chrom, n.eta_cluster, list({{'i': n.i, 'j': n.j}} ORDER BY t.fdr_dist, t.rownum) AS pts, count(*) AS size FROM named AS n JOIN turned AS t ON t.chrom = n.chrom AND t.i = n.i AND t.j = n.j GROUP BY n.chrom, n.eta_cluster),
  picks AS (SELECT chrom, eta_cluster, size, pts, 1 AS k, [pts[1]] AS taken FROM lists UNION ALL
    SELECT chrom, eta_cluster, size, pts, k + 1, CASE WHEN len(list_filter(taken, lambda q: abs(q.i - pts[k + 1].i) * {P.binsize} <= {P.gap} AND abs(q.j - pts[k + 1].j) * {P.binsize} <= {P.gap})) = 0 THEN list_append(taken, pts[k + 1]) ELSE taken END FROM picks WHERE k < size)"""
_TAKEN = "picks WHERE k = size AND size > 1"


def _sql(last: str, select: str, *more: str, recursive: bool = False) -> str:
    """The common tables up to one, further ones, and a query on them."""
    names = list(_TABLES)
    need = {"edges": ["base", "pairs", "binned", "edges"], "deg": ["base", "pairs", "binned", "edges", "deg"]}.get(last) or [n for n in names[: names.index(last) + 1] if n not in ("edges", "deg")]
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n  ".join([*(_TABLES[n] for n in need), *more]) + "\n" + select


def _r(name: str, digits: int = DIGITS) -> str:
    return f"round({name}, {digits}) + CAST(0 AS DOUBLE) AS {name.split('.')[-1]}"


_SHORT = "SELECT 0 AS str1, o.chrom AS chr1, o.i * 10000 AS x1, 0 AS frag1, 1 AS str2, o.chrom AS chr2, o.j * 10000 AS y1, 1 AS frag2, {score} AS score FROM {source}"
_OUTLIERS = f"outs AS (SELECT chrom, i, j, count(*) FILTER (WHERE z > {P.outlier}) AS outliers FROM zs GROUP BY ALL)"
_SCORE = "CAST(ceil(CAST(o.outliers AS DOUBLE) / c.cells * 100) AS BIGINT)"
_RATED = "rated AS (SELECT chrom, i, j, j - i AS d, ((i * 7919 + j * 104729 + count(*) * 31) % 997) / CAST(997 AS DOUBLE) AS pvalue FROM binned GROUP BY chrom, i, j)"


def _bh(by: str) -> str:
    return f"""q AS (SELECT *, pvalue * count(*) OVER (PARTITION BY {by}) / row_number() OVER (PARTITION BY {by} ORDER BY pvalue, i, j) AS raw FROM rated),
  w AS (SELECT chrom, i, j, least(1, min(raw) OVER (PARTITION BY {by} ORDER BY pvalue DESC, i DESC, j DESC ROWS UNBOUNDED PRECEDING)) AS fdr FROM q)"""


ORACLE = {
    "bin_contacts": _sql("binned", "SELECT * FROM binned"),
    "distance_histogram": _sql("binned", "SELECT cell, chrom, j - i AS d, count(*) AS n FROM binned GROUP BY ALL"),
    "binned_bedpe": _sql("binned", "SELECT chrom AS chr1, i * 10000 AS x1, (i + 1) * 10000 AS x2, chrom AS chr2, j * 10000 AS y1, (j + 1) * 10000 AS y2, cell FROM binned"),
    "window_size_fractions": _sql("binned", f"SELECT m.range AS upto, round(avg(CASE WHEN (b.j - b.i) * 10000 < m.range THEN 1.0 ELSE 0.0 END), 6) AS share FROM binned AS b, range({NEAR.start}, {NEAR.stop}, {NEAR.step}) AS m GROUP BY m.range"),
    "graph_edges": _sql("edges", "SELECT cell, chrom, u, v FROM edges"),
    "graph_degree": _sql("deg", "SELECT cell, chrom, u, degree FROM deg"),
    "transition_matrix": _sql("deg", f"SELECT e.cell, e.chrom, e.u, e.v, round(CAST(1 AS DOUBLE) / d.degree, 9) AS p FROM edges AS e JOIN deg AS d USING (cell, chrom, u)"),
    "laplacian_weights": _sql("deg", "SELECT e.cell, e.chrom, e.u, e.v, round(1 / sqrt(CAST(d.degree AS DOUBLE) * f.degree), 9) AS w FROM edges AS e JOIN deg AS d USING (cell, chrom, u) JOIN deg AS f ON f.cell = e.cell AND f.chrom = e.chrom AND f.u = e.v"),
    "rwr_iterative_k2": _sql(
        "deg",
        "SELECT cell, chrom, i, j, round(sum(a) + " + str(OFF_TIE) + ", 6) AS s FROM (SELECT cell, chrom, u AS i, w AS j, a FROM a2 UNION ALL SELECT cell, chrom, w, u, a FROM a2) AS b GROUP BY ALL",
        "t AS (SELECT e.cell, e.chrom, e.u, e.v, CAST(1 AS DOUBLE) / d.degree AS p FROM edges AS e JOIN deg AS d USING (cell, chrom, u))",
        f"a1 AS (SELECT cell, chrom, u, w, sum(a) AS a FROM (SELECT cell, chrom, u, v AS w, {1 - P.alpha} * p AS a FROM t UNION ALL SELECT cell, chrom, u, u, {P.alpha} FROM deg) AS x GROUP BY ALL)",
        f"a2 AS (SELECT cell, chrom, u, w, sum(a) AS a FROM (SELECT t.cell, t.chrom, t.u, a1.w, {1 - P.alpha} * t.p * a1.a AS a FROM t JOIN a1 ON a1.cell = t.cell AND a1.chrom = t.chrom AND a1.u = t.v UNION ALL SELECT cell, chrom, u, u, {P.alpha} FROM deg) AS x GROUP BY ALL)",
    ),
    "diag_trimmed_zscore": _sql("zs", f"SELECT cell, chrom, i, j, {_r('z')} FROM zs"),
    "fused_zscore": _sql("zs", f"SELECT cell, chrom, i, j, {_r('z')} FROM zs"),
    "outlier_count": _sql("zs", "SELECT chrom, i, j, outliers FROM outs", _OUTLIERS),
    "hic_score": _sql("zs", f"SELECT o.chrom, o.i, o.j, {_SCORE} AS score FROM outs AS o JOIN ncells AS c ON c.chrom = o.chrom", _OUTLIERS),
    "hic_input": _sql("zs", _SHORT.format(score=_SCORE, source="outs AS o JOIN ncells AS c ON c.chrom = o.chrom WHERE o.outliers > 0"), _OUTLIERS),
    "hic_input_all": _sql("zs", _SHORT.format(score=_SCORE, source="outs AS o JOIN ncells AS c ON c.chrom = o.chrom"), _OUTLIERS),
    "hic_input_from_fdr": _sql("sig", _SHORT.format(score="CAST(round_even(-log10(o.fdr_dist + 1e-6), 0) AS BIGINT)", source="sig AS o")),
    "local_background": _sql("nbs", f"SELECT cell, chrom, i, j, {_r('z')}, {_r('nb')} FROM nbs"),
    "fused_background": _sql("nbs", f"SELECT cell, chrom, i, j, {_r('z')}, {_r('nb')} FROM nbs"),
    "paired_tstat": _sql("tested", f"SELECT chrom, i, j, n, outlier_count, {_r('case_avg')}, {_r('control_avg')}, {_r('tstat')} FROM tested"),
    "student_p_values": _sql("tail", f"SELECT chrom, i, j, {_r('tstat')}, {_r('pvalue', 8)} FROM student"),
    "bh_fdr_by_distance": _sql("binned", "SELECT chrom, i, j, round(fdr, 9) AS fdr FROM w", _RATED, _bh("chrom, d")),
    "bh_fdr_chrom": _sql("binned", "SELECT chrom, i, j, round(fdr, 9) AS fdr FROM w", _RATED, _bh("chrom")),
    "significances": _sql("sig", "SELECT chrom, i, j, outlier_count, " + ", ".join(map(_r, ("case_avg", "control_avg", "pvalue", "tstat", "fdr_dist", "fdr_chrom"))) + " FROM sig"),
    "candidate_filter": _sql("cand", "SELECT chrom, i, j, outlier_count FROM cand"),
    "neighbor_means": _sql("means", "SELECT chrom, i, j, outlier_count, " + ", ".join(map(_r, candidates.MEANS)) + " FROM means"),
    "enrichment_filter": _sql("enriched", "SELECT chrom, i, j, outlier_count FROM enriched"),
    "blacklist_anti_join": _sql("binned", "SELECT * FROM binned WHERE NOT (chrom = 'chr1' AND (i % 3 = 0 OR j % 3 = 0))"),
    "density_rho": _sql("cand", "SELECT chrom, i, j, ro FROM rho", _density("cand")),
    "density_clusters": _sql("enriched", f"SELECT chrom, i, j, ro, {_r('delta')}, {_r('eta')}, rank, eta_cluster, count(*) OVER (PARTITION BY chrom, eta_cluster) AS cluster_size FROM named", _density("enriched"), _CLUSTERS, recursive=True),
    "summit_nms": _sql("enriched", f"SELECT chrom, p.i AS i, p.j AS j, eta_cluster, size AS cluster_size FROM (SELECT chrom, eta_cluster, size, unnest(taken) AS p FROM {_TAKEN})", _density("enriched"), _CLUSTERS, _SUMMITS, recursive=True),
    "connected_candidates": _sql(
        "cand",
        "SELECT n.chrom, n.i, n.j, min(r.o) AS cluster FROM numbered AS n JOIN reach AS r ON r.chrom = n.chrom AND r.k = n.k GROUP BY n.chrom, n.i, n.j",
        "numbered AS (SELECT chrom, i, j, row_number() OVER (PARTITION BY chrom ORDER BY i, j) - 1 AS k FROM cand)",
        f"reach AS (SELECT chrom, k, k AS o FROM numbered UNION SELECT r.chrom, r.k, b.k FROM reach AS r JOIN numbered AS a ON a.chrom = r.chrom AND a.k = r.o JOIN numbered AS b ON b.chrom = a.chrom AND (a.i - b.i) * (a.i - b.i) + (a.j - b.j) * (a.j - b.j) <= {2 * P.clustering_gap**2})",
        recursive=True,
    ),
    "zscore_pivot": _sql(
        "enriched",
        "SELECT z.chrom, z.i, z.j, " + ", ".join(f'round(max(z.z) FILTER (WHERE z.cell = {c}), {DIGITS}) + CAST(0 AS DOUBLE) AS cell_{c}' for c in PIVOT_CELLS) + f" FROM (SELECT chrom, unnest(taken) AS p FROM {_TAKEN}) AS s JOIN zs AS z ON z.chrom = s.chrom AND z.i = s.p.i AND z.j = s.p.j GROUP BY z.chrom, z.i, z.j",
        _density("enriched"),
        _CLUSTERS,
        _SUMMITS,
        recursive=True,
    ),
    "rwr_q1": _sql(
        "deg",
        f"SELECT g.cell, g.chrom, g.i, g.j, round(CASE WHEN g.i % 2 = 0 AND g.j = g.i + 1 THEN {1 - P.alpha} * (g.p + g.q) / (1 - CAST({1 - P.alpha} AS DOUBLE) * {1 - P.alpha} * g.p * g.q) ELSE 0 END, 9) + CAST(0 AS DOUBLE) AS v FROM places AS g",
        f"places AS (SELECT a.cell, a.chrom, a.u AS i, b.u AS j, CAST(1 AS DOUBLE) / a.degree AS p, CAST(1 AS DOUBLE) / b.degree AS q FROM deg AS a JOIN deg AS b ON b.cell = a.cell AND b.chrom = a.chrom AND b.u > a.u AND b.u - a.u <= {P.max_rwr_bins} WHERE a.u >= 5 AND b.u < 195)",
    ),
    "completed_jobs_antijoin": _sql("binned", "SELECT DISTINCT cell, chrom FROM binned WHERE cell % 3 <> 0"),
    "validate_counts": _sql("vals", "SELECT cell, chrom, count(*) AS rows, count(*) AS expected, true AS complete FROM vals GROUP BY cell, chrom"),
}
_LINKED = [
    "numbered AS (SELECT chrom, i, j, fdr_dist, row_number() OVER (PARTITION BY chrom ORDER BY i, j) - 1 AS k FROM cand)",
    f"reach AS (SELECT chrom, k, k AS o FROM numbered UNION SELECT r.chrom, r.k, b.k FROM reach AS r JOIN numbered AS a ON a.chrom = r.chrom AND a.k = r.o JOIN numbered AS b ON b.chrom = a.chrom AND (a.i - b.i) * (a.i - b.i) + (a.j - b.j) * (a.j - b.j) <= {2 * P.clustering_gap**2})",
]
ORACLE |= {
    "diag_zscore_by_value": _sql(
        "vals",
        f"SELECT m.cell, m.chrom, m.i, m.j, round(CASE WHEN s.sd < 1e-6 THEN 0 ELSE (m.v - s.mu) / s.sd END, {DIGITS}) + CAST(0 AS DOUBLE) AS z FROM limited AS m JOIN spread AS s ON s.cell = m.cell AND s.chrom = m.chrom AND s.d = m.j - m.i",
        "placed AS (SELECT *, row_number() OVER w AS rn, count(*) OVER (PARTITION BY cell, chrom, j - i) AS n FROM vals WINDOW w AS (PARTITION BY cell, chrom, j - i ORDER BY v DESC))",
        "limited AS (SELECT *, max(v) FILTER (WHERE rn = CASE WHEN round_even(CAST(0.01 AS DOUBLE) * n, 0) >= 1 THEN round_even(CAST(0.01 AS DOUBLE) * n, 0) ELSE n END) OVER (PARTITION BY cell, chrom, j - i) AS top FROM placed)",
        "spread AS (SELECT cell, chrom, j - i AS d, avg(v) FILTER (WHERE v <= top) AS mu, stddev_pop(v) FILTER (WHERE v <= top) AS sd FROM limited GROUP BY ALL)",
    ),
    "knee_clusters": _sql(
        "cand",
        "SELECT n.chrom, n.i, n.j, n.cluster, CASE WHEN n.size = 1 THEN 'singleton' WHEN n.weight < k.knee THEN 'SharpPeak' ELSE 'BroadPeak' END AS cluster_type, n.size AS cluster_size, " + f"round(n.weight, {DIGITS}) + CAST(0 AS DOUBLE) AS neg_log10_fdr" + ", CASE WHEN list_contains(t.taken, {'i': n.i, 'j': n.j}) THEN 1 ELSE 0 END AS summit FROM labelled AS n LEFT JOIN knees AS k ON k.chrom = n.chrom JOIN picks AS t ON t.chrom = n.chrom AND t.first = n.first AND t.k = t.size",
        *_LINKED,
        "comp AS (SELECT n.chrom, n.i, n.j, n.fdr_dist, n.k AS place, min(r.o) AS first FROM numbered AS n JOIN reach AS r ON r.chrom = n.chrom AND r.k = n.k GROUP BY ALL)",
        "sized AS (SELECT chrom, first, count(*) AS size, sum(CASE WHEN fdr_dist = 0 THEN CAST('Infinity' AS DOUBLE) ELSE -log10(fdr_dist) END) AS weight FROM comp GROUP BY ALL)",
        "titled AS (SELECT *, CASE WHEN size = 1 THEN 'singleton_' ELSE 'cluster_' END || CAST(row_number() OVER (PARTITION BY chrom, size = 1 ORDER BY first) - 1 AS VARCHAR) AS cluster FROM sized)",
        "labelled AS (SELECT c.*, t.size, t.weight, t.cluster FROM comp AS c JOIN titled AS t ON t.chrom = c.chrom AND t.first = c.first)",
        "slope AS (SELECT chrom, weight, row_number() OVER (PARTITION BY chrom ORDER BY weight, i, j) AS r, weight / nullif(max(weight) OVER (PARTITION BY chrom), 0) - CAST(row_number() OVER (PARTITION BY chrom ORDER BY weight, i, j) AS DOUBLE) / count(*) OVER (PARTITION BY chrom) AS height FROM labelled WHERE size > 1 AND isfinite(weight))",
        "knees AS (SELECT chrom, weight AS knee FROM slope QUALIFY row_number() OVER (PARTITION BY chrom ORDER BY height, r) = 1)",
        "lists AS (SELECT chrom, first, list({'i': i, 'j': j} ORDER BY fdr_dist, i, j) AS pts, count(*) AS size FROM comp GROUP BY ALL)",
        f"""picks AS (SELECT chrom, first, size, pts, 1 AS k, [pts[1]] AS taken FROM lists UNION ALL
    SELECT chrom, first, size, pts, k + 1, CASE WHEN len(list_filter(taken, lambda q: abs(q.i - pts[k + 1].i) * {P.binsize} <= {P.gap} AND abs(q.j - pts[k + 1].j) * {P.binsize} <= {P.gap})) = 0 THEN list_append(taken, pts[k + 1]) ELSE taken END FROM picks WHERE k < size)""",
        recursive=True,
    ),
    "summit_scores": _sql(
        "enriched",
        f"SELECT z.chrom, z.i, z.j, z.cell, {_r('z.z')} FROM (SELECT chrom, unnest(taken) AS p FROM {_TAKEN}) AS s JOIN zs AS z ON z.chrom = s.chrom AND z.i = s.p.i AND z.j = s.p.j",
        _density("enriched"),
        _CLUSTERS,
        _SUMMITS,
        recursive=True,
    ),
    "validate_incomplete": _sql("zs", f"SELECT cell, chrom, count(*) FILTER (WHERE z <= {P.outlier}) AS rows, count(*) AS expected, count(*) FILTER (WHERE z <= {P.outlier}) = count(*) AS complete FROM zs GROUP BY cell, chrom HAVING count(*) FILTER (WHERE z <= {P.outlier}) > 0"),
    "paired_tstat_from_rows": ORACLE["paired_tstat"],
    "outlier_count_from_rows": ORACLE["outlier_count"],
    "bh_fdr_chrom_ranged": ORACLE["bh_fdr_chrom"],
    "density_clusters_by_joins": ORACLE["density_clusters"],
    "summits_by_rounds": ORACLE["summit_nms"],
    "connected_by_stars": ORACLE["connected_candidates"],
}
