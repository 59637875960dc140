"""Candidate loops: thresholds, neighbourhood means, enrichment and excluded regions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loopweaver.params import Params
from loopweaver.staging import staged

MEANS = ("circle", "donut", "horizontal", "vertical", "lower_left")


def candidate_filter(significances: DataFrame, cells: DataFrame, p: Params) -> DataFrame:
    """Pairs that pass every threshold. cells: chrom, cells."""
    d = (F.col("j") - F.col("i")) * p.binsize
    passed = significances.where(d.between(p.candidate_lower_distance, p.candidate_upper_distance) & (F.col("case_avg") > 0) & (F.col("tstat") > p.tstat_threshold) & (F.col("fdr_dist") < p.fdr_threshold))
    return passed.join(cells, "chrom").where(F.col("outlier_count") > p.outlier_threshold_multiplier * F.col("cells")).drop("cells")


def neighbor_means(candidates: DataFrame, significances: DataFrame, p: Params) -> DataFrame:
    """Adds the mean outlier count of each kind of neighbour that is present; null where a kind has none, 0 for all five
    where there is no neighbour at all.

    Each candidate is paired with the places around it, so the theta join is an equi-join on (chrom, i, j).
    """
    g, s = p.gap_large, p.gap_small
    steps = [(a, b) for a in range(-g, g + 1) for b in range(-g, g + 1) if max(abs(a), abs(b)) > s]
    kind = lambda a, b: "horizontal" if a == 0 and b != 0 else "vertical" if b == 0 else "lower_left" if a < 0 and b < 0 else "donut"
    around = F.explode(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(kind(a, b)).alias("kind")) for a, b in steps)))
    places = candidates.select("chrom", F.col("i").alias("ci"), F.col("j").alias("cj"), around.alias("s")).select("chrom", "ci", "cj", (F.col("ci") + F.col("s.a")).alias("i"), (F.col("cj") + F.col("s.b")).alias("j"), "s.kind")
    near = places.join(significances.select("chrom", "i", "j", F.col("outlier_count").alias("near")), ["chrom", "i", "j"])
    means = near.groupBy("chrom", "ci", "cj").agg(F.avg("near").alias("circle"), *(F.avg(F.when(F.col("kind") == k, F.col("near"))).alias(k) for k in MEANS[1:]))
    joined = candidates.join(means.withColumnsRenamed({"ci": "i", "cj": "j"}), ["chrom", "i", "j"], "left")
    # circle is null only where there is no neighbour of any kind.
    return joined.withColumns({k: F.when(F.col("circle").isNull(), 0.0).otherwise(F.col(k)) for k in MEANS[1:]}).withColumn("circle", F.coalesce("circle", F.lit(0.0)))


def enrichment_filter(candidates: DataFrame, p: Params) -> DataFrame:
    """Candidates with more outlier cells than a multiple of every mean; a null mean fails."""
    times = dict(zip(MEANS, (p.circle_multiplier, p.donut_multiplier, p.horizontal_multiplier, p.vertical_multiplier, p.lower_left_multiplier), strict=True))
    out = candidates
    for k, m in times.items():
        out = out.where(F.col("outlier_count") > F.col(k) * m)
    return out


def blacklist_anti_join(candidates: DataFrame, regions: DataFrame, p: Params) -> DataFrame:
    """Candidates neither of whose ends starts a region (chrom, start)."""
    starts = regions.select(F.col("chrom").alias("c"), F.col("start").alias("s")).distinct()
    out = candidates
    for end in ("i", "j"):
        out = out.join(starts, (F.col("chrom") == F.col("c")) & (F.col(end) * p.binsize == F.col("s")), "left_anti")
    return out


def find_candidates(significances: DataFrame, cells: DataFrame, p: Params, regions: DataFrame | None = None) -> DataFrame:
    significances = staged(significances, "significances")  # one row per place; read by the filter and by the neighbours
    found = enrichment_filter(neighbor_means(candidate_filter(significances, cells, p), significances, p), p)
    return found if regions is None else blacklist_anti_join(found, regions, p)
