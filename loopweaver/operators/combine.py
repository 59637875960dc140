"""Cells combined: outlier counts, scores and the table that heat-map tools read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loopweaver.params import Params


def outlier_count(z: DataFrame, threshold: float = 1.96) -> DataFrame:
    """chrom, i, j, outliers: cells whose z is over the threshold."""
    return z.groupBy("chrom", "i", "j").agg(F.count_if(F.col("z") > threshold).alias("outliers"))


def cell_counts(z: DataFrame) -> DataFrame:
    """chrom and the number of its cells."""
    return z.select("chrom", "cell").distinct().groupBy("chrom").agg(F.count(F.lit(1)).alias("cells"))


def hic_score(outliers: DataFrame, cells: DataFrame) -> DataFrame:
    """chrom, i, j, score: percentage of outlier cells, rounded up. cells has a row per chromosome."""
    joined = outliers.join(cells, "chrom")
    return joined.select("chrom", "i", "j", F.ceil(F.col("outliers") / F.col("cells") * 100).alias("score"))


def _short(scores: DataFrame, p: Params) -> DataFrame:
    b = p.binsize
    cols = [("str1", F.lit(0)), ("chr1", F.col("chrom")), ("x1", F.col("i") * b), ("frag1", F.lit(0)), ("str2", F.lit(1)), ("chr2", F.col("chrom")), ("y1", F.col("j") * b), ("frag2", F.lit(1)), ("score", F.col("score"))]
    return scores.select(*(c.alias(n) for n, c in cols))


def hic_input(scores: DataFrame, p: Params, positive: bool = True) -> DataFrame:
    """Nine columns of the short text format; scores of 0 are left out unless positive=False."""
    return _short(scores.where("score > 0") if positive else scores, p)


def hic_input_from_fdr(significances: DataFrame, p: Params) -> DataFrame:
    """The same from -log10 of the distance-wise FDR, rounded half to even, zeros kept."""
    return _short(significances.select("chrom", "i", "j", F.rint(-F.log10(F.col("fdr_dist") + 1e-6)).cast("bigint").alias("score")), p)
