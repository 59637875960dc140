"""Paired t-tests over cells and false discovery rates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loopweaver.functions.student import p_value_udf
from loopweaver.operators import scan
from loopweaver.params import Params
from loopweaver.staging import staged

NO_T = -1000.0
#: Pairs of a chromosome from which its rates are taken by ranges instead of one window.
RANGED_PAIRS = 2_000_000
HUGE = 1.7976931348623157e308


def pair_sums(nb: DataFrame, outlier: float = 1.96) -> DataFrame:
    """Per chrom, i, j over cells: n, case_avg, control_avg, mean and deviation of the difference, outliers.

    One partial aggregate gives everything that later steps need from the cells.
    """
    delta = F.col("z") - F.col("nb")
    return nb.groupBy("chrom", "i", "j").agg(
        F.count(delta).alias("n"), F.avg("z").alias("case_avg"), F.avg("nb").alias("control_avg"), F.avg(delta).alias("mean"), F.stddev_samp(delta).alias("sd"), F.count_if(F.col("z") > outlier).alias("outlier_count")
    )


def paired_t(sums: DataFrame) -> DataFrame:
    """Adds tstat: NO_T where it is undefined or exactly 0, the largest double where only the deviation is 0.
    A mean that is exactly 0 is null."""
    t = F.col("mean") / F.nullif(F.col("sd"), F.lit(0.0)) * F.sqrt(F.col("n"))
    flat = F.when(F.col("mean") > 0, HUGE).when(F.col("mean") < 0, -HUGE).otherwise(NO_T)
    value = F.when((F.col("n") < 2) | F.col("sd").isNull() | F.isnan("sd"), NO_T).when(F.col("sd") == 0, flat).when(t == 0, NO_T).otherwise(t)
    return sums.withColumn("tstat", value).withColumn("case_avg", F.nullif("case_avg", F.lit(0.0))).withColumn("control_avg", F.nullif("control_avg", F.lit(0.0)))


def p_values(tested: DataFrame) -> DataFrame:
    """Adds pvalue, the two-sided tail of Student's t with n - 1 degrees of freedom; 1 where t is undefined."""
    p = F.when(F.col("tstat") == NO_T, 1.0).when(F.abs("tstat") >= HUGE, 0.0).otherwise(p_value_udf()(F.col("tstat"), (F.col("n") - 1).cast("double")))
    return tested.withColumn("pvalue", p)


def bh_fdr(tested: DataFrame, by: list[str], name: str) -> DataFrame:
    """Adds the Benjamini-Hochberg rate of pvalue within each group of `by`."""
    part = Window.partitionBy(*by)
    raw = F.col("pvalue") * F.count(F.lit(1)).over(part) / F.row_number().over(part.orderBy("pvalue", "i", "j"))
    ranked = tested.withColumn("_raw", raw).withColumn("_r", F.row_number().over(part.orderBy("pvalue", "i", "j")))
    down = part.orderBy(F.desc("_r")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return ranked.withColumn(name, F.least(F.lit(1.0), F.min("_raw").over(down))).drop("_raw", "_r")


def bh_fdr_ranged(tested: DataFrame, by: list[str], name: str, ranges: int | None = None) -> DataFrame:
    """bh_fdr() of groups of any size: ranks by ranges of p-values, and the running minimum carried from range to range."""
    rows = scan.ranked(tested, by, [F.col("pvalue"), F.col("i"), F.col("j")], "_r", ranges)
    rows = staged(rows.withColumn("_raw", F.col("pvalue") * F.col("_of") / F.col("_r")), "raw")
    least = scan.least_from_here(rows, by, "_raw", "_r", name)
    return least.withColumn(name, F.least(F.lit(1.0), F.col(name))).select(*tested.columns, name)


def universe(p: Params, spark) -> DataFrame:
    """chrom, i, j of every pair that is tested: local_upper_limit off the ends, up to max_bins apart."""
    u = p.local_upper_limit
    tops = spark.createDataFrame([(c, p.chrom_lengths[c] // p.binsize) for c in sorted(p.chrom_lengths)], "chrom string, top int").where(f"top - {u} > {u}")
    rows = tops.select("chrom", "top", F.explode(F.sequence(F.lit(u), F.col("top") - u - 1)).alias("i"))
    pairs = rows.select("chrom", "i", F.explode(F.sequence(F.col("i") + 1, F.least(F.col("i") + p.max_bins, F.col("top") - u))).alias("j"))
    return pairs.select("chrom", F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j"))


def significances(sums: DataFrame, p: Params) -> DataFrame:
    """chrom, i, j, outlier_count, case_avg, control_avg, pvalue, tstat, fdr_dist, fdr_chrom.

    The rates count every pair of the universe, with p = 1 where no cell was imputed; only imputed pairs are returned.
    """
    tested = p_values(paired_t(sums))
    d = F.col("j") - F.col("i")
    full = universe(p, sums.sparkSession).join(tested, ["chrom", "i", "j"], "left").withColumn("pvalue", F.coalesce("pvalue", F.lit(1.0))).withColumn("d", d)
    near = bh_fdr(full, ["chrom", "d"], "fdr_dist")  # a group has a pair for each bin at most
    largest = max((p.chrom_lengths[c] // p.binsize * p.max_bins for c in p.chrom_lengths), default=0)
    rated = (bh_fdr_ranged if largest > RANGED_PAIRS else bh_fdr)(near, ["chrom"], "fdr_chrom")
    return rated.where("n is not null").select("chrom", "i", "j", "outlier_count", "case_avg", "control_avg", "pvalue", "tstat", "fdr_dist", "fdr_chrom")
