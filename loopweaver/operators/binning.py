"""Binning: raw contacts to distinct pairs of bins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loopweaver.params import Params

AUTOSOMES = [f"chr{i}" for i in range(23)]


def in_range(contacts: DataFrame, p: Params, *more: str) -> DataFrame:
    """Contacts within one autosome, on it, and at least low_cutoff apart; positions in order, and further columns. Rows with
    a null position or chromosome are left out."""
    wanted = [c for c in AUTOSOMES if c in p.chrom_lengths] if p.chrom_lengths else AUTOSOMES
    d = contacts.where((F.col("chr1") == F.col("chr2")) & F.col("chr1").isin(wanted) & (F.abs(F.col("pos1") - F.col("pos2")) >= p.low_cutoff))
    if p.chrom_lengths:  # positions past a chromosome's end would widen its matrix for one cell only
        length = F.create_map(*(x for k, v in sorted(p.chrom_lengths.items()) for x in (F.lit(k), F.lit(v))))
        d = d.where(F.greatest("pos1", "pos2") < length[F.col("chr1")])
    return d.select("cell", F.col("chr1").alias("chrom"), F.least("pos1", "pos2").alias("a"), F.greatest("pos1", "pos2").alias("b"), *more)


def pair_bins(contacts: DataFrame, p: Params, *more: str) -> DataFrame:
    """cell, chrom, i, j of each contact at least two bins apart, repeats included, and further columns."""
    d = in_range(contacts, p, *more).select("cell", "chrom", F.expr(f"a div {p.binsize}").alias("i"), F.expr(f"b div {p.binsize}").alias("j"), *more)
    return d.where("j - i >= 2")


def bin_contacts(contacts: DataFrame, p: Params) -> DataFrame:
    """Distinct cell, chrom, i, j. Partial aggregation drops repeats before the shuffle."""
    return pair_bins(contacts, p).distinct()


def distance_histogram(binned: DataFrame) -> DataFrame:
    return binned.groupBy("cell", "chrom", (F.col("j") - F.col("i")).alias("d")).agg(F.count(F.lit(1)).alias("n"))


def bedpe(pairs: DataFrame, p: Params, *more: str) -> DataFrame:
    """Half-open coordinates of pairs of bins, with further columns."""
    b = p.binsize
    at = {"chr1": F.col("chrom"), "x1": F.col("i") * b, "x2": (F.col("i") + 1) * b, "chr2": F.col("chrom"), "y1": F.col("j") * b, "y2": (F.col("j") + 1) * b}
    return pairs.select(*(v.alias(k) for k, v in at.items()), *more)


def window_size_fractions(contacts: DataFrame, p: Params, limits: Sequence[int] = range(10_000_000, 100_000_001, 10_000_000)) -> DataFrame:
    """upto and share: pairs of bins nearer than each limit (in base pairs), in one aggregate. Shares of no pairs are null."""
    d = bin_contacts(contacts, p)
    far = (F.col("j") - F.col("i")) * p.binsize
    shares = d.agg(*(F.avg(F.when(far < m, 1.0).otherwise(0.0)).alias(str(m)) for m in limits))
    return shares.select(F.explode(F.array(*(F.struct(F.lit(m).cast("bigint").alias("upto"), F.col(str(m)).alias("share")) for m in limits))).alias("x")).select("x.*")


def window_bins(contacts: DataFrame, p: Params, share: float = 0.8) -> int:
    """Bins of the smallest window that holds over `share` of the pairs."""
    rows = sorted(window_size_fractions(contacts, p).collect())
    return next((r["upto"] for r in rows if (r["share"] or 0) > share), 100_000_000) // p.binsize
