"""Trimmed z-scores along each distance."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loopweaver.operators import jobs
from loopweaver.params import Params

TRIM = 0.01
LEAST_SD = 1e-6


def diag_zscore(v: DataFrame) -> DataFrame:
    """cell, chrom, i, j, z from v: per cell, chromosome and distance, the mean and population deviation leave out the
    largest values (rounded half to even, less one); z is 0 where the deviation is tiny."""
    d = v.withColumn("d", F.col("j") - F.col("i"))
    part = Window.partitionBy("cell", "chrom", "d")
    ranked = d.select("cell", "chrom", "i", "j", "d", "v", F.row_number().over(part.orderBy(F.desc("v"))).alias("rn"), F.count(F.lit(1)).over(part).alias("n"))
    k = F.rint(F.lit(TRIM) * F.col("n"))
    kept = F.when(k >= 1, F.col("rn") >= k).otherwise(F.col("rn") == F.col("n"))
    stats = ranked.withColumn("x", F.when(kept, F.col("v")))
    stats = stats.select("cell", "chrom", "i", "j", "v", F.avg("x").over(part).alias("mu"), F.stddev_pop("x").over(part).alias("sd"))
    return stats.select("cell", "chrom", "i", "j", F.when(F.col("sd") < LEAST_SD, 0.0).otherwise((F.col("v") - F.col("mu")) / F.nullif(F.col("sd"), F.lit(0.0))).alias("z"))


def diag_zscore_by_value(v: DataFrame) -> DataFrame:
    """The variant that leaves out by value instead of rank: what exceeds the value at the last rank that diag_zscore() leaves
    out, or the smallest value where it leaves out none; so all of equal values stay, or none. z is 0 where the deviation is
    tiny."""
    d = v.withColumn("d", F.col("j") - F.col("i"))
    part = Window.partitionBy("cell", "chrom", "d")
    ranked = d.select("cell", "chrom", "i", "j", "d", "v", F.row_number().over(part.orderBy(F.desc("v"))).alias("rn"), F.count(F.lit(1)).over(part).alias("n"))
    k = F.rint(F.lit(TRIM) * F.col("n"))
    limit = F.max(F.when(F.col("rn") == F.when(k >= 1, k).otherwise(F.col("n")), F.col("v"))).over(part)
    x = ranked.withColumn("limit", limit).withColumn("x", F.when(F.col("v") <= F.col("limit"), F.col("v")))
    x = x.select("cell", "chrom", "i", "j", "v", F.avg("x").over(part).alias("mu"), F.stddev_pop("x").over(part).alias("sd"))
    return x.select("cell", "chrom", "i", "j", F.when(F.col("sd") < LEAST_SD, 0.0).otherwise((F.col("v") - F.col("mu")) / F.nullif(F.col("sd"), F.lit(0.0))).alias("z"))


def diag_zscore_of_values(values: DataFrame, p: Params, by_value: bool = False) -> DataFrame:
    """diag_zscore() or diag_zscore_by_value() of on_grid(values, p), from the values alone: rows of the band are made last and
    never shuffled or sorted. The places of a distance without a value are zeros, which rank between the values of either sign;
    their number is known."""
    part = Window.partitionBy("cell", "chrom", "d")
    d = _with_starts(values, p)
    # Starts hold no value and sort last.
    d = d.withColumns({"rn": F.row_number().over(part.orderBy(F.desc_nulls_last("v"))), "zeros": F.col("n") - F.count("v").over(part), "above": F.count_if(F.col("v") >= 0).over(part)})
    d = d.withColumn("rn", F.when(F.col("v") < 0, F.col("rn") + F.col("zeros")).otherwise(F.col("rn")))
    k = F.rint(F.lit(TRIM) * F.col("n"))
    last = F.when(k >= 1, k).otherwise(F.col("n"))  # the first rank that stays
    if by_value:
        limit = F.max(F.when(F.col("rn") == last, F.col("v"))).over(part)
        d = d.withColumn("limit", F.coalesce(limit, F.lit(0.0)))
        kept, zeros = F.col("v") <= F.col("limit"), F.when(F.col("limit") >= 0, F.col("zeros")).otherwise(0)
    else:
        kept, zeros = F.col("rn") >= last, F.col("zeros") - F.greatest(F.lit(0), F.least(F.col("zeros"), last - 1 - F.col("above")))
    d = d.withColumns({"x": F.when(kept, F.col("v")), "zeros": zeros.cast("double")})
    d = d.withColumns({"m": F.count("x").over(part).cast("double"), "mean": F.coalesce(F.avg("x").over(part), F.lit(0.0)), "var": F.coalesce(F.var_pop("x").over(part), F.lit(0.0)), "sum": F.coalesce(F.sum("x").over(part), F.lit(0.0))})
    total = F.col("m") + F.col("zeros")
    d = d.withColumns({"mu": F.col("sum") / total, "sd": F.sqrt((F.col("var") + F.col("mean") * F.col("mean") * F.col("zeros") / total) * F.col("m") / total)})
    z = lambda v: F.when(F.col("sd") < LEAST_SD, 0.0).otherwise((v - F.col("mu")) / F.nullif(F.col("sd"), F.lit(0.0)))
    return _filled(d.select("cell", "chrom", "d", "i", "end", "v", z(F.col("v")).alias("here"), z(F.lit(0.0)).alias("there")), "z")


def zscore_rows(values: np.ndarray) -> np.ndarray:
    """z of one distance's values; the same rule for the fused kernel."""
    n = len(values)
    k = int(np.rint(TRIM * n))
    rest = np.sort(values)[::-1]
    rest = rest[k - 1 :] if k >= 1 else rest[-1:]
    sd = rest.std()
    return np.zeros(n) if sd < LEAST_SD else (values - rest.mean()) / sd


class Diagonals:
    """z of bands whose values lie at the distances d, all distances at once."""

    def __init__(self, d: np.ndarray):
        order = np.argsort(d, kind="stable")
        first = np.flatnonzero(np.r_[True, np.diff(d[order]) != 0]) if len(d) else np.zeros(0, np.int64)
        self.n = np.diff(np.r_[first, len(d)]).astype(np.int64)
        width = int(self.n.max()) if len(d) else 0
        row = np.empty(len(d), np.int64)
        row[order] = np.repeat(np.arange(len(first)), self.n)
        # A distance's values end its row, and what is before them sorts before them.
        place = np.empty(len(d), np.int64)
        place[order] = np.arange(len(d)) - np.repeat(first, self.n) + np.repeat(width - self.n, self.n)
        self.row, self.at, self.shape = row, row * width + place, (len(first), width)
        k = np.rint(TRIM * self.n).astype(np.int64)
        self.out = np.where(k >= 1, k - 1, self.n - 1)
        column = np.arange(width)[None, :]
        self.gone = (column < (width - self.n)[:, None]) | (column >= (width - self.out)[:, None])
        # Stretches of distances that leave out values, or none.
        self.cuts = np.flatnonzero(np.r_[True, np.diff(self.out > 0), True]).tolist() if len(self.out) else []

    def zscore(self, v: np.ndarray) -> np.ndarray:
        if not len(v):
            return np.zeros(0)
        x = np.full(self.shape, -np.inf)
        x.ravel()[self.at] = v
        for s, t in zip(self.cuts[:-1], self.cuts[1:], strict=True):
            if self.out[s]:
                x[s:t].sort(axis=1)  # what is left out ends the row
        np.copyto(x, 0.0, where=self.gone)
        count = self.n - self.out
        mu = x.sum(1) / count
        x -= mu[:, None]
        np.copyto(x, 0.0, where=self.gone)
        sd = np.sqrt(np.einsum("ij,ij->i", x, x) / count)
        flat = sd < LEAST_SD
        scale = np.where(flat, 0.0, 1 / np.where(flat, 1.0, sd))
        z = v - mu[self.row]
        z *= scale[self.row]
        return z


def zscore_band(v: np.ndarray, d: np.ndarray) -> np.ndarray:
    """z of a band of values at distances d."""
    return Diagonals(d).zscore(v)


def grid(p: Params, spark) -> DataFrame:
    """chrom, i, j of the band that is imputed in every cell."""
    sizes = spark.createDataFrame([(c, p.bins(c)) for c in sorted(p.chrom_lengths)], "chrom string, n int")
    m = p.margin
    rows = sizes.where(f"n > {2 * m}").select("chrom", "n", F.explode(F.sequence(F.lit(m), F.col("n") - 1 - m)).alias("i"))
    rows = rows.where(f"i + 1 < n - {m}")
    j = F.explode(F.sequence(F.col("i") + 1, F.least(F.col("i") + p.max_rwr_bins, F.col("n") - 1 - m)))
    return rows.select("chrom", F.col("i").cast("bigint").alias("i"), j.alias("j")).select("chrom", "i", F.col("j").cast("bigint").alias("j"))


def _with_starts(values: DataFrame, p: Params) -> DataFrame:
    """cell, chrom, d, i, v, n, end: the band's values, nulls as 0, and for every cell's chromosome and distance a row without
    a value before its first place; n places, of which the last comes before end. One shuffle, of the values."""
    m = p.margin
    sizes = F.create_map(*(x for c in sorted(p.chrom_lengths) for x in (F.lit(c), F.lit(p.bins(c)))))
    placed = jobs.together(values.select("cell", "chrom", "i", "j", F.coalesce("v", F.lit(0.0)).alias("v"))).withColumn("size", sizes[F.col("chrom")]).where("size is not null")
    first = F.row_number().over(Window.partitionBy("cell", "chrom").orderBy("i", "j")) == 1
    placed = placed.withColumn("first", first).withColumn("d", F.col("j") - F.col("i"))
    own = F.array(F.struct("d", "i", "v"))
    start = lambda d: F.struct(d.cast("bigint").alias("d"), F.lit(m - 1).cast("bigint").alias("i"), F.lit(None).cast("double").alias("v"))
    rows = placed.select("cell", "chrom", "size", F.explode(F.when(F.col("first"), F.concat(own, F.transform(F.sequence(F.lit(1), F.lit(p.max_rwr_bins)), start))).otherwise(own)).alias("r")).select("cell", "chrom", "size", "r.*")
    rows = rows.withColumn("end", F.col("size") - m - F.col("d")).withColumn("n", F.col("end") - m)
    inside = F.col("d").between(1, p.max_rwr_bins) & (F.col("n") > 0) & (F.col("i") < F.col("end"))
    return rows.where(inside & (F.col("v").isNull() | (F.col("i") >= m))).drop("size")


def _filled(rows: DataFrame, name: str) -> DataFrame:
    """cell, chrom, i, j and a value of every place: each row with a v gives `here` at its own place, and every row `there` at
    those up to the next row of its distance."""
    following = F.lead("i").over(Window.partitionBy("cell", "chrom", "d").orderBy("i"))
    rows = rows.withColumn("next", F.coalesce(following, "end")).withColumn("from", F.when(F.col("v").isNull(), F.col("i") + 1).otherwise(F.col("i")))
    to = F.when(F.col("v").isNull(), F.col("next")).otherwise(F.greatest("next", F.col("i") + 1)) - 1
    rows = rows.withColumn("to", to).where(F.col("from") <= F.col("to"))
    made = rows.select("cell", "chrom", "d", "here", "there", F.when(F.col("v").isNotNull(), F.col("i")).alias("own"), F.explode(F.sequence("from", "to")).alias("i"))
    return made.select("cell", "chrom", "i", (F.col("i") + F.col("d")).alias("j"), F.when(F.col("i") == F.col("own"), F.col("here")).otherwise(F.col("there")).alias(name))


def on_grid(values: DataFrame, p: Params) -> DataFrame:
    """cell, chrom, i, j, v over the whole band, 0 where there is no value; only the values are shuffled."""
    rows = _with_starts(values, p)
    return _filled(rows.select("cell", "chrom", "d", "i", "end", "v", F.col("v").alias("here"), F.lit(0.0).alias("there")), "v")
