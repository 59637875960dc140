"""Readers: raw contact lists, binned and normalised tables, chromosome sizes, filter regions, imputed matrices."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loopweaver.params import AUTOSOMES, Params
from loopweaver.sources.matrices import MatrixSource

BEDPE = "chr1 string, x1 bigint, x2 bigint, chr2 string, y1 bigint, y2 bigint"


def cell_name(path: F.Column, suffix: str = "", literal: bool = True) -> F.Column:
    """Name of a cell from its file's path: the base name without the suffix and the dots before it.

    literal=False takes the suffix as a pattern and removes every match, as older runs did.
    """
    base = F.element_at(F.split(path, "/"), -1)
    if literal:
        return F.regexp_replace(base, r"\.*" + re.escape(suffix) + "$", "") if suffix else base
    return F.regexp_replace(base, r"\.*" + suffix, "")


def raw_contacts(spark: SparkSession, p: Params) -> DataFrame:
    """cell, chr1, pos1, chr2, pos2 of every file of a folder whose name ends with the suffix; .gz is read by name."""
    width = max(*p.chr_columns, *p.pos_columns)
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(1, width + 1)])
    reader = spark.read.schema(schema).option("sep", "\t").option("header", False).option("mode", "PERMISSIVE").option("pathGlobFilter", f"*{p.suffix}")
    (c1, c2), (p1, p2) = p.chr_columns, p.pos_columns
    number = lambda c: F.expr(f"try_cast(c{c} as bigint)")
    return reader.csv(p.indir).select(
        cell_name(F.col("_metadata.file_path"), p.suffix).alias("cell"), F.col(f"c{c1}").alias("chr1"), number(p1).alias("pos1"), F.col(f"c{c2}").alias("chr2"), number(p2).alias("pos2")
    )


def chrom_sizes(spark: SparkSession, path: str) -> DataFrame:
    """chrom and length of a white-space separated file."""
    parts = F.split(F.trim("value"), r"\s+")
    return spark.read.text(path).where(F.trim("value") != "").select(parts[0].alias("chrom"), parts[1].cast("bigint").alias("length"))


def wanted_chroms(p: Params) -> list[str]:
    """Chromosomes to analyse: a list given by name, or chr1 to the largest number asked for or of the genome."""
    if p.chrom:
        return p.chrom.split()
    top = p.max_chrom_number
    if top < 1:
        top = next((n for g, n in AUTOSOMES.items() if p.genome.startswith(g)), 0)
        if not top:
            raise ValueError(f"the chromosomes of {p.genome} are not known; name them or give their largest number")
    return [f"chr{i}" for i in range(1, top + 1)]


def chrom_lengths(spark: SparkSession, p: Params) -> dict[str, int]:
    """Lengths of the wanted chromosomes; a few dozen rows."""
    rows = chrom_sizes(spark, p.chrom_sizes).where(F.col("chrom").isin(wanted_chroms(p))).collect()
    return {r["chrom"]: r["length"] for r in rows}


def filter_regions(spark: SparkSession, path: str) -> DataFrame:
    """chrom and start of each region; no rows where the file is empty."""
    parts = F.split("value", "\t")
    return spark.read.text(path).where(F.trim("value") != "").select(parts[0].alias("chrom"), F.expr("try_cast(split(value, '\t')[1] as bigint)").alias("start")).where("start is not null")


def binned_bedpe(spark: SparkSession, path: str, p: Params) -> DataFrame:
    """cell, chrom, i, j of binned contact files."""
    d = spark.read.schema(BEDPE).option("sep", "\t").csv(path)
    return d.where("chr1 = chr2").select(cell_name(F.col("_metadata.file_path"), ".bedpe").alias("cell"), F.col("chr1").alias("chrom"), F.expr(f"x1 div {p.binsize}").alias("i"), F.expr(f"y1 div {p.binsize}").alias("j"))


def normalised_bedpe(spark: SparkSession, path: str, p: Params) -> DataFrame:
    """cell, chrom, i, j, z of normalised files named <cell>.<chrom>.normalized.rwr.bedpe."""
    d = spark.read.schema(BEDPE + ", v double").option("sep", "\t").option("pathGlobFilter", "*.normalized.rwr.bedpe{,.gz}").csv(path)
    name = cell_name(F.regexp_replace("_metadata.file_path", r"\.gz$", ""), ".normalized.rwr.bedpe")
    return d.select(F.regexp_replace(name, r"\.[^.]+$", "").alias("cell"), F.col("chr1").alias("chrom"), F.expr(f"x1 div {p.binsize}").alias("i"), F.expr(f"y1 div {p.binsize}").alias("j"), F.col("v").alias("z"))


# Matrices that other tools imputed


def imputed_bedpe(spark: SparkSession, path: str, p: Params) -> DataFrame:
    """cell, chrom, i, j, v of upper-triangular files with a value."""
    d = spark.read.schema(BEDPE + ", v double").option("sep", "\t").csv(path)
    i, j = F.expr(f"x1 div {p.binsize}"), F.expr(f"y1 div {p.binsize}")
    return d.select(cell_name(F.col("_metadata.file_path"), ".bedpe").alias("cell"), F.col("chr1").alias("chrom"), F.least(i, j).alias("i"), F.greatest(i, j).alias("j"), "v")


def imputed_matrices(spark: SparkSession, path: str, kind: str, chrom: str | None = None, chroms: list[str] | None = None, stretch_bytes: int | None = None) -> DataFrame:
    """cell, chrom, i, j, v of matrices as files of other tools, each read by as many tasks as it has stretches. Files of other
    chromosomes than chroms are left out. See matrices."""
    spark.dataSource.register(MatrixSource)
    given = {"path": path, "kind": kind, "chrom": chrom, "chroms": " ".join(chroms) if chroms else None, "stretchBytes": stretch_bytes}
    options = {k: str(v) for k, v in given.items() if v is not None}
    return spark.read.format("imputed_matrix").options(**options).load()


def imputed_npz(spark: SparkSession, path: str, chrom: str | None = None, chroms: list[str] | None = None) -> DataFrame:
    """cell, chrom, i, j, v of dense square matrices, one file per cell; values other than zero above the diagonal."""
    return imputed_matrices(spark, path, "npz", chrom, chroms)


def imputed_hdf5(spark: SparkSession, path: str, chrom: str | None = None) -> DataFrame:
    """cell, chrom, i, j, v of files with `coordinates` (n, 2) and one `cell_<k>` (n) per cell. Needs h5py."""
    return imputed_matrices(spark, path, "hdf5", chrom)


def matrix_size(pairs: DataFrame) -> DataFrame:
    """chrom and number of bins that its pairs reach."""
    return pairs.groupBy("chrom").agg((F.max("j") + 1).alias("bins"))
