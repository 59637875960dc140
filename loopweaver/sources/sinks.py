"""Writers. Tables are Parquet partitioned by chromosome; text forms are written for other tools."""

from __future__ import annotations

import subprocess
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loopweaver.operators.binning import bedpe
from loopweaver.params import Params

PLACE = ["chr1", "x1", "y1"]
COORDINATES = ["chr1", "x1", "x2", "chr2", "y1", "y2"]
SIGNIFICANCES = [*COORDINATES, "outlier_count", "case_avg", "control_avg", "pvalue", "tstat", "fdr_dist", "fdr_chrom"]
MEANS = ["circle", "donut", "horizontal", "vertical", "lower_left"]
CANDIDATES = [*COORDINATES, "outlier_count", "pvalue", "tstat", "fdr_chrom", "fdr_dist", "case_avg", "control_avg", *MEANS]
ALL_CANDIDATES = [*COORDINATES, "outlier_count", "pvalue", "tstat", "fdr_dist", "case_avg", "control_avg", *MEANS, "eta_cluster", "cluster_size", "neg_log10_fdr"]
SUMMITS = ALL_CANDIDATES[:-3]


def parquet(df: DataFrame, path: str, *by: str) -> None:
    """Overwrites only the partitions that df has rows of, so that a run can be taken up again."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def tsv(df: DataFrame, path: str, header: bool = True) -> None:
    """Tab-separated rows in one file, of tables that are small; see sorted_tsv() for others."""
    df.coalesce(1).write.mode("overwrite").option("sep", "\t").option("header", header).option("compression", "none").csv(path)


def _concatenated(spark: SparkSession, fs, target, head: bytearray, ranges: list) -> bool:
    """Whether the file system joined the parts behind the head by moving their blocks, as HDFS can."""
    if not head or not fs.hasPathCapability(target, "fs.capability.paths.concat"):
        return False
    out = fs.create(target)
    out.write(head)
    out.close()
    sources = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(ranges))
    for k, (_, p) in enumerate(ranges):
        sources[k] = p
    fs.concat(target, sources)
    return True


def sorted_tsv(df: DataFrame, order: list[str], path: str, header: bool = True) -> None:
    """Tab-separated rows in one file of the folder, sorted. Tasks write ranges of the order, which are then joined: by the
    file system where it can, else by a copy through a buffer, without holding more of them than that."""
    spark = df.sparkSession
    java = spark._jvm.org.apache.hadoop.fs.Path
    parts, target = f"{path}_parts", java(path, "part-00000.csv")
    df.orderBy(*order).write.mode("overwrite").option("sep", "\t").option("header", False).option("compression", "none").csv(parts)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(java(path), True)
    ranges = sorted((f.getPath().getName(), f.getPath()) for f in fs.listStatus(java(parts)) if f.getPath().getName().startswith("part-") and f.getLen())
    head = bytearray(("\t".join(df.columns) + "\n").encode() if header else b"")
    if len(ranges) < 2 or not _concatenated(spark, fs, target, head, ranges):
        out = fs.create(target)
        try:
            out.write(head)
            for _, p in ranges:
                source = fs.open(p)
                spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 4 << 20, False)
                source.close()
        finally:
            out.close()
    fs.delete(java(parts), True)


def _one_file_each(df: DataFrame, path: str, by: list[str], order: list[str], name: Callable[..., str], compression: str = "none") -> None:
    """A headerless file per value of `by`, named by it. Rows of one file are sorted in one task; the driver only renames."""
    df.repartition(*by).sortWithinPartitions(*by, *order).write.mode("overwrite").partitionBy(*by).option("sep", "\t").option("compression", compression).csv(path)
    spark = df.sparkSession
    java = spark._jvm.org.apache.hadoop.fs.Path
    fs = java(path).getFileSystem(spark._jsc.hadoopConfiguration())
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    folders = [(java(path), ())]
    for column in by:
        folders = [(f.getPath(), (*values, unescape(f.getPath().getName()[len(column) + 1 :]))) for at, values in folders for f in fs.listStatus(at) if f.getPath().getName().startswith(column + "=")]
    for at, values in folders:
        for f in fs.listStatus(at):
            if f.getPath().getName().startswith("part-"):
                fs.rename(f.getPath(), java(path, name(*values) + (".gz" if compression == "gzip" else "")))
    for f in fs.listStatus(java(path)):
        if f.isDirectory():
            fs.delete(f.getPath(), True)


def binned(pairs: DataFrame, path: str, p: Params) -> None:
    """<cell>.bedpe for each cell, sorted by place."""
    _one_file_each(bedpe(pairs, p, "cell"), path, ["cell"], ["chr1", "x1", "y1"], lambda cell: f"{cell}.bedpe")


def normalised(z: DataFrame, path: str, p: Params) -> None:
    """<cell>.<chrom>.normalized.rwr.bedpe for each cell and chromosome, sorted by place; compressed if p.compress_rwr."""
    rows = bedpe(z, p, "cell", "z").withColumn("chrom", F.col("chr1"))
    _one_file_each(rows, path, ["cell", "chrom"], ["x1", "y1"], lambda cell, chrom: f"{cell}.{chrom}.normalized.rwr.bedpe", "gzip" if p.compress_rwr else "none")


def combined(outliers: DataFrame, path: str, p: Params) -> None:
    sorted_tsv(bedpe(outliers, p, "outliers"), PLACE, path, header=False)


def significances(s: DataFrame, path: str, p: Params) -> None:
    sorted_tsv(bedpe(s, p, *SIGNIFICANCES[6:]), PLACE, path)


def candidates(c: DataFrame, path: str, p: Params) -> None:
    sorted_tsv(bedpe(c, p, *CANDIDATES[6:]), PLACE, path)


def clustered(c: DataFrame, path: str, p: Params) -> None:
    sorted_tsv(bedpe(c, p, *ALL_CANDIDATES[6:], "summit"), PLACE, path)


def heat_maps(spark: SparkSession, text: str, p: Params, log: Callable[[str], None]) -> None:
    """Have external tools make .hic and .cool files of the heat-map text, where they are given and not declined."""
    local = text.removeprefix("file://")
    parts = sorted(Path(local).glob("part-*")) if "://" not in local else []
    name = f"{p.prefix}.allChr" if p.prefix else "allChr"
    wanted = [
        ("hic", p.no_hic, p.hic_jar, lambda part, out: ["java", "-jar", p.hic_jar, "pre", part, out, p.genome]),
        ("cool", p.no_cool, p.cool_tool, lambda part, out: [p.cool_tool, "cload", "pairs", "--zero-based", "--assembly", p.genome, "-c1", "2", "-p1", "3", "-c2", "6", "-p2", "7", "--field", "count=9", f"{p.chrom_sizes}:{p.binsize}", part, out]),
    ]
    for kind, declined, tool, command in wanted:
        if declined:
            continue
        if not tool:
            log(f"hic: no .{kind} file, as no tool for it was given; {text} is its input")
        elif len(parts) != 1:
            log(f"hic: no .{kind} file, as its tool needs one local file; {text} is its input")
        else:
            subprocess.run(command(str(parts[0]), str(Path(local).parent / f"{name}.{kind}")), check=True)
            log(f"hic: wrote {name}.{kind}")


def loops(clustered: DataFrame, path: str, p: Params) -> None:
    """<prefix>.postprocessed.all_candidates.bedpe and .summits.bedpe, with headers even where there are no rows."""
    sorted_tsv(bedpe(clustered, p, *ALL_CANDIDATES[6:]), PLACE, f"{path}/{p.prefix}.postprocessed.all_candidates.bedpe")
    sorted_tsv(bedpe(clustered.where("summit = 1 AND cluster_size > 1"), p, *SUMMITS[6:]), PLACE, f"{path}/{p.prefix}.postprocessed.summits.bedpe")
