"""Command line.

python -m loopweaver -i cells/ -o out/ -l hg19.chrom.sizes -g hg19 ...      the analysis
python -m loopweaver validate -i cells/ -o out/ -l hg19.chrom.sizes ...     cells and chromosomes that rwr left incomplete
python -m loopweaver normalise -t npz -i matrices/ -o out/ --chrom chr1     z-scores of matrices imputed elsewhere
"""

from __future__ import annotations

import argparse
import sys

from loopweaver.params import Params


def parser() -> argparse.ArgumentParser:
    d = Params()
    a = argparse.ArgumentParser(prog="loopweaver", description="Chromatin loops from single-cell contact lists.")
    add = a.add_argument
    add("-i", "--indir", required=True)
    add("-o", "--outdir", required=True)
    add("-l", "--chr-lens", dest="chrom_sizes", required=True)
    add("-s", "--suffix", default=d.suffix)
    add("-c", "--chr-columns", nargs=2, type=int, default=list(d.chr_columns))
    add("-p", "--pos-columns", nargs=2, type=int, default=list(d.pos_columns))
    add("-g", "--genome", default=d.genome)
    add("--chrom", default=None)
    add("--max-chrom-number", type=int, default=-1)
    number = lambda x: int(float(x))
    for flag, name in (("--dist", "dist"), ("--binsize", "binsize"), ("--low-cutoff", "low_cutoff"), ("--candidate-lower-distance", "candidate_lower_distance"), ("--candidate-upper-distance", "candidate_upper_distance"), ("--summit-gap", "summit_gap")):
        add(flag, dest=name, type=number, default=getattr(d, name))
    for flag, name in (("--alpha", "alpha"), ("--outlier", "outlier"), ("--tstat-threshold", "tstat_threshold"), ("--fdr-threshold", "fdr_threshold"), ("--outlier-threshold-multiplier", "outlier_threshold_multiplier")):
        add(flag, dest=name, type=float, default=getattr(d, name))
    for kind in ("circle", "donut", "lower-left", "horizontal", "vertical"):
        name = kind.replace("-", "_") + "_multiplier"
        add(f"--{kind}-threshold-multiplier", dest=name, type=float, default=getattr(d, name))
    for flag, name in (("--local-lower-limit", "local_lower_limit"), ("--local-upper-limit", "local_upper_limit"), ("--postproc-gap-large", "gap_large"), ("--postproc-gap-small", "gap_small"), ("--clustering-gap", "clustering_gap"), ("--blin-partitions", "blin_partitions"), ("--nblin-rank", "nblin_rank"), ("--max-iter", "max_iter"), ("--window-bins", "window_bins")):
        add(flag, dest=name, type=int, default=getattr(d, name))
    add("--rwr-method", default=d.rwr_method)
    add("--blin-contiguous", action="store_true", help="stretches of bins as blocks instead of parts of the graph")
    add("--keep-rwr-matrix", action="store_true")
    add("--filter-file", default=None)
    add("--steps", nargs="+", default=list(d.steps))
    add("--prefix", default=d.prefix)
    add("--compress-rwr", action="store_true", help="write the normalised text files compressed")
    add("--no-text", dest="text", action="store_false", help="no text files of binned, normalised and candidate pairs")
    add("--no-hic", action="store_true")
    add("--no-cool", action="store_true")
    add("--hic-jar", default=None, help="path of the jar whose `pre` command makes .hic files")
    add("--cool-tool", default=None, help="path of the tool whose `cload pairs` command makes .cool files")
    add("--verbose", type=int, default=d.verbose, help="level of the lines that the log keeps")
    for flag in ("--parallel", "--threaded"):
        add(flag, action="store_true", help="accepted; Spark decides how work is spread")
    for flag in ("-n", "--num-proc"), ("--max-memory",):
        add(*flag, default=None, help="accepted; see Spark's own settings")
    return a


def params(argv: list[str] | None = None) -> Params:
    a = vars(parser().parse_args(argv))
    a["steps"] = tuple(x for s in a["steps"] for x in s.split())
    a["chr_columns"], a["pos_columns"] = tuple(a["chr_columns"]), tuple(a["pos_columns"])
    return Params(**{k: v for k, v in a.items() if k in Params.__dataclass_fields__})


def _normalise(spark, argv: list[str]) -> None:
    from loopweaver.plans.analysis import normalise
    from loopweaver.sources import contacts

    d = Params()
    a = argparse.ArgumentParser(prog="loopweaver normalise", description="z-scores of matrices imputed elsewhere.")
    a.add_argument("-t", "--filetype", required=True, choices=["npz", "hdf5", "bedpe"])
    a.add_argument("-i", "--infile", required=True)
    a.add_argument("-o", "--outdir", required=True)
    a.add_argument("--chrom", help="needed for npz and hdf5, which do not name it")
    a.add_argument("--binsize", type=lambda x: int(float(x)), default=d.binsize)
    a.add_argument("--dist", type=lambda x: int(float(x)), default=d.dist)
    a.add_argument("--compress-rwr", action="store_true")
    x = a.parse_args(argv)
    p = Params(binsize=x.binsize, dist=x.dist, compress_rwr=x.compress_rwr)
    if x.filetype != "bedpe" and not x.chrom:
        a.error("--chrom is needed for this file type")
    read = {"npz": lambda: contacts.imputed_npz(spark, x.infile, x.chrom), "hdf5": lambda: contacts.imputed_hdf5(spark, x.infile, x.chrom), "bedpe": lambda: contacts.imputed_bedpe(spark, x.infile, p)}
    normalise(read[x.filetype](), x.outdir, p)


def _validate(spark, p: Params) -> int:
    from dataclasses import replace

    from loopweaver.plans.analysis import BINNED, validate
    from loopweaver.sources import contacts, sinks
    from loopweaver.sources.store import ScoreStore, exists

    p = p if p.chrom_lengths else replace(p, chrom_lengths=contacts.chrom_lengths(spark, p))
    missing = f"{p.outdir}/missing"
    binned = f"{p.outdir}/binned"
    wanted = spark.read.schema(BINNED).parquet(binned) if exists(spark, binned) else None
    sinks.tsv(validate(ScoreStore(spark, f"{p.outdir}/rwr"), p, wanted, recount=True).orderBy("cell", "chrom"), missing)
    n = spark.read.option("sep", "\t").option("header", True).csv(missing).count()
    print(f"{n} cells and chromosomes are incomplete; see {missing}")
    return n


def main(argv: list[str] | None = None, spark=None) -> int:
    from pyspark.sql import SparkSession

    from loopweaver.deploy import ship
    from loopweaver.plans.analysis import run

    argv = sys.argv[1:] if argv is None else argv
    command = argv[0] if argv and argv[0] in ("validate", "normalise") else None
    p = None if command == "normalise" else params(argv[1:] if command else argv)
    spark = spark or SparkSession.builder.appName("loopweaver").getOrCreate()
    ship(spark)
    if command == "normalise":
        _normalise(spark, argv[1:])
    elif command == "validate":
        return 1 if _validate(spark, p) else 0
    else:
        run(spark, p)
    return 0


if __name__ == "__main__":
    sys.exit(main())
