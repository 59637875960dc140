"""The whole analysis: contacts to loops, in memory-bounded groups and two kinds of shuffle.

Contacts are shuffled once by chromosome and bucket of cells, small as they are; imputation, z-scores and local background of a group
happen in its task, cells of a chromosome after each other, and what tests need of them is folded into arrays over the band
there. Everything after that has one row per place.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from loopweaver.operators import binning, candidates, cluster, combine, graph, jobs, moments, normalize, runs, stats
from loopweaver.operators.background import Surroundings
from loopweaver.params import Params
from loopweaver.runlog import RunLog
from loopweaver.sources import contacts as sources
from loopweaver.sources import sinks
from loopweaver.sources.store import MomentStore, ScoreStore, bucket, exists
from loopweaver.staging import staged, unstage

BINNED = "cell string, i bigint, j bigint, chrom string"


class Scorer:
    """Places, z and local background of one cell's band, for cells after each other; what follows from the places alone is kept
    for the next cell. Without background it is NaN."""

    def __init__(self, p: Params, background: bool = True):
        self.p, self.of, self.background = p, {}, background

    def __call__(self, chrom: str, i: np.ndarray, j: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, ...]:
        known = self.of.get(chrom)
        if known is None or known[0] is not i and not (np.array_equal(known[0], i) and np.array_equal(known[1], j)):
            near = Surroundings(i, j, self.p.chrom_lengths[chrom] // self.p.binsize, self.p) if self.background else None
            known = self.of[chrom] = i, j, normalize.Diagonals(j - i), near, np.full(len(i), np.nan)
        z = known[2].zscore(v)
        return i, j, z, known[3].means(z) if self.background else known[4]


def _streamed(rows: DataFrame, p: Params, band: Callable, costs: DataFrame | None, folded: bool, background: bool = True, by_runs: bool = False) -> DataFrame:
    """cell, chrom, i, j, z, nb, by_runs as arrays, or folded their packed moments. band(chrom, further columns) gives places and
    values of one cell; a task holds one cell at a time, and gets those of one bucket and chromosome after each other. Without
    background there is no nb, and the moments have outliers and numbers of cells alone."""
    kind = rows.schema["cell"].dataType
    names = ["z", "nb"] if background else ["z"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scored, known = Scorer(p, background), (None, None, None)
        for cell, chrom, columns in jobs.by_cell(batches):
            i, j, *values = scored(chrom, *band(chrom, *columns))
            if known[0] is not i or known[1] is not j:
                known = i, j, runs.Runs(i, j)
            yield from known[2].rows(cell, chrom, kind, **dict(zip(names, values)))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, scored = moments.Held(p.max_rwr_bins + 1, p.outlier), Scorer(p, background)
        for _, chrom, columns in jobs.by_cell(batches):
            yield from held.take(chrom, *scored(chrom, *band(chrom, *columns)), once=True)
        yield from held.rest()

    dealt = jobs.dealt(rows, costs)
    if folded:
        return dealt.mapInArrow(fold, moments.PACKED)
    found = dealt.mapInArrow(run, runs.schema(kind, *names))
    return found if by_runs else runs.single(found)


def imputed(binned: DataFrame, p: Params, longest_first: bool = False, folded: bool = False) -> DataFrame:
    """cell, chrom, i, j, z, nb; nb is null past max_bins. One shuffle of the contacts, or of the windows' values.

    longest_first deals groups of cells to tasks by their costs, which takes a pass over binned. folded gives each task's
    packed moments over its cells instead, so that no row of a cell leaves its task.
    """
    costs = jobs.group_costs(binned, p) if longest_first else None
    if p.rwr_method == "sliding_window":
        return from_values(graph.rwr(binned, p), p, costs, folded)
    if p.rwr_method not in graph.METHODS:
        raise ValueError(f"no such method: {p.rwr_method}; there are {', '.join(graph.METHODS)}")
    return _streamed(binned.select("cell", "chrom", "i", "j"), p, lambda chrom, i, j: graph.walked_band(i, j, p.bins(chrom), p), costs, folded)


def _band_of_values(p: Params) -> Callable:
    """Places of a chromosome's band and one cell's values there, 0 where it has none."""
    places: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def band(chrom: str, gi: np.ndarray, gj: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = p.bins(chrom)
        m = np.zeros((n, p.max_rwr_bins + 1))
        gd = gj - gi
        ok = (gi >= 0) & (gi < n) & (gd >= 1) & (gd <= p.max_rwr_bins)
        m[gi[ok], gd[ok]] = v[ok]
        i, j = places.get(chrom) or places.setdefault(chrom, graph.band_places(p, n))
        return i, j, m[i, j - i]

    return band


def from_values(values: DataFrame, p: Params, costs: DataFrame | None = None, folded: bool = False, background: bool = True, by_runs: bool = False) -> DataFrame:
    """The same from values that were imputed before (cell, chrom, i, j, v); places that are missing count as 0. Where only z or
    outliers are wanted, background=False spares the rest. by_runs gives arrays, for a step that takes them."""
    return _streamed(values.select("cell", "chrom", "i", "j", "v"), p, _band_of_values(p), costs, folded, background, by_runs)


def scores_at(values: DataFrame, places: DataFrame, p: Params) -> DataFrame:
    """chrom, i, j, cell, z of some places in every cell of the values: summit_scores() of from_values(), but the places are
    brought to the cells' values, and rows of others never leave the tasks. Places off the band have none."""
    kind = values.schema["cell"].dataType
    wanted = values.select("cell", "chrom").distinct().join(places.select("chrom", "i", "j").distinct(), "chrom")
    wanted = wanted.select("cell", "chrom", "i", "j", F.lit(None).cast("double").alias("v"), F.lit(True).alias("asked"))
    rows = values.select("cell", "chrom", "i", "j", "v", F.lit(False).alias("asked")).union(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scored, band, arrow = Scorer(p, background=False), _band_of_values(p), to_arrow_type(kind)
        for cell, chrom, (i, j, v, asked) in jobs.by_cell(batches):
            asked = asked.astype(bool)
            if not asked.any():
                continue
            bi, bj, z, _ = scored(chrom, *band(chrom, i[~asked], j[~asked], v[~asked]))
            i, j = i[asked], j[asked]
            key, want = bi * (p.max_rwr_bins + 1) + bj - bi, i * (p.max_rwr_bins + 1) + j - i  # places come in this order
            at = np.minimum(np.searchsorted(key, want), max(len(key) - 1, 0))
            ok = np.flatnonzero((bi[at] == i) & (bj[at] == j)) if len(key) else []
            n = len(ok)
            yield pa.RecordBatch.from_arrays([pa.repeat(chrom, n), pa.array(i[ok]), pa.array(j[ok]), pa.repeat(pa.scalar(cell, arrow), n), pa.array(z[at[ok]])], names=["chrom", "i", "j", "cell", "z"])

    return jobs.dealt(rows).mapInArrow(run, f"chrom string, i bigint, j bigint, cell {kind.simpleString()}, z double")


def tested_places(packed: DataFrame) -> DataFrame:
    """Sums by place of packed moments, where there is a background."""
    return moments.places(moments.merged(packed)).where("n > 0")


def sums(z: DataFrame, p: Params) -> DataFrame:
    """Everything that the tests and thresholds need from the cells, by place."""
    return moments.pair_moments(z.where("nb is not null"), p.max_rwr_bins + 1, p.outlier)


def loops(contacts: DataFrame, p: Params, regions: DataFrame | None = None) -> DataFrame:
    """Clustered candidates with their summits, from raw contacts, as one plan.

    Contacts are read and shuffled once: pairs of bins that repeat make the same links, and as every cell of a chromosome has a
    score and a background at each tested place, the places know the number of cells.
    """
    pairs = staged(tested_places(imputed(binning.pair_bins(contacts, p), p, folded=True)), "pairs")
    cells = pairs.groupBy("chrom").agg(F.max("n").alias("cells"))
    return cluster.clustered(candidates.find_candidates(stats.significances(pairs, p), cells, p, regions), p)


def run(spark: SparkSession, p: Params, log: Callable[[str], None] = print) -> None:
    """The steps asked for; each reads what the step before it wrote under outdir. Tables are Parquet; where p.text is set,
    the text forms that other tools read are written beside them, and the lines of the log to <outdir>/log."""
    unknown = set(p.steps) - {"bin", "rwr", "hic", "interaction", "postprocess"}
    if unknown:
        raise ValueError(f"no such steps: {', '.join(sorted(unknown))}")
    at = {k: f"{p.outdir}/{k}" for k in ("binned", "rwr", "hic", "interactions", "postprocessed")}
    if not p.chrom_lengths:
        p = replace(p, chrom_lengths=sources.chrom_lengths(spark, p))
    log = RunLog(spark, p, log)
    log.params(p)
    made: list[DataFrame] = []
    try:
        if "bin" in p.steps:
            sinks.parquet(binning.bin_contacts(sources.raw_contacts(spark, p), p), at["binned"], "chrom")
            if p.text:
                sinks.binned(spark.read.schema(BINNED).parquet(at["binned"]), f"{at['binned']}_text", p)
            log("bin: done")
        scores = ScoreStore(spark, at["rwr"])
        if "rwr" in p.steps:
            binned = spark.read.schema(BINNED).parquet(at["binned"])
            if p.rwr_method == "sliding_window" and not p.window_bins:
                p = replace(p, window_bins=binning.window_bins(sources.raw_contacts(spark, p), p))
            # Takes up an earlier run, or adds the cells that came since.
            todo = staged(binned.join(jobs.remaining_jobs(binned, scores.manifest()), ["cell", "chrom"], "left_semi"), "todo")
            made.append(todo)
            run_of = scores.append(imputed(todo, p, longest_first=True))
            if p.keep_rwr_matrix and run_of:
                graph.rwr(todo, p).where("v <> 0").withColumn("bucket", bucket("cell")).write.partitionBy("chrom", "bucket").parquet(f"{p.outdir}/rwr_matrix/run={run_of}")
            if p.text and run_of:
                sinks.normalised(scores.read(), f"{at['rwr']}_text", p)
            log("rwr: done")
        if {"hic", "interaction", "postprocess"} & set(p.steps):
            bad = validate(scores, p, spark.read.schema(BINNED).parquet(at["binned"]) if exists(spark, at["binned"]) else None).count()
            if bad:
                raise RuntimeError(f"the rwr step is incomplete for {bad} cells and chromosomes")
            z = scores.read()
            cells = combine.cell_counts(scores.manifest())
        if {"hic", "interaction"} & set(p.steps):
            # Scores are read once: those of runs that the moments lack are merged into them.
            kept = MomentStore(spark, f"{at['rwr']}_moments")
            log(f"moments: {kept.catch_up(scores, p.max_rwr_bins + 1, p.outlier)} runs added")
            pairs = staged(moments.places(kept.packed()), "pairs")
            made.append(pairs)
        if "hic" in p.steps:
            outliers = pairs.select("chrom", "i", "j", F.col("outlier_count").alias("outliers"))
            sinks.combined(outliers, f"{at['hic']}/normalized.combined.bedpe", p)
            text = f"{at['hic']}/allChr.hic.input"
            sinks.sorted_tsv(combine.hic_input(combine.hic_score(outliers, cells), p), sinks.PLACE, text, header=False)
            sinks.heat_maps(spark, text, p, log)
            log("hic: done")
        if "interaction" in p.steps:
            rated = stats.significances(pairs.where("n > 0"), p)
            sinks.parquet(rated, at["interactions"], "chrom")
            sinks.significances(spark.read.schema(rated.schema).parquet(at["interactions"]), f"{at['interactions']}_text/significances.bedpe", p)
            log("interaction: done")
        if "postprocess" in p.steps:
            found = spark.read.parquet(at["interactions"])
            regions = sources.filter_regions(spark, p.filter_file) if p.filter_file else None
            near = staged(candidates.neighbor_means(candidates.candidate_filter(found, cells, p), found, p), "nofilter")
            rich = candidates.enrichment_filter(near, p)
            rich = staged(rich if regions is None else candidates.blacklist_anti_join(rich, regions, p), "candidates")
            made += [near, rich]
            clustered = cluster.clustered(rich, p)
            clustered.write.mode("overwrite").parquet(at["postprocessed"])
            done = spark.read.schema(clustered.schema).parquet(at["postprocessed"])
            if p.text:
                for name, rows, write in (("nofilter", near, sinks.candidates), ("candidates", rich, sinks.candidates), ("clustered", done, sinks.clustered)):
                    write(rows, f"{at['postprocessed']}_text/{p.prefix}.{name}.bedpe", p)
            sinks.loops(done, f"{p.outdir}/final", p)
            sinks.sorted_tsv(cluster.zscore_pivot(cluster.summit_scores(cluster.final_summits(done), z)), ["chrom", "i", "j"], f"{p.outdir}/final/{p.prefix}.summits.zscores")
            log("postprocess: done")
    finally:
        log.flush()
        for x in made:
            unstage(x)


def validate(scores: ScoreStore, p: Params, wanted: DataFrame | None = None, recount: bool = False) -> DataFrame:
    """cell, chrom, rows and expected of the cells and chromosomes whose rows are not complete: by the manifest, or by the rows
    themselves. Those of wanted (cell, chrom) that have no rows at all are among them."""
    rows = scores.read().groupBy("cell", "chrom").agg(F.count(F.lit(1)).alias("rows")) if recount else scores.manifest().groupBy("cell", "chrom").agg(F.sum("rows").alias("rows"))
    if wanted is not None:
        rows = wanted.select("cell", "chrom").distinct().join(rows, ["cell", "chrom"], "full").select("cell", "chrom", F.coalesce("rows", F.lit(0)).alias("rows"))
    return jobs.completeness(rows, p).where("not complete").drop("complete")


def normalise(values: DataFrame, path: str, p: Params) -> None:
    """Text files of the z-scores of matrices that other tools imputed (cell, chrom, i, j, v); a chromosome has as many bins
    as its pairs reach."""
    bins = {r["chrom"]: int(r["bins"]) for r in sources.matrix_size(values).collect()}  # a row per chromosome
    p = replace(p, chrom_lengths={k: n * p.binsize for k, n in bins.items()})
    sinks.normalised(from_values(values, p), path, p)
