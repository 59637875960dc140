"""Which cells and chromosomes are done, whether outputs are whole, and which task works on what."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loopweaver.params import Params
from loopweaver.sources.store import bucket

#: Size of the block that keep_freed() shows to malloc: below its limit of 32 MB, twice of which it then keeps at most.
KEPT_BYTES = 31 << 20


def remaining_jobs(wanted: DataFrame, done: DataFrame) -> DataFrame:
    """cell, chrom that are wanted and not done."""
    return wanted.select("cell", "chrom").distinct().join(done.select("cell", "chrom").distinct(), ["cell", "chrom"], "left_anti")


def expected_rows(p: Params, spark) -> DataFrame:
    """chrom and the rows of its band in every cell."""
    from loopweaver.operators.normalize import grid

    return grid(p, spark).groupBy("chrom").agg(F.count(F.lit(1)).alias("expected"))


def completeness(found: DataFrame, p: Params) -> DataFrame:
    """cell, chrom, rows, expected, complete, given the rows of each cell and chromosome."""
    return found.join(expected_rows(p, found.sparkSession), "chrom").select("cell", "chrom", "rows", "expected", (F.col("rows") == F.col("expected")).alias("complete"))


def validate_counts(z: DataFrame, p: Params) -> DataFrame:
    """cell, chrom, rows, expected, complete."""
    return completeness(z.groupBy("cell", "chrom").agg(F.count(F.lit(1)).alias("rows")), p)


# Tasks


def longest_first(costs: list[float], tasks: int) -> list[int]:
    """The task of each job: jobs from the dearest on, each to the task that has least so far."""
    load = [(0.0, t) for t in range(tasks)]
    out = [0] * len(costs)
    for k in sorted(range(len(costs)), key=lambda k: (-costs[k], k)):
        have, t = heapq.heappop(load)
        out[k] = t
        heapq.heappush(load, (have + costs[k], t))
    return out


def group_costs(binned: DataFrame, p: Params) -> DataFrame:
    """chrom, bucket and cost of the groups of cells: a solve takes the cube of a chromosome's bins, a window less."""
    sizes = F.create_map(*(x for k in sorted(p.chrom_lengths) for x in (F.lit(k), F.lit(float(p.bins(k))))))
    n = sizes[F.col("chrom")]
    each = n * n * n if p.rwr_method != "sliding_window" else n
    cells = binned.select("chrom", "cell").distinct().groupBy("chrom", bucket("cell").alias("bucket")).agg(F.count(F.lit(1)).alias("cells"))
    return cells.select("chrom", "bucket", (F.col("cells") * each).alias("cost"))


def together(rows: DataFrame) -> DataFrame:
    """The rows with those of a cell's chromosome in one partition; windows and groups by cell, chromosome and more shuffle
    nothing after it. The number of partitions is the session's: they would else be merged by their bytes, which say nothing
    of what they grow to where each cell's band or chain is made of a few contacts."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "cell", "chrom")


def dealt(rows: DataFrame, costs: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
    """The rows by task: all of a chromosome's bucket of cells in one, sorted by chromosome, bucket and cell.

    With the groups' costs they go to numbered tasks, the dearest first; those costs have a row per chromosome and bucket, so
    that the driver can deal them. Without, cells of a chromosome are dealt by themselves, by a hash.
    """
    spark = rows.sparkSession
    if costs is None:
        return together(rows).sortWithinPartitions("chrom", "cell")
    named = rows.withColumn("_bucket", bucket("cell"))
    by = ["chrom", "_bucket", "cell"]
    groups = costs.orderBy("chrom", "bucket").collect()
    if not groups:
        return rows
    n = min(len(groups), tasks or int(spark.conf.get("spark.sql.shuffle.partitions")))
    task = longest_first([g["cost"] for g in groups], n)
    plan = spark.createDataFrame([(g["chrom"], g["bucket"], t) for g, t in zip(groups, task, strict=True)], "chrom string, _bucket int, _task int")
    placed = named.join(F.broadcast(plan), ["chrom", "_bucket"])  # BUCKETS rows for each chromosome
    return placed.repartitionById(n, F.col("_task")).sortWithinPartitions(*by).select(*rows.columns)


def keep_freed() -> None:
    """Let this process keep what it frees for the next cell. glibc gives the end of the heap back at every free until it has
    seen a larger block freed, and the pages of a cell's arrays would be faulted in again and again. Nothing is touched here."""
    np.empty(KEPT_BYTES, np.uint8)


def by_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, str, list[np.ndarray]]]:
    """Cell, chromosome and further columns of sorted rows, one cell of a chromosome at a time; batches begin with these two. A
    column of arrays gives their values after each other."""
    keep_freed()
    held: list[pa.RecordBatch] = []
    now: tuple | None = None

    def flat(x: pa.Array) -> np.ndarray:
        return (x.flatten() if pa.types.is_list(x.type) else x).to_numpy(zero_copy_only=False)

    def done() -> tuple[object, str, list[np.ndarray]]:
        return *now, [np.concatenate([flat(h.column(c)) for h in held]) for c in range(2, held[0].num_columns)]

    for b in batches:
        if not b.num_rows:
            continue
        change = np.zeros(b.num_rows - 1, bool)
        for c in (0, 1):
            code = b.column(c).dictionary_encode().indices.to_numpy(zero_copy_only=False)
            change |= code[1:] != code[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), b.num_rows]
        for s, t in zip(cuts[:-1], cuts[1:], strict=True):
            key = (b.column(0)[s].as_py(), b.column(1)[s].as_py())
            if key != now:
                if held:
                    yield done()
                held, now = [], key
            held.append(b.slice(s, t - s))
    if held:
        yield done()


