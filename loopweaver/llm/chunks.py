"""Comparing one part of a group with all of it in bounded tasks.

A group's rows are either held or only pass. Held rows are dealt into chunks, rows that pass into parts; a task holds one
chunk in memory and streams one part past it, with the held rows of later chunks, so that every pair with a held row meets
once, pairs of rows that pass never do, and no group's size bounds a task's memory.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loopweaver.llm.common import stash

#: Groups whose sizes are broadcast, at most (some 10 MB); those of more are joined by a shuffle.
BROADCAST_GROUPS = 100_000


def checked(small: DataFrame) -> DataFrame:
    """A staged table, marked for broadcast if its size allows."""
    return F.broadcast(small) if small.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS else small


def deal(rows: DataFrame, key: list[str], id_column: str, held: Column, held_size: int, part_size: int, weight: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows by task: key, lo, hi and role (0 held, 1 passing), then the other columns; and the staged sizes they were
    dealt by. Groups without a held row are left out. weight: what a row counts towards the two sizes."""
    weight = F.lit(1) if weight is None else weight
    others = [c for c in rows.columns if c not in key]
    rows = rows.withColumn("_held", held)
    share = lambda cond, size: F.ceil(F.sum(F.when(cond, weight)) / size)
    sizes = rows.groupBy(*key).agg(share(F.col("_held"), held_size).cast("int").alias("_chunks"), F.greatest(F.lit(1), F.coalesce(share(~F.col("_held"), part_size), F.lit(1))).cast("int").alias("_parts"))
    sizes = stash(sizes.where("_chunks > 0"), "sizes")
    mix = F.xxhash64(id_column)
    dealt = rows.join(checked(sizes), key).withColumns({"_own": F.pmod(mix, F.col("_chunks")).cast("int"), "_part": F.pmod(F.shiftrightunsigned(mix, 20), F.col("_parts")).cast("int")})
    # A held row meets every part, and passes the chunks numbered below its own.
    to = lambda lo, hi, role: F.struct(lo.cast("int").alias("lo"), hi.cast("int").alias("hi"), F.lit(role).alias("role"))
    holding = F.transform(F.sequence(F.lit(0), F.col("_parts") - 1), lambda hi: to(F.col("_own"), hi, 0))
    passing = F.transform(F.filter(F.sequence(F.lit(0), F.col("_chunks") - 1), lambda lo: ~F.col("_held") | (lo < F.col("_own"))), lambda lo: to(lo, F.col("_part"), 1))
    tasks = dealt.withColumn("_task", F.explode(F.when(F.col("_held"), F.concat(holding, passing)).otherwise(passing)))
    by = [*key, "lo", "hi"]
    return tasks.select(*key, "_task.*", *others).repartition(*by).sortWithinPartitions(*by, "role"), sizes


def deal_sides(held: DataFrame, passing: DataFrame, key: list[str], id_column: str, held_size: int, part_size: int) -> DataFrame:
    """deal() for two tables of the same columns: rows that are held meet those that pass, and no others. Groups that lack one
    of the two are left out."""
    others = [c for c in held.columns if c not in key]
    chunks, parts = (t.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias(name)) for t, size, name in ((held, held_size, "_chunks"), (passing, part_size, "_parts")))
    sizes = stash(chunks.join(parts, key), "sizes")
    number = lambda n, shift: F.pmod(F.shiftrightunsigned(F.xxhash64(id_column), shift), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    one = held.join(checked(sizes), key).select(*key, number("_chunks", 0).alias("lo"), every("_parts").alias("hi"), F.lit(0).alias("role"), *others)
    two = passing.join(checked(sizes), key).select(*key, every("_chunks").alias("lo"), number("_parts", 20).alias("hi"), F.lit(1).alias("role"), *others)
    by = [*key, "lo", "hi"]
    return one.union(two).repartition(*by).sortWithinPartitions(*by, "role")


def _runs(b: pa.RecordBatch, n: int) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Stretches of rows that agree in the first n columns."""
    change = np.zeros(b.num_rows - 1, bool)
    for i in range(n):
        c = b.column(i)
        x = np.array(c.to_pylist(), object) if pa.types.is_binary(c.type) else c.to_numpy(zero_copy_only=False)
        change |= (x[1:] != x[:-1]).astype(bool)
    cuts = [0, *(np.flatnonzero(change) + 1).tolist(), b.num_rows]
    for s, t in zip(cuts[:-1], cuts[1:], strict=True):
        yield tuple(b.column(i)[s].as_py() for i in range(n)), b.slice(s, t - s)


def work(key_columns: int, make: Callable[[tuple, list[pa.RecordBatch]], object]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function of deal()'s batches. make(key, held rows) gives a task; key ends with lo and hi; where hi is 0 the task also
    compares its held rows with each other. Its meet(rows) takes rows that pass, result() what is left at the end; both give
    a batch or None."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple | None = None
        held: list[pa.RecordBatch] = []
        task = None
        for b in batches:
            for k, part in _runs(b, key_columns + 3) if b.num_rows else ():
                if k[:-1] != now:
                    if held and (out := (task or make(now, held)).result()) is not None:
                        yield out
                    now, held, task = k[:-1], [], None
                if k[-1] == 0:
                    held.append(part)
                elif held:  # no row may have been dealt into a chunk
                    task = task or make(now, held)
                    if (out := task.meet(part)) is not None:
                        yield out
        if held and (out := (task or make(now, held)).result()) is not None:
            yield out

    return run
