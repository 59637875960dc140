"""Ranks and running minima over groups of any size: by ranges of rows, with what each range passes on to the next.

Rows are dealt to tasks by ranges of their order and numbered there; the counts of a group's ranges, a few rows each, give
where each range's ranks begin. A running minimum is carried from range to range in the same way. So no task holds a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loopweaver.staging import staged

#: Rows of a table that is broadcast, at most.
SMALL = 100_000


def small(df: DataFrame) -> DataFrame:
    """A staged table, marked for broadcast if its size allows."""
    return F.broadcast(df) if df.limit(SMALL + 1).count() <= SMALL else df


def ranked(df: DataFrame, by: list[str], order: list[Column], name: str = "rank", ranges: int | None = None) -> DataFrame:
    """df with a row's number in its group from 1 (name), the group's size (_of) and the range it lies in (_range); staged. The
    order must tell all rows of a group apart, and the columns of by must not be null."""
    keys = [*map(F.col, by), *order]
    # Both sides of a later join read the staged rows, so that numbers and counts agree whatever the ranges were.
    rows = df.repartitionByRange(*([ranges] if ranges else []), *keys).sortWithinPartitions(*keys).withColumn("_id", F.monotonically_increasing_id())
    rows = staged(rows, "ranges").withColumn("_range", F.shiftright("_id", 33).cast("int"))
    counts = rows.groupBy(*by, "_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*by, "_range", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(Window.partitionBy(*by)).alias("_of"))
    out = rows.join(small(staged(starts, "starts")), [*by, "_range"])
    return out.withColumn(name, F.col("_id") - F.col("_first") + F.col("_before") + 1).drop("_id", "_first", "_before")


def least_from_here(rows: DataFrame, by: list[str], value: str, rank: str, name: str) -> DataFrame:
    """Adds the least value of a row and all that come after it in its group. rows: as ranked() gives them."""
    ends = staged(rows.groupBy(*by, "_range").agg(F.min(value).alias("_least")), "ends")
    later = Window.partitionBy(*by).orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*by, "_range", F.min("_least").over(later).alias("_carried"))
    within = Window.partitionBy(*by, "_range").orderBy(F.desc(rank)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = rows.withColumn(name, F.min(value).over(within)).join(small(staged(carried, "carried")), [*by, "_range"])
    return out.withColumn(name, F.least(name, "_carried")).drop("_carried")
