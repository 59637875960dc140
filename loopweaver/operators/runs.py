"""Values at places of cells, by runs: one row for places of a bin at distances after each other, with an array per value.

A row that passes from Python to the JVM or back costs as much as dozens of values of an array. So what a task finds leaves
Python by runs, and rows of single places are made of them in the JVM, or not at all where another Python step takes them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Places of a batch that a task passes on, or those of one run.
BATCH = 250_000


def schema(kind: T.DataType, *values: str) -> str:
    """Of runs whose cells are of some type; j is that of the first place."""
    return f"cell {kind.simpleString()}, chrom string, i bigint, j bigint, " + ", ".join(f"{v} array<double>" for v in values)


class Runs:
    """The runs of places (i, j): i stays and j grows by 1. Any places in any order have some, if of one place each."""

    def __init__(self, i: np.ndarray, j: np.ndarray):
        cut = (i[1:] != i[:-1]) | (j[1:] != j[:-1] + 1)
        first = np.flatnonzero(np.r_[True, cut]) if len(i) else np.zeros(0, np.int64)
        self.ends = np.r_[first, len(i)].astype(np.int64)
        self.i, self.j = i[first], j[first]

    def rows(self, cell, chrom: str, kind: T.DataType, **values: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Values of a cell at the places; NaNs of nb are nulls."""
        s = 0
        while s < len(self.i):
            t = max(s + 1, int(np.searchsorted(self.ends, self.ends[s] + BATCH, side="right")) - 1)
            a, b = self.ends[s], self.ends[t]
            offsets = pa.array((self.ends[s : t + 1] - a).astype(np.int32))
            arrays = [pa.ListArray.from_arrays(offsets, pa.array(x[a:b], mask=np.isnan(x[a:b]) if k == "nb" else None)) for k, x in values.items()]
            yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(cell, to_arrow_type(kind)), t - s), pa.repeat(chrom, t - s), pa.array(self.i[s:t]), pa.array(self.j[s:t]), *arrays], names=["cell", "chrom", "i", "j", *values])
            s = t


def places(i: np.ndarray, j: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """i, j of the places of runs of n places each."""
    return np.repeat(i, n), np.arange(n.sum()) + np.repeat(j - np.cumsum(n) + n, n)


def single(runs: DataFrame) -> DataFrame:
    """A row for each place of the runs; arrays of a run are of one length."""
    first, *more = [f.name for f in runs.schema if isinstance(f.dataType, T.ArrayType)]
    at = runs.select("*", F.posexplode(first).alias("_k", "_x"))
    return at.select("cell", "chrom", "i", (F.col("j") + F.col("_k")).alias("j"), F.col("_x").alias(first), *(F.col(m)[F.col("_k")].alias(m) for m in more))
