"""The table of scores by cell: runs that are appended, and a manifest of what each of them completed.

A run's rows lie under run=<id>/chrom=<chrom>/bucket=<k>, where a cell's bucket follows from its name; the cell's name stays a
column, as a folder per cell would be too many, and a folder's name loses its type: names are text, whatever they look like
(001, 1.10, 2020-01-01). The manifest gets a run's cells only after its rows are written, and readers take the rows of the
runs in the manifest, so that a run that broke off leaves nothing that is read. Tasks write one chromosome's bucket each.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Buckets that a chromosome's cells are dealt into.
BUCKETS = 256

SCORES = "run string, chrom string, bucket int, cell string, i bigint, j bigint, z double, nb double"
MANIFEST = "run string, chrom string, cell string, rows bigint"


def bucket(cell: str | Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(F.col(cell).cast("string") if isinstance(cell, str) else cell.cast("string")), F.lit(buckets)).cast("int")


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


@dataclass(frozen=True)
class ScoreStore:
    """Scores under path, and the manifest beside them."""

    spark: SparkSession
    path: str

    @property
    def _manifest(self) -> str:
        return f"{self.path}_manifest"

    def append(self, z: DataFrame) -> str | None:
        """Write cell, chrom, i, j, z and nb as a new run, and then what it completed; the run's name, or None if there was
        nothing. Rows come as tasks of (chrom, bucket), as imputed() gives them."""
        run = uuid.uuid4().hex
        at = f"{self.path}/run={run}"
        named = z.select(F.col("chrom"), bucket("cell").alias("bucket"), F.col("cell").cast("string").alias("cell"), "i", "j", "z", "nb")
        named.write.partitionBy("chrom", "bucket").parquet(at)
        done = self._rows(at).groupBy("chrom", "cell").agg(F.count(F.lit(1)).alias("rows"))
        if not done.head(1):
            p = self.spark._jvm.org.apache.hadoop.fs.Path(at)
            p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)
            return None
        done.select(F.lit(run).alias("run"), "chrom", "cell", "rows").write.mode("append").parquet(self._manifest)
        return run

    def _rows(self, at: str) -> DataFrame:
        schema = SCORES if at == self.path else SCORES.removeprefix("run string, ")
        return self.spark.read.schema(schema).parquet(at)

    def manifest(self) -> DataFrame:
        """run, chrom, cell, rows of what is complete."""
        if not exists(self.spark, self._manifest):
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(self._manifest)

    def runs(self) -> list[str]:
        """Names of the complete runs, as many as were made."""
        return sorted(r["run"] for r in self.manifest().select("run").distinct().collect())

    def read(self, runs: list[str] | None = None) -> DataFrame:
        """chrom, bucket, cell, i, j, z, nb of these runs, or of all complete ones."""
        runs = self.runs() if runs is None else runs
        if not runs:
            return self.spark.createDataFrame([], SCORES.removeprefix("run string, "))
        return self._rows(self.path).where(F.col("run").isin(runs)).drop("run")


@dataclass(frozen=True)
class MomentStore:
    """Versions of packed moments over cells, each with the runs that it covers; see operators.moments.

    A version is complete once its runs are written, after its moments. A new one merges the runs that the last one lacks
    into it, without reading the runs before; a cell of a chromosome that two runs hold is refused, as it would count twice.
    """

    spark: SparkSession
    path: str

    def _versions(self) -> list[int]:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(n[1:]) for n in names if n.startswith("v") and exists(self.spark, f"{self.path}/{n}/runs/_SUCCESS"))

    def runs(self) -> list[str]:
        """The runs that the latest version covers."""
        v = self._versions()
        return sorted(r["run"] for r in self.spark.read.schema("run string").parquet(f"{self.path}/v{v[-1]}/runs").collect()) if v else []

    def packed(self) -> DataFrame:
        from loopweaver.operators.moments import PACKED

        v = self._versions()
        return self.spark.read.schema(PACKED).parquet(f"{self.path}/v{v[-1]}/moments") if v else self.spark.createDataFrame([], PACKED)

    def catch_up(self, scores: ScoreStore, width: int, outlier: float) -> int:
        """Merge the complete runs that are missing; how many those were."""
        from loopweaver.operators.moments import fold, merged

        have, new = self.runs(), scores.runs()
        if not set(have) <= set(new):
            raise ValueError(f"{self.path} covers runs that {scores.path} doesn't have; delete it to start anew")
        new = [r for r in new if r not in have]
        if not new:
            return 0
        twice = scores.manifest().groupBy("chrom", "cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("chrom", "cell").limit(3).collect()
        if twice:
            raise ValueError("these cells were scored more than once: " + ", ".join(f"{r['cell']} ({r['chrom']})" for r in twice))
        at = f"{self.path}/v{(self._versions() or [0])[-1] + 1}"
        parts = [fold(scores.read(new), width, outlier)]
        if have:
            parts.insert(0, self.packed())
        merged(*parts).write.mode("overwrite").parquet(f"{at}/moments")
        self.spark.createDataFrame([(r,) for r in have + new], "run string").coalesce(1).write.mode("overwrite").parquet(f"{at}/runs")
        return len(new)
