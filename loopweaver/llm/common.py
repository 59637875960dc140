"""What the corpus operators share: staged tables in the cluster's shared folder and table reading."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import inspect
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the corpus, by any path that Spark's readers open."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; where that is unset and all runs on one machine, a folder of our own."""
    sc = spark.sparkContext
    where = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not where:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="loopweaver-"))
        where = sc.getCheckpointDir()
    return where.rstrip("/")


def new_path(spark: SparkSession, what: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


#: Arrow batches while a table is staged: long texts in batches of Spark's usual size fill an executor's direct memory.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


@contextlib.contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Hold Arrow batches small for the jobs run inside."""
    before = {k: spark.conf.get(k) for k in BATCHES}
    for k, v in BATCHES.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def trim() -> None:
    """In a Python worker: give freed memory back, as idle workers stay beside those of the next stage."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def trimmed(run: Callable) -> Callable:
    """run, a generator over batches or a function of a group, that gives its memory back once it is done."""
    if inspect.isgeneratorfunction(run):

        def over_batches(batches):
            yield from run(batches)
            gc.collect()
            trim()

        return over_batches

    def done(out):
        trim()
        return out

    # Spark tells functions of a group, with its key, and of two groups apart by their number of arguments.
    return (lambda a: done(run(a))) if len(inspect.signature(run).parameters) == 1 else (lambda a, b: done(run(a, b)))


def whole_rows(documents: DataFrame, name: str = "row") -> Column:
    """All columns of documents as one, so that no column's name can clash."""
    return F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias(name)


def rows_where(rows: DataFrame, decide: Callable) -> DataFrame:
    """The whole rows (a first column of whole_rows()) for which decide(texts, arrays of the further columns) gives true.
    Each is judged where it is: no key has to tell rows apart, and nothing is shuffled. Only the text and the further columns
    go to Python, and a boolean comes back; the JVM keeps the row."""
    first, *more = rows.columns

    @F.arrow_udf("boolean")
    def keep(judged):
        import pyarrow as pa

        out = pa.array(decide(*judged.flatten()), pa.bool_())
        trim()
        return out

    judged = F.struct(F.col(f"{first}.text").alias("text"), *(F.col(c) for c in more))
    return rows.where(keep(judged)).select(f"{first}.*")


#: What stash() wrote inside each open scratch().
_open: list[list[DataFrame]] = []


def stash(df: DataFrame, what: str = "stage", compression: str | None = None) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, survives lost executors, and is computed once.

    It stays until unstash(), or until the scratch() it was made in ends.
    """
    path = new_path(df.sparkSession, what)
    with small_batches(df.sparkSession):
        df.write.parquet(path, compression=compression)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stash_path = path
    if _open:
        _open[-1].append(out)
    return out


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path of the shared folder."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def unstash(df: DataFrame) -> None:
    """Delete what stash() wrote; for tables that no later plan reads."""
    path = getattr(df, "_stash_path", None)
    if path:
        remove(df.sparkSession, path)


@contextlib.contextmanager
def scratch() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Delete at the end what stash() wrote inside. The function given keeps one result: it is staged if something was
    staged before, as it may read that, and then belongs to the scratch() around this one, or to the caller."""
    mine: list[DataFrame] = []
    kept: list[DataFrame] = []

    def keep(df: DataFrame) -> DataFrame:
        out = df if not mine or hasattr(df, "_stash_path") else stash(df, "result")
        kept.append(out)
        return out

    _open.append(mine)
    try:
        yield keep
    finally:
        _open.pop()
        for x in mine:
            if not any(x is k for k in kept):
                unstash(x)
            elif _open:
                _open[-1].append(x)
