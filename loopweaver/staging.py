"""Small tables that several later steps read: written once to the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame


def staged(df: DataFrame, what: str = "stage") -> DataFrame:
    """df, computed once: written under spark.checkpoint.dir and read back. Lost executors cost no recomputation.

    unstage() deletes it; what a query returns may read it, so that falls to whoever reads the result. Where
    spark.checkpoint.dir is unset a folder of this machine is taken, if all runs on it.
    """
    spark = df.sparkSession
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="loopweaver-"))
        where = spark.sparkContext.getCheckpointDir()
    path = f"{where.rstrip('/')}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def unstage(df: DataFrame) -> None:
    """Delete what staged() wrote."""
    path = getattr(df, "_staged_path", None)
    if path:
        p = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)
