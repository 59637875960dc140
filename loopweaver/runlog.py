"""The log of a run: lines with time and level, shown as they come and kept as text beside the results."""

from __future__ import annotations

import time
from dataclasses import asdict

from pyspark.sql import SparkSession

from loopweaver.params import Params


class RunLog:
    """Lines up to the level of `verbose` are kept; flush() appends them to <outdir>/log."""

    def __init__(self, spark: SparkSession, p: Params, show=print):
        self.spark, self.path, self.verbose, self.show = spark, f"{p.outdir}/log", p.verbose, show
        self.lines: list[str] = []

    def __call__(self, message: str, level: int = 1) -> None:
        if level <= self.verbose:
            self.lines.append(f"{time.ctime()} {message}")
            self.show(message)

    def params(self, p: Params) -> None:
        """Every option with its value."""
        for name, value in asdict(p).items():
            self(f"{name}: {value}", level=2)

    def flush(self) -> None:
        if self.lines:
            self.spark.createDataFrame([(x,) for x in self.lines], "value string").coalesce(1).write.mode("append").text(self.path)
            self.lines = []
