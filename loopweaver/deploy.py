"""Make this package importable in Python workers of executors that don't share the driver's folders."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors once per application, as spark-submit --py-files would."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    out = os.path.join(tempfile.mkdtemp(prefix="loopweaver-"), "loopweaver.zip")
    with zipfile.ZipFile(out, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(out)
    _shipped.add(sc.applicationId)
