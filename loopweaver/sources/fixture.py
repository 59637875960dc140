"""Synthetic contacts made from the driver's `lineitem`, with planted loops; see FIXTURES.md."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loopweaver.params import Params

PARAMS = Params(dist=600_000, candidate_upper_distance=600_000, chrom_lengths={"chr1": 2_000_000, "chr2": 2_000_000})

_POS1 = "CASE WHEN planted THEN (30 + 40 * a) * 10000 + (l_orderkey % 2) * 10000 + 137 ELSE p0 END"
_POS2 = "CASE WHEN planted THEN (30 + 40 * a + 25) * 10000 + (l_partkey % 2) * 10000 + 731 ELSE p0 + (l_orderkey * 15485863) % 600000 END"


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cell, chr1, pos1, chr2, pos2."""
    base = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_discount")
    base = base.withColumns({"planted": F.expr("l_discount between 0.045d and 0.055d"), "a": F.expr("l_orderkey % 4"), "p0": F.expr("(l_partkey * 7919 + l_linenumber * 104729) % 2000000")})
    chrom = F.concat(F.lit("chr"), (1 + F.col("l_linenumber") % 2).cast("string"))
    out = base.select(F.col("l_suppkey").cast("bigint").alias("cell"), chrom.alias("chr1"), F.expr(_POS1).cast("bigint").alias("pos1"), chrom.alias("chr2"), F.expr(_POS2).cast("bigint").alias("pos2"))
    # Numbered rows keep later filters above the positions, each of which would else be worked out again for every use of it in
    # them; the code made of that is too long for the JVM to compile.
    numbered = out.withColumn("_row", F.monotonically_increasing_id()).where("_row >= 0 and pos2 < 2000000")
    return numbered.drop("_row")


#: The same in DuckDB's SQL: CTE `contacts`.
SQL = f"""base AS (
  SELECT 'chr' || CAST(1 + l_linenumber % 2 AS VARCHAR) AS chrom, CAST(l_suppkey AS BIGINT) AS cell,
    (l_partkey * 7919 + l_linenumber * 104729) % 2000000 AS p0, l_orderkey % 4 AS a, l_orderkey, l_partkey,
    l_discount BETWEEN CAST(0.045 AS DOUBLE) AND CAST(0.055 AS DOUBLE) AS planted
  FROM lineitem
), contacts AS (
  SELECT * FROM (SELECT cell, chrom, CAST({_POS1} AS BIGINT) AS pos1, CAST({_POS2} AS BIGINT) AS pos2 FROM base) AS c WHERE pos2 < 2000000
)"""
