"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loopweaver.llm.common import stash, unstash


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One step: each node's larger (or smaller and own) neighbours are linked to its smallest neighbour, itself included.

    The smallest neighbour is a partial aggregate, and the join that brings it back has a plain exchange on both sides, so
    that Spark can split a hub's rows.
    """
    if large:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        linked = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        linked = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return linked.where("u <> v").distinct()


def _sign(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("bigint")), F.sum(F.hash("v", "u", F.lit(1)).cast("bigint"))).first()
    return tuple(r)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """node and component (the smallest node reachable) of every node that has a link. edges: u and v, any direction.

    Loops, repeated links and nulls are dropped. The rounds grow with the logarithm of the number of nodes; each round's
    links are written to the shared folder and the round before is deleted, so a lost executor costs no more than a round. The
    result is staged; unstash() deletes it.
    """
    now = stash(edges.select("u", "v").where("u is not null and v is not null and u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    seen = _sign(now)
    for _ in range(max_rounds):
        step = stash(_stars(_stars(now, True), False), "links")
        unstash(now)
        now, before = step, seen
        seen = _sign(now)
        if seen == before:
            break
    else:
        raise RuntimeError("the components did not settle")
    # Every link now goes from a node to the smallest one of its component.
    out = stash(now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()), "components")
    unstash(now)
    return out
