"""A training-data pipeline over `documents`: quality, toxicity, near-duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on everything the stage before it kept; its result is written to the
shared folder as Parquet and read again. All but the last return the columns of documents, whatever further columns there
are and however they are named. Stages that send whole texts through Python stage their result themselves, in the small
batches that stash() sets. An empty table passes through as an empty table, and texts of any length are read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loopweaver.llm import minhash, packing, quality, secrets, toxicity
from loopweaver.llm.common import scratch, stash, table, unstash, whole_rows


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that the quality rules keep.

    Every row is judged by its own text and language, so repeated rows, rows that share a doc_id and rows without one fare
    alike. Rows without text, or with fewer than 50 words, are rejected; a null lang is held against the pooled reference.
    """
    return stash(quality.good_rows(docs), "good")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows scored below 0.5 by the model learnt from the labelled ones among them.

    Every row is judged by its own text, so repeated rows, rows that share a doc_id and rows without one fare alike. Rows
    without text stay; without labels of both kinds all rows stay.
    """
    return stash(toxicity.clean_rows(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"))), "clean")


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest doc_id.

    Rows without doc_id link with nothing and all stay, equal ones too. Of rows with the same doc_id and text one stays: that
    whose further columns come first in order. Rows with one doc_id but different texts stay if one of them is kept. Rows
    without text are groups of their own.
    """
    found = minhash.near_duplicates(docs)
    by_id = found.where("doc_id is not null").groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    ids = stash(by_id.where("not kept or n > 1").select(F.col("doc_id").alias("_id"), "kept"), "rejected")
    of = lambda rows, ids: rows["doc_id"].cast("bigint") == ids["_id"]
    gone, several = ids.where("not kept"), ids.where("kept")
    rest = docs.join(gone, of(docs, gone), "left_anti")
    if not several.head(1):
        return rest
    # Only rows of repeated ids are grouped, and partly before the shuffle.
    same = rest.join(several, of(rest, several), "left_semi").select(whole_rows(docs, "_row"))
    one = same.groupBy("_row.doc_id", "_row.text").agg(F.min("_row").alias("_row")).select("_row.*")
    return rest.join(several, of(rest, several), "left_anti").unionByName(one)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with a mask in place of every secret in their texts; n_chars follows.

    Rows without text, and texts without secrets, stay as they are; repeated rows are masked alike.
    """
    return secrets.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all rows in sequences along the curve.

    Repeated rows are packed once each; a row without text is its end token alone; rows without doc_id have pieces without.
    """
    return stash(packing.pack(docs), "packed")


STAGES = [
    ("quality rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("near-dedup", dedup_stage),
    ("secret scans", secrets_stage),
    ("packing", packing_stage),
]

#: Near-duplicates, learnt scores and tokenizer ids are beyond SQL; the tests hold run() against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what they staged is deleted, but for the result."""
    with scratch() as keep_last:
        docs = table(spark, sf_dir, "documents")
        for name, stage in STAGES:
            before = docs
            with scratch() as keep:
                out = stage(spark, before, sf_dir)
                docs = keep(out if hasattr(out, "_stash_path") else stash(out, name.replace(" ", "-")))
            unstash(before)
        return keep_last(docs)
