"""Contacts that arrive as files: binned as they come, distinct across batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loopweaver.operators.binning import bin_contacts, pair_bins
from loopweaver.params import Params

SCHEMA = "cell string, chr1 string, pos1 bigint, chr2 string, pos2 bigint"


def contact_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Contacts of the Parquet files that appear in a folder."""
    return spark.readStream.schema(SCHEMA).parquet(folder)


def bin_stream(contacts: DataFrame, p: Params, out: str, checkpoint: str, within: str | None = None) -> StreamingQuery:
    """Append distinct binned contacts to a Parquet table partitioned by chromosome until the folder is read up.

    Without `within` every pair of bins ever seen stays in the state, and the table is distinct. With it (such as "2 days")
    pairs are told apart for that long after they came, so that the state is bounded; pairs that return later are appended
    again, and readers take distinct rows.
    """
    if within is None:
        pairs = bin_contacts(contacts, p)
    else:
        names = ["cell", "chrom", "i", "j"]
        came = contacts.select("*", F.col("_metadata.file_modification_time").alias("_came"))
        pairs = pair_bins(came, p, "_came").withWatermark("_came", within).dropDuplicatesWithinWatermark(names).select(names)
    return pairs.writeStream.format("parquet").partitionBy("chrom").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
