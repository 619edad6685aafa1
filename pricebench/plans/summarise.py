"""The summary stage over curated splits: pending requests, then replies merged in.

Both steps can be run again after a failure: requests already answered are left out, and
the merged table goes to a new folder, never to the one being read.
"""

from pyspark.sql import DataFrame, SparkSession

from pricebench.operators.requests import apply_summaries, summary_requests
from pricebench.sources.splits import read_splits, write_splits


def pending_requests(
    spark: SparkSession, curated: str, replies: DataFrame | None = None, limit: int | None = None
) -> DataFrame:
    return summary_requests(read_splits(spark, curated), replies, limit)


def merge_summaries(spark: SparkSession, curated: str, replies: DataFrame, out: str) -> None:
    write_splits(apply_summaries(read_splits(spark, curated), replies), out)
