"""Requests for the first rows of each split."""

from pyspark.sql import functions as F

from pricebench.operators.requests import summary_requests


def test_first_rows_are_found_without_dealing_items_by_split(spark):
    """Nearly all items have one split; a join that shuffles by split would send them to one task."""
    split = F.when(F.col("id") < 990_000, "train").when(F.col("id") < 999_000, "test")
    items = spark.range(1_000_000).select(
        "id", split.alias("split"), F.lit("a title").alias("title"), F.lit("a text").alias("full"), F.lit("").alias("summary")
    )
    asked = summary_requests(items, limit=3)
    assert "SortMergeJoin" not in asked._jdf.queryExecution().sparkPlan().toString()
    assert sorted(r["id"] for r in asked.collect()) == [0, 1, 2, 990_000, 990_001, 990_002]
