"""Summaries of a price table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricebench.functions.order import exact_median


def describe_prices(df: DataFrame) -> DataFrame:
    """One row: count, mean, exact median, min, max."""
    median = exact_median(df, F.col("price"), []).scalar()
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("price").alias("mean_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
    ).withColumn("median_price", median)


def category_histogram(df: DataFrame) -> DataFrame:
    """Rows per category, largest first."""
    return df.groupBy("category").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "category")


def sample_statistics(df: DataFrame) -> DataFrame:
    """Count, mean and median price, shown before any model is scored."""
    return describe_prices(df).select("n", "mean_price", "median_price")
