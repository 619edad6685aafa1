"""Raw listings, kept in one folder per category."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricebench.schemas import CATEGORIES, RAW


def read_listings(
    spark: SparkSession, path: str, categories: tuple[str, ...] | None = CATEGORIES, fmt: str = "json"
) -> DataFrame:
    """Listings below ``path/category=<name>/``; other categories' folders are not opened.

    The schema is given, so nothing is inferred; a price stored as a number reads as text.
    """
    listings = spark.read.format(fmt).schema(RAW).load(path)
    return listings if categories is None else listings.filter(F.col("category").isin(*categories))


def read_folder(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """One category's folder, which does not name its category."""
    schema = T.StructType([f for f in RAW.fields if f.name != "category"])
    return spark.read.format(fmt).schema(schema).load(path)


def union_categories(tables: dict[str, DataFrame]) -> DataFrame:
    """Tables that do not name their category, as one table that does."""
    named = [df.withColumn("category", F.lit(name)) for name, df in tables.items()]
    union = named[0]
    for df in named[1:]:
        union = union.unionByName(df)
    return union


def write_listings(listings: DataFrame, path: str, fmt: str = "json") -> None:
    listings.write.partitionBy("category").format(fmt).save(path)
