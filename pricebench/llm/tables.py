"""Reading the given tables, and positions that no hot group can pull into one task."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ranked_in(df: DataFrame, group: str, key: Column, name: str, salts: int) -> DataFrame:
    """Add a gapless 0-based rank of each row inside its group.

    Every group is split by a hash of the key and the whole row into ``salts`` parts. Part sizes give
    where each part starts, and windows run inside the parts, so a group that holds a third of all
    rows is still ranked by many tasks, and so are different rows of one key or without a key.
    """
    part = F.pmod(F.xxhash64(key, *[F.col(f"`{c}`") for c in df.columns]), F.lit(salts)).cast("int")
    keyed = df.withColumn("_part", part).withColumn("_key", key)
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        keyed.groupBy(group, "_part")
        .agg(F.count(F.lit(1)).alias("_size"))
        .withColumn("_start", F.coalesce(F.sum("_size").over(before), F.lit(0)))
        .select(F.col(group).alias("_group"), F.col("_part").alias("_in"), "_start")
    )
    inside = Window.partitionBy(group, "_part").orderBy("_key")
    return (
        keyed.withColumn("_row", F.row_number().over(inside))
        .join(starts, (F.col(group) == F.col("_group")) & (F.col("_part") == F.col("_in")))
        .withColumn(name, (F.col("_start") + F.col("_row") - 1).cast("bigint"))
        .drop("_part", "_key", "_row", "_group", "_in", "_start")
    )
