"""Curated splits on disk."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricebench.schemas import ITEM, SPLITS

SPLIT_ITEM = T.StructType([*ITEM.fields, T.StructField("split", T.StringType())])


def write_splits(items: DataFrame, path: str, fmt: str = "json") -> None:
    """One folder per split with the ITEM columns, one JSON object per line, nulls written out."""
    columns = [
        (F.col(f.name) if f.name in items.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in SPLIT_ITEM.fields
    ]
    writer = items.select(*columns).write.partitionBy("split").format(fmt)
    if fmt == "json":
        writer = writer.option("ignoreNullFields", "false")
    writer.save(path)


def read_splits(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """All splits as one table with a ``split`` column; a filter on it prunes folders."""
    return spark.read.format(fmt).schema(SPLIT_ITEM).load(path)


def read_split_files(spark: SparkSession, path: str) -> DataFrame:
    """The same from three files, ``train.jsonl``, ``validation.jsonl`` and ``test.jsonl``."""
    parts = [
        spark.read.schema(ITEM).json(f"{path}/{name}.jsonl").withColumn("split", F.lit(name)) for name in SPLITS
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
