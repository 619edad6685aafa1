"""Parsing as files arrive: the batch job on a file stream.

Parsing looks at one listing at a time, so the same columns run on a stream without state
or watermark. Finished files are remembered in the checkpoint; a run that was cut short
goes on with the rest.
"""

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from pricebench.operators.parse import parse_listings
from pricebench.schemas import RAW


def parse_new_listings(
    spark: SparkSession, path: str, out: str, checkpoint: str, fmt: str = "json", files_per_batch: int = 1_000
) -> StreamingQuery:
    """Parse every listing file not seen before into ``out`` (Parquet), then stop."""
    raw = spark.readStream.format(fmt).schema(RAW).option("maxFilesPerTrigger", files_per_batch).load(path)
    return (
        parse_listings(raw)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
    )
