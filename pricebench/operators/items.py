"""Projections of items: the text a model sees and the prompts built from it."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricebench.functions.text import or_null

# Fixed values.
QUESTION = "What does this cost to the nearest dollar?"
PREFIX = "Price is $"
TITLE_CHARS = 60


def item_text() -> Column:
    """Summary, else body, else title; empty text falls through."""
    return F.coalesce(or_null(F.col("summary")), or_null(F.col("full")), F.col("title"))


def inference_prompt() -> Column:
    return F.concat(F.lit(f"{QUESTION}\n\n"), item_text(), F.lit(f"\n\n{PREFIX}"))


def training_prompt() -> Column:
    """The inference prompt and the price to the dollar, halves to even."""
    dollars = F.bround("price").cast("bigint").cast("string")
    return F.concat(inference_prompt(), dollars, F.lit(".00"))


def with_prompts(items: DataFrame) -> DataFrame:
    return items.withColumn("prompt", training_prompt())


def text_to_items(texts: DataFrame, text: str = "text") -> DataFrame:
    """Free text as items that any fitted model can score; other columns are kept."""
    return texts.select(
        *[c for c in texts.columns if c != text],
        F.substring(text, 1, TITLE_CHARS).alias("title"),
        F.lit("unknown").alias("category"),
        F.lit(0.0).alias("price"),
        F.col(text).alias("full"),
        F.lit(None).cast("double").alias("weight"),
        F.lit(None).cast("string").alias("summary"),
    )
