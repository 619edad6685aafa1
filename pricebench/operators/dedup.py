"""Seeded order and removal of repeated listings.

Both passes run on a narrow table of digests; the wide rows are moved once, by a semi join
with the surviving keys.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricebench.functions.order import hash_bucket, seeded_hash, with_position
from pricebench.schemas import SEED


def digest(column: str) -> Column:
    """32 bytes that stand for a text of any length."""
    return F.unhex(F.sha2(column, 256))


def content_key(texts: list[str], others: list[str]) -> Column:
    """A key made of the row itself, for tables that carry no id of their own."""
    return F.sha2(F.to_json(F.struct(*[F.sha2(name, 256).alias(name) for name in texts], *others)), 256)


def seeded_order(df: DataFrame, key: str, seed: int = SEED, name: str = "position") -> DataFrame:
    """Add each row's place in the seeded shuffle of the table."""
    hashed = df.withColumn("_hash", seeded_hash(f"{seed}:dedup", F.col(key)))
    return with_position(hashed, ["_hash", key], hash_bucket(F.col("_hash")), name).drop("_hash")


def first_per_value(df: DataFrame, columns: list[str], order: list) -> DataFrame:
    """Keep the first row of each value; nulls count as one value.

    Spark limits each group to one row before the shuffle as well as after it, so a value
    held by a third of the table sends at most one row per map task to its reducer.
    """
    group = Window.partitionBy(*columns).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(group)).filter(F.col("_n") == 1).drop("_n")


def dedup_pool(items: DataFrame, key: str, seed: int = SEED) -> DataFrame:
    """The narrow table the passes need: key, order, and digests of title and body."""
    return items.select(
        F.col(key).alias("_key"),
        seeded_hash(f"{seed}:dedup", F.col(key)).alias("_order"),
        digest("title").alias("_title"),
        digest("full").alias("_body"),
    )


def surviving(pool: DataFrame, passes: tuple[str, ...] = ("_title", "_body")) -> DataFrame:
    """Chained passes: a row removed by its title can no longer suppress another by body.

    Rows that share a hash are ordered by their text before their key.
    """
    for value in passes:
        pool = first_per_value(pool, [value], ["_order", "_title", "_body", "_key"])
    return pool


def deduplicate(
    items: DataFrame, key: str = "id", seed: int = SEED, passes: tuple[str, ...] = ("_title", "_body")
) -> DataFrame:
    """One row per title, then one per body. ``key`` must be unique and not null."""
    kept = surviving(dedup_pool(items, key, seed), passes).select(F.col("_key").alias(key))
    return items.join(kept, key, "left_semi")
