"""Train, validation and test parts with contiguous ids."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricebench.functions.order import hash_bucket, seeded_hash, with_position
from pricebench.schemas import SEED

MAX_VALIDATION = 10_000
MAX_TEST = 2_000


def sequential_ids(
    df: DataFrame, key: str, seed: int = SEED, name: str = "id", hashed: Column | None = None
) -> DataFrame:
    """0..n-1 in the seeded shuffle of the table; equal hashes go by key."""
    hashed = seeded_hash(f"{seed}:split", F.col(key)) if hashed is None else hashed
    placed = df.withColumn("_hash", hashed)
    return with_position(placed, ["_hash", key], hash_bucket(F.col("_hash")), name).drop("_hash")


def cut_points(df: DataFrame, validation: int, test: int) -> Column:
    """Where validation and test start, as one scalar subquery over the row count."""
    total = F.count(F.lit(1))
    tenth = F.floor(total / 10)
    test_start = total - F.least(F.lit(test), tenth)
    validation_start = test_start - F.least(F.lit(validation), tenth)
    return df.agg(F.struct(validation_start.alias("validation"), test_start.alias("test")).alias("cuts")).scalar()


def train_val_test_split(
    df: DataFrame,
    key: str,
    validation: int = MAX_VALIDATION,
    test: int = MAX_TEST,
    seed: int = SEED,
    name: str = "id",
    hashed: Column | None = None,
) -> DataFrame:
    """Add ``name`` (contiguous over train, validation, test) and ``split``."""
    placed = sequential_ids(df, key, seed, name, hashed)
    cuts = cut_points(df, validation, test)
    part = (
        F.when(F.col(name) < cuts["validation"], "train")
        .when(F.col(name) < cuts["test"], "validation")
        .otherwise("test")
    )
    return placed.withColumn("split", part)


def first_rows(part: DataFrame, size: int, id_column: str = "id") -> DataFrame:
    """First ``size`` rows of one part. Ids are contiguous, so no sort and no limit."""
    start = part.agg(F.min(id_column)).scalar()
    return part.filter(F.col(id_column) < start + size)


def split_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
