"""Price-weighted sampling without replacement."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricebench.functions.order import log_bucket, seeded_hash, take_smallest, uniform
from pricebench.schemas import CATEGORY_DAMPING, SEED
from pricebench.session import write_through

PRICE_POWER = 2


def damping_factor(category: Column, damping: dict[str, float]) -> Column:
    factor = F.lit(1.0)
    for name, value in damping.items():
        factor = F.when(category == name, F.lit(float(value))).otherwise(factor)
    return factor


def _ends(df: DataFrame, price: str) -> Column:
    """Lowest price and width of the price range over the whole table, as one scalar subquery."""
    low, high = F.min(price), F.max(price)
    return df.agg(F.struct(low.alias("low"), (high - low).alias("width")).alias("ends")).scalar()


def _scaled(price: str, ends: Column) -> Column:
    return (F.col(price) - ends["low"]) / (ends["width"] + F.lit(1e-9))


def minmax_scale(df: DataFrame, price: str = "price", name: str = "scaled") -> DataFrame:
    """(price - min) / (max - min + 1e-9)."""
    return df.withColumn(name, _scaled(price, _ends(df, price)))


def _raw_weights(df: DataFrame, damping: dict[str, float], power: float) -> DataFrame:
    ends = _ends(df, "price")
    # With all prices equal every scaled price is 0; only the damping is left to weigh by.
    base = F.when(ends["width"] == 0, F.lit(1.0)).otherwise(F.pow(_scaled("price", ends), F.lit(float(power))))
    return df.withColumn("weight_raw", base * damping_factor(F.col("category"), damping))


def sample_weights(
    df: DataFrame, damping: dict[str, float] = CATEGORY_DAMPING, power: float = PRICE_POWER
) -> DataFrame:
    """Add ``sample_weight``: scaled price to a power, damped by category, summing to 1."""
    raw = _raw_weights(df, damping, power)
    total = raw.agg(F.sum("weight_raw")).scalar()
    return raw.withColumn("sample_weight", F.col("weight_raw") / total).drop("weight_raw")


def sample_keys(
    pool: DataFrame,
    size: int,
    key: str,
    damping: dict[str, float] = CATEGORY_DAMPING,
    seed: int = SEED,
    hashed: Column | None = None,
    power: float = PRICE_POWER,
) -> DataFrame:
    """The rows of a narrow (key, category, price) table that the weighted draw picks.

    Keeping the k smallest -ln(u)/w has the distribution of k successive draws with
    probability proportional to w (Efraimidis and Spirakis, 2006). A common factor of the
    weights changes nothing, so they are not normalised. Rows of weight 0 cannot be drawn.
    u comes from ``hashed``, by default the seeded hash of the key; equal draws go by key.
    """
    hashed = seeded_hash(f"{seed}:sample", F.col(key)) if hashed is None else hashed
    weighed = (
        _raw_weights(pool, damping, power)
        .filter(F.col("weight_raw") > 0)
        .withColumn("_draw", -F.ln(uniform(hashed)) / F.col("weight_raw"))
    )
    chosen = take_smallest(weighed, size, ["_draw", key], log_bucket(F.col("_draw")))
    return chosen.drop("weight_raw", "_draw")


def balanced_sample(
    items: DataFrame,
    size: int,
    key: str = "id",
    damping: dict[str, float] = CATEGORY_DAMPING,
    seed: int = SEED,
) -> DataFrame:
    """Weighted sample of whole rows: drawn on keys, then joined back to the wide table.

    The keys are written first, so that Spark picks the join from their size.
    """
    chosen = sample_keys(items.select(key, "category", "price"), size, key, damping, seed).select(key)
    return items.join(write_through(chosen, "sample-keys"), key, "left_semi")


def sample_summary(sample: DataFrame) -> DataFrame:
    return sample.agg(F.count(F.lit(1)).alias("n"), F.avg("price").alias("mean_price"))
