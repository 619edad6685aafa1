"""Models that do not read the text."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricebench.functions.order import seeded_hash
from pricebench.models.base import PriceModel
from pricebench.schemas import SEED
from pricebench.session import write_through

TOP_GUESS = 999


class RandomGuess(PriceModel):
    """Whole dollars 1..999 from a hash of the id: the same in every partitioning."""

    display_name = "random guess"
    needs_training = False

    def __init__(self, seed: int = SEED):
        self.seed = seed

    def transform(self, items: DataFrame) -> DataFrame:
        hashed = seeded_hash(f"{self.seed}:guess", F.col("id"))
        return items.withColumn("guess", (hashed % TOP_GUESS + 1).cast("double"))


class TrainingAverage(PriceModel):
    display_name = "training average"

    def fit(self, train: DataFrame, validation: DataFrame | None = None) -> "TrainingAverage":
        self.average = train.agg(F.avg("price").alias("mean")).first()["mean"]
        return self

    def transform(self, items: DataFrame) -> DataFrame:
        return items.withColumn("guess", F.lit(self.average).cast("double"))

    def save(self, path: str) -> None:
        row = [(self.average,)]
        SparkSession.active().createDataFrame(row, "mean double").write.mode("overwrite").parquet(path)

    def load(self, path: str) -> "TrainingAverage":
        self.average = SparkSession.active().read.parquet(path).first()["mean"]
        return self


class CategoryAverage(PriceModel):
    """Mean per category; a category unknown to the training rows gets the overall mean.

    Fitting writes the means, one row per category: they no longer follow the training table,
    and Spark picks the join from their size.
    """

    display_name = "category average"

    def fit(self, train: DataFrame, validation: DataFrame | None = None) -> "CategoryAverage":
        sums = train.groupBy("category").agg(F.sum("price").alias("_sum"), F.count("price").alias("_n"))
        return self._hold(write_through(sums, "category-sums"))

    def _hold(self, sums: DataFrame) -> "CategoryAverage":
        self.by_category = sums
        self.overall = sums.agg((F.sum("_sum") / F.sum("_n")).alias("mean")).first()["mean"]
        return self

    def transform(self, items: DataFrame) -> DataFrame:
        own = F.col("_sum") / F.col("_n")
        joined = items.join(self.by_category, "category", "left")
        return joined.select(*items.columns, F.coalesce(own, F.lit(self.overall).cast("double")).alias("guess"))

    def save(self, path: str) -> None:
        self.by_category.write.mode("overwrite").parquet(path)

    def load(self, path: str) -> "CategoryAverage":
        return self._hold(SparkSession.active().read.parquet(path))
