"""Evaluation reports: a summary per model and every prediction, in a new stamped folder."""

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricebench.operators.evaluate import metrics


def report_rows(predictions: DataFrame, dataset: str) -> DataFrame:
    """Every prediction under the name of its data set, one row each.

    A document nested by model would put all predictions of a model into one row.
    """
    return predictions.select(F.lit(dataset).alias("dataset"), "model", "id", "title", "truth", "guess")


def report_summary(predictions: DataFrame, dataset: str) -> DataFrame:
    return metrics(predictions).withColumn("dataset", F.lit(dataset))


def write_report(predictions: DataFrame, folder: str, dataset: str, label: str = "comparison") -> str:
    """Write both tables below ``folder/label-<UTC stamp>``; gives the path back."""
    stamp = datetime.now(timezone.utc).strftime("%Y%m%d-%H%M%S")
    path = f"{folder}/{label}-{stamp}"
    stamped = F.lit(stamp).alias("generated")
    report_summary(predictions, dataset).select(stamped, "*").write.json(f"{path}/summary")
    report_rows(predictions, dataset).select(stamped, "*").write.partitionBy("model").json(f"{path}/predictions")
    return path
