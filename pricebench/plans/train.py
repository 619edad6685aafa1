"""Train once, keep the fitted pipeline, score texts in bulk."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricebench.models.base import PriceModel
from pricebench.operators.evaluate import SLICE_ROWS, evaluation_slice
from pricebench.operators.items import text_to_items


def train_and_save(items: DataFrame, model: PriceModel, path: str, size: int = SLICE_ROWS) -> DataFrame:
    """Fit, save, and give the predictions on the evaluation slice."""
    model.fit(items.filter(F.col("split") == "train"), items.filter(F.col("split") == "validation"))
    model.save(path)
    return model.predictions(evaluation_slice(items.filter(F.col("split") == "test"), size))


def score_texts(texts: DataFrame, model: PriceModel, text: str = "text") -> DataFrame:
    """Guesses for a table of free texts; ``model`` is fitted or loaded."""
    return model.transform(text_to_items(texts, text))
