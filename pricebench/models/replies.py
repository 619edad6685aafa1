"""Zero-shot pricing from a table of model replies."""

from pyspark.sql import DataFrame

from pricebench.models.base import PriceModel
from pricebench.operators.requests import price_replies


class ZeroShot(PriceModel):
    """Reads the guess out of replies to ``zero_shot_requests``; nothing to train."""

    needs_training = False

    def __init__(self, replies: DataFrame, model: str = "replies"):
        self.replies = replies
        self.display_name = f"zero-shot {model.split('/')[-1]}"

    def transform(self, items: DataFrame) -> DataFrame:
        return price_replies(items, self.replies)
