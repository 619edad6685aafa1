"""What every price model offers: ``fit`` on items, ``transform`` adds ``guess``."""

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from pricebench.operators.evaluate import as_predictions


class PriceModel:
    display_name = "pricer"
    needs_training = True
    reads_words = False  # whether it makes features of the words of a text, without its ``stop_words``

    def fit(self, train: DataFrame, validation: DataFrame | None = None) -> "PriceModel":
        return self

    def transform(self, items: DataFrame) -> DataFrame:
        raise NotImplementedError

    def predictions(self, items: DataFrame) -> DataFrame:
        return as_predictions(self.transform(items), self.display_name)


class PipelinePriceModel(PriceModel):
    """A model whose fitted state is one PipelineModel, inverse target included."""

    model: PipelineModel

    def transform(self, items: DataFrame) -> DataFrame:
        return self.model.transform(items).select(*items.columns, "guess")

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(path)

    def load(self, path: str) -> "PipelinePriceModel":
        self.model = PipelineModel.load(path)
        return self
