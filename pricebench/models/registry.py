"""Model names to factories; keyword arguments go to the model."""

from pricebench.models.base import PriceModel
from pricebench.models.baselines import CategoryAverage, RandomGuess, TrainingAverage
from pricebench.models.linear import HandFeatureRegression, HashedHuber, SvdRidge, WordCountRidge
from pricebench.models.replies import ZeroShot
from pricebench.models.trees import BoostedTrees, Forest

REGISTRY = {
    "random": RandomGuess,
    "average": TrainingAverage,
    "category-average": CategoryAverage,
    "features": HandFeatureRegression,
    "bow-linear": WordCountRidge,
    "svd-ridge": SvdRidge,
    "random-forest": Forest,
    "boosted-trees": BoostedTrees,
    "hashed-huber": HashedHuber,
    "zero-shot": ZeroShot,
}


def create(name: str, **parameters) -> PriceModel:
    return REGISTRY[name](**parameters)
