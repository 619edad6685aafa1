"""Quality classifier on supervised subword embeddings.

A text is the average of learned vectors of its words, of the character n-grams inside them, and of one
marker for each window of words that the text has had before; all are hashed into a fixed number of
buckets. A softmax layer over two classes reads the average. Vectors and layer are trained together by
stochastic gradient descent in numpy on a bounded sample of labelled rows. To score, the layer is folded
into the vectors first: the average of one number per bucket is the same logit.
"""

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricebench.llm.bytewords import BLANK, bounds, hashes, mix, shingles, spans

BUCKETS = 1 << 16
GRAMS = (1, 2, 3, 4)
DIMENSIONS = 16
FOLDS = 5
THRESHOLD = 0.3
WINDOW = 3
GRAM_BASE = np.uint64(0x100000001B3)
AGAIN = 0  # the bucket of windows that occurred before


def fold(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS


def _bucket(hashed: np.ndarray) -> np.ndarray:
    return (np.uint64(1) + hashed % np.uint64(BUCKETS - 1)).astype(np.int64)


def buckets(text: str | None) -> np.ndarray:
    """The bucket of every feature of a whole text, repeats included."""
    found, words = [], []
    for octets in spans((text or "").encode()):
        starts, ends = bounds(octets)
        if not len(starts):
            continue
        own = hashes(octets, starts, ends)
        words.append(own)
        found.append(_bucket(own))
        # n-grams see the blank before and after a word, but never two words
        wide = np.concatenate([[0x20], octets, [0x20]]).astype(np.uint64)
        blanks = np.concatenate([[0], np.cumsum(BLANK[wide.astype(np.uint8)])])
        for n in GRAMS:
            count = len(wide) - n + 1
            grams = np.zeros(count, np.uint64)
            for i in range(n):
                grams = grams * GRAM_BASE + wide[i : i + count] + np.uint64(1)
            within = 1 if n > 1 else 0  # a single character must itself be no blank
            kept = blanks[n - within : n - within + count] == blanks[within : within + count]
            found.append(_bucket(mix(grams[kept] + np.uint64(n))))
    if not words:
        return np.zeros(0, np.int64)
    windows = shingles(np.concatenate(words), WINDOW)
    again = len(windows) - len(np.unique(windows))
    # Markers weigh as much as all features of the words that they repeat.
    found.append(np.full(again * (2 + len(GRAMS)), AGAIN))
    return np.concatenate(found)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # logit of class 1 that each bucket adds
    bias: float

    def score(self, text: str | None) -> float:
        """P(quality 1); a text without features is scored by the bias alone."""
        found = buckets(text)
        logit = self.bias + (float(self.weights[found].mean()) if len(found) else 0.0)
        return float(1 / (1 + np.exp(-logit)))


def train(
    texts: list[str | None],
    labels: list[int],
    epochs: int = 12,
    rate: float = 0.5,
    dimensions: int = DIMENSIONS,
    seed: int = 7,
) -> Model:
    """Plain SGD, one document a step, the rate falling in a line to zero. Only one class seen: it wins."""
    draw = np.random.default_rng(seed)
    vectors = draw.uniform(-1, 1, (BUCKETS, dimensions)) / dimensions
    layer, bias = np.zeros((dimensions, 2)), np.zeros(2)
    known = [(*np.unique(buckets(t), return_counts=True), y) for t, y in zip(texts, labels)]
    known = [(ids, n / max(n.sum(), 1), y) for ids, n, y in known]
    steps, total = 0, epochs * max(len(known), 1)
    for _ in range(epochs):
        for i in draw.permutation(len(known)):
            ids, share, y = known[i]
            lr = rate * (1 - steps / total)
            steps += 1
            hidden = share @ vectors[ids]
            logits = hidden @ layer + bias
            grad = np.exp(logits - logits.max())
            grad /= grad.sum()
            grad[y] -= 1
            back = layer @ grad
            layer -= lr * np.outer(hidden, grad)
            bias -= lr * grad
            # Every feature stands for its share of the text; scaled up, or long texts would never learn.
            vectors[ids] -= lr * np.outer(np.minimum(share * 50, 1), back)
    return Model(vectors @ (layer[:, 1] - layer[:, 0]), float(bias[1] - bias[0]))


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` labelled rows outside the held-out fold, those with the smallest hash of their id.

    An id gives one row, however many texts it has: the one with the least hash.
    """
    marked = labels.filter(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = marked.filter(fold() != 0).orderBy(F.xxhash64(F.lit("train"), "doc_id")).limit(rows)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return texts.groupBy("doc_id", "quality").agg(F.min_by("text", F.xxhash64("text")).alias("text"))


def fit(docs: DataFrame, labels: DataFrame, rows: int = 4000) -> Model:
    """Learn from a bounded sample: ``rows`` (documented bound) texts reach the driver, whole.

    Without labelled rows every text scores a half; with one class only, that class is likelier.
    """
    sample = labelled_sample(docs, labels, rows).orderBy("doc_id", "text").toArrow()
    return train(sample.column("text").to_pylist(), sample.column("quality").to_pylist())


def scored(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: whether it is held out, its score and the predicted label.

    Null and empty texts get the score of the bias. A null id is in no fold that is held out.
    """

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype="float64")

    return docs.select(
        "doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), score("text").alias("score")
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
