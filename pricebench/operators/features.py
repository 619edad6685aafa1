"""Text and numeric features, as columns and as persistable ML stages."""

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    CountVectorizerModel,
    ElementwiseProduct,
    Normalizer,
    RegexTokenizer,
    SQLTransformer,
    StopWordsRemover,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricebench.functions.order import magnitude_bucket, take_smallest
from pricebench.functions.text import TOKEN
from pricebench.operators.items import item_text
from pricebench.session import write_through

MIN_DOCUMENTS = 2
HASH_BUCKETS = 5_000
# The same rule as items.item_text, in the form a saved pipeline can hold.
TEXT_SQL = "SELECT *, coalesce(nullif(summary, ''), nullif(`full`, ''), title) AS text FROM __THIS__"


def hand_features(items: DataFrame) -> DataFrame:
    """Weight, whether it is missing, text length, and words counted by single spaces."""
    text = item_text()
    spaces = F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))
    return items.withColumns(
        {
            "weight": F.coalesce("weight", F.lit(0.0)),
            "weight_missing": (F.coalesce("weight", F.lit(0.0)) == 0).cast("bigint"),
            "text_length": F.length(text).cast("bigint"),
            "word_count": (spaces + 1).cast("bigint"),
        }
    )


def log_target(price: Column) -> Column:
    return F.log1p(price)


def inverse_target(value: Column, floor: float) -> Column:
    return F.greatest(F.expm1(value), F.lit(float(floor)))


def standardise(df: DataFrame, column: str, name: str) -> DataFrame:
    """(x - mean) / sample standard deviation, both from one scalar subquery."""
    moments = df.agg(
        F.struct(F.avg(column).alias("mean"), F.stddev_samp(column).alias("sd")).alias("m")
    ).scalar()
    return df.withColumn(name, (F.col(column) - moments["mean"]) / moments["sd"])


def train_cap(train: DataFrame, rows: int | None) -> DataFrame:
    """First rows of the training part; its ids start at 0. None keeps all rows."""
    return train if rows is None else train.filter(F.col("id") < rows)


TOKEN_STAGES = 3


def token_stages(stop_words: list[str] | None = None) -> list:
    """Items to ``text`` to ``tokens``: lower case, two word characters or more, no stop words."""
    words = stop_words if stop_words is not None else StopWordsRemover.loadDefaultStopWords("english")
    return [
        SQLTransformer(statement=TEXT_SQL),
        RegexTokenizer(inputCol="text", outputCol="words", pattern=TOKEN, gaps=False, toLowercase=True),
        StopWordsRemover(inputCol="words", outputCol="tokens", stopWords=list(words)),
    ]


def tokenise(items: DataFrame, stop_words: list[str] | None = None) -> DataFrame:
    """Items with their ``tokens``; those that have them already stay as they are."""
    if "tokens" in items.columns:
        return items
    return Pipeline(stages=token_stages(stop_words)).fit(items).transform(items)


def vectors_of(words: PipelineModel, items: DataFrame) -> DataFrame:
    """Items with their ``features``; the stages that make tokens are left out where items have them."""
    stages = words.stages[TOKEN_STAGES:] if "tokens" in items.columns else words.stages
    return PipelineModel(stages).transform(items).select(*items.columns, "features")


def token_counts(tokenised: DataFrame) -> DataFrame:
    """Corpus frequency and document frequency of each term.

    Each document gives all its tokens and then each distinct one once more; the position
    tells them apart. One map-side combined aggregation counts both, so no shuffle is keyed
    by (document, term).
    """
    # The array is made inside the generator: as a column of its own, Spark would first
    # filter on its size and so tokenise every text several times.
    both = F.posexplode(F.concat("tokens", F.array_distinct("tokens"))).alias("_position", "term")
    counted_once = F.col("_position") < F.col("_size")
    return (
        tokenised.select("tokens", F.size("tokens").alias("_size"))
        .select("_size", both)
        .groupBy("term")
        .agg(F.count_if(counted_once).alias("n"), F.count_if(~counted_once).alias("documents"))
    )


def vocabulary(tokenised: DataFrame, size: int, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """The ``size`` most frequent terms found in enough documents; ties by the term.

    The counts are written: finding the cut reads them several times, and texts must be split up once only.
    """
    frequent = write_through(token_counts(tokenised).filter(F.col("documents") >= min_documents), "term-counts")
    start = F.rpad(F.hex(F.substring(F.col("term").cast("binary"), 1, 2)), 4, "0")
    return take_smallest(frequent, size, [F.desc("n"), "term"], -magnitude_bucket(F.col("n")), start)


class Vectoriser:
    """A fitted vocabulary and the stages that turn items into ``features``."""

    def __init__(self, size: int, tfidf: bool = False, stop_words: list[str] | None = None):
        self.size = size
        self.tfidf = tfidf
        self.stop_words = stop_words

    def fit(self, items: DataFrame) -> "Vectoriser":
        tokenised = tokenise(items, self.stop_words)
        rows = vocabulary(tokenised, self.size).toPandas().sort_values(["n", "term"], ascending=[False, True])
        self.terms = rows["term"].tolist()
        if not self.terms:
            raise ValueError("no term occurs in enough documents")
        stages = token_stages(self.stop_words)
        counts = "counts" if self.tfidf else "features"
        stages.append(CountVectorizerModel.from_vocabulary(self.terms, inputCol="tokens", outputCol=counts))
        if self.tfidf:
            # Smoothed and plus one; the rows are brought to length 1 afterwards.
            idf = np.log((1 + items.count()) / (1 + rows["documents"].to_numpy())) + 1
            stages += [
                ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol=counts, outputCol="weighted"),
                Normalizer(p=2.0, inputCol="weighted", outputCol="features"),
            ]
        self.model = PipelineModel(stages)
        return self

    def transform(self, items: DataFrame) -> DataFrame:
        return vectors_of(self.model, items)


def hashing_stages(buckets: int = HASH_BUCKETS, stop_words: list[str] | None = None) -> list:
    """Presence of each hashed token, rows of length 1; no vocabulary to carry around.

    The bucket is the first 32 bits of the token's md5 modulo their number, so that any engine finds the same.
    """
    bucket = f"CAST(CAST(conv(substr(md5(t), 1, 8), 16, 10) AS BIGINT) % {buckets} AS STRING)"
    numbers = [str(i) for i in range(buckets)]
    return token_stages(stop_words) + [
        SQLTransformer(statement=f"SELECT *, transform(tokens, t -> {bucket}) AS buckets FROM __THIS__"),
        CountVectorizerModel.from_vocabulary(numbers, inputCol="buckets", outputCol="hashed").setBinary(True),
        Normalizer(p=2.0, inputCol="hashed", outputCol="features"),
    ]


def vector_entries(df: DataFrame, keys: list[str], column: str = "features") -> DataFrame:
    """Sparse vectors in long form: keys, ``index``, ``value``. No shuffle."""
    entry = F.unwrap_udt(column)
    return df.select(*keys, entry.alias("_v")).select(
        *keys, F.inline(F.arrays_zip(F.col("_v.indices").alias("index"), F.col("_v.values").alias("value")))
    )


def term_entries(df: DataFrame, vectoriser: Vectoriser, keys: list[str]) -> DataFrame:
    """Long form with terms; the vocabulary has a set size, so it may be broadcast."""
    spark = df.sparkSession
    terms = spark.createDataFrame(list(enumerate(vectoriser.terms)), "index int, term string")
    return vector_entries(df, keys).join(F.broadcast(terms), "index").drop("index")
