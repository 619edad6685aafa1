"""Linear models on log prices.

``rows`` limits training to the first rows; by default a model learns from all of them.
"""

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricebench.models.base import PipelinePriceModel, PriceModel
from pricebench.models.sparse import Rows, SparseTable
from pricebench.operators.features import (
    Vectoriser,
    hashing_stages,
    inverse_target,
    log_target,
    train_cap,
    vectors_of,
)

STEPS, TOLERANCE = 2_000, 1e-6
RANK, RANGE_ROUNDS = 320, 2  # leading eigenvectors that a ridge fit solves for directly
EXTRA_COLUMNS, SVD_ROUNDS = 20, 9
PENALTIES = tuple(10 ** (1 - i / 2) for i in range(9))
BLOCK = 1 << 22  # numbers gathered at once by a projection
CLASSICAL_FLOOR = 0.5
HAND_FEATURES = ["weight_value", "weight_missing", "text_length", "word_count"]
HAND_SQL = """
SELECT *, coalesce(weight, 0D) AS weight_value,
       CAST(coalesce(weight, 0D) = 0 AS INT) AS weight_missing,
       length(text) AS text_length,
       length(text) - length(replace(text, ' ', '')) + 1 AS word_count
FROM (SELECT *, coalesce(nullif(summary, ''), nullif(`full`, ''), title) AS text FROM __THIS__)
"""


def guess_stage(mean: float = 0.0, sd: float = 1.0, floor: float = CLASSICAL_FLOOR) -> SQLTransformer:
    """Back from the (standardised) log price to dollars, kept inside the saved pipeline."""
    return SQLTransformer(
        statement=f"SELECT *, greatest(expm1(prediction * {sd!r}D + {mean!r}D), {floor!r}D) AS guess FROM __THIS__"
    )


def with_label(items: DataFrame) -> DataFrame:
    return items.withColumn("label", log_target(F.col("price")))


def orthonormal(matrix: np.ndarray) -> np.ndarray:
    """Orthonormal columns that span the same space.

    Twice by the eigenvectors of the products of the columns, which costs little; by reflections where the
    columns depend on each other too much for that.
    """
    found = matrix / np.maximum(np.linalg.norm(matrix, axis=0), 1e-300)
    for _ in range(2):
        values, turn = np.linalg.eigh(found.T @ found)
        if values[0] <= 1e-13 * values[-1]:
            return np.linalg.qr(matrix)[0]
        found = found @ (turn / np.sqrt(values))
    return found


def leading_space(times, size: int, width: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues and unit vectors of a symmetric matrix of which only products are known.

    A random block of ``width`` columns is multiplied ``rounds`` times and made orthonormal in between; then
    the matrix is solved inside the space that the block spans. Each product is one pass, so ``rounds`` + 1
    passes in all. The seed is fixed.
    """
    block = orthonormal(np.random.default_rng(0).standard_normal((size, width)))
    for _ in range(rounds):
        block = orthonormal(times(block))
    inner = block.T @ times(block)
    values, turn = np.linalg.eigh((inner + inner.T) / 2)
    return np.maximum(values[::-1], 0), block @ turn[:, ::-1]


def ridge(table: SparseTable, alpha: float, tolerance: float = TOLERANCE, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights and intercept that minimise |y - Xw|² + alpha |w|² with a free intercept.

    Conjugate gradients on the centred normal equations. The leading eigenvectors are found first and
    solved for directly by the preconditioner (all of them if there are at most ``RANK`` terms), so that what is
    left to the steps is the flat part of the spectrum. Each step is one pass. It stops when the residual
    has fallen to ``tolerance`` of the right side; a fit that does not get there raises.
    """
    moments = table.moments()
    means, n = moments.means, moments.n

    def times(block: np.ndarray) -> np.ndarray:
        return table.gram_times(block) - n * np.outer(means, means @ block)

    width = min(RANK, table.size)
    values, vectors = leading_space(times, table.size, width, RANGE_ROUNDS if width < table.size else 0)
    damping = (values[-1] + alpha) / (values + alpha) - 1

    def precondition(residual: np.ndarray) -> np.ndarray:
        return residual + vectors @ (damping * (vectors.T @ residual))

    right = moments.centred_with_target
    weights, residual, direction, before = np.zeros(table.size), right.copy(), np.zeros(table.size), 1.0
    goal = tolerance * np.linalg.norm(right)
    for _ in range(steps):
        if np.linalg.norm(residual) <= goal:
            return weights, float(moments.target / max(n, 1) - means @ weights)
        steered = precondition(residual)
        along = residual @ steered
        direction = steered + along / before * direction
        image = times(direction[:, None])[:, 0] + alpha * direction
        step = along / (direction @ image)
        weights, residual, before = weights + step * direction, residual - step * image, along
    raise RuntimeError(f"ridge regression has not settled within {steps} steps")


class HandFeatureRegression(PipelinePriceModel):
    """Least squares on four hand-built features."""

    display_name = "linear (features)"

    def fit(self, train: DataFrame, validation: DataFrame | None = None) -> "HandFeatureRegression":
        stages = [
            SQLTransformer(statement=HAND_SQL),
            VectorAssembler(inputCols=HAND_FEATURES, outputCol="features"),
            LinearRegression(regParam=0.0, solver="normal"),
            guess_stage(),
        ]
        self.model = Pipeline(stages=stages).fit(with_label(train))
        return self


class WordWeights(PriceModel):
    """A weight per term: the standardised log price is their sum over a text, and an intercept."""

    reads_words = True
    words: PipelineModel
    weights: np.ndarray
    intercept: float
    mean, sd, floor = 0.0, 1.0, CLASSICAL_FLOOR

    def transform(self, items: DataFrame) -> DataFrame:
        vectors = vectors_of(self.words, items)
        scored = project(vectors, self.weights[:, None], "_sum")
        log_price = (vector_to_array("_sum")[0] + self.intercept) * self.sd + self.mean
        return scored.withColumn("guess", inverse_target(log_price, self.floor)).select(*items.columns, "guess")

    def save(self, path: str) -> None:
        """The words as a pipeline; next to them one row per term, and one with the rest."""
        spark = SparkSession.active()
        self.words.write().overwrite().save(f"{path}/words")
        rows = pd.DataFrame({"term": range(len(self.weights)), "weight": self.weights})
        spark.createDataFrame(rows).write.mode("overwrite").parquet(f"{path}/weights")
        rest = [(float(self.intercept), float(self.mean), float(self.sd), float(self.floor))]
        spark.createDataFrame(rest, "intercept double, mean double, sd double, floor double").write.mode(
            "overwrite"
        ).parquet(f"{path}/rest")

    def load(self, path: str) -> "WordWeights":
        spark = SparkSession.active()
        self.words = PipelineModel.load(f"{path}/words")
        self.weights = spark.read.parquet(f"{path}/weights").orderBy("term").toPandas()["weight"].to_numpy()
        self.intercept, self.mean, self.sd, self.floor = spark.read.parquet(f"{path}/rest").first()
        return self


class WordCountRidge(WordWeights):
    """Ridge on word counts."""

    display_name = "linear (bag of words)"

    def __init__(
        self,
        max_features: int = 20_000,
        rows: int | None = None,
        alpha: float = 1.0,
        stop_words: list[str] | None = None,
    ):
        self.rows = rows
        self.alpha = alpha
        self.stop_words = stop_words
        self.vectoriser = Vectoriser(max_features, stop_words=stop_words)

    def fit(self, train: DataFrame, validation: DataFrame | None = None) -> "WordCountRidge":
        train = train_cap(train, self.rows)
        self.words = self.vectoriser.fit(train).model
        with SparseTable(with_label(self.vectoriser.transform(train)), len(self.vectoriser.terms)) as table:
            self.weights, self.intercept = ridge(table, self.alpha)
        return self


def truncated_svd(table: SparseTable, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Singular values and right singular vectors of an uncentred sparse matrix, from ``SVD_ROUNDS`` + 1 passes."""
    width = min(k + EXTRA_COLUMNS, table.size)
    squares, basis = leading_space(table.gram_times, table.size, width, SVD_ROUNDS if width < table.size else 0)
    return np.sqrt(squares[:k]), basis[:, :k]


def project(df: DataFrame, basis: np.ndarray, name: str, column: str = "features") -> DataFrame:
    """Add ``x · V`` as a dense vector; each executor gets the basis once, as a broadcast."""
    shared = df.sparkSession.sparkContext.broadcast(basis)
    width = basis.shape[1]

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def times_basis(indices: pd.Series, values: pd.Series) -> pd.Series:
        ends = np.cumsum([0, *map(len, indices)])
        out, start = np.zeros((len(indices), width)), 0
        while start < len(out):
            # So many rows at once that the gathered basis rows stay within a block.
            stop = max(start + 1, int(np.searchsorted(ends, ends[start] + BLOCK // width, "right")) - 1)
            starts = ends[start:stop] - ends[start]
            filled = np.flatnonzero(np.diff(ends[start : stop + 1]))
            if len(filled):
                weights = np.concatenate(list(values[start:stop]))[:, None]
                gathered = shared.value[np.concatenate(list(indices[start:stop]))] * weights
                out[start + filled] = np.add.reduceat(gathered, starts[filled], axis=0)
            start = stop
        return pd.Series(list(out))

    entry = F.unwrap_udt(column)
    return df.withColumn(name, array_to_vector(times_basis(entry["indices"], entry["values"])))


class SvdRidge(WordWeights):
    """Ridge on TF-IDF reduced by a truncated SVD."""

    display_name = "svd + ridge"

    def __init__(
        self,
        components: int = 300,
        max_features: int = 40_000,
        rows: int | None = None,
        alpha: float = 1.0,
        stop_words: list[str] | None = None,
    ):
        self.components = components
        self.rows = rows
        self.alpha = alpha
        self.stop_words = stop_words
        self.vectoriser = Vectoriser(max_features, tfidf=True, stop_words=stop_words)

    def fit(self, train: DataFrame, validation: DataFrame | None = None) -> "SvdRidge":
        """The normal equations of the reduced rows follow from the singular values and the term sums.

        So no reduced row is ever made, and the ridge weights become weights of terms.
        """
        train = train_cap(train, self.rows)
        self.words = self.vectoriser.fit(train).model
        size = len(self.vectoriser.terms)
        with SparseTable(with_label(self.vectoriser.transform(train)), size) as table:
            self.values, self.basis = truncated_svd(table, max(1, min(self.components, size - 1)))
            moments = table.moments()
        means = self.basis.T @ moments.means
        normal = np.diag(self.values**2 + self.alpha) - moments.n * np.outer(means, means)
        strength, turn = np.linalg.eigh(normal)
        reduced = turn @ (turn.T @ (self.basis.T @ moments.centred_with_target) / strength)
        self.weights = self.basis @ reduced
        self.intercept = float(moments.target / max(moments.n, 1) - means @ reduced)
        return self

    def reduce(self, items: DataFrame) -> DataFrame:
        vectors = vectors_of(self.words, items)
        return project(vectors, self.basis, "reduced").drop("features")

    def save(self, path: str) -> None:
        super().save(path)
        rows = pd.DataFrame({"term": range(len(self.basis)), "loadings": list(self.basis)})
        SparkSession.active().createDataFrame(rows).write.mode("overwrite").parquet(f"{path}/basis")

    def load(self, path: str) -> "SvdRidge":
        super().load(path)
        rows = SparkSession.active().read.parquet(f"{path}/basis").orderBy("term").toPandas()
        self.basis = np.vstack(rows["loadings"])
        return self


def smooth_l1(residual: np.ndarray) -> np.ndarray:
    """Half the square up to 1, straight beyond."""
    size = np.abs(residual)
    return np.where(size < 1, residual**2 / 2, size - 0.5)


class HuberLoss:
    """The mean smooth L1 loss on standardised features, and a penalty on the squared weights.

    Parameters are one weight per standardised feature, then the intercept. Every call is one pass.
    """

    def __init__(self, table: SparseTable):
        moments = table.moments()
        self.table, self.n, self.means = table, max(moments.n, 1.0), moments.means
        spread = np.sqrt(np.maximum(moments.squares / self.n - self.means**2, 0))
        self.scale = np.divide(1, spread, out=np.zeros_like(spread), where=spread > 1e-12)  # constant ones weigh 0

    def plain(self, parameters: np.ndarray) -> tuple[np.ndarray, float]:
        """Weights and intercept for features as they come."""
        weights = parameters[:-1] * self.scale
        return weights, float(parameters[-1] - self.means @ weights)

    def __call__(self, parameters: np.ndarray, penalty: float) -> tuple[float, np.ndarray]:
        """Loss and gradient."""
        weights, intercept = self.plain(parameters)

        def part(rows: Rows, sent: np.ndarray) -> np.ndarray:
            residual = rows.target - rows.times(sent[:-1, None])[:, 0] - sent[-1]
            pull = np.clip(residual, -1, 1)
            return np.concatenate([rows.transposed_times(pull[:, None])[:, 0], [pull.sum(), smooth_l1(residual).sum()]])

        sums = self.table.sum_over(part, np.append(weights, intercept), (self.table.size + 2,)) / self.n
        slope = penalty * parameters[:-1] - (sums[:-2] - self.means * sums[-2]) * self.scale
        return float(sums[-1] + penalty / 2 * parameters[:-1] @ parameters[:-1]), np.append(slope, -sums[-2])


def descend(loss, start: np.ndarray, steps: int, tolerance: float = 1e-6) -> np.ndarray:
    """The least value by limited-memory BFGS from ``start``, until a step gains less than ``tolerance`` of it."""
    at = start
    value, slope = loss(at)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        turned, kept = slope.copy(), []
        for moved, changed in reversed(pairs):
            share = (moved @ turned) / (moved @ changed)
            turned -= share * changed
            kept.append(share)
        if pairs:
            moved, changed = pairs[-1]
            turned *= (moved @ changed) / (changed @ changed)
        for (moved, changed), share in zip(pairs, reversed(kept)):
            turned += (share - (changed @ turned) / (moved @ changed)) * moved
        size, descent = 1.0, slope @ turned
        while True:
            there = at - size * turned
            value_there, slope_there = loss(there)
            if value_there <= value - 1e-4 * size * descent or size < 1e-6:
                break
            size /= 2
        moved, changed = there - at, slope_there - slope
        if moved @ changed > 1e-12 * (changed @ changed):
            pairs = [*pairs[-9:], (moved, changed)]
        gained = value - value_there
        if value_there > value:
            return at
        at, value, slope = there, value_there, slope_there
        if gained <= tolerance * max(abs(value), 1e-12):
            return at
    return at


class HashedHuber(WordWeights):
    """Robust regression of the standardised log price on hashed words.

    The squared-then-straight loss, the target and the floor of 0 are those of a small network over the same
    features. The penalty is chosen while fitting: a path from strong to weak ones, each started where the one
    before ended, is walked until the error in dollars on validation rows has not fallen for ``patience`` steps.
    ``path`` keeps these errors, ``validation_mae`` the least. Without validation rows a tenth of the training
    rows, by a hash of their id, takes their part.
    """

    display_name = "hashed + huber"

    def __init__(
        self,
        buckets: int = 5_000,
        rows: int | None = None,
        penalties: tuple[float, ...] = PENALTIES,
        patience: int = 2,
        max_iter: int = 100,
        stop_words: list[str] | None = None,
    ):
        self.buckets = buckets
        self.rows = rows
        self.penalties = penalties
        self.patience = patience
        self.max_iter = max_iter
        self.stop_words = stop_words
        self.floor = 0.0

    def fit(self, train: DataFrame, validation: DataFrame | None = None) -> "HashedHuber":
        train = train_cap(train, self.rows)
        if validation is None:
            tenth = F.pmod(F.xxhash64(F.lit("validation"), "id"), F.lit(10)) == 0
            train, validation = train.filter(~tenth), train.filter(tenth)
        self.words = PipelineModel(hashing_stages(self.buckets, self.stop_words))
        target = log_target(F.col("price"))
        moments = train.agg(F.avg(target).alias("mean"), F.stddev_samp(target).alias("sd")).first()
        self.mean, self.sd = moments["mean"], moments["sd"] or 1.0
        labelled = vectors_of(self.words, train).select("features", ((target - self.mean) / self.sd).alias("label"))
        held = vectors_of(self.words, validation).select("features", F.col("price").alias("label"))
        with SparseTable(labelled, self.buckets) as table, SparseTable(held, self.buckets) as check:
            loss, at = HuberLoss(table), np.zeros(self.buckets + 1)
            self.path: list[tuple[float, float]] = []
            self.validation_mae = np.inf
            for penalty in self.penalties:
                at = descend(lambda parameters: loss(parameters, penalty), at, self.max_iter)
                weights, intercept = loss.plain(at)
                error = self._error(check, weights, intercept)
                self.path.append((penalty, error))
                if error < self.validation_mae:
                    best = len(self.path)
                    self.validation_mae, self.weights, self.intercept = error, weights, intercept
                elif len(self.path) - best >= self.patience:
                    break
        return self

    def _error(self, check: SparseTable, weights: np.ndarray, intercept: float) -> float:
        """The mean absolute error in dollars; without any row, 0."""
        mean, sd, floor = self.mean, self.sd, self.floor

        def part(rows: Rows, sent: np.ndarray) -> np.ndarray:
            log_price = (rows.times(sent[:-1, None])[:, 0] + sent[-1]) * sd + mean
            guess = np.maximum(np.expm1(log_price), floor)
            return np.array([np.abs(guess - rows.target).sum(), rows.number])

        total, n = check.sum_over(part, np.append(weights, intercept), (2,))
        return float(total / max(n, 1))
