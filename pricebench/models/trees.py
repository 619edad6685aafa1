"""Forest and boosted trees on log prices.

``rows`` and ``validation_rows`` limit what is read to the first rows; by default all are. A tree without a
depth limit has up to half as many leaves as rows, so the size of a forest is set by ``trees`` and ``rows``;
the fitted trees are kept by the driver, and scoring sends them to the tasks in parts of a bounded size.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricebench.models.base import PriceModel
from pricebench.models.growing import Ensemble, Growth, Task, Tree, grow, poisson, uniform
from pricebench.models.linear import CLASSICAL_FLOOR, with_label
from pricebench.models.sparse import Rows, SparseTable
from pricebench.operators.features import Vectoriser, inverse_target, train_cap, vectors_of
from pricebench.operators.split import first_rows

# The settings of the reference models that decide what is fitted.
FOREST_TREES, FOREST_TERMS, FOREST_LEAST_ROWS = 100, 10_000, 2
BOOST_ROUNDS, BOOST_TERMS, BOOST_DEPTH, BOOST_LEAST_ROWS = 600, 20_000, 8, 4
BOOST_RATE, BOOST_ROW_SHARE, BOOST_TERM_SHARE, BOOST_PATIENCE, BOOST_SHRINK = 0.06, 0.8, 0.6, 40, 1.0

COUNT_LEVELS = np.array([1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128, 192])
SENT_NODES = 1 << 21  # nodes of trees that are sent to the tasks together
ROUNDS_PER_CHECK = 10
ROUNDS_PER_FOLD = 10  # trees that every pass walks through again before their guesses are taken off the targets


def count_levels(values: np.ndarray) -> np.ndarray:
    """Counts up to 4 are levels of their own; above, there are two levels to a doubling."""
    return np.searchsorted(COUNT_LEVELS, values, side="right")


def share_levels(values: np.ndarray) -> np.ndarray:
    """Entries of vectors of length 1: two levels to a halving, 15 in all."""
    return np.clip(15 + np.floor(2 * np.log2(np.maximum(values, 1e-300))), 1, 15).astype(np.int64)


def coded_levels(values: np.ndarray) -> np.ndarray:
    """Values that are levels already."""
    return values.astype(np.int64)


def parts_of(trees: list[Tree], nodes: int = SENT_NODES) -> Iterator[list[Tree]]:
    """Trees in runs of a bounded number of nodes; a larger tree is a run of its own."""
    part, held = [], 0
    for tree in trees:
        if part and held + len(tree) > nodes:
            yield part
            part, held = [], 0
        part.append(tree)
        held += len(tree)
    if part:
        yield part


def _leaf_sum(shared, levels: Callable, terms: int):
    @F.pandas_udf("double")
    def leaves(indices: pd.Series, values: pd.Series) -> pd.Series:
        walk = shared.value
        ends = np.cumsum([len(i) for i in indices])
        flat = [np.concatenate([*side, np.zeros(0)]) for side in (indices, values)]
        rows = Rows(ends, flat[0].astype(np.int64), flat[1], np.zeros(len(ends)), np.zeros(len(ends)), terms)
        return pd.Series(walk.value[walk.leaves(rows, levels(rows.values))].sum(axis=1))

    return leaves


def sum_of_leaves(df: DataFrame, trees: list[Tree], levels: Callable, terms: int, name: str, column: str = "features") -> DataFrame:
    """Add the sum of the values that each row's vector ends at in the trees."""
    entry = F.unwrap_udt(column)
    total = F.lit(0.0)
    for part in parts_of(trees):
        shared = df.sparkSession.sparkContext.broadcast(Ensemble(part))
        total = total + _leaf_sum(shared, levels, terms)(entry["indices"], entry["values"])
    return df.withColumn(name, total)


class TreeModel(PriceModel):
    """The log price is ``base`` and ``factor`` times the sum of the leaves that a text ends in."""

    reads_words = True
    words: PipelineModel
    trees: list[Tree]
    base, factor, terms = 0.0, 1.0, 0
    levels: Callable

    def transform(self, items: DataFrame) -> DataFrame:
        vectors = vectors_of(self.words, items)
        scored = sum_of_leaves(vectors, self.trees, type(self).levels, self.terms, "_sum")
        log_price = F.lit(float(self.base)) + F.lit(float(self.factor)) * F.col("_sum")
        return scored.withColumn("guess", inverse_target(log_price, CLASSICAL_FLOOR)).select(*items.columns, "guess")

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        self.words.write().overwrite().save(f"{path}/words")
        rows = [(i, tree.packed()) for i, tree in enumerate(self.trees)]
        spark.createDataFrame(rows, "number int, packed binary").write.mode("overwrite").parquet(f"{path}/trees")
        rest = [(float(self.base), float(self.factor), int(self.terms))]
        spark.createDataFrame(rest, "base double, factor double, terms int").write.mode("overwrite").parquet(f"{path}/rest")

    def load(self, path: str) -> "TreeModel":
        spark = SparkSession.active()
        self.words = PipelineModel.load(f"{path}/words")
        packed = spark.read.parquet(f"{path}/trees").orderBy("number").toArrow().column("packed").to_pylist()
        self.trees = [Tree.unpacked(p) for p in packed]
        self.base, self.factor, self.terms = spark.read.parquet(f"{path}/rest").first()
        return self


class Forest(TreeModel):
    """The mean of trees, each grown on rows drawn with replacement."""

    display_name = "random forest"
    levels = staticmethod(count_levels)

    def __init__(
        self,
        max_features: int = FOREST_TERMS,
        trees: int = FOREST_TREES,
        rows: int | None = None,
        max_depth: int | None = None,
        stop_words: list[str] | None = None,
    ):
        self.number = trees
        self.rows = rows
        self.max_depth = max_depth
        self.stop_words = stop_words
        self.vectoriser = Vectoriser(max_features, stop_words=stop_words)

    def fit(self, train: DataFrame, validation: DataFrame | None = None) -> "Forest":
        train = train_cap(train, self.rows)
        self.words = self.vectoriser.fit(train).model
        self.terms, self.factor = len(self.vectoriser.terms), 1 / self.number
        growth = Growth(least_rows=FOREST_LEAST_ROWS, depth=self.max_depth)
        task = Task(count_levels, poisson, lambda rows, levels: rows.target, growth)
        with SparseTable(with_label(self.vectoriser.transform(train)), self.terms, key="id") as table:
            self.trees = grow(table, task, list(range(self.number)))
        return self


def rounds_to_keep(losses: list[float], patience: int) -> int:
    """Rounds up to the best one, looking no further than ``patience`` flat rounds."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


class BoostedTrees(TreeModel):
    """Gradient boosting on TF-IDF, one tree a round on what the trees before it leave over.

    With validation rows, their loss is taken after every few rounds; once it has not fallen for ``patience``
    rounds, the trees up to the best round are kept. Nothing is fitted twice.
    """

    display_name = "boosted trees"
    levels = staticmethod(share_levels)

    def __init__(
        self,
        max_features: int = BOOST_TERMS,
        rounds: int = BOOST_ROUNDS,
        max_depth: int = BOOST_DEPTH,
        rows: int | None = None,
        validation_rows: int | None = None,
        patience: int = BOOST_PATIENCE,
        stop_words: list[str] | None = None,
    ):
        self.rounds = rounds
        self.max_depth = max_depth
        self.rows = rows
        self.validation_rows = validation_rows
        self.patience = patience
        self.factor = BOOST_RATE
        self.stop_words = stop_words
        self.vectoriser = Vectoriser(max_features, tfidf=True, stop_words=stop_words)

    def fit(self, train: DataFrame, validation: DataFrame | None = None) -> "BoostedTrees":
        train = train_cap(train, self.rows)
        self.words = self.vectoriser.fit(train).model
        self.terms = len(self.vectoriser.terms)
        held = validation
        if validation is not None and self.validation_rows is not None:
            held = first_rows(validation, self.validation_rows)
        with SparseTable(with_label(self.vectoriser.transform(train)), self.terms, key="id") as table:
            moments = table.moments()
            self.base = float(moments.target / max(moments.n, 1))
            if held is None:
                self._boost(table, None)
            else:
                with SparseTable(with_label(self.vectoriser.transform(held)), self.terms) as check:
                    self._boost(table, check)
        return self

    def _boost(self, table: SparseTable, check: SparseTable | None) -> None:
        self.trees, self.losses = [], []
        growth = Growth(BOOST_LEAST_ROWS, self.max_depth, BOOST_TERM_SHARE, BOOST_SHRINK)
        drawn = lambda keys, tree: (uniform(keys, tree) < BOOST_ROW_SHARE).astype(np.int64)
        base, factor, known = self.base, self.factor, 0  # guesses of ``known`` trees are taken off the targets already
        table = table.coded(share_levels)
        try:
            for number in range(self.rounds):
                walk = Ensemble(self.trees[known:])
                if len(self.trees) - known == ROUNDS_PER_FOLD:
                    table = table.less(lambda rows: factor * walk.value[walk.leaves(rows, coded_levels(rows.values))].sum(axis=1))
                    known, walk = len(self.trees), Ensemble([])

                def left_over(rows: Rows, levels: np.ndarray) -> np.ndarray:
                    return rows.target - base - factor * walk.value[walk.leaves(rows, levels)].sum(axis=1)

                self.trees += grow(table, Task(coded_levels, drawn, left_over, growth), [number])
                if check is not None and (len(self.trees) % ROUNDS_PER_CHECK == 0 or number + 1 == self.rounds):
                    self.losses += self._losses(check, len(self.losses))
                    keep = rounds_to_keep(self.losses, self.patience)
                    if number + 1 == self.rounds or len(self.losses) - keep >= self.patience:
                        self.trees = self.trees[:keep]
                        return
        finally:
            table.let_go()

    def _losses(self, check: SparseTable, done: int) -> list[float]:
        """The mean squared error on validation rows after each round from ``done`` on: one pass."""
        walk, base, factor, rounds = Ensemble(self.trees), self.base, self.factor, len(self.trees)

        def part(rows: Rows, _) -> np.ndarray:
            steps = np.cumsum(walk.value[walk.leaves(rows, share_levels(rows.values))], axis=1)
            error = rows.target[:, None] - base - factor * steps[:, done:]
            return np.append((error**2).sum(axis=0), rows.number)

        sums = check.sum_over(part, np.zeros(0), (rounds - done + 1,))
        return (sums[:-1] / max(sums[-1], 1)).tolist()
