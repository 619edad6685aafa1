"""Blocks read in few tasks, products that add in place, vocabularies from one reading of the texts."""

import numpy as np
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from pricebench.models.sparse import Rows, SparseTable
from pricebench.operators.features import vocabulary


def test_blocks_are_read_in_as_many_tasks_as_run_at_once(spark):
    """However many files hold the blocks; every task sends a matrix of its own to be added up."""
    rows = [(i, Vectors.sparse(5, {i % 5: 1.0 + i}), float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, ["id", "features", "label"]).repartition(30)
    settings = {"spark.sql.files.maxPartitionBytes": "1", "spark.sql.files.openCostInBytes": "1"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        with SparseTable(df, 5, key="id") as table:
            assert table.blocks.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
            assert table.number == 60 and table.moments().target == sum(range(60))
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_products_add_to_what_is_there():
    rng = np.random.default_rng(2)
    x = np.where(rng.random((9, 12)) < 0.4, rng.normal(size=(9, 12)), 0.0)
    x[[0, 4]] = 0
    row, term = np.nonzero(x)
    ends = np.cumsum(np.bincount(row, minlength=9))
    rows = Rows(ends, term, x[row, term], np.zeros(9), np.zeros(9), 12)
    for columns in (1, 3):
        matrix, there = rng.normal(size=(9, columns)), rng.normal(size=(12, columns))
        wanted = there + x.T @ matrix
        assert rows.add_transposed_times(matrix, there) is there and np.allclose(there, wanted)


def test_texts_are_split_up_once_for_a_vocabulary(spark):
    read = spark.sparkContext.accumulator(0)

    @F.pandas_udf("array<string>")
    def watched(text):
        read.add(len(text))
        return text.str.split(" ")

    texts = spark.createDataFrame([(f"a b{i % 7} c{i % 11} d",) for i in range(40)], ["text"]).repartition(3)
    found = vocabulary(texts.select(watched("text").alias("tokens")), 12)
    assert len(found.collect()) == 12 and found.count() == 12
    assert read.value == 40
