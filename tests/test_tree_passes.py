"""How often the growth of trees reads the rows, and what it need not look at."""

import numpy as np
from pyspark.ml.linalg import Vectors

from pricebench.models import growing, trees
from pricebench.models.growing import Ensemble, Growth, Task, Tree, grow
from pricebench.models.sparse import Rows, SparseTable


def test_one_pass_for_a_level_of_large_nodes(spark):
    """The rows of a child are known from the split of its parent; codes are found once for a table."""
    rows = [(i, Vectors.dense([i % 2 + 0.0, i // 2 % 2 + 0.0, i // 4 % 2 + 0.0]), 4.0 * (i % 2) + 2 * (i // 2 % 2) + i // 4 % 2) for i in range(64)]
    task = Task(trees.count_levels, lambda keys, _: np.ones(len(keys), np.int64), lambda rows, _: rows.target, Growth(depth=3))
    with SparseTable(spark.createDataFrame(rows, ["id", "features", "label"]).repartition(3), 3, key="id") as table:
        tree = grow(table, task, [0], local_rows=10)[0]
        assert table.passes == 4 and len(tree) == 15  # the codes, then three levels
        grow(table, task, [0], local_rows=10)
        assert table.passes == 7


def test_levels_are_written_once(spark):
    rows = [(i, Vectors.sparse(4, {i % 4: 0.1 + i / 30}), float(i)) for i in range(20)]
    with SparseTable(spark.createDataFrame(rows, ["id", "features", "label"]), 4, key="id") as table:
        sums = np.zeros(4)
        for i in range(20):
            sums[i % 4] += trees.share_levels(np.array([0.1 + i / 30]))[0]
        with table.coded(trees.share_levels) as coded:
            assert np.array_equal(coded.moments().sums, sums) and coded.moments().target == sum(range(20))


def test_rows_are_spread_over_the_terms_asked_for_alone():
    tree = Tree(np.array([5, -1, 90, -1, -1]), np.array([2, 0, 1, 0, 0]), np.array([1, 0, 3, 0, 0]), np.array([2, 0, 4, 0, 0]), np.arange(5.0))
    walk = Ensemble([tree, growing.single_leaf()])
    assert walk.asked.tolist() == [5, 90]
    ends, terms, values = np.array([0, 1, 3, 5]), np.array([5, 5, 90, 7, 90]), np.array([1, 2, 1, 3, 1])
    rows = Rows(ends, terms, values, np.zeros(4), np.zeros(4), 100)
    assert walk.leaves(rows, values).tolist() == [[0 + 1, 5], [1, 5], [4, 5], [1, 5]]
    assert Ensemble([growing.single_leaf()]).leaves(rows, values).tolist() == [[0]] * 4


def test_terms_in_too_few_rows_of_a_node():
    of, code = np.array([0, 0, 0, 1, 1]), np.array([16, 17, 40, 17, 40])
    assert growing._in_enough_rows(of, code, np.array([1, 1, 1, 1, 2]), 2).tolist() == [True, True, False, False, True]
    assert len(growing._in_enough_rows(of[:0], code[:0], of[:0], 2)) == 0
