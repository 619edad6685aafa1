"""Large nodes grown by the sums of their smaller part; targets less the guesses so far."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from pricebench.models import growing, trees
from pricebench.models.sparse import SparseTable


@pytest.mark.parametrize("growth", [growing.Growth(), growing.Growth(4, 5, 0.6, 1.0)], ids=["deep", "shallow"])
@pytest.mark.parametrize("entries", [0, 100])
def test_large_nodes_have_the_same_trees(monkeypatch, growth, entries):
    """One node at a time, its larger part by subtraction, against all nodes of a level at once."""
    rng = np.random.default_rng(3)
    levels = np.minimum(rng.poisson(rng.choice([0.02, 0.1, 0.7], 30), (300, 30)), 15)
    levels[:5] = 0
    row, term = np.nonzero(levels)
    code = growing.falling(term, levels[row, term])
    weight, target = rng.integers(1, 4, 300), growing.whole_steps(levels[:, 0] + rng.normal(size=300))

    def nested(tree, node=0):
        if tree.term[node] == growing.LEAF:
            return float(tree.value[node])
        return (int(tree.term[node]), int(tree.level[node]), nested(tree, tree.left[node]), nested(tree, tree.right[node]))

    level_by_level = growing.grow_here(row, code, weight, target, 2, growth)
    monkeypatch.setattr(growing, "LEVEL_ENTRIES", entries)
    assert nested(growing.grow_here(row, code, weight, target, 2, growth)) == nested(level_by_level)
    assert len(level_by_level) > 20


def test_guesses_are_taken_off_the_targets(spark):
    rows = [(i, Vectors.sparse(5, {i % 5: 1.0 + i}), float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, ["id", "features", "label"]).repartition(3)
    with SparseTable(df, 5, key="id") as table:
        sums = table.moments().sums
        with table.less(lambda rows: rows.target / 2) as left:
            assert left.number == 60 and left.moments().target == sum(range(60)) / 2
            assert np.allclose(left.moments().sums, sums)


def test_boosting_is_the_same_however_often_targets_are_renewed(spark, monkeypatch):
    rng = np.random.default_rng(7)
    counts = rng.poisson(0.6, (90, 8))
    rows = [(i, Vectors.dense(v / max(np.linalg.norm(v), 1)), float(v[0] + rng.normal())) for i, v in enumerate(counts)]
    df = spark.createDataFrame(rows, ["id", "features", "label"]).repartition(3)

    def fitted(every):
        monkeypatch.setattr(trees, "ROUNDS_PER_FOLD", every)
        model = trees.BoostedTrees(rounds=5, max_depth=3)
        with SparseTable(df, 8, key="id") as table:
            model._boost(table, None)
        return model.trees

    often, never = fitted(2), fitted(100)
    assert len(often) == len(never) == 5
    for a, b in zip(often, never):
        assert np.array_equal(a.term, b.term) and np.array_equal(a.level, b.level) and np.allclose(a.value, b.value, atol=1e-9)
