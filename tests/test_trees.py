"""Trees against a plain recursive version, whatever the partitions and however large nodes are split."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from pricebench.models import growing, trees
from pricebench.models.growing import Ensemble, Growth, Task, Tree, grow, poisson, uniform
from pricebench.models.sparse import Rows, SparseTable


def plain_tree(levels, weight, target, growth, tree, depth=0):
    """Nested (term, level, left, right) or a value; the same rule, one node at a time."""
    total, w = (weight * target).sum(), weight.sum()
    value = total / (w + growth.shrink) * growing.STEP
    allowed = np.flatnonzero(growth.allowed(tree, np.arange(levels.shape[1])))
    best = (0.0, None)
    if growth.depth is None or depth < growth.depth:
        for term in allowed:
            for level in sorted(set(levels[:, term]) - {0}, reverse=True):
                right = levels[:, term] >= level
                if min(right.sum(), (~right).sum()) < growth.least_rows:
                    continue
                parts = sum(
                    (weight[s] * target[s]).sum() ** 2 / (weight[s].sum() + growth.shrink) for s in (right, ~right)
                )
                gain = parts - total**2 / (w + growth.shrink)
                if gain > 1e-10 * parts + 0.5 and gain > best[0] * (1 + 1e-12):
                    best = (gain, (int(term), int(level), right))
    if best[1] is None:
        return value
    term, level, right = best[1]
    sides = [plain_tree(levels[s], weight[s], target[s], growth, tree, depth + 1) for s in (~right, right)]
    return (term, level, *sides)


def nested(tree: Tree, node=0):
    if tree.term[node] == growing.LEAF:
        return float(tree.value[node])
    return (int(tree.term[node]), int(tree.level[node]), nested(tree, tree.left[node]), nested(tree, tree.right[node]))


def walked(tree, row):
    while isinstance(tree, tuple):
        tree = tree[3] if row[tree[0]] >= tree[1] else tree[2]
    return tree


def same(a, b):
    if isinstance(a, tuple) and isinstance(b, tuple):
        return a[:2] == b[:2] and same(a[2], b[2]) and same(a[3], b[3])
    return not isinstance(a, tuple) and not isinstance(b, tuple) and abs(a - b) < 1e-9


def rows_of(spark, number=150, terms=25, seed=0):
    draw = np.random.default_rng(seed)
    counts = draw.poisson(draw.choice([0.1, 0.4, 1.5], terms), (number, terms)).astype(float)
    counts[3], counts[4] = 0, 40
    target = counts[:, 0] - 0.5 * (counts[:, 1] > 0) + draw.normal(size=number)
    data = [(i, Vectors.sparse(terms, {int(j): v[j] for j in np.flatnonzero(v)}), float(t)) for i, (v, t) in enumerate(zip(counts, target))]
    return counts, target, spark.createDataFrame(data, ["id", "features", "label"])


def keys_of(spark, number):
    from pyspark.sql import functions as F

    rows = spark.range(number).select("id", F.xxhash64("id").alias("h")).collect()
    return np.array([r["h"] for r in sorted(rows, key=lambda r: r["id"])], np.int64).view(np.uint64)


GROWTHS = [Growth(), Growth(least_rows=4, depth=3), Growth(3, 6, term_share=0.6, shrink=1.0)]


@pytest.mark.parametrize("growth", GROWTHS, ids=["deep", "shallow", "shrunk"])
@pytest.mark.parametrize("parts, local", [(1, 1 << 15), (5, 1 << 15), (3, 40), (4, 5)])
def test_trees_equal_plain_ones(spark, growth, parts, local):
    """With few local rows the upper nodes are split by sums over tasks; the trees are the same."""
    counts, target, df = rows_of(spark)
    levels, whole, keys = trees.count_levels(counts), growing.whole_steps(target), keys_of(spark, len(target))
    task = Task(trees.count_levels, poisson, lambda rows, _: rows.target, growth)
    with SparseTable(df.repartition(parts), counts.shape[1], key="id") as table:
        found = grow(table, task, [0, 7], local_rows=local)
    for number, tree in zip((0, 7), found):
        weight = poisson(keys, number)
        here = weight > 0
        expected = plain_tree(levels[here], weight[here].astype(float), whole[here], growth, number)
        assert same(nested(tree), expected)
    walk = Ensemble(found)
    rows = sparse_rows(counts)
    ends = walk.leaves(rows, trees.count_levels(rows.values))
    assert np.allclose(walk.value[ends], [[walked(nested(t), row) for t in found] for row in levels])


def sparse_rows(counts):
    row, term = np.nonzero(counts)
    ends = np.cumsum(np.bincount(row, minlength=len(counts)))
    return Rows(ends, term, counts[row, term], np.zeros(len(counts)), np.zeros(len(counts)), counts.shape[1])


def test_large_nodes_in_several_passes(spark, monkeypatch):
    counts, target, df = rows_of(spark, seed=3)
    task = Task(trees.count_levels, poisson, lambda rows, _: rows.target, Growth())
    with SparseTable(df.repartition(2), counts.shape[1], key="id") as table:
        expected = [nested(t) for t in grow(table, task, [1, 2, 3])]
        monkeypatch.setattr(growing, "HISTOGRAM", 1)
        found = [nested(t) for t in grow(table, task, [1, 2, 3], local_rows=30)]
    assert all(map(same, found, expected))


def test_no_rows_and_equal_targets(spark):
    _, _, df = rows_of(spark, number=20)
    task = Task(trees.count_levels, poisson, lambda rows, _: np.full(rows.number, 2.5), Growth())
    with SparseTable(df, 25, key="id") as table:
        assert [nested(t) for t in grow(table, task, [0])] == [pytest.approx(2.5, abs=1e-5)]
    with SparseTable(df.limit(0), 25, key="id") as table:
        assert [nested(t) for t in grow(table, task, [0])] == [0.0]


def test_three_boosting_rounds_by_hand(spark):
    counts, target, df = rows_of(spark, seed=5)
    shares = counts / np.maximum(np.linalg.norm(counts, axis=1, keepdims=True), 1e-300)
    data = [(i, Vectors.sparse(25, {int(j): v[j] for j in np.flatnonzero(v)}), float(t)) for i, (v, t) in enumerate(zip(shares, target))]
    df = spark.createDataFrame(data, ["id", "features", "label"])
    model = trees.BoostedTrees(rounds=3, max_depth=4)
    with SparseTable(df.repartition(3), 25, key="id") as table, SparseTable(df, 25) as check:
        moments = table.moments()
        model.base = float(moments.target / moments.n)
        model.rounds, model.patience = 3, 10
        model._boost(table, None)
        losses = model._losses(check, 0)
    levels = np.where(shares > 0, trees.share_levels(shares), 0)
    growth = Growth(trees.BOOST_LEAST_ROWS, 4, trees.BOOST_TERM_SHARE, trees.BOOST_SHRINK)
    keys, guess = keys_of(spark, len(target)), np.full(len(target), target.mean())
    for number in range(3):
        drawn = uniform(keys, number) < trees.BOOST_ROW_SHARE
        left = growing.whole_steps(target - guess)
        expected = plain_tree(levels[drawn], np.ones(drawn.sum()), left[drawn], growth, number)
        assert same(nested(model.trees[number]), expected)
        guess += trees.BOOST_RATE * np.array([walked(expected, row) for row in levels])
        assert losses[number] == pytest.approx(((target - guess) ** 2).mean())


def test_draws():
    keys = np.random.default_rng(0).integers(0, 1 << 63, 200_000).astype(np.uint64)
    times = poisson(keys, 3)
    assert abs(times.mean() - 1) < 0.01 and abs(times.var() - 1) < 0.02 and abs((times == 0).mean() - np.exp(-1)) < 0.005
    assert np.array_equal(times, poisson(keys, 3)) and abs(np.corrcoef(times, poisson(keys, 4))[0, 1]) < 0.01
    assert abs(uniform(keys, 9).mean() - 0.5) < 0.003


def test_levels():
    assert trees.count_levels(np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 1000])).tolist() == [0, 1, 2, 3, 4, 4, 5, 5, 6, 15]
    assert trees.share_levels(np.array([1.0, 0.8, 0.7, 0.5, 0.49, 1e-9])).tolist() == [15, 14, 13, 13, 12, 1]


def test_trees_are_sent_in_parts():
    sizes = [3, 3, 9, 1, 1]
    made = [Tree(*(np.zeros(n, int) for _ in range(4)), np.zeros(n)) for n in sizes]
    assert [[len(t) for t in part] for part in trees.parts_of(made, 6)] == [[3, 3], [9], [1, 1]]


def test_packed_trees_come_back():
    tree = Tree(np.array([4, -1, -1]), np.array([2, 0, 0]), np.array([1, 0, 0]), np.array([2, 0, 0]), np.array([0.5, -1.0, 2.0]))
    back = Tree.unpacked(tree.packed())
    assert nested(back) == nested(tree) == (4, 2, -1.0, 2.0)
    assert nested(tree.grafted(2, back)) == (4, 2, -1.0, (4, 2, -1.0, 2.0))
