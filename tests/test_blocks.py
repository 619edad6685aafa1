"""Blocks on disk in short numbers, matrices sent in panels of columns."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from pricebench.models import sparse
from pricebench.models.sparse import Rows, SparseTable


def table_of(spark, x, y, parts=3):
    rows = [(i, Vectors.sparse(x.shape[1], {int(j): v[j] for j in np.flatnonzero(v)}), float(t)) for i, (v, t) in enumerate(zip(x, y))]
    return SparseTable(spark.createDataFrame(rows, ["id", "features", "label"]).repartition(parts), x.shape[1], key="id")


def test_blocks_are_kept_on_disk_alone(spark):
    """What an executor keeps in memory must not grow with the rows."""
    x = np.eye(6)
    with table_of(spark, x, np.arange(6.0)) as table:
        assert table.number == 6
        levels = [info.storageLevel() for info in spark.sparkContext._jsc.sc().getRDDStorageInfo()]
        assert levels and not any(level.useMemory() for level in levels)


def test_a_matrix_is_sent_in_panels(spark, monkeypatch):
    """No task holds more numbers of a matrix, or of its sum, than a panel has."""
    rng = np.random.default_rng(4)
    x = np.where(rng.random((40, 30)) < 0.3, rng.normal(size=(40, 30)), 0.0)
    matrix = rng.normal(size=(30, 7))
    monkeypatch.setattr(sparse, "PANEL", 60)
    with table_of(spark, x, np.zeros(40)) as table:
        assert np.allclose(table.gram_times(matrix), x.T @ (x @ matrix))
        assert table.passes == 4  # two columns at a time
        assert np.allclose(table.gram_times(matrix[:, :1]), x.T @ (x @ matrix[:, :1])) and table.passes == 5


@pytest.mark.parametrize("joined", [1, 50, 1 << 21])
def test_short_numbers_come_back(spark, monkeypatch, joined):
    """Counts, large counts, negative values and fractions, joined in blocks of any size."""
    rng = np.random.default_rng(5)
    x = rng.poisson(0.5, (45, 20)).astype(float)
    y = rng.normal(size=45)
    monkeypatch.setattr(sparse, "JOINED_ENTRIES", joined)
    for change in (1.0, 300.0, 70_000.0, -1.0, 0.5):
        x[3, 4] = change
        with table_of(spark, x, y) as table:
            moments = table.moments()
            assert np.allclose(moments.sums, x.sum(axis=0)) and np.allclose(moments.with_target, x.T @ y)


def test_bytes_of_a_value():
    sizes = [len(sparse.short_values(np.array([3.0, high]))) // 2 for high in (255.0, 256.0, 65_535.0, 65_536.0, -1.0, 0.5, np.nan)]
    assert sizes == [1, 2, 2, 8, 8, 8, 8]
    assert [len(sparse.short_terms(np.array([3, high]))) // 2 for high in (65_535, 65_536)] == [2, 4]


def test_rows_of_a_table_of_many_terms():
    ends = np.array([0, 2], "<i8")
    block = tuple(part.tobytes() for part in (ends, np.array([1, 70_000], "<u4"), np.array([2, 9], "<u1"), np.zeros(2), ends))
    rows = Rows.of(block, 80_000)
    assert rows.terms.tolist() == [1, 70_000] and rows.values.tolist() == [2.0, 9.0] and rows.row.tolist() == [1, 1]
