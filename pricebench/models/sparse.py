"""Sparse rows packed into blocks, and the passes that solvers make over them.

A fit writes its vectors once, as compressed rows of many documents each, and reads them in as many tasks as run
side by side, from the executors' disks: what an executor keeps in memory does not grow with the rows. A pass sends a
small matrix to every task, a panel of columns at a time, and sums what the tasks make of it, so what is
shuffled does not grow with the rows; sums are added up in chunks, so that no task and no row
holds more than a chunk of each. The driver holds matrices of vocabulary by number of columns, both of
which are parameters of the models, never anything that grows with the rows. Small sums of few tasks go to it
straight, behind a check of their size.
"""

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricebench.session import write_through

BLOCK_ENTRIES = 1 << 18  # of a block as it is written and read
JOINED_ENTRIES = 1 << 21  # of the blocks that a pass works on together
PANEL = 5 << 20  # numbers of a matrix that a task holds at a time, and of the sum that it adds to
CHUNK = 1 << 16  # numbers of a sum that travel together
DIRECT_BYTES = 32 << 20  # sums of all tasks that the driver adds up itself; more are added up by tasks


@dataclass
class Rows:
    """Some rows of a sparse matrix: the end of each in ``terms`` and ``values``, one target and one key per row."""

    ends: np.ndarray
    terms: np.ndarray
    values: np.ndarray
    target: np.ndarray
    keys: np.ndarray
    size: int

    @staticmethod
    def of(block: tuple, size: int) -> "Rows":
        ends, terms, values, target, keys = block
        ends = np.frombuffer(ends, "<i8")
        entries = max(int(ends[-1]) if len(ends) else 0, 1)
        terms = np.frombuffer(terms, f"<u{max(len(terms) // entries, 1)}").astype(np.intp)
        values = np.frombuffer(values, VALUE_KINDS[len(values) // entries]).astype(float)
        return Rows(ends, terms, values, np.frombuffer(target, "<f8"), np.frombuffer(keys, "<u8"), size)

    @staticmethod
    def joined(blocks: Iterable[tuple], size: int) -> Iterator["Rows"]:
        """The rows of as many blocks at a time as have ``JOINED_ENTRIES`` together."""
        held: list[Rows] = []
        for block in blocks:
            held.append(Rows.of(block, size))
            if sum(len(rows.terms) for rows in held) >= JOINED_ENTRIES:
                yield Rows.together(held)
                held = []
        if held:
            yield Rows.together(held)

    @staticmethod
    def together(parts: list["Rows"]) -> "Rows":
        if len(parts) == 1:
            return parts[0]
        before = np.cumsum([0, *(len(part.terms) for part in parts)])
        ends = np.concatenate([part.ends + shift for part, shift in zip(parts, before)])
        rest = (np.concatenate([getattr(part, name) for part in parts]) for name in ("terms", "values", "target", "keys"))
        return Rows(ends, *rest, parts[0].size)

    def __post_init__(self):
        self.number = len(self.ends)
        self.row = np.repeat(np.arange(self.number), np.diff(self.ends, prepend=0))

    def times(self, matrix: np.ndarray) -> np.ndarray:
        """X · M for M of (terms, columns)."""
        if matrix.shape[1] == 1:
            return np.bincount(self.row, self.values * matrix[self.terms, 0], self.number)[:, None]
        out = np.zeros((self.number, matrix.shape[1]))
        start = 0
        for at, end in enumerate(self.ends.tolist()):
            out[at] = self.values[start:end] @ matrix[self.terms[start:end]]
            start = end
        return out

    def add_transposed_times(self, matrix: np.ndarray, out: np.ndarray) -> np.ndarray:
        """Add X' · M for M of (rows, columns) to ``out``, one term at a time; no second array of its size is made."""
        if matrix.shape[1] == 1:
            out[:, 0] += np.bincount(self.terms, self.values * matrix[self.row, 0], self.size)
            return out
        short = self.terms.astype(np.uint16 if self.size <= 1 << 16 else np.int64)  # short numbers are sorted by radix
        order = np.argsort(short, kind="stable")
        row, values = self.row[order].astype(np.int32), self.values[order]
        counts = np.bincount(self.terms, minlength=self.size)
        found = np.flatnonzero(counts)
        start = 0
        for term, end in zip(found.tolist(), np.cumsum(counts[found]).tolist()):
            out[term] += values[start:end] @ matrix[row[start:end]]
            start = end
        return out

    def transposed_times(self, matrix: np.ndarray) -> np.ndarray:
        """X' · M for M of (rows, columns)."""
        return self.add_transposed_times(matrix, np.zeros((self.size, matrix.shape[1])))


BLOCKS = "ends binary, terms binary, values binary, target binary, keys binary"
VALUE_KINDS = {0: "<f8", 1: "<u1", 2: "<u2", 8: "<f8"}  # by the bytes of a value


def short_terms(terms: np.ndarray) -> bytes:
    return terms.astype("<u2" if not len(terms) or terms.max() < 1 << 16 else "<u4").tobytes()


def short_values(values: np.ndarray) -> bytes:
    """Small whole numbers in as few bytes as hold all of them, anything else as doubles."""
    if len(values) and values.min() >= 0 and values.max() < 1 << 16 and np.array_equal(values, np.floor(values)):
        return values.astype("<u1" if values.max() < 1 << 8 else "<u2").tobytes()
    return values.astype("<f8").tobytes()


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Indices, values and target of each row to blocks of a bounded number of entries."""
    for batch in batches:
        lengths = pc.list_value_length(batch.column(0)).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        target, keys = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
        start = 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + BLOCK_ENTRIES, "right")))
            terms, values = (
                batch.column(i).slice(start, stop - start).flatten().to_numpy(zero_copy_only=False) for i in (0, 1)
            )
            plain = ((ends[start:stop] - before, "<i8"), (target[start:stop], "<f8"), (keys[start:stop], "<u8"))
            own_ends, own_target, own_keys = (part.astype(kind).tobytes() for part, kind in plain)
            parts = (own_ends, short_terms(terms), short_values(values), own_target, own_keys)
            packed = [pa.array([part], pa.binary()) for part in parts]
            yield pa.record_batch(packed, ["ends", "terms", "values", "target", "keys"])
            start = stop


def blocks_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    for at in range(batch.num_rows):
        yield tuple(memoryview(batch.column(i)[at].as_buffer()) for i in range(batch.num_columns))


class SparseTable:
    """Feature vectors with a target, written once and read by every pass; ``passes`` counts them.

    ``key`` names a column whose hash tells rows apart where a fit draws some of them.
    """

    def __init__(
        self, labelled: DataFrame, size: int, features: str = "features", target: str = "label", key: str | None = None
    ):
        entry = F.unwrap_udt(features)
        places = F.coalesce(entry["indices"], F.sequence(F.lit(0), F.size(entry["values"]) - 1))
        keys = F.lit(0).cast("long") if key is None else F.xxhash64(key)
        vectors = places.alias("indices"), entry["values"].alias("values")
        rows = labelled.select(*vectors, F.col(target).cast("double").alias("target"), keys.alias("key"))
        self.size = size
        self.passes = 0
        self._hold(write_through(rows.mapInArrow(_pack, BLOCKS), "sparse-blocks"))

    def __enter__(self) -> "SparseTable":
        return self

    def __exit__(self, *_) -> None:
        self.let_go()

    def let_go(self) -> None:
        self.held.unpersist()

    def less(self, part: Callable[[Rows], np.ndarray]) -> "SparseTable":
        """The same rows with ``part(rows)`` taken off their targets, written; this table is let go."""
        out = self._with("target", lambda rows: (rows.target - part(rows)).astype("<f8").tobytes())
        out.facts = self.facts
        return out

    def coded(self, levels: Callable[[np.ndarray], np.ndarray]) -> "SparseTable":
        """The same rows with ``levels(values)`` for their values, written; this table is let go."""
        return self._with("values", lambda rows: short_values(levels(rows.values)))

    def _with(self, column: str, made: Callable[[Rows], bytes]) -> "SparseTable":
        size, place = self.size, self.blocks.columns.index(column)

        def renewed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at, block in enumerate(blocks_of(batch)):
                    one = pa.array([made(Rows.of(block, size))], pa.binary())
                    yield batch.slice(at, 1).set_column(place, column, one)

        out = object.__new__(SparseTable)
        out.size, out.passes = size, self.passes + 1
        out._hold(write_through(self.blocks.mapInArrow(renewed, BLOCKS), "sparse-blocks"))
        self.let_go()
        return out

    def _hold(self, written: DataFrame) -> None:
        """Blocks go from the disk to the tasks one by one: nothing of them is kept in memory."""
        parts = max(1, written.sparkSession.sparkContext.defaultParallelism)
        self.blocks = written.coalesce(parts)
        self.facts: dict = {}  # what was found out of the terms and values
        self.held: RDD = self.blocks.rdd.map(lambda row: tuple(map(bytes, row))).persist(StorageLevel.DISK_ONLY)

    def sum_over(
        self,
        part: Callable[..., np.ndarray],
        sent: np.ndarray,
        shape: tuple[int, ...],
        in_place: bool = False,
    ) -> np.ndarray:
        """The sum of ``part(rows, sent)`` over all rows, an array of ``shape``: one pass.

        With ``in_place``, ``part(rows, sent, total)`` adds to the sum itself.
        """
        self.passes += 1
        shared = self.blocks.sparkSession.sparkContext.broadcast(sent)
        size, numbers = self.size, int(np.prod(shape))

        def summed(blocks: Iterator[tuple]) -> Iterator[tuple[int, bytes]]:
            total = None
            for rows in Rows.joined(blocks, size):
                if in_place:
                    total = part(rows, shared.value, np.zeros(shape) if total is None else total)
                else:
                    found = part(rows, shared.value)
                    total = found if total is None else np.add(total, found, out=total)
            if total is not None:
                flat = total.ravel()
                for at in range(0, numbers, CHUNK):
                    yield at // CHUNK, flat[at : at + CHUNK].astype("<f8").tobytes()

        def added(parts: Iterator[tuple[int, bytes]]) -> Iterator[tuple[int, bytes]]:
            totals: dict[int, np.ndarray] = {}
            for chunk, sums in parts:
                found = np.frombuffer(sums, "<f8")
                totals[chunk] = np.add(totals[chunk], found, out=totals[chunk]) if chunk in totals else found.copy()
            for chunk, total in totals.items():
                yield chunk, total.tobytes()

        sums = self.held.mapPartitions(summed)
        if 8 * numbers * self.partitions > DIRECT_BYTES:
            sums = sums.partitionBy(self.partitions).mapPartitions(added)
        out = np.zeros(numbers)
        for chunk, found in sums.collect():
            out[chunk * CHUNK :][: len(found) // 8] += np.frombuffer(found, "<f8")
        shared.destroy()
        return out.reshape(shape)

    @cached_property
    def number(self) -> int:
        """How many rows there are."""
        return self.held.map(lambda block: len(block[-1]) // 8).sum()

    @cached_property
    def partitions(self) -> int:
        return max(1, self.held.getNumPartitions())

    def gram_times(self, matrix: np.ndarray) -> np.ndarray:
        """X'X · M: one pass for each panel of columns."""

        def part(rows: Rows, sent: np.ndarray, total: np.ndarray) -> np.ndarray:
            return rows.add_transposed_times(rows.times(sent), total)

        panels = min(matrix.shape[1], -(-matrix.size // PANEL))
        if panels <= 1:
            return self.sum_over(part, matrix, matrix.shape, in_place=True)
        out, at = np.empty(matrix.shape), 0
        for panel in np.array_split(matrix, panels, axis=1):
            sent = np.ascontiguousarray(panel)
            out[:, at : at + panel.shape[1]] = self.sum_over(part, sent, sent.shape, in_place=True)
            at += panel.shape[1]
        return out

    def moments(self) -> "Moments":
        """Sums over the rows that every linear model needs: one pass."""

        def part(rows: Rows, _) -> np.ndarray:
            out = np.zeros((5, rows.size))
            for i, weights in enumerate((rows.values, rows.values**2, rows.values * rows.target[rows.row])):
                out[i] = np.bincount(rows.terms, weights, rows.size)
            out[3, 0], out[4, 0] = rows.number, rows.target.sum()
            return out

        sums = self.sum_over(part, np.zeros(0), (5, self.size))
        return Moments(sums[0], sums[1], sums[2], sums[3, 0], sums[4, 0])


@dataclass
class Moments:
    """Per term the sum of values, of squares and of products with the target; rows, and the target's sum."""

    sums: np.ndarray
    squares: np.ndarray
    with_target: np.ndarray
    n: float
    target: float

    @property
    def means(self) -> np.ndarray:
        return self.sums / max(self.n, 1)

    @property
    def centred_with_target(self) -> np.ndarray:
        return self.with_target - self.means * self.target
