"""Best-fit packing by large-item matching, planned on counts of lengths.

How many pieces there are of each length says all that a packing needs, and there are at most
``capacity`` lengths however large the corpus is. So the plan is made on those counts: pieces above a
third of the capacity are matched greedily in pairs, smaller ones go best fit into the gaps. Spark then
gives every piece its rank among the pieces of its length, which the plan maps to a sequence and an offset.
"""

import base64
import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricebench.llm.tables import ranked_in
from pricebench.session import write_through

CAPACITY = 2048
PLAN = "length int, first long, last long, sequence long, offset long"
PIECES = "piece int, start long, length long, ids binary"
END_ID = 0


class Plan:
    """Which ranks of each length go where; ranges of equal sequences are kept as one."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.rows: list[tuple[int, int, int, int, int]] = []
        self.placed: dict[int, int] = {}
        self.sequences = 0
        self.gaps: dict[int, list[tuple[int, int]]] = {}

    def open(self, number: int) -> tuple[int, int]:
        first, self.sequences = self.sequences, self.sequences + number
        return first, number

    def put(self, length: int, where: tuple[int, int], offset: int) -> None:
        """One piece of this length into each sequence of the range."""
        first, number = where
        rank = self.placed.get(length, 0)
        self.placed[length] = rank + number
        self.rows.append((length, rank, rank + number, first, offset))

    def leave(self, gap: int, where: tuple[int, int]) -> None:
        if gap and where[1]:
            self.gaps.setdefault(gap, []).append(where)

    def match_large(self, left: dict[int, int]) -> None:
        """Pair each large length, longest first, with the longest large one that still fits."""
        third = self.capacity / 3
        for length in sorted((n for n in left if n > third), reverse=True):
            while left[length]:
                fits = [n for n in left if third < n <= self.capacity - length and left[n] > (n == length)]
                if not fits:
                    where = self.open(left[length])
                    self.put(length, where, 0)
                    self.leave(self.capacity - length, where)
                    left[length] = 0
                    break
                mate = max(fits)
                number = left[length] // 2 if mate == length else min(left[length], left[mate])
                where = self.open(number)
                self.put(length, where, 0)
                self.put(mate, where, length)
                self.leave(self.capacity - length - mate, where)
                left[length] -= number
                left[mate] -= number

    def fit_small(self, left: dict[int, int]) -> None:
        """Longest first into the tightest gap; new sequences only when no gap is wide enough."""
        for length in sorted((n for n in left if left[n]), reverse=True):
            while left[length]:
                gap = min((g for g in self.gaps if g >= length), default=None)
                if gap is None:
                    self.fill_new(length, left[length])
                    break
                first, number = self.gaps[gap].pop()
                if not self.gaps[gap]:
                    del self.gaps[gap]
                used = min(number, left[length])
                self.put(length, (first, used), self.capacity - gap)
                self.leave(gap - length, (first, used))
                self.leave(gap, (first + used, number - used))
                left[length] -= used

    def fill_new(self, length: int, number: int) -> None:
        each = self.capacity // length
        full, rest = divmod(number, each)
        for where, slots in ((self.open(full), each), (self.open(1 if rest else 0), rest)):
            if where[1]:
                for slot in range(slots):
                    self.put(length, where, slot * length)
                self.leave(self.capacity - slots * length, where)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Pack ``counts[length]`` pieces of each length, 1 to ``capacity``."""
    made, left = Plan(capacity), dict(counts)
    made.match_large(left)
    made.fit_small(left)
    return made


def pack(pieces: DataFrame, capacity: int = CAPACITY, salts: int = 128, key: str = "doc_id") -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a table with a ``length`` of 1 to ``capacity``.

    The table is read twice and should be a written one. Only counts per length reach the driver,
    and the plan that goes back has a size set by the capacity. Repeated rows are pieces of their own.
    """
    spark = pieces.sparkSession
    sums = pieces.groupBy(F.col("length").cast("int").alias("n")).agg(F.count(F.lit(1)).alias("k")).collect()
    rows = plan({r["n"]: r["k"] for r in sums}, capacity).rows
    steps = F.broadcast(spark.createDataFrame(rows, PLAN).withColumnRenamed("length", "of"))
    ranked = ranked_in(pieces, "length", F.struct(key, "piece"), "_rank", salts)
    here = (F.col("length") == F.col("of")) & (F.col("_rank") >= F.col("first")) & (F.col("_rank") < F.col("last"))
    return (
        ranked.join(steps, here)
        .withColumn("sequence_id", F.col("sequence") + F.col("_rank") - F.col("first"))
        .drop("of", "first", "last", "sequence", "_rank")
        .select(*pieces.columns, "sequence_id", "offset")
    )


def cut_points(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, end) of the pieces of a document: all full but the first."""
    first = length % capacity or min(length, capacity)
    return [(0, first), *((a, a + capacity) for a in range(first, length, capacity))]


def tokenised_pieces(
    docs: DataFrame, tokenizer_path: str, ranks_path: str, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """The pieces of every document: doc_id, piece, start, length and the ids as little-endian 32-bit numbers.

    A document is its whole text as ids, then ``end_id``; null and empty texts are the end id alone. Only a
    longer one than ``capacity`` is cut. Ids are those of the tokenizer file; texts without special strings
    are encoded from the rank file of the same vocabulary, which gives the same ids in a third of the time.
    """
    name = docs.schema["doc_id"].dataType.simpleString()

    special = special_strings(tokenizer_path)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path, ranks_path, special)
        for batch in batches:
            held: list[tuple] = []
            size = 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.array([*encode(text.as_py() or ""), end_id], "<u4")
                for piece, (a, b) in enumerate(cut_points(len(ids), capacity)):
                    held.append((doc_id, piece, a, b - a, ids[a:b].tobytes()))
                    size += b - a
                if size > 1 << 21:
                    yield as_batch(held, batch.schema.field(0).type)
                    held, size = [], 0
            if held:
                yield as_batch(held, batch.schema.field(0).type)

    return docs.select("doc_id", "text").mapInArrow(cut, f"doc_id {name}, {PIECES}")


def as_batch(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    types = [id_type, pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    arrays = [pa.array(values, kind) for values, kind in zip(zip(*rows), types)]
    return pa.record_batch(arrays, ["doc_id", "piece", "start", "length", "ids"])


def special_strings(tokenizer_path: str) -> list[str]:
    """The strings that the tokenizer file gives ids of their own."""
    with open(tokenizer_path, encoding="utf-8") as file:
        return [token["content"] for token in json.load(file)["added_tokens"]]


def encoder(tokenizer_path: str, ranks_path: str, special: list[str]) -> Callable[[str], list[int]]:
    """Text to ids as the tokenizer file says; the file itself is only loaded for texts with special strings."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    plain = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    loaded: list[Tokenizer] = []

    def encode(text: str) -> list[int]:
        if any(s in text for s in special):
            if not loaded:
                loaded.append(Tokenizer.from_file(tokenizer_path))
            return loaded[0].encode(text, add_special_tokens=False).ids
        return plain.encode_ordinary(text)

    return encode


def packed_documents(docs: DataFrame, tokenizer_path: str, ranks_path: str, capacity: int = CAPACITY) -> DataFrame:
    """All pieces of ``docs`` with their ids, sequence and offset; the ids are written once, then joined."""
    cut = write_through(tokenised_pieces(docs, tokenizer_path, ranks_path, capacity), "token-pieces")
    return pack(cut, capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: their ids in order of offset, at most ``capacity`` in each."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    whole = F.aggregate(parts, F.lit(b""), lambda acc, part: F.concat(acc, part["ids"]))
    return packed.groupBy("sequence_id").agg(whole.alias("ids"), F.sum("length").alias("length"))
