"""Spelling variants: words one letter apart, from bit-sliced position indexes.

The vocabulary of a task is a set of bits. For every position and letter, one row of bits says which words
have that letter there. A word is compared with all others at once by going through its letters: one set
of bits holds the words that agree so far without an error, three more those that agree with one error and
stand level (a replaced letter), one position behind (a deleted one) or one ahead (an inserted one). A mark
after the last letter makes lengths agree.

One error lies in one half of a word, so two such words share the other half. Words therefore meet under
their first and their last letters only, half as many as the shorter word has. Small groups are put
together into tasks of bounded size; a group that is too large is split into blocks and every two blocks meet
in a task of their own. A pair that shares both halves counts under the first one alone.
"""

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricebench.session import write_through

RUN = re.compile("[a-zÀ-ÿ]+")
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
LEAST_LETTERS, LEAST_TIMES, NOISE, FACTOR = 5, 3, 97, 2
HELD_WORDS = 1 << 18
LETTERS = 1 << 16  # letters of the words that meet in one task
TOGETHER_BY_LENGTH = 4  # small groups of one length share a task; there are several lengths to a task number
QUERIES = 1 << 10  # words compared with all others at a time
KEPT_POSITIONS = 256
END = "\x01"


def noisy(word: str, seed: int, noise: int) -> str:
    """The word without one letter, if ``noise`` divides the checksum that starts from ``seed``."""
    h = zlib.crc32(word.encode(), seed)
    at = h % len(word)
    return word[:at] + word[at + 1 :] if h % noise == 0 else word


def word_counts(
    docs: DataFrame, noise: int | None = NOISE, letters: int = LEAST_LETTERS, times: int = LEAST_TIMES
) -> DataFrame:
    """(word, n): runs of Latin letters in whole texts, with at least ``letters`` letters, found ``times`` times.

    Only A-Z is lower-cased. With ``noise``, the run of every ``noise``-th checksum of ``<doc_id>:<run>`` loses a
    letter; a null id counts as an empty one there. Null and empty texts have no words. Words are counted
    inside the tasks before anything is shuffled, in tables of bounded size.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = Counter(RUN.findall((text.as_py() or "").encode().translate(LOWER).decode()))
                seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for run, n in found.items():
                    word = run if noise is None else noisy(run, seed, noise)
                    if len(word) >= letters:
                        total[word] += n
                if len(total) >= HELD_WORDS:
                    yield _as_counts(total)
                    total = Counter()
        yield _as_counts(total)

    found = docs.select("doc_id", "text").mapInArrow(counted, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= times)


def _as_counts(total: Counter) -> pa.RecordBatch:
    return pa.record_batch(
        [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"]
    )


class PositionIndex:
    """For each position and letter, the words with that letter there, as bits."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.alphabet = np.arange(int(codes.max(initial=0)) + 1)
        self.words = -(-len(codes) // 64)
        self.kept: dict[int, np.ndarray] = {}

    def at(self, position: int) -> np.ndarray:
        """One row of bits per letter; all empty outside the words."""
        if position in self.kept:
            return self.kept[position]
        octets = np.zeros((len(self.alphabet), 8 * self.words), np.uint8)
        if 0 <= position < self.codes.shape[1]:
            packed = np.packbits(self.codes[:, position] == self.alphabet[:, None], axis=1, bitorder="little")
            octets[:, : packed.shape[1]] = packed
        if len(self.kept) >= KEPT_POSITIONS:
            self.kept.clear()
        self.kept[position] = octets.view(np.uint64)
        return self.kept[position]

    def one_error(self, queries: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The words one replaced, deleted or inserted letter away from each query, as bits.

        ``queries`` holds the codes of words of ``length`` letters, the end mark behind them.
        """
        exact = np.full((len(queries), self.words), ~np.uint64(0))
        level, behind, ahead = (np.zeros_like(exact) for _ in range(3))
        for i in range(length + 1):
            letter = queries[:, i]
            here = self.at(i)[letter]
            ahead = (ahead | exact) & self.at(i + 1)[letter]
            behind &= self.at(i - 1)[letter]
            level &= here
            if i < length:  # the end mark itself is neither deleted nor replaced
                behind |= exact
                level |= exact & ~here
            exact &= here
        return level, behind, ahead


def word_codes(words: list[str], width: int) -> np.ndarray:
    """Small numbers for the letters of each word; 0 behind the end mark, and nowhere else."""
    text = "".join([(w + END).ljust(width, "\0") for w in words] + ["\0" * width])
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    return np.unique(points, return_inverse=True)[1].reshape(-1, width)[:-1]


def _ones(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of every set bit."""
    row, word = np.nonzero(bits)
    within = np.unpackbits(bits[row, word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    which, bit = np.nonzero(within)
    return row[which], 64 * word[which] + bit


MET = "word string, n_near long, form_n long, form string"


def _compare(rows: pd.DataFrame) -> pd.DataFrame:
    """The words of one task, all with ``short`` letters or one more: near words and the best one of each."""
    words = rows["word"].tolist()
    short, half = int(rows["short"].iloc[0]), int(rows["short"].iloc[0]) // 2
    lengths = np.array([len(w) for w in words])
    codes = word_codes(words, short + 2)
    index = PositionIndex(codes)
    pairs = []
    for length in (short, short + 1):
        chosen = np.flatnonzero(lengths == length)
        for start in range(0, len(chosen), QUERIES):
            here = chosen[start : start + QUERIES]
            level, behind, ahead = index.one_error(codes[here], length)
            query, other = _ones(level | ahead if length == short else behind)
            pairs.append((here[query], other))
    a, b = (np.concatenate(side) for side in zip(*pairs))
    # Rows of other groups are in the task too; only words of one group meet, and of two blocks if it is split.
    key, last, mine = (rows[c].to_numpy() for c in ("key", "last", "mine"))
    met = (key[a] == key[b]) & (last[a] == last[b]) & (rows["alone"].to_numpy()[a] | (mine[a] != mine[b]))
    a, b = a[met], b[met]
    ends = (lengths - half)[:, None] + np.arange(half)
    same_start = (codes[a, :half] == codes[b, :half]).all(axis=1)
    same_end = (codes[a[:, None], ends[a]] == codes[b[:, None], ends[b]]).all(axis=1)
    mine_to_count = np.where(last[a], same_end & ~same_start, same_start)
    a, b = a[mine_to_count], b[mine_to_count]
    n = rows["n"].to_numpy()
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((rank[b], -n[b], a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.diff(a, prepend=-1))
    near = np.diff(np.append(first, len(a)))
    word, form = (pd.Series([words[i] for i in side[first]], dtype=object) for side in (a, b))
    return pd.DataFrame({"word": word, "n_near": near, "form_n": n[b[first]], "form": form})


def near_words(counts: DataFrame, letters: int = LEAST_LETTERS, together: int = LETTERS) -> DataFrame:
    """(word, n_near, form_n, form) of each word that has near ones: how many, and the most frequent of them.

    ``counts`` holds each word once, with at least ``letters`` letters. Ties go to the first in code-point order.
    ``together`` bounds the letters that meet in one task.
    """
    length = F.char_length("word")
    groups = F.explode(
        F.array(*[F.struct((length - back).alias("short"), F.lit(last).alias("last")) for back in (0, 1) for last in (False, True)])
    ).alias("group")
    shared = F.when(F.col("last"), F.expr("substring(word, char_length(word) - short div 2 + 1, short div 2)")).otherwise(
        F.expr("substring(word, 1, short div 2)")
    )
    members = (
        counts.select("word", "n", groups)
        .select("word", "n", "group.short", "group.last")
        .filter(F.col("short") >= letters)
        .withColumn("key", F.xxhash64("short", "last", shared))
    )
    # Letters that meet: a word goes to four groups. Their number alone says how many tasks there are.
    total = 4 * (counts.agg(F.sum(length).alias("letters")).first()["letters"] or 0)
    tasks = max(1, -(-total // (TOGETHER_BY_LENGTH * together)))
    most = F.greatest(F.lit(2), F.floor(F.lit(together) / (F.col("short") + 2))).cast("int")
    sizes = members.groupBy("short", "key").agg(F.count(F.lit(1)).alias("size"))
    hot = write_through(sizes.filter(F.col("size") > most), "large-groups")  # fewer than the tasks that they fill
    blocks = F.ceil(F.col("size") / F.greatest(F.lit(1), F.floor(most / 2))).cast("int")
    placed = members.join(hot, ["short", "key"], "left").withColumn("blocks", F.coalesce(blocks, F.lit(1)))
    placed = placed.withColumn("mine", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    own_task = F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).bitwiseOR(F.lit(-(2**63)))
    placed = placed.select(
        *("word", "n", "short", "last", "key", "mine"),
        (F.col("mine") == F.col("other")).alias("alone"),
        # Groups that are split have tasks below 0, apart from those of the small ones.
        F.when(F.col("blocks") > 1, own_task).otherwise(F.pmod(F.xxhash64("key"), F.lit(tasks))).alias("task"),
    )
    found = placed.groupBy("short", "task").applyInPandas(_compare, MET)
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best")
    return (
        found.groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), best)
        .select("word", "n_near", (-F.col("best.less")).alias("form_n"), "best.form")
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where the forms of each word (word, form) lead in the end.

    Each round doubles how far a pointer reaches. A form is at least twice as frequent as its word, so
    pointers have no circle, and the number of rounds is the logarithm of a logarithm of the counts.
    """
    pointers = write_through(forms.select("word", F.col("form").alias("root")), "pointers")
    while True:
        onward = pointers.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = pointers.join(onward, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
        )
        moved = write_through(moved, "pointers")
        pointers = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return pointers


def variants(
    counts: DataFrame, letters: int = LEAST_LETTERS, factor: int = FACTOR, together: int = LETTERS
) -> DataFrame:
    """One row per word of ``counts`` (word, n): form, root, n, n_near and form_n.

    Near words differ by one inserted, deleted or replaced code point. The form is the most frequent near word,
    ties to the first in code-point order, if it is at least ``factor`` (2 or more) times as frequent; root is
    where the forms lead, the word itself if it has none. No words give no rows.
    """
    counts = write_through(counts.select("word", "n"), "word-counts")
    near = near_words(counts, letters, together)
    frequent = F.col("form_n") >= F.lit(factor) * F.col("n")
    found = counts.join(near, "word", "left").select(
        "word",
        F.when(frequent, F.col("form")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(frequent, F.col("form_n")).alias("form_n"),
    )
    found = write_through(found, "near-words")
    ends = roots(found.filter(F.col("form").isNotNull()))
    return found.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
