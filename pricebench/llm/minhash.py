"""Document fingerprints by MinHash over word shingles, and near duplicates from signature bands.

Each of 128 universal hash permutations is applied to all shingles of a text at once; the fingerprint
holds the low 16 bits of each minimum. The share of equal places estimates the Jaccard similarity of
the shingle sets. Bands of the signature are joined in Spark, and the Jaccard similarity of each
candidate pair is verified on the shingles themselves.
"""

from collections.abc import Iterator

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricebench.llm.bytewords import shingles, word_hashes
from pricebench.llm.simhash import LOWER, components, lowest_labels
from pricebench.session import write_through

WIDTH = 5
PLACES = 128
ALIKE = 0.8
BLOCK = 1 << 12

_draw = np.random.default_rng(20_240_601)
MULTIPLIERS = _draw.integers(0, 1 << 63, PLACES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _draw.integers(0, 1 << 63, PLACES, dtype=np.uint64)


def signature(hashed: np.ndarray) -> np.ndarray:
    """Low 16 bits of the least permuted value per place; all ones for a text without shingles."""
    least = np.full(PLACES, np.iinfo(np.uint64).max)
    for at in range(0, len(hashed), BLOCK):
        permuted = MULTIPLIERS[:, None] * hashed[None, at : at + BLOCK]
        permuted += OFFSETS[:, None]
        np.minimum(least, permuted.min(axis=1), out=least)
    return (least >> np.uint64(40)).astype("<u2")


def signature_of(text: str) -> np.ndarray:
    return signature(shingles(word_hashes(text.encode()), WIDTH))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def edited(text: str, follower: str) -> str:
    """The second half, rounded down, replaced by as many leading characters of the next text, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + follower[:half]


RESULT = "edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
MOST_RANGES = 20_000
FIRST = -(2**63)  # a null id comes before all others


def _id_ranges(docs: DataFrame, rows_each: int) -> tuple[np.ndarray, dict[int, int]]:
    """Cut points of even ranges of ids, and for the first id of each range the range that it closes.

    Only ids are read. At most ``MOST_RANGES`` values of either kind reach the driver.
    """
    ids = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST)).alias("k"))
    ranges = min(MOST_RANGES, max(1, -(-ids.count() // rows_each)))
    shares = [i / ranges for i in range(1, ranges)]
    cuts = np.unique(np.array(ids.stat.approxQuantile("k", shares, 0.25 / ranges) if shares else [], np.int64))
    firsts = ids.groupBy(_range_of(cuts)("k").alias("range")).agg(F.min("k").alias("k")).orderBy("range").collect()
    return cuts, {row["k"]: firsts[i - 1]["range"] for i, row in enumerate(firsts)}


def _range_of(cuts: np.ndarray):
    @F.pandas_udf("int")
    def place(k: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, k.to_numpy(), side="right").astype(np.int32))

    return place


def _closes(closed: dict[int, int]):
    @F.pandas_udf("int")
    def place(k: pd.Series) -> pd.Series:
        return k.map(closed).astype("Int32")

    return place


def in_order(docs: DataFrame, rows_each: int) -> DataFrame:
    """Texts sorted inside ranges of ids, each range ended by a copy of the first row of the next one.

    So every row's follower is in its own partition. Each text is sent once, and one row per range
    twice; the last range is ended by the first row of all.
    """
    cuts, closed = _id_ranges(docs, rows_each)
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST))
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), key.alias("k"))
    own = keyed.withColumn("range", _range_of(cuts)("k")).withColumn("closing", F.lit(False))
    ends = keyed.withColumn("range", _closes(closed)("k")).withColumn("closing", F.lit(True))
    both = own.unionByName(ends.filter(F.col("range").isNotNull()))
    return both.repartition("range").sortWithinPartitions("range", "closing", "k", "text")


def _print(octets: bytes | np.ndarray) -> bytes:
    return np.asarray(octets, "<u2").tobytes()


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare each row with its edited text and with the row after it in the range."""
    before = None
    for batch in batches:
        rows: list[tuple] = []
        doc_ids, texts, _, ranges, closing = (batch.column(i) for i in range(5))
        for doc_id, text, at, ends in zip(doc_ids.to_pylist(), texts, ranges.to_pylist(), closing.to_pylist()):
            if before is None and ends:
                continue  # a second row with the first id of the next range
            text = text.as_py()
            now = signature_of(text)
            if before is not None:
                rows.append(_compare(*before[:3], text, now))
            before = None if ends else (doc_id, text, now, at)
        if rows:
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(zip(*rows), _types(batch.schema.field(0).type))], _NAMES
            )


_NAMES = ["doc_id", "n_chars", *[part.split()[0] for part in RESULT.split(", ")]]


def _types(id_type: pa.DataType) -> list[pa.DataType]:
    return [id_type, pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]


def _compare(doc_id, text: str, own: np.ndarray, follower: str, next_own: np.ndarray) -> tuple:
    changed = edited(text, follower)
    other = signature_of(changed)
    digest = hashlib.sha256(changed.encode()).hexdigest()
    near = likeness(own, other), likeness(own, next_own)
    return doc_id, len(text), digest, _print(own), _print(other), *near


def fingerprints_with_edits(docs: DataFrame, rows_each: int = 2000) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): its fingerprint, that of its edited text, and both likenesses.

    The edited text takes over as many leading characters of the next document by ascending doc_id as
    the second half has; the last document is followed by the first, a lone one by itself. Null texts
    are empty; a null id comes first; rows of one id follow each other by text. A text without words
    has the fingerprint of no shingles, which is like itself only. An empty table gives no rows.
    """
    name = docs.schema["doc_id"].dataType.simpleString()
    return in_order(docs, rows_each).mapInArrow(_walk, f"doc_id {name}, n_chars long, {RESULT}")


def hex_print(name: str) -> Column:
    return F.lower(F.hex(name))


def _sketches(docs: DataFrame, lower: bool) -> DataFrame:
    """Per row: the signature, the distinct shingle hashes, and the node, a hash of those that copies share."""

    @F.pandas_udf("node long, print binary, shingles array<long>")
    def sketch(texts: pd.Series) -> pd.DataFrame:
        raw = [(t or "").encode() for t in texts]
        found = [np.unique(shingles(word_hashes(r.translate(LOWER) if lower else r), WIDTH)) for r in raw]
        nodes = [int.from_bytes(hashlib.sha256(f.astype("<u8").tobytes()).digest()[:8], "little", signed=True) for f in found]
        prints = [_print(signature(f)) for f in found]
        sets = pd.Series([f.view(np.int64) for f in found], dtype="object")
        return pd.DataFrame({"node": pd.Series(nodes, dtype="int64"), "print": prints, "shingles": sets})

    return docs.select("doc_id", sketch("text").alias("s")).select("doc_id", "s.*")


def linked_sets(sets: list[np.ndarray], columns: int = 1 << 12) -> np.ndarray:
    """For each set, the index of the first one that links of Jaccard similarity 0.8 or more reach."""
    n, sizes = len(sets), np.array([len(s) for s in sets])
    member = np.repeat(np.arange(n), sizes)
    _, column = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(column, kind="stable")
    member, column = member[order], column[order]
    shared = np.zeros((n, n), np.float32)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, columns):
        a, b = np.searchsorted(column, [at, at + columns])
        holds = np.zeros((n, columns), np.float32)
        holds[member[a:b], column[a:b] - at] = 1
        shared += holds @ holds.T
    return lowest_labels(shared >= ALIKE * (sizes[:, None] + sizes[None, :] - shared))


def _links_of_bands(rows: pd.DataFrame) -> pd.DataFrame:
    high, low = [], []
    for _, band in rows.sort_values("node").groupby("key", sort=False):
        node = band["node"].to_numpy()
        label = linked_sets([np.asarray(s, np.int64) for s in band["shingles"]])
        moved = np.flatnonzero(label != np.arange(len(node)))
        high.append(node[moved])
        low.append(node[label[moved]])
    return pd.DataFrame({"a": np.concatenate(high), "b": np.concatenate(low)}, dtype="int64")


def _alike() -> Column:
    """Is the Jaccard similarity of the sets ``x`` and ``y`` 0.8 or more? Two empty sets are one node and never asked."""
    shared = F.size(F.array_intersect("x", "y"))
    return 5 * shared >= 4 * (F.size("x") + F.size("y") - shared)


def _sets_of(sketches: DataFrame, asked: DataFrame) -> DataFrame:
    """The shingle set of each node of ``asked``."""
    rows = sketches.select("node", "shingles").join(asked.select("node").distinct(), "node", "left_semi")
    return rows.groupBy("node").agg(F.first("shingles").alias("shingles"))


def _open_lists(crowded: DataFrame, roots: DataFrame, most: int) -> DataFrame:
    """Comparisons still to make, as (key, node): all nodes under one key meet.

    Links inside a list only matter between nodes that are not joined yet. So a list that is one class is
    done, and in a list of more than ``most`` nodes those outside its largest class, in blocks, meet every
    block; a class of many copies is not compared with itself.
    """
    half = max(1, most // 2)
    member = crowded.filter("n > 2").join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    classes = member.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    lists = (
        classes.groupBy("key")
        .agg(F.count(F.lit(1)).alias("classes"), F.sum("n").alias("n"), F.max(F.struct("n", "root")).alias("main"))
        .filter("classes > 1")
        .select("key", "n", F.col("main.root").alias("main"), F.col("main.n").alias("inside"))
    )
    outer, inner = F.ceil((F.col("n") - F.col("inside")) / half), F.ceil(F.col("inside") / half)
    place, within = F.xxhash64("node", F.lit("block")), F.col("root") == F.col("main")
    mine = F.when(within, F.col("outer") + F.pmod(place, "inner")).otherwise(F.pmod(place, "outer"))
    others = F.sequence(F.lit(0).cast("long"), F.col("outer") + F.when(within, 0).otherwise(F.col("inner")) - 1)
    short = F.col("n") <= most
    return (
        member.join(lists, "key")
        .withColumns({"outer": outer, "inner": inner})
        .withColumn("mine", F.when(short, 0).otherwise(mine))
        .withColumn("other", F.explode(F.when(short, F.array(F.lit(0).cast("long"))).otherwise(others)))
        .select("node", F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("key"))
    )


def _roots(sketches: DataFrame, bands: int, most: int) -> DataFrame:
    """The smallest node that each linked node reaches, as (node, root).

    Every list of a band is first compared with its smallest node; that settles lists of two and joins
    most copies. What is not joined yet inside a list is then compared in full.
    """
    nodes = write_through(sketches.groupBy("node").agg(F.first("print").alias("print")), "nodes")
    places = 2 * PLACES // bands
    keys = [F.xxhash64(F.lit(i), F.substring("print", 1 + i * places, places)) for i in range(bands)]
    postings = nodes.select("node", F.explode(F.array(*keys)).alias("key"))
    lists = postings.groupBy("key").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    crowded = write_through(postings.join(lists, "key"), "bands")
    sets = write_through(_sets_of(sketches, crowded), "shingle-sets")
    pairs = crowded.filter("node != first").select(F.col("node").alias("a"), F.col("first").alias("b")).distinct()
    x, y = (sets.select(F.col("node").alias(n), F.col("shingles").alias(s)) for n, s in (("a", "x"), ("b", "y")))
    links = write_through(pairs.join(x, "a").join(y, "b").filter(_alike()).select("a", "b"), "star-links")
    roots = components(links)
    met = write_through(_open_lists(crowded, roots, most), "open-lists")
    if met.isEmpty():
        return roots
    more = met.join(sets, "node").groupBy("key").applyInPandas(_links_of_bands, "a long, b long")
    return components(links.union(more))


def _placed(sketches: DataFrame, bands: int, most: int) -> DataFrame:
    """The class of each sketched row, as (doc_id, root)."""
    placed = sketches.select("doc_id", "node").join(_roots(sketches, bands, most), "node", "left")
    return placed.select("doc_id", F.coalesce("root", "node").alias("root"))


def near_duplicates(docs: DataFrame, bands: int = 32, most: int = 256, lower: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): the smallest doc_id that near copies reach.

    Texts with the same shingles are one node. Nodes that share a band of the signature meet in Spark,
    and their Jaccard similarity is verified on the whole shingle sets; with 32 bands of 4 places a pair
    at 0.8 is missed once in ten million. ``most`` bounds a comparison, not a list: longer lists are cut
    into blocks that meet. Null and blank texts are one class. A null doc_id counts as larger than all
    others, and a class of only such rows is null. With ``lower``, ASCII letters count the same in either case.
    """
    sketches = write_through(_sketches(docs, lower), "sketches")
    placed = _placed(sketches, bands, most)
    classes = placed.groupBy("root").agg(F.min("doc_id").cast("long").alias("class_id"))
    return placed.join(classes, "root").select("doc_id", "class_id")


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that lead their class of near copies, with all their columns.

    Near copies have 0.8 or more of their runs of five words in common, in either case of letters. The
    leader is the row with the smallest doc_id, null as the largest; between rows of one id a hash of the
    whole row decides, so that texts that share an id are told apart. Rows that repeat the leader go too.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    key = F.struct(F.col("doc_id").isNull().alias("late"), F.col("doc_id").alias("k"), F.xxhash64("text", *columns).alias("h"))
    sketches = write_through(_sketches(docs.select(key.alias("doc_id"), "text"), True), "sketches")
    placed = _placed(sketches, 32, 256)
    leaders = placed.groupBy("root").agg(F.min("doc_id").alias("at")).select("at.*").withColumn("k", F.coalesce("k", F.lit(0)))
    rows = docs.select(key.alias("at"), F.struct(*columns).alias("row"))
    rows = rows.select("at.late", F.coalesce("at.k", F.lit(0)).alias("k"), "at.h", "row")
    return rows.join(leaders, ["late", "k", "h"], "left_semi").dropDuplicates(["late", "k", "h"]).select("row.*")
