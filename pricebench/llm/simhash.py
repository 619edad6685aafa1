"""SimHash near-duplicates: fingerprints that differ in few bits, found through shared bytes.

Two fingerprints that differ in at most 3 of 64 bits agree in at least 5 of their 8 bytes. The index
holds each fingerprint under its bytes at fixed positions; inside a posting list the shared positional
bytes of each pair are tallied, pairs below the guaranteed minimum fall out, and the rest are verified
bit by bit. A list of single bytes would hold a 256th of all fingerprints, so the index is kept under
byte triples: positions are split into two blocks of four, five shared bytes put three into one block,
and the eight triples inside the blocks therefore meet every such pair.
"""

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricebench.session import write_through

BITS, BYTES = 64, 8
MAX_BITS = 3
SHARED = BYTES - MAX_BITS  # bytes that must agree
TRIPLES = [c for block in (range(4), range(4, 8)) for c in combinations(block, 3)]
QUINTUPLES = list(combinations(range(8), SHARED))
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str | None, width: int = 3) -> int:
    """The signed 64-bit SimHash of the text's word shingles, each counted as often as it occurs."""
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > width:
        starts, ends = starts[: len(words) - width + 1], ends[width - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    hashed = [xxhash.xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts.tolist(), ends.tolist())]
    bits = np.zeros(BITS, np.int64)
    for at in range(0, len(hashed), 1 << 16):
        block = np.array(hashed[at : at + (1 << 16)], "<u8")
        bits += np.unpackbits(block.view(np.uint8).reshape(-1, BYTES), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(hashed), bitorder="little").view("<i8")[0])


def fingerprint_of(text: str, width: int = 3) -> Column:
    @F.pandas_udf("long")
    def hashed(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, width) for t in texts], dtype="int64")

    return hashed(F.col(text))


def _postings(nodes: DataFrame, subsets: list[tuple[int, ...]]) -> DataFrame:
    """A row per fingerprint and subset of byte positions; the key holds the subset and its bytes."""
    keys = []
    for number, positions in enumerate(subsets):
        key = F.lit(number).cast("long")
        for p in positions:
            byte = F.shiftrightunsigned("print", 8 * p).bitwiseAND(F.lit(255).cast("long"))
            key = F.shiftleft(key, 8).bitwiseOR(byte)
        keys.append(key)
    return nodes.select("print", "node", F.explode(F.array(*keys)).alias("key"))


def linked(prints: np.ndarray) -> np.ndarray:
    """For each fingerprint of a posting list, the index of the first one in its component there."""
    n = len(prints)
    octets = prints.view(np.uint8).reshape(n, BYTES)
    tally = np.zeros((n, n), np.uint8)
    for p in range(BYTES):
        tally += octets[:, p, None] == octets[None, :, p]
    near = tally >= SHARED
    a, b = np.nonzero(near)
    near[a, b] = np.bitwise_count(prints[a] ^ prints[b]) <= MAX_BITS
    return lowest_labels(near)


def lowest_labels(near: np.ndarray) -> np.ndarray:
    """The lowest index in the component of each index, of a symmetric reflexive relation."""
    n = len(near)
    label = np.arange(n)
    while True:
        lowest = np.where(near, label[None, :], n).min(axis=1)
        lowest = lowest[lowest]
        if np.array_equal(lowest, label):
            return label
        label = lowest


def _edges_of_lists(rows: pd.DataFrame) -> pd.DataFrame:
    """Links of several whole posting lists: each member with the lowest member it reaches there."""
    rows = rows.sort_values(["key", "node"], kind="stable")
    key, node = rows["key"].to_numpy(), rows["node"].to_numpy()
    prints = np.ascontiguousarray(rows["print"].to_numpy(np.int64)).view(np.uint64)
    cuts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
    sizes = np.diff(cuts)
    pairs = cuts[:-1][sizes == 2]
    close = np.bitwise_count(prints[pairs] ^ prints[pairs + 1]) <= MAX_BITS  # implies the tally
    high, low = [node[pairs + 1][close]], [node[pairs][close]]
    for start, end in zip(cuts[:-1][sizes > 2], cuts[1:][sizes > 2]):
        label = linked(prints[start:end])
        moved = np.flatnonzero(label != np.arange(end - start))
        high.append(node[start + moved])
        low.append(node[start + label[moved]])
    return pd.DataFrame({"a": np.concatenate(high), "b": np.concatenate(low)}, dtype="int64")


def _links(postings: DataFrame, sizes: DataFrame, most: int, bundle: int) -> DataFrame:
    """Links inside the posting lists of 2 to ``most`` members; many short lists share a task call."""
    total = sizes.filter(F.col("n").between(2, most)).agg(F.sum("n")).first()[0] or 0
    bundles = max(1, -(-total // bundle))
    chosen = postings.join(sizes.filter(F.col("n").between(2, most)).select("key"), "key")
    bundled = chosen.withColumn("bundle", F.pmod(F.xxhash64("key"), F.lit(bundles)))
    return bundled.groupBy("bundle").applyInPandas(_edges_of_lists, "a long, b long")


def _block_links(postings: DataFrame, sizes: DataFrame, most: int) -> DataFrame:
    """Links inside longer lists: split into blocks by hash, every pair of blocks compared in a task of its own."""
    half = max(1, most // 2)
    long = postings.join(sizes.filter(F.col("n") > most), "key")
    blocks = F.ceil(F.col("n") / half).cast("int")
    mine = F.pmod(F.xxhash64("print"), blocks).cast("int")
    met = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    split = long.withColumn("blocks", blocks).withColumn("mine", mine).withColumn("other", met)
    rekeyed = split.select(
        "print",
        "node",
        F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("key"),
    )
    return rekeyed.groupBy("key").applyInPandas(_edges_of_lists, "a long, b long")


def similar_nodes(nodes: DataFrame, most: int = 2048, bundle: int = 16_384) -> DataFrame:
    """Links (a, b), b the smaller, that connect all fingerprints within 3 bits of each other.

    ``nodes`` holds each distinct ``print`` once, with an id ``node``. Lists up to ``most`` are compared
    in one go. A longer list is indexed again under all sets of five bytes, which every linked pair
    shares one of; what is still longer is compared block against block. No list is cut short.
    """
    first = _postings(nodes, TRIPLES)
    sizes = write_through(first.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "posting-sizes")
    found = _links(first, sizes, most, bundle)
    hot = sizes.filter(F.col("n") > most)
    if not hot.isEmpty():
        again = first.join(hot.select("key"), "key").select("print", "node").distinct()
        second = _postings(again, QUINTUPLES)
        longer = write_through(second.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "posting-sizes")
        found = found.union(_links(second, longer, most, bundle)).union(_block_links(second, longer, most))
    return found.distinct()


def components(links: DataFrame) -> DataFrame:
    """The smallest node that each linked node reaches: (node, root), by label passing with jumps."""
    both = write_through(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = write_through(
        both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")).withColumnRenamed("a", "node"), "labels"
    )
    while True:
        heard = (
            both.join(labels, both.b == labels.node)
            .groupBy(both.a.alias("node"))
            .agg(F.min("root").alias("heard"))
        )
        lower = labels.join(heard, "node").select("node", "root", F.least("root", "heard").alias("new"))
        jump = labels.select(F.col("node").alias("new"), F.col("root").alias("jumped"))
        after = lower.join(jump, "new", "left").select(
            "node", F.coalesce(F.least("new", "jumped"), "new").alias("root"), F.col("root").alias("before")
        )
        after = write_through(after, "labels")
        labels = after.select("node", "root")
        if after.filter(F.col("root") != F.col("before")).isEmpty():
            return labels


def _classes(prints: DataFrame) -> DataFrame:
    """(print, root, first) of each distinct print: the print that stands for its class, and its smallest doc_id.

    Prints are their own nodes: rows that share an id, or have none, are no more linked by that than others.
    """
    firsts = prints.groupBy("print").agg(F.min("doc_id").cast("long").alias("first"))
    nodes = write_through(firsts.withColumn("node", F.col("print")), "nodes")
    roots = components(similar_nodes(nodes.select("print", "node")))
    return nodes.join(roots, "node", "left").select("print", F.coalesce("root", "print").alias("root"), "first")


def near_duplicates(docs: DataFrame, width: int = 3) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): its fingerprint (signed) and its class.

    The class is the smallest doc_id that links of at most 3 bits reach. Null, empty and blank texts
    have fingerprint 0 and link like any other. Equal fingerprints are one node, so copies are never
    compared with each other. A null doc_id counts as larger than all others, and a class of only such
    rows is null. Repeated rows give repeated rows; an empty table gives none.
    """
    prints = write_through(docs.select("doc_id", fingerprint_of("text", width).alias("print")), "fingerprints")
    classes = write_through(_classes(prints), "classes")
    names = classes.groupBy("root").agg(F.min("first").alias("component_id"))
    named = classes.join(names, "root").select("print", "component_id")
    return prints.join(named, "print").select("doc_id", "print", "component_id")


def keep_one_of_each(docs: DataFrame, width: int = 3) -> DataFrame:
    """The rows of ``docs`` that lead their class of near duplicates, with all their columns.

    The leader is the row with the smallest doc_id, null as the largest; between rows of one id a hash
    of the whole row decides, so texts that share an id are told apart, and of repeated rows one stays.
    The rows are written once with a number each, so that everything else moves numbers and prints only.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    numbered = docs.select(
        F.monotonically_increasing_id().alias("number"),
        F.struct(*columns).alias("row"),
        F.col("doc_id"),
        F.xxhash64(*columns).alias("hash"),
        fingerprint_of("text", width).alias("print"),
    )
    numbered = write_through(numbered, "numbered-rows")
    classes = _classes(numbered.select("print", "doc_id")).select("print", "root")
    order = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "hash", "number")
    narrow = numbered.select("print", order.alias("at"))
    leaders = narrow.join(classes, "print").groupBy("root").agg(F.min("at").alias("at")).select("at.number")
    return numbered.select("number", "row").join(leaders, "number", "left_semi").select("row.*")


def hex_print(name: str) -> Column:
    return F.lower(F.lpad(F.hex(name), 16, "0"))
