"""Sharding by jump consistent hashing: a stable key and the number of shards decide."""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricebench.llm.tables import ranked_in

STEP = np.uint64(2862933555777941757)  # fixed value of the published algorithm


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each unsigned 64-bit key, all keys advancing together.

    A key jumps forward through shard counts at random; its shard is the last one it reached
    below ``shards``. So one more shard moves a key only if its next jump lands on that shard.
    """
    state = keys.astype(np.uint64)
    at = np.zeros(len(state), np.int64)
    ahead = np.zeros(len(state), np.int64)
    going = np.flatnonzero(ahead < shards)
    while len(going):
        at[going] = ahead[going]
        state[going] = state[going] * STEP + np.uint64(1)
        draw = (state[going] >> np.uint64(33)).astype(np.float64) + 1.0
        ahead[going] = ((at[going] + 1) * (float(1 << 31) / draw)).astype(np.int64)
        going = going[ahead[going] < shards]
    return at.astype(np.int32)


def shard_of(key: Column, shards: int) -> Column:
    """The shard as a column; the key is any integer or string column, null keys count as one key."""

    @F.pandas_udf("int")
    def place(hashed: pd.Series) -> pd.Series:
        return pd.Series(jump(hashed.to_numpy(np.int64).view(np.uint64), shards))

    return place(F.xxhash64(key))


def shard_documents(docs: DataFrame, shards: int = 8, salts: int = 512) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): its shard, its place there, and its shard after growth.

    The key is doc_id, so the law is ``key``: equal ids share a shard, texts play no part. A null
    text has size 1 and the checksum of nothing; a null id is a key of its own; an empty table
    gives no rows. Rows that repeat get slots of their own. Columns other than doc_id and text
    are not read.
    """
    placed = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(F.col("doc_id"), shards).alias("shard"),
        shard_of(F.col("doc_id"), shards + 1).alias("grown_shard"),
    )
    return ranked_in(placed, "shard", F.col("doc_id"), "slot", salts)
