"""Sharding by jump consistent hashing: a stable key and the number of shards decide the shard,
without a ring table; appending a shard moves only the rows that go to it.

Slots number the rows of a shard from 0 without gaps. No shard is ever in one task: a shard is cut
into blocks by a salt that is written with each row, so rows that repeat one key, or have none, are
spread as well; the blocks' counts give each its first slot, and rows are numbered inside their
block. The number of blocks follows the row count.

Cases: a null key is a key like any other and goes to one shard; null and empty texts have the size
of the overhead alone; repeated rows share a shard and get slots of their own; an empty table gives
an empty result; other columns are never looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helixframe.storage import scratch

OVERHEAD = 16
ROWS_PER_BLOCK = 200_000


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key, all keys at once; a step advances only those not yet placed."""
    if shards < 1:
        raise ValueError("at least one shard")
    state = keys.astype(np.uint64)
    at, ahead = np.full(len(state), -1, np.int64), np.zeros(len(state), np.int64)
    live = np.arange(len(state))
    while live.size:
        at[live] = ahead[live]
        state[live] = state[live] * np.uint64(2862933555777941757) + np.uint64(1)
        draw = ((state[live] >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
        ahead[live] = ((at[live] + 1) * (float(1 << 31) / draw)).astype(np.int64)
        live = live[ahead[live] < shards]
    return at.astype(np.int32)


def jump_column(key: Column, shards: int) -> Column:
    """Jump hash of a long column, as an int column."""

    @F.pandas_udf("int")
    def place(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(np.int64), shards))

    return place(F.xxhash64(key))


def shard(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot, grown_shard), one row per document; grown_shard is
    the shard if there were one more."""
    body = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    key = F.col(id_col).cast("long")
    placed = scratch(
        docs.select(
            key.alias("doc_id"),
            (F.octet_length(body) + OVERHEAD).cast("long").alias("size"),
            F.crc32(body).alias("text_crc32"),
            jump_column(key, shards).alias("shard"),
            jump_column(key, shards + 1).alias("grown_shard"),
            F.monotonically_increasing_id().alias("salt"),
        ),
        "shards",
    )
    blocks = max(1, placed.count() // (shards * ROWS_PER_BLOCK))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("salt"), F.lit(blocks)))
    counts = placed.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("rows"))
    first = counts.select("shard", "block", (F.sum("rows").over(W.partitionBy("shard").orderBy("block")) - F.col("rows")).alias("first"))
    inside = F.row_number().over(W.partitionBy("shard", "block").orderBy("doc_id", "text_crc32", "size", "salt")) - 1
    return placed.withColumn("inside", inside).join(first, ["shard", "block"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("inside")).cast("long").alias("slot"), "grown_shard"
    )
