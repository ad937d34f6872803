"""Jump consistent hashing: keys to shards without a table of the ring."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import written

#: Parts of a shard that are numbered side by side.
PARTS = 1024


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unsigned 64-bit key. From n to n + 1 shards a key stays or goes to shard n, with probability 1 / (n + 1)."""
    if shards < 1:
        raise ValueError("there must be a shard")
    key, last, jump = keys.astype(np.uint64).copy(), np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
    open_rows = np.arange(len(keys))
    while len(open_rows):
        last[open_rows] = jump[open_rows]
        k = key[open_rows] * np.uint64(2862933555777941757) + np.uint64(1)
        key[open_rows] = k
        jump[open_rows] = ((last[open_rows] + 1) * (float(1 << 31) / ((k >> np.uint64(33)).astype(np.float64) + 1))).astype(np.int64)
        open_rows = open_rows[jump[open_rows] < shards]
    return last


def shard_of(key: Column, shards: int) -> Column:
    """Shard of a key of any type; a null key is a key like any other. Keys are mixed by xxhash64 first, so that neighbours part."""

    @F.pandas_udf(T.IntegerType())
    def place(h: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(h.to_numpy(np.int64).view(np.uint64), shards).astype(np.int32))

    return place(F.xxhash64(key))


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``slot``, which counts the rows of each group from 0 without a gap.

    A group is numbered in PARTS parts, dealt by a hash of the row's ``order`` columns
    and of its place in a partition, so neither a large group nor repeated rows fill a
    task; the offsets of the parts are ``groups * PARTS`` rows at most. Give a written table.
    """
    parts = rows.withColumn("__part", F.pmod(F.xxhash64(*order, "__row"), F.lit(PARTS)))
    counts = parts.groupBy(group, "__part").count()
    offsets = counts.select(group, "__part", (F.sum("count").over(Window.partitionBy(group).orderBy("__part")) - F.col("count")).alias("__offset"))
    inner = F.row_number().over(Window.partitionBy(group, "__part").orderBy(*order, "__row")) - 1
    ranked = parts.withColumn("__inner", inner)
    return ranked.join(F.broadcast(offsets), [group, "__part"]).withColumn("slot", F.col("__offset") + F.col("__inner")).drop("__part", "__offset", "__inner", "__row")


def shard(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", overhead: int = 8) -> DataFrame:
    """``(id, size, text_crc32, law, shard, slot, grown_shard)`` for every row, under the law ``key``.

    The id and the number of shards decide a row's shard; ``grown_shard`` is its shard
    with one more. ``size`` is the text's UTF-8 bytes plus ``overhead`` (null: none).
    Repeated ids share a shard, and each row has its own slot; null ids are one key.
    Other columns are not read.
    """
    text, key = F.coalesce(F.col(text_col), F.lit("")), F.col(id_col)
    rows = docs.select(
        key.alias("id"),
        (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(key, shards).alias("shard"),
        shard_of(key, shards + 1).alias("grown_shard"),
        F.monotonically_increasing_id().alias("__row"),
    )
    out = numbered(written(rows, "shards"), "shard", ["id", "text_crc32", "size"])
    return out.select("id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
