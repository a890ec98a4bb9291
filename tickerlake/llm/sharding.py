"""Operator 2, sharding: jump consistent hashing (Lamping & Veach) of a stable key.

No ring table: the shard follows from the key and the shard count alone, shards
are near equal in rows, and going from n to n + 1 shards moves only about
1 / (n + 1) of the keys, all of them into the new shard.

Defined results: a null key is one key of its own (the text 'null'); rows with the
same key, repeated rows included, share a shard; a null text has size 16 and the
checksum of the empty text; an empty table gives an empty result; only the key
and text columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerlake.llm.common import gapless_rank

#: Fixed value: multiplier of the 64-bit linear congruential step in the published algorithm.
STEP = 2862933555777941757


def stable_key(col: Column) -> Column:
    """60 bits of the key's MD5: the same in any engine, run and session."""
    text = F.coalesce(col.cast("string"), F.lit("null"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key, all keys of a batch stepping together."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    key = keys.astype(np.uint64)
    b = np.zeros(len(key), np.int64)
    j = np.zeros(len(key), np.int64)
    live = np.arange(len(key))
    with np.errstate(over="ignore"):
        while len(live):
            b[live] = j[live]
            k = key[live] * np.uint64(STEP) + np.uint64(1)
            key[live] = k
            jump = (b[live] + 1) * (float(1 << 31) / ((k >> np.uint64(33)).astype(np.float64) + 1))
            j[live] = jump.astype(np.int64)
            live = live[j[live] < shards]
    return b.astype(np.int32)


def shard_of(key: Column, shards: int) -> Column:
    """Column expression: the shard of a 64-bit key column (Arrow batches; only the key column moves)."""

    @F.pandas_udf(T.IntegerType())
    def shard(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(keys.to_numpy(np.int64).astype(np.uint64), shards))

    return shard(key)


def assign_shards(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard), one row per input row.

    ``slot`` numbers a shard's rows from 0 without gaps; ``grown_shard`` is the
    shard once one more is appended.
    """
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(key).alias("doc_id"), (F.octet_length(body) + 16).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"), stable_key(F.col(key)).alias("key64"))
    rows = rows.select("doc_id", "size", "text_crc32", shard_of(F.col("key64"), shards).alias("shard"),
                       shard_of(F.col("key64"), shards + 1).alias("grown_shard"))
    ranked = gapless_rank(rows, ["shard"], ["doc_id", "text_crc32", "size"], "slot", rows=docs.count())
    return ranked.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
