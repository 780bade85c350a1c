"""Shards by jump consistent hashing, with a gapless slot for each row of a shard.

The shard of a key needs no ring table: the key seeds a sequence of jumps over
bucket numbers and the last jump below the shard count wins (Lamping and Veach,
2014).  With one shard more, a row stays or moves into the new shard.

Slots: rows of a shard are numbered from 0 in the order of (block, key).  A
block is a hash of the row, so a shard of any size is numbered in many tasks:
row numbers inside a block, plus the sum of the shard's earlier blocks.

Defined results: a null key is a key of its own; a null text counts as empty;
repeated rows get slots of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.llm.common import fresh, map_batches

#: Blocks that a shard's rows are numbered in.
BLOCKS = 1024
_FACTOR = np.uint64(2862933555777941757)
#: The key that stands for null (no 64-bit id is likely to be it; if one is, they share a shard).
_NULL_KEY = -(1 << 63)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each key (unsigned 64 bits)."""
    key = keys.astype(np.uint64)
    shard = np.full(len(key), -1, np.int64)
    ahead = np.zeros(len(key), np.int64)
    moving = np.arange(len(key))
    while len(moving):
        shard[moving] = ahead[moving]
        key[moving] = key[moving] * _FACTOR + np.uint64(1)
        pace = float(1 << 31) / ((key[moving] >> np.uint64(33)).astype(np.float64) + 1)
        ahead[moving] = ((shard[moving] + 1) * pace).astype(np.int64)
        moving = moving[ahead[moving] < shards]
    return shard


def with_shard(df: DataFrame, key: str, shards: int, out: str = "shard", grown: str | None = "grown_shard") -> DataFrame:
    """Append the shard of ``key`` and, if named, its shard with one shard more."""
    if shards < 1:
        raise ValueError("shards must be at least 1")

    def add(batch):
        keys = batch.column(batch.schema.get_field_index(key)).cast(pa.int64()).fill_null(_NULL_KEY).to_numpy(zero_copy_only=False).view(np.uint64)
        return [pa.array(jump(keys, n).astype(np.int32)) for n in ([shards, shards + 1] if grown else [shards])]

    return map_batches(df, add, [T.StructField(c, T.IntegerType()) for c in ([out, grown] if grown else [out])])


def with_slot(df: DataFrame, shard: str, order: list[str], out: str = "slot", blocks: int = BLOCKS) -> DataFrame:
    """Append a number from 0 without gaps inside each ``shard``, by (block, order)."""
    block, before, n = (fresh(df, x) for x in ("block", "before", "block_rows"))
    dealt = df.withColumn(block, F.pmod(F.xxhash64(*order), F.lit(blocks)).cast("int"))
    sizes = dealt.groupBy(shard, block).agg(F.count("*").alias(n))
    earlier = Window.partitionBy(shard).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col(shard).alias("_s"), F.col(block).alias("_b"), F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(before))
    inside = F.row_number().over(Window.partitionBy(shard, block).orderBy(*order)) - 1
    numbered = dealt.withColumn(out, inside)
    joined = numbered.join(offsets, (F.col(shard) == F.col("_s")) & (F.col(block) == F.col("_b")))
    return joined.select(*df.columns, (F.col(out) + F.col(before)).cast("long").alias(out))


def write_shards(df: DataFrame, path: str, shard: str = "shard", slot: str = "slot", parts: int = 16) -> None:
    """Parquet folders ``shard=k``, each in ``parts`` files of consecutive slots."""
    part = fresh(df, "part")
    spread = df.withColumn(part, F.pmod(F.floor(F.col(slot) / F.lit(1 << 20)), F.lit(parts)))
    spread.repartition(shard, part).sortWithinPartitions(shard, slot).drop(part).write.partitionBy(shard).parquet(path)
