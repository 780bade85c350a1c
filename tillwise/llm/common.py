"""Helpers shared by the operators: scratch tables, Arrow text buffers, components."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.session import scratch_path

#: Bytes of text that a task turns into number arrays at once.  A longer text is taken alone.
BLOCK_BYTES = 2 << 20

#: ASCII white space, as a Java regex class: what separates words.
SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Tables written under ``spark.checkpoint.dir`` and read again.

    A written table cuts the lineage: it survives lost executors, and rows keep
    the ids given to them when it was written.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
        self.n = 0

    def save(self, df: DataFrame, compression: str = "zstd") -> DataFrame:
        self.n += 1
        path = f"{self.base}/t{self.n}"
        df.write.option("compression", compression).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch = path
        return out

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def drop(self, *tables: DataFrame | str) -> None:
        """Delete tables that no later step reads."""
        for t in tables:
            delete_path(self.spark, t if isinstance(t, str) else t._scratch)


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet (case-insensitive)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of an Arrow string column, and where each begins and ends."""
    if col.null_count:
        col = col.fill_null("")
    _, offsets, data = col.buffers()
    wide = np.int64 if pa.types.is_large_string(col.type) else np.int32
    offsets = np.frombuffer(offsets, wide)[col.offset: col.offset + len(col) + 1] if len(col) else np.zeros(1, wide)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets.astype(np.int64)


def blocks(offsets: np.ndarray, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes each; a longer text stands alone."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def raw_texts(col: pa.Array) -> Iterator[bytes]:
    data, offsets = utf8(col)
    whole = memoryview(data)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        yield bytes(whole[a:b])


_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the rolling hashes' base and of its inverse modulo 2^64, ``n`` at least."""
    if len(_POWERS.get("up", ())) < n:
        for name, x in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, x, np.uint64)
            steps[:1] = 1
            _POWERS[name] = np.cumprod(steps)
    return _POWERS["up"], _POWERS["down"]


def mixed(h: np.ndarray) -> np.ndarray:
    """Rolling hashes with their bits spread evenly."""
    for _ in range(2):
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def map_batches(df: DataFrame, fn, fields: list[T.StructField], keep: list[str] | None = None) -> DataFrame:
    """Append columns that ``fn(batch) -> list of Arrow arrays`` computes; ``keep`` stays in front."""
    keep = df.columns if keep is None else keep
    schema = T.StructType([df.schema[c] for c in keep] + fields)
    names = [f.name for f in schema]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(c)) for c in keep] + list(fn(batch)), names=names)

    return df.mapInArrow(run, schema)


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of ``edges`` (a, b longs).

    Alternating large-star and small-star rounds.  A hub's neighbours are never
    gathered: each round is a partially aggregated minimum and a join, and ends
    in a written table.  Rounds grow with the logarithm of the longest chain.
    """
    def both(e):
        return e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def state(e):
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = scratch.save(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = state(now)
    while True:
        pairs = both(now)
        least = pairs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = pairs.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = scratch.save(large.where("a <> b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.greatest("b", "m").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        after = scratch.save(small.where("a <> b").distinct())
        scratch.drop(now, large)
        now, before, seen = after, seen, state(after)
        if seen == before:
            break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
