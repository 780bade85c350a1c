"""Exact duplicates, with the frequent texts split off before the shuffle.

Equal texts have equal SHA-256 digests of their (normalised) UTF-8 bytes.

* Digests are written once, with a number for each row; no later step reads texts.
* Misra-Gries: each task keeps ``COUNTERS`` counters of digests.  A digest on more
  than one row in ``COUNTERS + 1`` keeps a counter in some task, so it is among the
  counters' sums; at most ``2 * SHARE`` sums can reach half a share of the rows.
* Those candidates are counted exactly.  Digests on at least one row in ``SHARE``
  are the heavy hitters, ``SHARE`` at most, whatever the table's size: their
  winners are broadcast, and their rows are answered without a shuffle.
* All other digests are grouped by an ordinary shuffle; none of them holds more
  than one row in ``SHARE``.

Defined results: a null text counts as empty; of equal texts the row with the
largest id stays (null ids are the smallest), one of them if it is repeated; an
empty table gives an empty result; columns may have any names.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.llm.common import Scratch, fresh

#: A digest on one row in so many is a heavy hitter.
SHARE = 1024
#: Counters of a task: a heavy hitter's summed counters lose less than half of its rows.
COUNTERS = 2 * SHARE


class MisraGries:
    """At most ``k`` counters; each is too low by at most (rows seen) / (k + 1)."""

    def __init__(self, k: int = COUNTERS):
        self.k = k
        self.counts: dict = {}

    def add(self, items: list, counts: list[int]) -> None:
        for item, n in zip(items, counts, strict=True):
            self.counts[item] = self.counts.get(item, 0) + n
        if len(self.counts) > self.k:
            held = np.fromiter(self.counts.values(), np.int64, len(self.counts))
            cut = int(np.partition(held, len(held) - self.k - 1)[len(held) - self.k - 1])
            self.counts = {item: n - cut for item, n in self.counts.items() if n > cut}


def summaries(digests: DataFrame, k: int = COUNTERS) -> DataFrame:
    """(digest, count): the counters that each task ends with."""
    column = digests.columns[0]

    def run(batches):
        mine = MisraGries(k)
        for batch in batches:
            seen = pc.value_counts(batch.column(0))
            mine.add(seen.field("values").to_pylist(), seen.field("counts").to_pylist())
        held = sorted(mine.counts.items())
        yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in held], pa.binary()), pa.array([n for _, n in held], pa.int64())], names=[column, "count"])

    return digests.mapInArrow(run, T.StructType([T.StructField(column, T.BinaryType()), T.StructField("count", T.LongType())]))


class ExactDedup:
    """Duplicate classes of the rows of ``docs``; ``id`` decides which row stays."""

    def __init__(self, docs: DataFrame, id: str = "doc_id", text: str = "text", normalise: Callable[[Column], Column] | None = None, share: int = SHARE):
        self.docs, self.id, self.text = docs, id, text
        self.normalise = normalise or (lambda c: c)
        self.share = share
        self.scratch = Scratch(docs.sparkSession, "exact-dedup")

    def _digest(self) -> Column:
        return F.unhex(F.sha2(F.coalesce(self.normalise(F.col(self.text)), F.lit("")).cast("binary"), 256))

    def _winners(self, rows: DataFrame) -> DataFrame:
        """(digest, best, size): the row that stays and the class size, for each digest of ``rows``."""
        return rows.groupBy("digest").agg(F.max(F.struct("id", "row")).alias("best"), F.count("*").alias("size"))

    def heavy(self, rows: DataFrame) -> DataFrame:
        """Verified winners of the digests on at least one row in ``share``: ``share`` rows at most."""
        total = rows.count()
        bound = total / self.share
        counters = summaries(rows.select("digest"), 2 * self.share).groupBy("digest").agg(F.sum("count").alias("count"))
        candidates = counters.where(F.col("count") >= bound / 2).select("digest")
        exact = self._winners(rows.join(F.broadcast(candidates), "digest"))
        # a digest on a single row needs no broadcast
        return self.scratch.save(exact.where((F.col("size") >= bound) & (F.col("size") > 1)))

    def _classes(self, rows: DataFrame) -> DataFrame:
        """``rows`` (id, row, digest) with best and size of their digest."""
        heavy = self.heavy(rows)
        marked = rows.join(F.broadcast(heavy), "digest", "left")
        ready = marked.where("best is not null")
        rest = rows.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
        winners = self.scratch.save(self._winners(rest))
        return ready.unionByName(rest.join(winners, "digest"))

    def classes(self) -> DataFrame:
        """One row for each row of ``docs``: its id, keep_id, group_size, kept, digest (lower-case hex)."""
        # the row number tells repeated rows apart; the written table fixes it
        rows = self.scratch.save(self.docs.select(F.col(self.id).alias("id"), F.monotonically_increasing_id().alias("row"), self._digest().alias("digest")))
        return self._classes(rows).select(
            F.col("id").alias(self.id), F.col("best.id").alias("keep_id"), F.col("size").cast("long").alias("group_size"),
            (F.col("row") == F.col("best.row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))

    def keep(self) -> DataFrame:
        """The rows of ``docs`` that stay, with their columns.

        Rows of heavy hitters go map-side; of the other digests, only the numbers of the rows to drop are joined.
        """
        number, digest = fresh(self.docs, "row"), fresh(self.docs, "digest")
        whole = self.scratch.save(self.docs.withColumn(number, F.monotonically_increasing_id()))
        rows = self.scratch.save(whole.select(F.col(self.id).alias("id"), F.col(number).alias("row"), self._digest().alias("digest")))
        heavy = self.heavy(rows)
        light = rows.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
        winners = self.scratch.save(self._winners(light).where("size > 1"))
        losers = self.scratch.save(light.join(winners, "digest").where("row <> best.row").select(F.col("row").alias(number)))
        best = fresh(whole, "best")
        kept = whole.withColumn(digest, self._digest()).join(F.broadcast(heavy.select(F.col("digest").alias(digest), F.col("best.row").alias(best))), digest, "left")
        kept = kept.where(F.col(best).isNull() | (F.col(best) == F.col(number)))
        return kept.join(losers, number, "left_anti").select(self.docs.columns)
