"""Containment range join against an SCD2 table.

Semantics: equal keys, ``left.start >= right.start`` and
``(left.end <= right.end OR right.end IS NULL)``.  A left row straddling a
change of the right row is dropped; overlapping right rows duplicate it.

One plan for every size: each right row stands for the months its interval
shares with the left table's span, and the join key gains the month of
``left.start``.  Every left row has exactly one month, so a pair meets at most
once, and a hot key is spread over time; AQE broadcasts a side that turns out
small and splits what is left of the skew.  Intervals that start after the last
left row, or end before they start, hold no left row and go before the explode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def containment_join(left: DataFrame, right: DataFrame, keys: list[str],
                     left_start: str, left_end: str, right_start: str, right_end: str) -> DataFrame:
    """Inner join of ``left`` rows whose [start, end] lies inside a ``right`` interval.

    ``right`` columns other than the keys keep their names; callers select what
    they need.  Key names must be equal on both sides.
    """
    month = lambda c: F.trunc(c, "MM")
    span = left.agg(F.min(month(F.col(left_start))).alias("first"), F.max(month(F.col(left_start))).alias("last"))
    first, last = span.select("first").scalar(), span.select("last").scalar()
    begin = F.greatest(month(F.col(right_start)), first)
    end = F.least(F.coalesce(month(F.col(right_end)), last), last)  # least skips nulls
    months = F.when(begin <= end, F.sequence(begin, F.greatest(begin, end), F.expr("INTERVAL 1 MONTH")))
    ordered = right.where(F.col(right_end).isNull() | (F.col(right_end) >= F.col(right_start)))
    r = ordered.withColumn("_bucket", F.explode(months))
    l_ = left.withColumn("_bucket", month(F.col(left_start)))
    inside = ((l_[left_start] >= r[right_start])
              & ((l_[left_end] <= r[right_end]) | r[right_end].isNull()))
    joined = l_.join(r, [l_[k] == r[k] for k in [*keys, "_bucket"]] + [inside], "inner")
    return joined.drop(*[r[k] for k in keys], l_["_bucket"], r["_bucket"])
