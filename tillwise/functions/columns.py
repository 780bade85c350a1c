"""Small column-expression helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# SKU family rules, applied in this order, first match wins
# (case-sensitive substring -> family); anything else, NULL included, is OTHER.
SKU_FAMILY_RULES: list[tuple[str, str]] = [
    ("ALL_PURPOSE", "ALL_PURPOSE"),
    ("JOBS", "JOBS"),
    ("DLT", "DLT"),
    ("SQL", "SQL"),
    ("INFERENCE", "MODEL_INFERENCE"),
]
SKU_FAMILY_DEFAULT = "OTHER"


def bucket_by_substring(c: Column, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """Ordered first-match substring bucketing; NULL input gets ``default``."""
    expr = None
    for needle, label in rules:
        cond = c.contains(needle)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def clip_below_zero(c: Column) -> Column:
    """``x < 0 -> 0``; NULL stays NULL (unlike ``greatest``, which skips NULLs)."""
    return F.when(c < 0, F.lit(0)).otherwise(c)


def not_null_flag(c: Column) -> Column:
    return c.isNotNull().cast("int")


def outlier_class(y: Column, lower: Column, upper: Column) -> Column:
    """1 above ``upper``, -1 below ``lower``, else 0 (NULL y -> 0, as a failed comparison)."""
    return F.when(y > upper, F.lit(1)).when(y < lower, F.lit(-1)).otherwise(F.lit(0))
