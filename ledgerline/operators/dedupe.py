"""De-duplication and first-row selection.

Both are aggregations that Spark combines map-side before the shuffle (keep-first sorts for it): a
key that holds a third of all rows is reduced on every mapper and never sorted
inside one task, which a ``row_number()`` window would do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedupe_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Whole-row (or subset) de-duplication."""
    return df.dropDuplicates(subset) if subset else df.dropDuplicates()


def keep_first(df: DataFrame, keys: list[str], order: list[str],
               payload: list[str] | None = None) -> DataFrame:
    """One row per ``keys``: the smallest by ``order`` (ties by payload).

    Returns ``keys + order + payload`` columns.  NULLs in ``order`` sort
    first, as Spark orders structs.
    """
    payload = [c for c in (payload if payload is not None else df.columns)
               if c not in keys and c not in order]
    best = F.min(F.struct(F.struct(*order).alias("o"), F.struct(*payload).alias("p")))
    out = df.groupBy(*keys).agg(best.alias("_best"))
    return out.select(*keys, *[F.col(f"_best.o.{c}").alias(c) for c in order],
                      *[F.col(f"_best.p.{c}").alias(c) for c in payload])


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-NULL values of one column."""
    return df.select(column).where(F.col(column).isNotNull()).distinct()
