"""Header check: compare actual column lists with the expected lists.

Set based, order-insensitive and case-sensitive.  A repeated actual name is
reported as an extra column (a reader would have to rename the second copy,
which then matches nothing in the configuration).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import constants as K


def split_header(header: Column, delimiter: str, quote: str | None = None) -> Column:
    """Header line -> array of trimmed column names (qualifiers stripped).

    A delimiter between qualifiers belongs to the name: only one that an even number
    of qualifiers follows parts two names.  A doubled qualifier in a name is one.
    """
    clean = F.regexp_replace(F.regexp_replace(header, "\r$", ""), "^\ufeff", "")
    if not quote:
        return F.transform(F.split(clean, re.escape(delimiter), -1), lambda p: F.trim(p))
    q = re.escape(quote)
    parts = F.split(clean, f"{re.escape(delimiter)}(?=(?:[^{q}]*{q}[^{q}]*{q})*[^{q}]*$)", -1)
    return F.transform(parts, lambda p: F.replace(
        F.regexp_replace(F.trim(p), f"^{q}|{q}$", ""), F.lit(quote * 2), F.lit(quote)))


def issue_column(has_extra: Column, has_missing: Column) -> Column:
    """'' / 'ExtraColumns' / 'MissingColumns' / 'ExtraColumns.MissingColumns'."""
    return F.concat_ws(
        K.ISSUE_JOINER,
        F.when(has_extra, F.lit(K.ISSUE_EXTRA)),
        F.when(has_missing, F.lit(K.ISSUE_MISSING)),
    )


def header_check(df: DataFrame, actual: str, expected: str,
                 duplicates_are_extra: bool = True) -> DataFrame:
    """Add extra_columns, missing_columns, has_duplicates and Issue.

    ``actual`` and ``expected`` are array<string> columns; NULL entries of
    ``expected`` are ignored (a config row without a file column).
    """
    a = F.col(actual)
    e = F.filter(F.col(expected), lambda x: x.isNotNull())
    extra = F.array_sort(F.array_except(a, e))
    missing = F.array_sort(F.array_except(e, a))
    dup = F.size(a) > F.size(F.array_distinct(a))
    has_extra = (F.size(extra) > 0) | (dup if duplicates_are_extra else F.lit(False))
    return (df.withColumn("extra_columns", extra)
              .withColumn("missing_columns", missing)
              .withColumn("has_duplicates", dup)
              .withColumn("Issue", issue_column(has_extra, F.size(missing) > 0)))


def item_sets(pairs: DataFrame, key: str, item: str) -> DataFrame:
    """Long (key, item) rows -> (key, items array, n_items, has_duplicates).

    Pre-aggregates on (key, item) first, so a key with a huge number of rows
    is collapsed map-side; the collected array holds distinct items only.
    """
    per_item = pairs.groupBy(key, item).agg(F.count(F.lit(1)).alias("_n"))
    return per_item.groupBy(key).agg(
        F.collect_list(item).alias("items"),
        F.sum("_n").alias("n_items"),
        (F.max("_n") > 1).alias("has_duplicates"),
    )


def header_check_sets(sets: DataFrame, expected: list[str], items: str = "items",
                      dup_flag: str = "has_duplicates") -> DataFrame:
    """Header check over pre-aggregated distinct item sets (see ``item_sets``)."""
    e = F.array(*[F.lit(x) for x in expected])
    extra = F.array_sort(F.array_except(F.col(items), e))
    missing = F.array_sort(F.array_except(e, F.col(items)))
    return (sets.withColumn("extra_columns", extra)
                .withColumn("missing_columns", missing)
                .withColumn("Issue", issue_column((F.size(extra) > 0) | F.col(dup_flag),
                                                  F.size(missing) > 0)))
