"""Lookups (left joins on a dimension's natural key).

The joins carry no hint: the planner and AQE choose a broadcast by the bytes they
see (``spark.sql.autoBroadcastJoinThreshold``), and split skewed partitions otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(df: DataFrame, dim: DataFrame, left_on: str, right_on: str,
           take: list[str], how: str = "left", prefix: str = "_lk_") -> DataFrame:
    """``df`` ⟕ ``dim`` on ``df[left_on] == dim[right_on]``, adding ``take``.

    The dimension key must be unique, otherwise rows fan out.  Plain equality: a NULL source value stays unmatched.
    """
    renamed = dim.select(F.col(right_on).alias(prefix + "key"),
                         *[F.col(c).alias(prefix + c) for c in take])
    joined = df.join(renamed, df[left_on] == renamed[prefix + "key"], how)
    return joined.drop(prefix + "key").select(
        *[c for c in joined.columns if not c.startswith(prefix)],
        *[F.col(prefix + c).alias(c) for c in take],
    )


def dimension_lookup(df: DataFrame, dim: DataFrame, columns: str | dict[str, str], dimension: str) -> DataFrame:
    """Add ``{dimension}GUID`` by the dimension's natural key.

    ``columns``: the column of ``df`` that holds the Name, or one for each key column.
    A NULL Name stays unmatched; in the other key columns NULL matches NULL.
    """
    guid = f"{dimension}GUID"
    if isinstance(columns, str) or len(columns) == 1:
        return lookup(df, dim, columns if isinstance(columns, str) else columns["Name"], "Name", [guid])
    members = dim.select(*[F.col(k).alias(f"_key_{k}") for k in columns], guid)
    same = [df[c] == members["_key_Name"] if k == "Name" else df[c].eqNullSafe(members[f"_key_{k}"])
            for k, c in columns.items()]
    return df.join(members, reduce(lambda x, y: x & y, same), "left").drop(*[f"_key_{k}" for k in columns])


def account_lookup(config_file: DataFrame, account_dim: DataFrame,
                   account_column: str = "Account") -> DataFrame:
    """Add AccountGUID to configuration (or data) rows by account Name."""
    return lookup(config_file, account_dim, account_column, "Name", ["AccountGUID"])
