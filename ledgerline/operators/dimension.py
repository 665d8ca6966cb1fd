"""Dimension members: new natural keys get a deterministic GUID."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.guid import stable_guid
from ledgerline.operators.mapping import null_safe_anti
from ledgerline.schemas import dimension_schema


def new_members(values: DataFrame, columns: str | dict[str, str], dim: DataFrame, dimension: str,
                keys: Sequence[str] = ("Name",), inserted_at: Column | None = None) -> DataFrame:
    """Distinct members whose natural key is absent from ``dim``, shaped as dim rows.

    ``columns``: the column of ``values`` that holds the Name, or one for each column
    of the dimension.  Rows without a Name make no member; a NULL in another key
    column is a key value.  Where a member's other columns differ, the smallest counts.
    """
    columns = {"Name": columns} if isinstance(columns, str) else columns
    candidates = (values.select(*[F.col(source).alias(c) for c, source in columns.items()])
                  .where(F.col("Name").isNotNull() & (F.trim("Name") != ""))
                  .groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"),
                                      *[F.min(c).alias(c) for c in columns if c not in keys]).drop("_n"))
    fresh = null_safe_anti(candidates, dim.select(*keys), list(keys))
    return shape_members(fresh, dimension, keys, inserted_at)


def shape_members(members: DataFrame, dimension: str, keys: Sequence[str] = ("Name",),
                  inserted_at: Column | None = None) -> DataFrame:
    """Members -> rows of the dimension's schema with a GUID that follows from the key."""
    made = {
        f"{dimension}GUID": stable_guid(dimension, *keys),
        "DateTimeInserted": inserted_at if inserted_at is not None else F.current_timestamp(),
        **{c: F.col(c) for c in members.columns},
    }
    return members.select(*[made.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
                            for f in dimension_schema(dimension).fields])


def unique_members(dim: DataFrame, dimension: str) -> DataFrame:
    """One row per member, that inserted first.

    A member's GUID follows from its natural key, so a member that two overlapping runs both
    appended is the same GUID twice.  Lookups against the folded dimension never fan out.
    """
    guid = f"{dimension}GUID"
    rest = [c for c in dim.columns if c != guid]
    first = F.min(F.struct(F.col("DateTimeInserted").alias("_at"), *rest)).alias("_m")
    return dim.groupBy(guid).agg(first).select(guid, *[F.col(f"_m.{c}").alias(c) for c in rest]).select(dim.columns)


def repeated_members(dims: dict[str, DataFrame]) -> dict[str, int]:
    """Dimension -> rows beyond the first of their member, in one pass over the GUIDs."""
    guids = [d.select(F.lit(name).alias("dimension"), F.col(f"{name}GUID").alias("guid")) for name, d in dims.items()]
    every = guids[0]
    for g in guids[1:]:
        every = every.unionByName(g)
    found = every.groupBy("dimension", "guid").agg((F.count(F.lit(1)) - 1).alias("more")) \
        .groupBy("dimension").agg(F.sum("more").alias("more")).where(F.col("more") > 0)
    return {r["dimension"]: r["more"] for r in found.collect()}  # a row a dimension
