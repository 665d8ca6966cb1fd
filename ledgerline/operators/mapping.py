"""ToMap resolution and the mapping bridge.

Rows whose source value has no bridge entry wait in ToMap until someone fills
in Brand / Category / ProductService / Seller names.  Each run resolves those
names to dimension GUIDs, appends fully resolved rows to the bridge and keeps
the rest, and holds back every Bronze row of a file that still has an
unresolved value (all-or-nothing per file).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline.operators.lookup import lookup

GUID_COLUMNS = [f"{d}GUID" for d in K.BRIDGE_DIMENSIONS]


def resolve_to_map(to_map: DataFrame, dims: dict[str, DataFrame],
                   names: dict[str, str] | None = None) -> DataFrame:
    """Four left lookups (name -> GUID) plus a ``resolved`` flag.

    ``names`` maps a dimension to the column holding its name in ``to_map``
    (default: the dimension's own name).  ``resolved`` is true when every
    GUID was found, i.e. the row would survive four inner joins.
    """
    names = names or {}
    out = to_map
    for d in K.BRIDGE_DIMENSIONS:
        out = lookup(out, dims[d], names.get(d, d), "Name", [f"{d}GUID"])
    resolved = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in GUID_COLUMNS])
    return out.withColumn("resolved", resolved)


def null_safe_anti(df: DataFrame, other: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of ``df`` whose ``columns`` tuple is not in ``other`` (NULL = NULL)."""
    o = other.select(*[F.col(c).alias(f"_o_{c}") for c in columns]).distinct()
    cond = reduce(lambda a, b: a & b, [df[c].eqNullSafe(o[f"_o_{c}"]) for c in columns])
    return df.join(o, cond, "left_anti")


def new_bridge_rows(resolved: DataFrame, bridge: DataFrame,
                    columns: list[str] | None = None) -> DataFrame:
    """Resolved tuples not yet in the bridge, distinct."""
    columns = columns or ["AccountGUID", "SourceValue", *GUID_COLUMNS]
    return null_safe_anti(resolved.select(*columns).distinct(), bridge, columns)


def unprocessable_rows(bronze: DataFrame, pending: DataFrame, key: str = "SourceFile") -> DataFrame:
    """Bronze rows whose file still has an unresolved value (semi join)."""
    keys = pending.select(key).where(F.col(key).isNotNull()).distinct()
    return bronze.join(keys, key, "left_semi")


def processable_rows(bronze: DataFrame, pending: DataFrame, key: str = "SourceFile") -> DataFrame:
    """Bronze rows of files with everything mapped (anti join)."""
    keys = pending.select(key).where(F.col(key).isNotNull()).distinct()
    return bronze.join(keys, key, "left_anti")
