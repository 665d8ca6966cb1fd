"""GUIDs.

Run and step GUIDs are random (one per driver-side step, made once, then used
as literals).  Surrogate keys of table rows must survive recomputation and
re-runs, so they are derived from the row's natural key with md5 and shaped as
a GUID.  ``uuid()`` is never used inside a plan: a recomputed partition would
get new keys.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

_NULL_PART = "\u0001"  # stands for NULL so that (NULL, 'a') != ('', 'a')
_SEP = "\u001f"


def run_guid() -> str:
    return str(uuid.uuid4())


def stable_guid(namespace: str, *parts: Column | str) -> Column:
    """Deterministic GUID string from a namespace and natural-key columns."""
    cols = [F.lit(namespace)] + [
        F.coalesce(F.col(p).cast("string") if isinstance(p, str) else p.cast("string"),
                   F.lit(_NULL_PART))
        for p in parts
    ]
    # one md5, shaped 8-4-4-4-12 by a single anchored pattern
    return F.regexp_replace(F.md5(F.concat_ws(_SEP, *cols)),
                            r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
