"""Audit columns and row counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def add_bronze_audit(df: DataFrame, execution_guid: str, source: Column | str,
                     source_file: Column | str, ingest_at: Column | None = None) -> DataFrame:
    """ExecutionGUID, IngestDatetime, Source, SourceFile."""
    return df.withColumns({
        "ExecutionGUID": F.lit(execution_guid),
        "IngestDatetime": ingest_at if ingest_at is not None else F.current_timestamp(),
        "Source": F.col(source) if isinstance(source, str) else source,
        "SourceFile": F.col(source_file) if isinstance(source_file, str) else source_file,
    })


def add_silver_audit(df: DataFrame, execution_guid: str, inserted_at: Column | None = None) -> DataFrame:
    """DateTimeInserted and ExecutionGUID (SourceFile is carried from Bronze)."""
    return df.withColumns({
        "DateTimeInserted": inserted_at if inserted_at is not None else F.current_timestamp(),
        "ExecutionGUID": F.lit(execution_guid),
    })


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row-count observation; read ``obs.get['rows']`` after an action.

    The count rides along the write, so no second pass over the data.
    """
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs
