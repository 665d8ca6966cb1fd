"""Layer tables (Parquet): read-or-empty and append."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.sources.files import exists


class SchemaMismatch(ValueError):
    pass


def schema_issue(actual: list[str], declared: list[str]) -> str:
    """Header-check of a table's columns against its declared columns."""
    extra = [c for c in actual if c not in declared] or len(actual) != len(set(actual))
    missing = [c for c in declared if c not in actual]
    return ".".join(x for x, bad in (("ExtraColumns", extra), ("MissingColumns", missing)) if bad)


def empty(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    """No rows, known to the planner: a join with a table that is not there yet shuffles nothing."""
    fields = spark.createDataFrame([], schema).schema.fields
    return spark.range(1).where(F.lit(False)).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType,
                  validate: bool = True) -> DataFrame:
    """The table at ``path`` with the declared schema, or an empty one.

    An existing table whose stored columns differ from the declaration is
    rejected instead of being read with NULL-filled or dropped columns.
    """
    if exists(spark, path):
        if validate:
            stored = stored_columns(spark, path)
            issue = schema_issue(stored, [f.name for f in schema.fields]) if stored else ""
            if issue:
                raise SchemaMismatch(f"{path}: {issue} (stored {stored})")
        return spark.read.schema(schema).parquet(path)
    return empty(spark, schema)


def stored_columns(spark: SparkSession, path: str) -> list[str]:
    """Columns of a stored table; [] when it holds no data files yet."""
    try:
        return spark.read.parquet(path).columns
    except Exception as exc:  # an empty append leaves only _SUCCESS
        if "UNABLE_TO_INFER_SCHEMA" in str(exc):
            return []
        raise


def read_columns(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """Just the named columns of a table (empty if it does not exist yet)."""
    if exists(spark, path):
        return spark.read.schema(ddl).parquet(path)
    return empty(spark, ddl)


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
