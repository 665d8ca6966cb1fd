"""Configuration operators: expected columns, filters, missing configuration
and first-row selection per source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.dedupe import keep_first


def expected_columns(config_column: DataFrame) -> DataFrame:
    """(ConfigurationFileID, expected array) from non-NULL ColumnName_File."""
    return (config_column.where(F.col("ColumnName_File").isNotNull())
            .groupBy("ConfigurationFileID")
            .agg(F.array_sort(F.collect_set("ColumnName_File")).alias("expected")))


def for_source(config_file: DataFrame, source: str) -> DataFrame:
    return config_file.where(F.col("Source") == F.lit(source))


def with_columns_config(config_file: DataFrame, config_column: DataFrame) -> DataFrame:
    """File-level rows joined to their column-level rows by ConfigurationFileID."""
    return config_file.join(config_column, "ConfigurationFileID", "inner")


def first_per_source(config_file: DataFrame, order: str = "_row") -> DataFrame:
    """The first configuration row (in stored order) of each Source."""
    return keep_first(config_file, ["Source"], [order])


def missing_from(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``df`` with no match in ``other`` on ``keys`` (left anti)."""
    return df.join(other.select(*keys).distinct(), keys, "left_anti")
