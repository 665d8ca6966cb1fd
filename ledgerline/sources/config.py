"""Configuration tables: unquoted, '|'-delimited text with a header row.

They are edited by people, so they stay text.  Columns are matched by header
name, so a file may hold any subset of the declared columns in any order;
absent ones read as NULL, unknown ones are an error.  A missing file is created
with the declared header only (get-or-create).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import constants as K
from ledgerline import schemas
from ledgerline.sources.files import exists, write_text

REQUIRED = {
    "file": ("ConfigurationFileID", "Delimiter", "Source"),
    "column": ("ConfigurationFileID", "ColumnName_File"),
}


class ConfigurationError(ValueError):
    pass


def header_of(spark: SparkSession, path: str, delimiter: str = K.DEFAULT_DELIMITER) -> list[str]:
    first = spark.read.text(path).limit(1).collect()
    if not first:
        return []
    line = first[0][0].lstrip("\ufeff").rstrip("\r")
    return [c.strip() for c in line.split(delimiter)]


def retrieve_or_create(spark: SparkSession, path: str, schema: T.StructType,
                       required: tuple[str, ...] = (),
                       delimiter: str = K.DEFAULT_DELIMITER) -> DataFrame:
    """Read a configuration table, or create it with its header and return it empty.

    Adds ``_row``: the stored order of rows (files are read in name order and
    ids grow within a file), used to pick the first row per source.
    """
    if not exists(spark, path):
        write_text(spark, path, delimiter.join(f.name for f in schema.fields) + "\n")
    actual = header_of(spark, path, delimiter)
    declared = [f.name for f in schema.fields]
    extra = sorted(set(actual) - set(declared))
    missing = sorted(set(required) - set(actual))
    if actual and (extra or missing or len(actual) != len(set(actual))):
        raise ConfigurationError(
            f"{path}: extra columns {extra}, missing required {missing}, header {actual}")
    if not actual:
        return spark.createDataFrame([], schema).withColumn("_row", F.lit(0).cast("long"))
    text_schema = T.StructType([T.StructField(c, T.StringType()) for c in actual])
    raw = (spark.read.schema(text_schema).option("header", True).option("sep", delimiter)
           .option("quote", "").option("ignoreLeadingWhiteSpace", True)
           .option("ignoreTrailingWhiteSpace", True).csv(path))
    typed = raw.select(*[
        (F.col(f.name).try_cast(f.dataType) if f.name in actual else F.lit(None).cast(f.dataType))
        .alias(f.name) for f in schema.fields
    ], F.monotonically_increasing_id().alias("_row"))
    return typed


def load(spark: SparkSession, admin_dir: str) -> tuple[DataFrame, DataFrame]:
    """(file-level, column-level) configuration from the Admin folder."""
    cf = retrieve_or_create(spark, f"{admin_dir}/ConfigurationFile.txt", schemas.CONFIG_FILE,
                            REQUIRED["file"])
    cc = retrieve_or_create(spark, f"{admin_dir}/ConfigurationColumn.txt", schemas.CONFIG_COLUMN,
                            REQUIRED["column"])
    return cf, cc


MAPPING_FILE_NAME = "ConfigurationBrandCategoryProductServiceSeller.txt"


def load_mappings(spark: SparkSession, admin_dir: str) -> DataFrame:
    """Hand-maintained source-value mappings (created empty if missing)."""
    return retrieve_or_create(spark, f"{admin_dir}/{MAPPING_FILE_NAME}", schemas.MAPPING_FILE,
                              ("Account", "SourceValue"))


CATEGORY_FILE_NAME = "ConfigurationCategory.txt"


def load_categories(spark: SparkSession, admin_dir: str) -> DataFrame:
    """Hand-maintained category hierarchy: a category and the one above it (created empty if missing)."""
    return retrieve_or_create(spark, f"{admin_dir}/{CATEGORY_FILE_NAME}", schemas.CATEGORY_FILE,
                              ("Category", "ParentCategory"))
