"""Declared schemas for configuration, layer tables and the run log."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Superset of the column lists the code declares, the columns Silver reads and
# the header on disk (FileNamePattern).
CONFIG_FILE = _struct(
    ("Account", S), ("ConfigurationFileID", T.IntegerType()), ("DefaultCategory", S),
    ("Delimiter", S), ("FileNamePattern", S), ("Source", S), ("TextQualifier", S),
)

CONFIG_COLUMN = _struct(
    ("ColumnName_Bronze", S), ("ColumnName_File", S), ("ColumnName_Silver", S),
    ("ColumnName_Gold", S), ("ConfigurationColumnOrder", T.IntegerType()),
    ("ConfigurationFileID", T.IntegerType()), ("Datatype", S),
    ("Transformation_FileToBronze", S), ("SilverEntity", S), ("SilverColumn", S),
    ("Transformation_BronzeToSilver_Type", S), ("Transformation_BronzeToSilver", S),
    ("ColumnIsInNaturalKey", S),
)

BRONZE_TRANSACTION = _struct(
    ("Amount", T.DecimalType(18, 2)), ("Category", S), ("Date", T.DateType()),
    ("Description", S), ("ExecutionGUID", S), ("IngestDatetime", T.TimestampType()),
    ("Source", S), ("SourceFile", S),
)

LOG = _struct(
    ("ExecutionGUID", S), ("ParentExecutionGUID", S), ("Begin", T.TimestampType()),
    ("End", T.TimestampType()), ("Severity", S), ("Caller", S), ("CallStack", S),
    ("Action", S), ("RowCount", T.LongType()), ("Source", S), ("Target", S),
    ("Result", S), ("File", S), ("Parameters", T.MapType(S, S)),
)

TO_MAP = _struct(
    ("AccountGUID", S), ("SourceValue", S), ("Brand", S), ("Category", S),
    ("ProductService", S), ("Seller", S), ("SourceFile", S),
)

BRIDGE = _struct(
    ("AccountGUID", S), ("SourceValue", S), ("BrandGUID", S), ("CategoryGUID", S),
    ("ProductServiceGUID", S), ("SellerGUID", S),
)

def dimension_schema(name: str) -> T.StructType:
    """Silver dimension schema: {Dim}GUID, DateTimeInserted, Name (+ extras)."""
    fields = [(f"{name}GUID", S), ("DateTimeInserted", T.TimestampType()), ("Name", S)]
    if name == "Category":
        fields.append(("ParentCategoryGUID", S))
    if name == "UnitOfMeasurement":
        fields.append(("Abbreviation", S))
    return _struct(*fields)


def silver_transaction_schema() -> T.StructType:
    return _struct(
        ("TransactionGUID", S), ("AccountGUID", S), ("Date", T.DateType()),
        ("Amount", T.DecimalType(18, 2)), ("Description", S), ("BrandGUID", S),
        ("CategoryGUID", S), ("ProductServiceGUID", S), ("SellerGUID", S),
        ("DateTimeInserted", T.TimestampType()), ("ExecutionGUID", S),
        ("Source", S), ("SourceFile", S),
    )


# Files taken into Silver (one row per file and Silver run) and Silver runs
# taken into Gold: small bookkeeping tables that keep each run incremental.
SILVER_FILES = _struct(("Source", S), ("SourceFile", S), ("ExecutionGUID", S),
                       ("DateTimeInserted", T.TimestampType()))
GOLD_RUNS = _struct(("SilverExecutionGUID", S), ("ExecutionGUID", S),
                    ("DateTimeInserted", T.TimestampType()))

# Hand-maintained mappings (configuration text): account name and source value
# to the four bridge dimension names.
MAPPING_FILE = _struct(("Account", S), ("SourceValue", S), ("Brand", S), ("Category", S),
                       ("ProductService", S), ("Seller", S))
# The category hierarchy (configuration text).
CATEGORY_FILE = _struct(("Category", S), ("ParentCategory", S))
