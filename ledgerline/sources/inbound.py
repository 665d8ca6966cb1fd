"""Inbound discovery: every file below ``<Inbound>/<Source>/...``, zero-byte files included."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.text import has_accepted_extension
from ledgerline.sources.taskfiles import listing


def with_source(files: DataFrame) -> DataFrame:
    """Adds Source, the first folder of ``relative`` (none at the top level), and whether the file type is accepted."""
    parts = F.split("relative", "/")
    return files.withColumn("Source", F.when(F.size(parts) > 1, parts.getItem(0))) \
        .withColumn("accepted", has_accepted_extension("file_name"))


def discover(spark: SparkSession, inbound_root: str, source: str | None = None) -> DataFrame:
    """(path, uri, relative, file_name, size, modified, Source, accepted)."""
    out = with_source(listing(spark, inbound_root))
    if source is not None:
        out = out.where(F.col("Source") == F.lit(source))
    return out
