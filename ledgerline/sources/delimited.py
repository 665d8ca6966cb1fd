"""Reading delimited inbound files whose column order varies.

A fixed schema applied by position would silently misread a file with the same columns in another
order.  So the files of a configuration are read as lines once, lines are put together to records
where a qualified field runs over a line end (``records.py``: in splits, however large the file),
and each record is parsed with the schema of its own file's header.  The number of schemas is that of
distinct header layouts, not of files.

A record with more or fewer fields than its header is not cut or padded: its text comes back whole in
``MALFORMED`` and the row is set aside.  A qualifier inside a field is doubled, as in the usual CSV
convention.  Blank lines between records are skipped.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.sources.records import CHANGE, INSIDE, assemble, transition

MALFORMED = "_malformed"
ACCEPTED_GLOB = "*.{[cC][sS][vV],[tT][xX][tT]}"


def csv_options(delimiter: str, quote: str | None) -> dict[str, str]:
    return {"sep": delimiter, "quote": quote or "", "escape": quote or "\\",
            "mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}


def text_schema(columns) -> T.StructType:
    """The named columns as text, and the whole line where it doesn't fit them."""
    return T.StructType([T.StructField(c, T.StringType()) for c in (*columns, MALFORMED)])


@dataclass(frozen=True)
class Layout:
    delimiter: str
    quote: str | None
    columns: tuple[str, ...]


def file_path() -> Column:
    """The path of the file a row was read from, as the listing names it."""
    path = F.col("_metadata.file_path")
    path = F.when(F.contains(path, F.lit("%")), F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)
    return F.when(F.contains(path, F.lit(":///")), F.regexp_replace(path, r"^([A-Za-z][A-Za-z0-9+.-]*):///", "$1:/")) \
        .otherwise(path)


def scan_lines(spark: SparkSession, folder: str, modified_after: str | None = None) -> DataFrame:
    """(path, block, id, line) of the accepted files below ``folder``: block is the split, id the order in it."""
    reader = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).option("pathGlobFilter", ACCEPTED_GLOB)
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after).option("timeZone", "UTC")
    return reader.text(folder).select(
        file_path().alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"), F.col("value").alias("line"))


def add_transitions(lines: DataFrame, delimiter: str = "Delimiter", qualifier: str = "TextQualifier") -> DataFrame:
    """Adds ``kind``: what each line does to the state "inside a qualified field"."""
    return lines.withColumn("kind", transition(F.col("line"), F.col(delimiter), F.col(qualifier)))


def file_headers(lines: DataFrame) -> DataFrame:
    """(path, header_id, header, multi_line) of each file, from its lines with their ``kind``.

    ``multi_line``: some line may leave a field open.  Combined map-side to a row per file and task.
    """
    first = F.min(F.when(F.col("block") == 0, F.struct("id", "line")))
    return lines.groupBy("path").agg(
        first["id"].alias("header_id"), first["line"].alias("header"),
        F.max(F.col("kind").isin(CHANGE, INSIDE)).alias("multi_line")) \
        .withColumn("header", F.regexp_replace(F.regexp_replace("header", "\r$", ""), "^﻿", ""))


def records_of(lines: DataFrame, files: DataFrame, take: Sequence[str] = (), multi_line: bool = True) -> DataFrame:
    """(path, record, *take) of the files (path, header_id, multi_line, *take), headers left out.

    ``multi_line``: whether it may be true of a file; if not, the lines are read once, not three times.
    """
    known = files.select(F.col("path").alias("_path"), "header_id", "multi_line", *take)
    own = lines.join(known, F.col("path") == F.col("_path")).drop("_path")
    plain = own.where(~F.col("multi_line")).select("path", F.col("id").alias("first_id"), F.col("line").alias("record"),
                                                   "header_id", *take)
    both = plain
    if multi_line:
        joined = assemble(own.where("multi_line").select("path", "block", "id", "line", "kind"))
        both = plain.unionByName(joined.join(known, F.col("path") == F.col("_path")).drop("_path", "multi_line"))
    both = both.where(F.col("first_id") != F.col("header_id")).withColumn("record", F.regexp_replace("record", "\r$", ""))
    return both.where(F.trim("record") != "").select("path", "record", *take)


def parse(record: Column, layout: Layout) -> Column:
    """A record as a struct of its columns, by the layout of its file."""
    return F.from_csv(record, _ddl(layout.columns), {**csv_options(layout.delimiter, layout.quote), "multiLine": "true"})


def _ddl(columns) -> str:
    return ", ".join(f"`{c.replace('`', '``')}` string" for c in (*columns, MALFORMED))


def parse_any(records: DataFrame, layouts: Sequence[Layout], number: str) -> DataFrame:
    """Records with their layout's number -> all layouts' columns as text, in one pass."""
    names = [*dict.fromkeys(c for x in layouts for c in x.columns), MALFORMED]

    def widened(layout: Layout) -> Column:
        own = {*layout.columns, MALFORMED}
        if own == set(names) and len(own) == len(layout.columns) + 1 and layout.columns == tuple(names[:-1]):
            return parse(F.col("record"), layout)
        return F.transform(F.array(parse(F.col("record"), layout)), lambda r: F.struct(*[
            (r[c] if c in own else F.lit(None).cast("string")).alias(c) for c in names]))[0]

    value = F.lit(None)
    for i, layout in enumerate(layouts):
        value = F.when(F.col(number) == i, widened(layout)).otherwise(value)
    return records.withColumn("_r", value).select("path", *[F.col("_r").getField(c).alias(c) for c in names])


def read_delimited(spark: SparkSession, folder: str, layout: Layout) -> DataFrame:
    """All accepted files of a folder that share one layout, as text columns with ``path``.

    The lines are written once, as a table in the shared folder: the order of lines and the
    borders of splits are those of one reading, whatever is repeated later.
    """
    from ledgerline.session import shared_folder

    at = shared_folder(spark, "lines")
    add_transitions(scan_lines(spark, folder).withColumns(
        {"Delimiter": F.lit(layout.delimiter), "TextQualifier": F.lit(layout.quote)})).write.parquet(at)
    lines = spark.read.parquet(at)
    records = records_of(lines, file_headers(lines))
    return parse_any(records.withColumn("_layout", F.lit(0)), [layout], "_layout")
