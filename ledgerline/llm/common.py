"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import ensure_checkpoint_dir, read_table

# White space that parts words: the space and \t \n \v \f \r.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def words(text: Column) -> Column:
    """The words of a text, in order; a null or blank text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), lambda w: w != "")


def count_words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(F.length(trimmed) > 0, F.size(F.split(trimmed, SPACE_RUN))).otherwise(0)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, not once per use inside a lambda."""
    return F.transform(F.array(value), body)[0]


def crc_rest(doc_id: Column, parts: int) -> Column:
    """crc32(doc_id as text) mod ``parts``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(parts))


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared checkpoint folder; its lineage is cut."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def unused(name: str, df: DataFrame) -> str:
    """``name``, with underscores in front until no column of ``df`` has it (names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
