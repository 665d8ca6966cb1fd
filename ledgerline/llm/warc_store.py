r"""Content-addressed WARC archive.

Every record keeps its exact header (a WARC/1.1 header block with CRLF line ends); its
payload bytes are stored once under their SHA-256.  The archive is two Parquet tables in
one folder, ``headers`` (key, digest, header) and ``payloads`` (digest, payload).
``read_archive`` reconstructs the records by joining them and verifies each stored
payload against its digest; ``read_records`` parses the header back into fields.
``write_warc`` writes the reconstructed records as plain WARC files.

Of records with equal payloads of at least ``LEAST_REVISIT`` bytes the one with the
smallest key is a response, the others are revisits that refer to it; below, all are
responses.  Payloads are never grouped by value: pages are reduced to (digest, key)
first.  A payload held by a third of all pages is written once; joins that fan it out
are plain equi-joins, whose hot keys adaptive execution splits.

Defined cases: a null payload is empty; rows that repeat a key are records of their own,
those with the smallest key of a payload are all responses; a null key is larger than
every other (a response only if all keys of the payload are null); a null URL gives a
record without WARC-Target-URI; an empty table gives an empty archive.  Line ends in a
URL are percent-encoded in its header line.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


LEAST_REVISIT = 100
CRLF = "\r\n"
# A fixed date: the pages carry none, and equal input makes equal archives.
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record_id(key: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws("|", key.cast("string"), digest))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in (
        (1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value)


def build_headers(pages: DataFrame, key: str, url: str, payload: str) -> DataFrame:
    """key, digest, bytes, header of each record; no payload leaves its task."""
    body = F.coalesce(F.col(f"`{payload}`"), F.lit("")).cast("binary")
    slim = pages.select(F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").alias("url"),
                        F.sha2(body, 256).alias("digest"), F.length(body).cast("long").alias("bytes"))
    first = slim.groupBy("digest").agg(F.min("key").alias("first_key"))
    joined = slim.join(first, "digest")
    original = F.col("key").eqNullSafe(F.col("first_key")) | (F.col("bytes") < LEAST_REVISIT)
    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    header = F.concat_ws(
        CRLF, F.lit("WARC/1.1"),
        _line("WARC-Type", F.when(original, "response").otherwise("revisit")),
        _line("WARC-Record-ID", _record_id(F.col("key"), F.col("digest"))),
        _line("WARC-Date", F.lit(DATE)), _line("WARC-Target-URI", uri),
        F.when(~original, F.lit(f"WARC-Profile: {PROFILE}")),
        F.when(~original, _line("WARC-Refers-To", _record_id(F.col("first_key"), F.col("digest")))),
        F.when(~original, _line("X-Refers-To-Key", F.col("first_key").cast("string"))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        F.lit("Content-Type: text/html; charset=utf-8"),
        _line("Content-Length", F.when(original, F.col("bytes")).otherwise(F.lit(0)).cast("string")))
    return joined.select("key", "digest", "bytes", header.alias("header"))


def write_archive(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url",
                  payload: str = "html") -> None:
    """Write ``headers`` and ``payloads`` under ``folder``."""
    build_headers(pages, key, url, payload).drop("bytes").write.parquet(f"{folder}/headers")
    body = F.coalesce(F.col(f"`{payload}`"), F.lit("")).cast("binary")
    name = F.coalesce(F.col("key").cast("string"), F.lit(""))
    held = pages.select(F.col(f"`{key}`").alias("key"), body.alias("payload"), F.sha2(body, 256).alias("digest"))
    first = (held.groupBy("digest").agg(F.min("key").alias("key")).select("digest", name.alias("name")))
    # Only first holders keep their payload; rows that repeat a key are where they were joined.
    once = held.withColumn("name", name).join(first, ["digest", "name"]).dropDuplicates(["digest", "name"])
    once.select("digest", "payload").write.parquet(f"{folder}/payloads")


def read_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """digest, payload as stored; bytes that don't hash to their digest raise an error."""
    stored = spark.read.parquet(f"{folder}/payloads")
    return stored.select("digest", F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("payload doesn't match its digest "), "digest")).cast("binary")).alias("payload"))


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """key, header, payload of every record (the full payload, also of revisits)."""
    return spark.read.parquet(f"{folder}/headers").join(read_payloads(spark, folder), "digest") \
        .select("key", "header", "payload")


def field(header: Column, name: str) -> Column:
    """The value of a header line, null if it isn't there."""
    value = F.regexp_extract(F.concat(header, F.lit(CRLF)), rf"(?s)\r\n{name}: (.*?)\r\n", 1)
    return F.when(F.contains(header, F.lit(f"{CRLF}{name}: ")), value)


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """key, payload_bytes, payload_digest, record_type, refers_to, target_uri, as read from the archive.

    The bytes and the digest are those of the reconstructed payload, taken where it is
    read: no payload is shuffled for them.
    """
    held = read_payloads(spark, folder).select(
        "digest", F.length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"))
    r = spark.read.parquet(f"{folder}/headers").join(held, "digest")
    h = F.col("header")
    return r.select(
        "key", "payload_bytes", "payload_digest", field(h, "WARC-Type").alias("record_type"),
        field(h, "X-Refers-To-Key").cast("long").alias("refers_to"), field(h, "WARC-Target-URI").alias("target_uri"),
        field(h, "WARC-Payload-Digest").alias("header_digest"))


def write_warc(spark: SparkSession, folder: str, out: str) -> None:
    """The archive's records as WARC text files: header, empty line, block, two line ends."""
    r = read_archive(spark, folder)
    block = F.when(field(F.col("header"), "WARC-Type") == "revisit", "").otherwise(F.col("payload").cast("string"))
    r.select(F.concat("header", F.lit(CRLF * 2), block).alias("value")).write.option(
        "lineSep", CRLF * 2).text(out)
