"""File-system metadata through the Hadoop FileSystem API of the session.

Only metadata goes through the driver here (listings, renames, one-line
header files); row data is always read by Spark tasks.  Works for any
Hadoop-compatible store (local, HDFS, S3A, ABFS, GCS).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

LISTING_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("uri", T.StringType()),
    T.StructField("relative", T.StringType()),
    T.StructField("file_name", T.StringType()), T.StructField("size", T.LongType()),
    T.StructField("modified", T.LongType()),
])


@dataclass(frozen=True)
class FileInfo:
    path: str
    uri: str          # encoded form, equal to ``_metadata.file_path`` of a scan
    relative: str
    file_name: str
    size: int
    modified: int


_EMPTY_AUTHORITY = re.compile(r"^([A-Za-z][A-Za-z0-9+.-]*):///")


def normalize_uri(uri: str) -> str:
    """'file:///x' and 'file:/x' name the same file; keep the short form."""
    return _EMPTY_AUTHORITY.sub(r"\1:/", uri)


def normalize_uri_col(col):
    from pyspark.sql import functions as F

    return F.regexp_replace(col, r"^([A-Za-z][A-Za-z0-9+.-]*):///", "$1:/")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def qualify(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    return fs.makeQualified(p).toString()


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def hidden(name: str) -> bool:
    """Names Spark itself skips: '_SUCCESS', '.crc' siblings, '_temporary'."""
    return name.startswith(".") or name.startswith("_")


def list_files(spark: SparkSession, root: str) -> list[FileInfo]:
    """Every non-hidden file under ``root`` (recursive), zero-byte ones included."""
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return []
    base = fs.makeQualified(p).toString().rstrip("/") + "/"
    out: list[FileInfo] = []
    it = fs.listFiles(p, True)
    while it.hasNext():
        st = it.next()
        full = st.getPath().toString()
        rel = full[len(base):] if full.startswith(base) else st.getPath().getName()
        if any(hidden(part) for part in rel.split("/")):
            continue
        out.append(FileInfo(full, normalize_uri(st.getPath().toUri().toString()), rel, st.getPath().getName(),
                            int(st.getLen()), int(st.getModificationTime())))
    return out


def listing_frame(spark: SparkSession, root: str) -> DataFrame:
    rows = [(f.path, f.uri, f.relative, f.file_name, f.size, f.modified)
            for f in list_files(spark, root)]
    return spark.createDataFrame(rows, LISTING_SCHEMA)


def mkdirs(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.mkdirs(p))


def rename(spark: SparkSession, src: str, dst: str) -> bool:
    fs, s = _fs(spark, src)
    d = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(dst)
    fs.mkdirs(d.getParent())
    return bool(fs.rename(s, d))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Create (or replace) a small text file, e.g. a header-only config file."""
    fs, p = _fs(spark, path)
    fs.mkdirs(p.getParent())
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def delete(spark: SparkSession, path: str) -> bool:
    """Removes a file or a folder with all it holds; false if there was none."""
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))
