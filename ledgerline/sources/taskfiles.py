"""Listing and moving files from executor tasks.

Tasks reach the files through Arrow's file systems, which open the same stores as Hadoop's
under the names below.  The driver looks once whether Arrow sees the pipeline's folder; where
it doesn't (another scheme, no native client, other credentials), listing and moving fall back to the
session's Hadoop file system on the driver.

Moves are safe to repeat: a target is never replaced, a file that is gone while its target is there
counts as moved, and each file gets an acknowledgement, so that a load that was
interrupted half way goes on where it stopped.
"""

from __future__ import annotations

import posixpath
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.sources import files as driver_files

ARROW_SCHEMES = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}
ENTRY = "path string, relative string, is_folder boolean, size bigint, modified bigint"
MOVED, TARGET_EXISTS, MISSING = "Moved", "TargetExists", "Missing"
ACK = "path string, TargetPath string, LoadGUID string, Outcome string"


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """Arrow's file system of a Hadoop path, and the path inside it."""
    scheme, _, rest = uri.partition(":")
    if scheme not in ARROW_SCHEMES:
        raise ValueError(f"no Arrow file system for {uri}")
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    authority, _, path = rest.removeprefix("//").partition("/")
    fs, base = pafs.FileSystem.from_uri(f"{ARROW_SCHEMES[scheme]}://{authority}/")
    return fs, posixpath.join(base or "/", path)


def tasks_reach(uri: str) -> bool:
    try:
        fs, path = open_folder(uri)
        return fs.get_file_info(path).type == pafs.FileType.Directory
    except (ValueError, OSError, ImportError):
        return False


def list_below(folders: DataFrame, root: str, recursive: bool) -> DataFrame:
    """ENTRY rows of what the folders (relative to ``root``) hold, a folder at a time in the tasks."""
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_folder(root)
        for b in batches:
            waiting = b["relative"].to_pylist()
            while waiting:
                folder = waiting.pop()
                found = [i for i in fs.get_file_info(pafs.FileSelector(posixpath.join(base, folder)))
                         if not driver_files.hidden(i.base_name)]
                names = [posixpath.join(folder, i.base_name) for i in found]
                folder_flags = [i.type == pafs.FileType.Directory for i in found]
                if recursive:
                    waiting += [n for n, f in zip(names, folder_flags) if f]
                yield pa.RecordBatch.from_arrays([
                    pa.array([f"{root}/{n}" for n in names], pa.string()), pa.array(names, pa.string()), pa.array(folder_flags, pa.bool_()),
                    pa.array([i.size or 0 for i in found], pa.int64()), pa.array([(i.mtime_ns or 0) // 1_000_000 for i in found], pa.int64())],
                    names=["path", "relative", "is_folder", "size", "modified"])

    return folders.select("relative").mapInArrow(walk, ENTRY)


def listing(spark: SparkSession, root: str) -> DataFrame:
    """(path, uri, relative, file_name, size, modified) of every file below ``root``, empty ones too.

    The driver knows the first level of folders (a source each); their contents are listed by
    tasks, those of the second level in parallel.
    """
    if not driver_files.exists(spark, root):
        return spark.createDataFrame([], driver_files.LISTING_SCHEMA)
    base = driver_files.qualify(spark, root).rstrip("/")
    if not tasks_reach(base):
        return driver_files.listing_frame(spark, root)
    top = spark.createDataFrame([("",)], "relative string")
    first = list_below(top, base, recursive=False)
    sources = [(r["relative"],) for r in first.where("is_folder").select("relative").collect()]  # one row a source
    entries = first
    if sources:
        inside = list_below(spark.createDataFrame(sources, "relative string").repartition(len(sources)), base, recursive=False)
        deeper = inside.where("is_folder").repartition("relative")
        entries = first.unionByName(inside).unionByName(list_below(deeper, base, recursive=True))
    return entries.where("NOT is_folder").select(
        "path", F.col("path").alias("uri"), "relative", F.regexp_extract("relative", "([^/]*)$", 1).alias("file_name"), "size", "modified")


def move(files: DataFrame, root: str) -> DataFrame:
    """ACK rows: every (path, TargetPath), both below ``root``, moved, or why not."""
    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_folder(root)
        for b in batches:
            outcomes = []
            for path, target in zip(b["path"].to_pylist(), b["TargetPath"].to_pylist()):
                old, new = (posixpath.join(base, p.removeprefix(root + "/")) for p in (path, target))
                here, there = (i.type == pafs.FileType.File for i in fs.get_file_info([old, new]))
                if here and not there:
                    fs.create_dir(posixpath.dirname(new), recursive=True)
                    fs.move(old, new)
                outcomes.append(TARGET_EXISTS if here and there else MOVED if here or there else MISSING)
            yield pa.RecordBatch.from_arrays([b["path"], b["TargetPath"], b["LoadGUID"], pa.array(outcomes, pa.string())],
                                             names=["path", "TargetPath", "LoadGUID", "Outcome"])

    return files.select("path", "TargetPath", "LoadGUID").mapInArrow(carry, ACK)


def move_on_driver(spark: SparkSession, files: DataFrame) -> DataFrame:
    """The same through the session's Hadoop file system, a row at a time."""
    done = []
    for r in files.select("path", "TargetPath", "LoadGUID").toLocalIterator():
        here, there = driver_files.exists(spark, r["path"]), driver_files.exists(spark, r["TargetPath"])
        if here and not there:
            driver_files.rename(spark, r["path"], r["TargetPath"])
        done.append((r["path"], r["TargetPath"], r["LoadGUID"], TARGET_EXISTS if here and there else MOVED if here or there else MISSING))
    return spark.createDataFrame(done, ACK)
