"""URL filtering with a sorted digest array that is memory-mapped on the executors.

Entries are strings ``host + path``: allow and block rules, and the hosts and URLs of a
blocklist (a block entry with a lower rank).  Their 64-bit xxhash keys stand sorted in
one file, the strings with their verdicts in a second, in the same order.  Spark ships
the files to the executors, which map them and probe a whole Arrow batch at once by
binary search; the stored string confirms each hit, so that colliding keys can't decide.

An entry fits its host and all subdomains, if the URL's path starts with the entry's.
Rules come before the blocklist; of several the longest string wins, the longer host if
they tie.  Probes of a URL are its host's suffixes at dots, each with the path's beginnings
of the lengths that occur among the entries.

The lists are configuration: they are built on the driver and may hold at most
``MAX_ENTRIES``; a longer list raises an error that says to join tables instead.

Defined cases: a null URL or one without ``://`` has an empty host and path and fits no
entry; equal entries in the lists count once, a rule before the blocklist, block before
allow; an empty list blocks nothing.  Extra columns are ignored.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import shared_folder

MAX_ENTRIES = 20_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


@dataclass(frozen=True)
class Entry:
    host: str
    path: str
    verdict: str  # allow or block
    listed: bool = False  # from the blocklist, not a rule

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Index:
    """Names of the shipped files, and the path lengths that occur."""

    digests: str
    strings: str
    lengths: tuple[int, ...]
    size: int


def build_index(spark: SparkSession, entries: list[Entry]) -> Index:
    """Write the sorted digest array and its strings to the shared folder and ship them."""
    if len(entries) > MAX_ENTRIES:
        raise ValueError(f"more than {MAX_ENTRIES} entries: keep them as a table and join it")
    first: dict[str, Entry] = {}
    for e in sorted(entries, key=lambda e: (e.listed, e.verdict != "block")):
        first.setdefault(e.name, e)
    keyed = sorted((xxhash.xxh64_intdigest(n.encode()), n) for n in first)
    digests = np.array([k for k, _ in keyed], "<u8").tobytes()
    strings = json.dumps([[n, len(first[n].path), first[n].verdict, first[n].listed] for _, n in keyed]).encode()
    folder = shared_folder(spark, "urls")
    names = []
    for kind, data in (("digests", digests), ("strings", strings)):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}-{kind}")
        out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True)
        out.write(bytearray(data))
        out.close()
        spark.sparkContext.addFile(path.toString())
        names.append(path.getName())
    return Index(names[0], names[1], tuple(sorted({len(e.path) for e in first.values()})), len(first))


def probe(digests: np.ndarray, names: np.ndarray, keys: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Place of each text in the index or -1: binary search, then equal digests by their strings."""
    at = np.searchsorted(digests, keys)
    found = np.full(len(keys), -1, np.int64)
    open_ = np.flatnonzero(at < len(digests))
    while len(open_):
        open_ = open_[digests[at[open_]] == keys[open_]]
        same = names[at[open_]] == texts[open_]
        found[open_[same]] = at[open_[same]]
        open_ = open_[~same]
        at[open_] += 1
        open_ = open_[at[open_] < len(digests)]
    return found


def _judge(index: Index):
    def run(batches):
        if index.size:
            digests = np.memmap(SparkFiles.get(index.digests), "<u8", "r")
            with open(SparkFiles.get(index.strings), "rb") as f:
                stored = json.load(f)
        else:
            digests, stored = np.zeros(0, np.uint64), []
        names = np.array([x[0] for x in stored], object)
        for batch in batches:
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            row, text = [], []
            for i, (h, p) in enumerate(zip(hosts, paths)):
                labels = h.split(".") if h else []
                for k in range(len(labels)):
                    suffix = ".".join(labels[k:])
                    for n in index.lengths:
                        if n <= len(p):
                            row.append(i)
                            text.append(suffix + p[:n])
            keys = np.array([xxhash.xxh64_intdigest(t.encode()) for t in text], np.uint64)
            found = probe(digests, names, keys, np.array(text, object))
            rule: list[str | None] = [None] * len(hosts)
            verdict = ["allow"] * len(hosts)
            best = [(-1, -1, -1)] * len(hosts)
            for i, at in zip(np.array(row, np.int64)[found >= 0], found[found >= 0]):
                name, path_len, what, listed = stored[at]
                rank = (not listed, len(name), len(name) - path_len)  # rules first, then the longest
                if rank > best[i]:
                    best[i], verdict[i] = rank, what
                    rule[i] = None if listed else name
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                names=[*batch.schema.names, "rule", "verdict"])

    return run


def judge_urls(pages: DataFrame, index: Index, key: str = "page_id", url: str = "url") -> DataFrame:
    """key, host, path, rule (the entry of a rule that decided, else null), verdict."""
    u = F.col(f"`{url}`")
    slim = pages.select(F.col(f"`{key}`").alias("key"), host_of(u).alias("host"), path_of(u).alias("path"))
    kind = slim.schema["key"].dataType.simpleString()
    out = slim.mapInArrow(_judge(index), f"key {kind}, host string, path string, rule string, verdict string")
    return out.withColumnRenamed("key", key)
