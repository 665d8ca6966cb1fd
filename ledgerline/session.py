"""Spark session helpers.

The library never builds its own cluster configuration when a session already
exists: callers on a cluster pass their session in. ``get_session`` is only a
convenience for local runs, tests and the bench.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Tables supplied with the test data; all are single parquet files.
TEST_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "ledgerline") -> SparkSession:
    """Return the active session, or build a local one with sane defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    master = master or os.environ.get("LEDGERLINE_MASTER", "local[8]")
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("LEDGERLINE_DRIVER_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is; without it this raises, since a machine-local folder would lose data
    with its executor.  Only on a local master (tests, local runs) is a fresh
    folder of our own set, on the context (the SQL configuration refuses it).
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a folder that the driver and all "
                f"executors of {sc.master} share")
        current = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def shared_folder(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder that no earlier run has used."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazy accessor: ``Tables(spark, dir).lineitem`` reads one parquet table."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark = spark
        self._dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TEST_TABLES:
            raise AttributeError(name)
        if name not in self._cache:  # one DataFrame per table, so columns resolve
            self._cache[name] = read_table(self._spark, self._dir, name)
        return self._cache[name]
