"""Bronze -> Silver.

1. Whole-row de-duplication of Bronze.  Its audit columns don't count for it; those
   of the first load are kept, so that expressions can use them.
2. Accounts: configuration Account names are seeded into the Account
   dimension; each row gets the AccountGUID of the configuration row its file was
   read by (none, if that row is gone since).
3. ToMap -> bridge: names filled into ToMap become dimension members, fully
   resolved (AccountGUID, SourceValue) rows are appended to the bridge.
4. Rows whose (AccountGUID, SourceValue) has no bridge entry go to ToMap; every
   row of a file with such a value is held back (all-or-nothing per file).
5. Configured Lookup columns add dimension members and resolve to GUIDs.
6. Processable rows become Silver transactions with a deterministic GUID over
   the Bronze values that the de-duplication compares (an edited expression keeps
   it); only new GUIDs are appended, so re-runs add nothing.

Appends are ordered bridge -> dimensions -> facts; every append is guarded by
an anti join, so an interrupted run can simply be repeated.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import constants as K
from ledgerline import schemas
from ledgerline.functions.guid import stable_guid
from ledgerline.layout import Layout
from ledgerline.operators.audit import add_silver_audit, observed
from ledgerline.operators.cleanse import align
from ledgerline.operators.dedupe import keep_first
from ledgerline.operators.dimension import new_members, repeated_members, unique_members
from ledgerline.operators.lookup import account_lookup, dimension_lookup
from ledgerline.operators.mapping import (
    GUID_COLUMNS, new_bridge_rows, null_safe_anti, processable_rows, resolve_to_map,
)
from ledgerline.plans.runlog import RunLog
from ledgerline.sources import config as config_source
from ledgerline.sources.files import exists
from ledgerline.sources.tables import append, read_columns, read_or_empty

BRONZE_VALUE_COLUMNS = ["Amount", "Category", "Date", "Description", "Source", "SourceFile"]
BRIDGE_KEY = ["AccountGUID", "SourceValue"]
FILE_KEY = ["Source", "SourceFile"]
CONFIGURATION_KEY = ["Source", "ConfigurationFileID"]
TRANSACTION_KEY = ["Source", "SourceFile", "Date", "Amount", "Description", "Category"]


@dataclass
class SilverResult:
    transactions_added: int
    held_back_files: int
    to_map_added: int
    bridge_added: int


def stored_dimension(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    return read_or_empty(spark, layout.silver_dimension(name), schemas.dimension_schema(name))


def read_dimension(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    """A dimension with each member once, whatever overlapping runs have appended."""
    return unique_members(stored_dimension(spark, layout, name), name)


def report_repeats(spark: SparkSession, layout: Layout, log: RunLog, step) -> None:
    for name, more in sorted(repeated_members({d: stored_dimension(spark, layout, d) for d in K.SILVER_DIMENSIONS}).items()):
        log.warn(step, f"{name}: {more} repeated member row(s); each counts once")


def add_members(spark: SparkSession, layout: Layout, values: DataFrame, columns: str | dict[str, str],
                dimension: str, keys: Sequence[str] = ("Name",)) -> int:
    """Append members missing from a dimension; returns how many were added."""
    dim = stored_dimension(spark, layout, dimension)  # an anti join: repeats don't matter
    fresh, obs = observed(new_members(values, columns, dim, dimension, keys), f"new_{dimension}")
    append(fresh, layout.silver_dimension(dimension))
    return obs.get.get("rows", 0)


def _to_map_pending(to_map: DataFrame, bridge: DataFrame) -> DataFrame:
    """One ToMap row per (AccountGUID, SourceValue) not yet in the bridge.

    Filled-in rows (all four names given) win over blank ones; then the first
    file in name order.
    """
    waiting = null_safe_anti(to_map, bridge.select(*BRIDGE_KEY), BRIDGE_KEY)
    blank = reduce(lambda a, b: a + b, [F.col(d).isNull().cast("int") for d in K.BRIDGE_DIMENSIONS])
    return keep_first(waiting.withColumn("_blank", blank), BRIDGE_KEY, ["_blank", "SourceFile"],
                      list(K.BRIDGE_DIMENSIONS)).drop("_blank")


def apply_manual_mapping(spark: SparkSession, layout: Layout, mapping: DataFrame) -> int:
    """Fill pending ToMap rows from a mapping (SourceValue -> the four names).

    This is what a person does by hand: the filled rows are appended to
    ToMap and resolved by the next Silver run.  A mapping with an ``AccountGUID``
    column holds per account; a NULL SourceValue maps rows without a value.
    """
    to_map = read_or_empty(spark, layout.to_map, schemas.TO_MAP)
    bridge = read_or_empty(spark, layout.bridge, schemas.BRIDGE)
    pending = null_safe_anti(to_map, bridge.select(*BRIDGE_KEY), BRIDGE_KEY) \
        .select("AccountGUID", "SourceValue", "SourceFile").distinct()
    keys = [c for c in BRIDGE_KEY if c in mapping.columns]
    names = mapping.select(*[F.col(c).alias(f"_{c}") for c in keys], *K.BRIDGE_DIMENSIONS)
    filled = pending.join(names, reduce(lambda x, y: x & y, [
        F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys]), "inner")
    filled, obs = observed(align(filled, schemas.TO_MAP), "filled")
    append(filled, layout.to_map)
    return obs.get.get("rows", 0)


def _lookup_rules(cc_rows: list) -> tuple[dict[str, dict[str, list[tuple[int, str]]]], dict[str, list[str]]]:
    """Dimension -> its column -> [(ConfigurationFileID, Bronze column)] from Lookup
    rules, and dimension -> natural key.

    SilverColumn names the dimension's column (Name, if it has no such column).  The key
    is Name with the columns that ColumnIsInNaturalKey marks; dimensions that other
    tables find by name alone (Account and those of the bridge) have Name as their key.
    """
    rules: dict[str, dict[str, list[tuple[int, str]]]] = {}
    marked: set[tuple[str, str]] = set()
    for r in cc_rows:
        entity = r["SilverEntity"] or ""
        if r["Transformation_BronzeToSilver_Type"] != K.TRANSFORM_LOOKUP or not entity.endswith("GUID"):
            continue
        dim = entity[: -len("GUID")]
        if dim not in K.SILVER_DIMENSIONS or not r["ColumnName_Bronze"]:
            continue
        own = [f.name for f in schemas.dimension_schema(dim).fields[2:]]
        column = r["SilverColumn"] if r["SilverColumn"] in own else "Name"
        rules.setdefault(dim, {}).setdefault(column, []).append((r["ConfigurationFileID"], r["ColumnName_Bronze"]))
        if r["ColumnIsInNaturalKey"] == K.NATURAL_KEY_YES and dim not in (K.ACCOUNT_DIMENSION, *K.BRIDGE_DIMENSIONS):
            marked.add((dim, column))
    rules = {d: columns for d, columns in rules.items() if "Name" in columns}
    return rules, {d: ["Name", *sorted(c for e, c in marked if e == d and c != "Name")] for d in rules}


TRANSACTION_ENTITY = "Transaction"


def _transaction_rules(spark: SparkSession, cc_rows: list, rows: DataFrame):
    """(target -> [(ConfigurationFileID, Column)], ConfigurationFileIDs with a broken rule).

    Direct and Expression rules of the Transaction entity, per file type, in
    configuration order.  A rule is checked against the columns of ``rows``, the
    frame it will run on; it can set that frame's Silver columns.
    """
    from ledgerline.operators.expressions import validate_expression
    from ledgerline.plans.bronze import rule_order

    silver_types = {f.name: f.dataType for f in schemas.silver_transaction_schema().fields}
    out: dict[str, list] = {}
    broken: dict[int, str] = {}
    for r in sorted(cc_rows, key=rule_order):
        target, kind = r["ColumnName_Silver"], r["Transformation_BronzeToSilver_Type"]
        if r["SilverEntity"] != TRANSACTION_ENTITY or target not in silver_types:
            continue
        if kind == K.TRANSFORM_EXPRESSION and r["Transformation_BronzeToSilver"]:
            text = r["Transformation_BronzeToSilver"]
        elif kind == K.TRANSFORM_DIRECT and r["ColumnName_Bronze"] and r["ColumnName_Bronze"] != target:
            text = "`" + r["ColumnName_Bronze"].replace("`", "``") + "`"
        else:
            continue
        err = validate_expression(spark, text, rows.schema)
        if not err and target not in rows.columns:
            err = "a rule can't set this column"
        config_id = r["ConfigurationFileID"]
        if err:
            broken[config_id] = f"ConfigurationFileID {config_id}: rule for {target} does not resolve: {err}"
        elif not any(i == config_id for i, _ in out.get(target, [])):  # first rule wins
            out.setdefault(target, []).append((config_id, F.expr(text).cast(silver_types[target])))
    return out, broken


def _apply_transaction_rules(df: DataFrame, rules: dict) -> DataFrame:
    """All rules in one projection: each sees the Bronze values, none another's result."""
    columns = {}
    for target, pairs in rules.items():
        columns[target] = F.col(target)
        for config_id, value in reversed(pairs):
            columns[target] = F.when(F.col("ConfigurationFileID") == config_id, value).otherwise(columns[target])
    return df.withColumns(columns) if columns else df


def _rule_value(pairs: list[tuple[int, str]]) -> Column:
    return F.coalesce(*[F.when(F.col("ConfigurationFileID") == i, F.col(c)) for i, c in pairs])


def pending_bronze(spark: SparkSession, layout: Layout, source: str | None = None) -> tuple[DataFrame, bool]:
    """Bronze rows of valid files not yet taken into Silver, with the
    ConfigurationFileID that each file was read by, and whether a file has several loads.

    The pending file list comes from the file dispositions minus the small
    SilverFiles table (metadata, one row per file); only the Bronze loads that
    hold such files are read, by partition pruning on ExecutionGUID.  Rows of a
    load whose dispositions were never recorded (an interrupted run) are never
    read; that load is simply repeated.
    """
    from ledgerline.plans.bronze import DISPOSITION_SCHEMA, VALID

    disp = read_or_empty(spark, layout.disposition, DISPOSITION_SCHEMA) \
        .where(F.col("Disposition") == VALID)
    if source is not None:
        disp = disp.where(F.col("Source") == source)
    done = read_or_empty(spark, layout.silver_files, schemas.SILVER_FILES).select(*FILE_KEY)
    pending = disp.select(*FILE_KEY, F.col("ExecutionGUID").alias("_load"), "ConfigurationFileID") \
        .join(done.distinct(), FILE_KEY, "left_anti")
    loads = [r["_load"] for r in pending.select("_load").distinct().collect()]
    bronze = read_or_empty(spark, layout.bronze_transaction, schemas.BRONZE_TRANSACTION)
    bronze = bronze.where(F.col("ExecutionGUID").isin(loads))
    keys = pending.groupBy(*FILE_KEY, F.col("_load").alias("ExecutionGUID")).agg(
        F.min("ConfigurationFileID").alias("ConfigurationFileID"))
    several = not keys.groupBy(*FILE_KEY).count().where(F.col("count") > 1).isEmpty()
    return bronze.join(keys, [*FILE_KEY, "ExecutionGUID"]), several


def first_rows(bronze: DataFrame, several: bool) -> DataFrame:
    """Bronze rows without repeats, with the audit columns of the first load.

    Where each file has one load (not ``several``), the load and its configuration row follow from the file, and
    only the time may differ: that is an aggregate by hashing, the general one sorts all rows twice.
    """
    if several:
        return keep_first(bronze, BRONZE_VALUE_COLUMNS, ["IngestDatetime"], ["ExecutionGUID", "ConfigurationFileID"])
    keys = [*BRONZE_VALUE_COLUMNS, "ExecutionGUID", "ConfigurationFileID"]
    # a missing time comes first, as in keep_first
    time = F.when(~F.max(F.col("IngestDatetime").isNull()), F.min("IngestDatetime"))
    return bronze.groupBy(*keys).agg(time.alias("IngestDatetime")) \
        .select(*BRONZE_VALUE_COLUMNS, "IngestDatetime", "ExecutionGUID", "ConfigurationFileID")


def key_month(date: Column) -> Column:
    return (F.year(date) * 100 + F.month(date)).cast("int")


def append_transactions(spark: SparkSession, layout: Layout, facts: DataFrame, run_guid: str) -> int:
    """Append new Silver transactions (partitioned by the Silver run) and
    record their files in SilverFiles; returns the number of rows added.

    The guard is a table of keys, partitioned by the month of the date in the natural key
    (``_key_month``; the Date where it isn't given): the anti join reads the months that the increment
    holds, not the whole history.  Only keys of recorded runs count: what a run wrote before it was interrupted has
    no files recorded, so Gold never takes it, and its files are loaded again.
    """
    if "_key_month" not in facts.columns:
        facts = facts.withColumn("_key_month", key_month(F.col("Date")))
    shaped = align(facts.withColumn("ExecutionGUID", F.lit(run_guid)), T.StructType(
        [*schemas.silver_transaction_schema().fields, T.StructField("_key_month", T.IntegerType())])) \
        .persist(StorageLevel.MEMORY_AND_DISK)
    # File keys come from the input, never from a frame that reads the table
    # being appended to (it would see the new rows after the write).
    files = shaped.select(*FILE_KEY).distinct().select(
        *FILE_KEY, F.lit(run_guid).alias("ExecutionGUID"),
        F.current_timestamp().alias("DateTimeInserted"))
    new = shaped
    if not read_or_empty(spark, layout.silver_files, schemas.SILVER_FILES).isEmpty():  # else no run is recorded: all are new
        done = recorded_keys(spark, layout, [r[0] for r in shaped.select("_key_month").distinct().collect()])  # months
        new = shaped.join(done, "TransactionGUID", "left_anti").persist(StorageLevel.MEMORY_AND_DISK)
    added, obs = observed(new.drop("_key_month"), "silver")
    added.write.mode("append").partitionBy("ExecutionGUID").parquet(layout.silver_transaction)
    # A month's keys go together into few files, not one of each task.
    new.select("TransactionGUID", "ExecutionGUID", F.col("_key_month").alias("KeyMonth")).hint("rebalance", "KeyMonth") \
        .write.mode("append").partitionBy("KeyMonth").parquet(layout.silver_keys)
    append(align(files, schemas.SILVER_FILES), layout.silver_files)
    new.unpersist()
    shaped.unpersist()
    return obs.get.get("rows", 0)


def recorded_keys(spark: SparkSession, layout: Layout, months: list[int | None]) -> DataFrame:
    """TransactionGUIDs of recorded runs whose natural key lies in one of the months.

    A root that an earlier version filled has no table of keys: its first load makes one, with keys of unknown
    months (as for undated rows, partition NULL), which every load reads.
    """
    recorded = read_or_empty(spark, layout.silver_files, schemas.SILVER_FILES).select("ExecutionGUID").distinct()
    ddl = "TransactionGUID string, ExecutionGUID string, KeyMonth int"
    if not exists(spark, layout.silver_keys) and exists(spark, layout.silver_transaction):
        read_columns(spark, layout.silver_transaction, "TransactionGUID string, ExecutionGUID string") \
            .withColumn("KeyMonth", F.lit(None).cast("int")).write.partitionBy("KeyMonth").parquet(layout.silver_keys)
    keys = read_columns(spark, layout.silver_keys, ddl).where(
        F.col("KeyMonth").isNull() | F.col("KeyMonth").isin([m for m in months if m is not None]))
    return keys.join(recorded, "ExecutionGUID", "left_semi").select("TransactionGUID")


def load_bronze_to_silver(spark: SparkSession, layout: Layout, log: RunLog,
                          source: str | None = None,
                          source_value_column: str = "Description") -> SilverResult:
    with log.step("LoadBronzeToSilver", Source=source or "") as main:
        cf, cc = config_source.load(spark, layout.admin)
        cfg = keep_first(cf, CONFIGURATION_KEY, ["_row"], ["Account"]).drop("_row")
        used = {r["ConfigurationFileID"] for r in cfg.collect()}  # configuration only
        cc_rows = [r for r in cc.collect() if r["ConfigurationFileID"] in used]

        bronze, several = pending_bronze(spark, layout, source)
        if several:  # which load's configuration row counts is known after it
            bronze = first_rows(bronze, several)

        with log.step("Accounts") as s:
            report_repeats(spark, layout, log, s)
            s.rows = add_members(spark, layout, cfg, "Account", "Account")
            # Configuration: a few rows per source.  As local rows, the working set below doesn't read the Account
            # dimension: a Lookup's append to it would have Spark drop the persisted rows and compute them again.
            accounts = account_lookup(cfg, read_dimension(spark, layout, "Account")).select(*CONFIGURATION_KEY, "AccountGUID")
            accounts = F.broadcast(spark.createDataFrame(accounts.collect(), accounts.schema))
        # Repeats have no say in what is mapped: that reads three columns of Bronze, and only rows of
        # files that are taken are de-duplicated.
        rows = bronze.join(accounts, CONFIGURATION_KEY, "left").withColumn("SourceValue", F.col(source_value_column))

        with log.step("ResolveToMap") as s:
            to_map = read_or_empty(spark, layout.to_map, schemas.TO_MAP)
            bridge = read_or_empty(spark, layout.bridge, schemas.BRIDGE)
            # Hand-maintained mappings count as filled-in ToMap rows.
            hand = account_lookup(config_source.load_mappings(spark, layout.admin),
                                  read_dimension(spark, layout, "Account"))
            candidates = to_map.unionByName(align(hand, schemas.TO_MAP))
            pending = _to_map_pending(candidates, bridge).persist()
            bridge_added = 0
            if not pending.isEmpty():
                for d in K.BRIDGE_DIMENSIONS:
                    add_members(spark, layout, pending, d, d)
                dims = {d: read_dimension(spark, layout, d) for d in K.BRIDGE_DIMENSIONS}
                resolved = resolve_to_map(pending, dims)
                fresh, obs = observed(new_bridge_rows(resolved.where("resolved"), bridge), "bridge")
                append(align(fresh, schemas.BRIDGE), layout.bridge)
                bridge_added = obs.get.get("rows", 0)
            pending.unpersist()
            s.rows, s.target = bridge_added, layout.bridge

        with log.step("CategoryTree") as s:
            links = config_source.load_categories(spark, layout.admin)
            named = links.select(F.explode(F.array("Category", "ParentCategory")).alias("Category"))
            s.rows = add_members(spark, layout, named, "Category", "Category")

        with log.step("SetAsideUnmapped") as s:
            bridge = read_or_empty(spark, layout.bridge, schemas.BRIDGE)
            to_map = read_or_empty(spark, layout.to_map, schemas.TO_MAP)
            unmapped = null_safe_anti(rows.select(*BRIDGE_KEY, *FILE_KEY), bridge.select(*BRIDGE_KEY), BRIDGE_KEY).distinct() \
                .persist(StorageLevel.MEMORY_AND_DISK)
            new_rows = unmapped.select("AccountGUID", "SourceValue", "SourceFile").distinct()
            new_rows = null_safe_anti(new_rows, to_map, ["AccountGUID", "SourceValue", "SourceFile"])
            new_rows, obs = observed(align(new_rows, schemas.TO_MAP), "to_map")
            append(new_rows, layout.to_map)
            to_map_added = obs.get.get("rows", 0)
            held_files = unmapped.select(*FILE_KEY).distinct().persist()
            held_n = held_files.count()  # before SilverFiles, which these rows are read by, is appended to
            s.rows, s.target = to_map_added, layout.to_map

        # Rows of held-back files stay in Bronze and are taken again next run.
        taken = bronze
        if held_n:
            keyed = bronze.withColumn("_file", F.concat_ws("/", "Source", "SourceFile"))
            held_keys = held_files.select(F.concat_ws("/", "Source", "SourceFile").alias("_file"))
            taken = processable_rows(keyed, held_keys, key="_file").drop("_file")
        unmapped.unpersist()
        if not several:
            taken = first_rows(taken, several)
        rules, keys = _lookup_rules(cc_rows)
        ready = taken.join(accounts, CONFIGURATION_KEY, "left") \
            .withColumn("SourceValue", F.col(source_value_column)) \
            .withColumn("TransactionGUID", stable_guid("Transaction", "AccountGUID", *TRANSACTION_KEY)) \
            .withColumn("_key_month", key_month(F.col("Date")))
        if rules:  # each adds its members first; kept for the run, recomputed from Bronze if an executor is lost
            ready = ready.persist(StorageLevel.MEMORY_AND_DISK)
        working = ready

        with log.step("Transformations") as s:
            t_rules, broken = _transaction_rules(spark, cc_rows, ready)
            for message in broken.values():
                log.warn(s, message + "; its rows are held back")
            if broken:
                ready = ready.where(~F.col("ConfigurationFileID").isin(list(broken)))
            ready = _apply_transaction_rules(ready, t_rules)
            s.parameters["columns"] = ",".join(sorted(t_rules))

        with log.step("Lookups") as s:
            for dim, columns in rules.items():
                own = {c: f"_lk_{dim}_{c}" for c in columns}
                ready = ready.withColumns({own[c]: _rule_value(pairs) for c, pairs in columns.items()})
                add_members(spark, layout, ready, own, dim, keys[dim])
                # Rows may have a GUID of this dimension already (the file's account).
                ready = dimension_lookup(ready.withColumnRenamed(f"{dim}GUID", f"_had_{dim}"),
                                         read_dimension(spark, layout, dim), {k: own[k] for k in keys[dim]}, dim) \
                    .withColumnRenamed(f"{dim}GUID", f"_lkg_{dim}").withColumnRenamed(f"_had_{dim}", f"{dim}GUID") \
                    .drop(*own.values())
            s.parameters["dimensions"] = ",".join(sorted(rules))

        with log.step("WriteTransactions") as s:
            b = bridge.select(*[F.col(c).alias(f"_b_{c}") for c in BRIDGE_KEY],
                                                *GUID_COLUMNS)
            cond = reduce(lambda x, y: x & y,
                          [ready[c].eqNullSafe(b[f"_b_{c}"]) for c in BRIDGE_KEY])
            facts = ready.join(b, cond, "left").drop(*[f"_b_{c}" for c in BRIDGE_KEY])
            for dim in rules:
                col = f"{dim}GUID"
                if col in facts.columns:
                    facts = facts.withColumn(col, F.coalesce(col, f"_lkg_{dim}"))
                else:
                    facts = facts.withColumn(col, F.col(f"_lkg_{dim}"))
            facts = add_silver_audit(facts, main.guid)
            added = append_transactions(spark, layout, facts, main.guid)
            s.rows, s.target = added, layout.silver_transaction

        if held_n:
            log.warn(main, f"{held_n} file(s) held back until their values are mapped")
        held_files.unpersist()
        working.unpersist()
        main.rows = added
    return SilverResult(added, held_n, to_map_added, bridge_added)
