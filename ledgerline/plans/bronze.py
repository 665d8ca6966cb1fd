"""File -> Bronze.

1. List ``Inbound/<Source>/**`` in tasks (skipping files already given a
   disposition with the same size and modification time).
2. Give each file its configuration row (a Source has one per file type, told
   apart by FileNamePattern) with the expected file columns.
3. Read the lines of candidate files, once, into a table of the load; headers and
   whether fields run over line ends come from it.
4. Give every file exactly one disposition: Valid, Error (header issue or
   Empty), Ignored (not .csv/.txt, or outside a source folder) or
   NoConfiguration (left in place and logged).
5. Parse the valid files' records by their file's layout, map file columns to Bronze
   columns, turn NULL tokens into NULL, coerce to the declared types (with one order of
   day and month for the whole date column), set
   rows with uncastable cells and lines with surplus or missing fields aside
   (``_bad_columns`` says which), add audit columns and append.

The file registry (listing, dispositions, row counts) is a table throughout: each step writes it
to the load's folder and the next reads it again.  The driver sees configuration rows, counts and the distinct
header layouts, never a row per file.

Optionally, file moves follow the dispositions (Archive / Error with the
issue in the name): intents are recorded first, moved by tasks and acknowledged one by one, so that an
interrupted run is carried on by the next.  Without moves, re-runs skip files already recorded.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import constants as K
from ledgerline import schemas
from ledgerline.functions.text import error_file_name, fits_glob
from ledgerline.functions.values import (
    DAY_FIRST, MONTH_FIRST, coerce_ordered, date_family, declared_layout, fits_order, null_tokens_to_null,
)
from ledgerline.layout import Layout
from ledgerline.operators.audit import add_bronze_audit, observed
from ledgerline.operators.cleanse import (
    align, coerce_columns, rename_first_target_wins, split_quarantine,
)
from ledgerline.operators.configuration import expected_columns
from ledgerline.operators.header import header_check, split_header
from ledgerline.operators.layouts import chosen_order, merged
from ledgerline.plans.runlog import RunLog
from ledgerline.sources import config as config_source
from ledgerline.session import shared_folder
from ledgerline.sources.delimited import Layout as FileLayout
from ledgerline.sources.delimited import (
    MALFORMED, add_transitions, file_headers, parse_any, records_of, scan_lines,
)
from ledgerline.sources.files import delete, exists, qualify
from ledgerline.sources.inbound import discover
from ledgerline.sources.tables import append, read_or_empty
from ledgerline.sources.taskfiles import MOVED, move, move_on_driver, tasks_reach

VALID, ERROR, IGNORED, NO_CONFIG = "Valid", "Error", "Ignored", "NoConfiguration"

DISPOSITION_SCHEMA = schemas._struct(
    ("path", schemas.S), ("uri", schemas.S), ("file_name", schemas.S), ("Source", schemas.S),
    ("size", T.LongType()), ("modified", T.LongType()),
    ("ConfigurationFileID", T.IntegerType()), ("header", schemas.S),
    ("RowCount", T.LongType()), ("Issue", schemas.S), ("Disposition", schemas.S),
    ("TargetPath", schemas.S), ("ExecutionGUID", schemas.S), ("SourceFile", schemas.S),
)

DATE = "Date"
COLUMN_LAYOUT = schemas._struct(
    ("ConfigurationFileID", T.IntegerType()), ("ColumnName_Bronze", schemas.S), ("Family", schemas.S),
    ("Cells", T.LongType()), ("MonthFirst", T.LongType()), ("DayFirst", T.LongType()), ("ExecutionGUID", schemas.S))
MOVE_OUTCOME = schemas._struct(("path", schemas.S), ("TargetPath", schemas.S), ("LoadGUID", schemas.S),
                               ("Outcome", schemas.S), ("ExecutionGUID", schemas.S))

BRONZE_TEXT_COLUMNS = ["Amount", "Category", "Date", "Description"]
# What _bad_columns holds for a line with surplus or missing fields.
FIELD_COUNT = "FieldCount"
LINES_A_FILE = 200_000


@dataclass
class BronzeResult:
    dispositions: DataFrame
    rows_loaded: int
    rows_quarantined: int


def _split_by_layout(header: str, layouts: list[tuple[str, str]]):
    """Header text -> array of names, with each row's own delimiter and qualifier."""
    expr = F.lit(None).cast("array<string>")
    for d, q in layouts:
        expr = F.when((F.col("Delimiter") == d) & (F.col("TextQualifier") == q),
                      split_header(F.col(header), d, q)).otherwise(expr)
    return expr


def check_configuration(spark: SparkSession, cf_rows: list, cc_rows: list) -> dict:
    """Configuration problems that make a source unusable, by ConfigurationFileID.

    A configured File -> Bronze expression must resolve against the file's
    (text) columns; its files are then treated as unconfigured (left in place).
    Of several file-level rows of a source with one pattern the first counts; that
    is reported under a ("warning", Source, pattern) key and disables nothing.
    """
    from ledgerline.operators.expressions import validate_expression

    problems: dict = {}
    by_id: dict = {}
    for r in cc_rows:
        by_id.setdefault(r["ConfigurationFileID"], []).append(r)
    for config_id, rows in by_id.items():
        schema = T.StructType([T.StructField(r["ColumnName_File"], T.StringType())
                               for r in rows if r["ColumnName_File"]])
        for r in rows:
            expr = r["Transformation_FileToBronze"]
            if expr:
                err = validate_expression(spark, expr, schema)
                if err:
                    problems[config_id] = (f"ConfigurationFileID {config_id}: expression for "
                                           f"{r['ColumnName_Bronze']} does not resolve: {err}")
    seen: dict = {}
    for r in sorted(cf_rows, key=lambda x: x["_row"]):
        pattern = (r["FileNamePattern"] or "").strip()
        seen.setdefault((r["Source"], pattern), []).append(r["ConfigurationFileID"])
    for (source, pattern), ids in seen.items():
        if len(ids) > 1:
            problems[("warning", source, pattern)] = (
                f"Source {source!r} has {len(ids)} file-level configuration rows for pattern "
                f"{pattern!r}; using ConfigurationFileID {ids[0]}")
    return problems


def source_configuration(cf: DataFrame, cc: DataFrame) -> DataFrame:
    """The file-level rows in full, each with its expected file columns."""
    rows = cf.select("_row", "Source", "ConfigurationFileID", "Delimiter", "TextQualifier", "Account",
                     "DefaultCategory", "FileNamePattern")
    delim = F.coalesce(*[F.when(F.lower(F.trim("Delimiter")) == name, F.lit(ch))
                         for name, ch in K.DELIMITER_NAMES.items()],
                       F.when(F.col("Delimiter").isNull() | (F.col("Delimiter") == ""),
                              F.lit(K.DEFAULT_DELIMITER)),
                       F.col("Delimiter"))
    qualifier = F.when(F.trim("TextQualifier") != "", F.trim("TextQualifier")) \
        .otherwise(K.DEFAULT_QUALIFIER)
    return rows.withColumns({"Delimiter": delim, "TextQualifier": qualifier}).join(
        expected_columns(cc), "ConfigurationFileID", "left")


def choose_configuration(files: DataFrame, cfg: DataFrame, unusable: list[int]) -> DataFrame:
    """Each file with the columns of one configuration row of its Source.

    The first row whose FileNamePattern fits, else the first without a pattern, else
    the first of the Source (the header check tells whether it holds).  A pattern with
    a ``/`` is compared with the path inside the source folder, another with the file
    name.  A file that gets one of the ``unusable`` rows counts as unconfigured.
    """
    kept = [c for c in cfg.columns if c not in ("_row", "Source")]
    per_source = cfg.groupBy("Source").agg(
        F.array_sort(F.collect_list(F.struct("_row", *kept))).alias("_rows"))
    in_source = F.regexp_replace("relative", r"^[^/]*/", "")

    def pattern(row):
        return F.coalesce(F.trim(row.FileNamePattern), F.lit(""))

    def fits(row):
        return (pattern(row) != "") & fits_glob(
            F.when(F.contains(pattern(row), F.lit("/")), in_source).otherwise(F.col("file_name")), pattern(row))

    row = F.coalesce(F.get(F.filter("_rows", fits), F.lit(0)),
                     F.get(F.filter("_rows", lambda r: pattern(r) == ""), F.lit(0)),
                     F.get(F.col("_rows"), F.lit(0)))
    out = files.join(per_source, "Source", "left").withColumn("_chosen", row)
    out = out.select(*files.columns, *[F.col(f"_chosen.{c}").alias(c) for c in kept])
    if unusable:
        out = out.withColumn("ConfigurationFileID", F.when(
            ~F.col("ConfigurationFileID").isin(unusable), F.col("ConfigurationFileID")))
    return out.withColumn("expected", F.when(F.col("ConfigurationFileID").isNotNull(), F.col("expected")))


def target_path(layout: Layout):
    """Archive path for valid files, Error path with the issue in the name.

    Sub-folders below the source folder are kept, so equal file names in
    different sub-folders do not collide.
    """
    sub = F.regexp_extract(F.regexp_replace("relative", r"^[^/]*/", ""), r"^(.*/)?[^/]*$", 1)
    return (F.when(F.col("Disposition") == ERROR, F.concat(
        F.lit(layout.bronze_error + "/"), F.col("Source"), F.lit("/"), sub,
        error_file_name("file_name", "Issue")))
        .when(F.col("Disposition") == VALID, F.concat(
            F.lit(layout.bronze_archive + "/"), F.col("Source"), F.lit("/"), sub,
            F.col("file_name"))))


def with_row_counts(layout: Layout, disp: DataFrame, counts: DataFrame) -> DataFrame:
    """Attach parsed row counts; a header-valid file without rows is Empty."""
    c = counts.select(F.col("_path").alias("number"), F.col("n").alias("_n"))
    joined = disp.join(c, "number", "left")
    valid = F.col("Disposition") == VALID
    empty = valid & (F.coalesce("_n", F.lit(0)) == 0)
    out = (joined.withColumn("RowCount", F.when(valid, F.coalesce("_n", F.lit(0)))
                             .otherwise(F.col("RowCount")))
           .withColumn("Issue", F.when(empty, F.lit(K.EMPTY_TAG)).otherwise(F.col("Issue")))
           .withColumn("Disposition", F.when(empty, F.lit(ERROR)).otherwise(F.col("Disposition"))))
    return out.withColumn("TargetPath", target_path(layout)).drop("_n")


def candidate_lines(spark: SparkSession, folder: str, files: DataFrame, target: str) -> DataFrame:
    """Writes the lines of the files to be checked to ``target``, by configuration row, and reads them again.

    ``path`` is the file's number in the registry: the write sorts a split's lines by configuration row, and a path
    in each would be most of what that sort holds.  Files of LINES_A_FILE lines at most can be dealt out evenly
    to the tasks that parse them.  One reading of every file: what follows sees the same lines, order and splits whatever is
    repeated, and whatever arrives meanwhile.
    """
    wanted = files.where(F.col("accepted") & (F.col("size") > 0) & F.col("expected").isNotNull()
                         & F.col("Source").isNotNull())
    oldest = wanted.agg(F.min("modified")).first()[0]  # files before it need no look
    schema = "path bigint, block bigint, id bigint, line string, kind int, ConfigurationFileID int"
    if oldest is None:
        return spark.createDataFrame([], schema)
    since = dt.datetime.fromtimestamp(oldest // 1000 - 1, dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S")
    known = wanted.select(F.col("path").alias("_path"), "number", "ConfigurationFileID", "Delimiter", "TextQualifier")
    lines = scan_lines(spark, folder, since).join(known, F.col("path") == F.col("_path"))
    add_transitions(lines).select(F.col("number").alias("path"), "block", "id", "line", "kind", "ConfigurationFileID") \
        .write.option("maxRecordsPerFile", LINES_A_FILE).partitionBy("ConfigurationFileID").parquet(target)
    return spark.read.schema(schema).parquet(target)


def dispositions(layout: Layout, files: DataFrame, headers: DataFrame, layouts: list[tuple[str, str]],
                 execution_guid: str) -> DataFrame:
    """One row per discovered file with its disposition and target path."""
    df = files.join(headers.withColumnRenamed("path", "number"), "number", "left").withColumn("actual", _split_by_layout("header", layouts))
    df = header_check(df, "actual", "expected")
    # Zero-byte or blank files; header-only files are found after parsing.
    empty = (F.col("size") == 0) | F.coalesce(F.trim("header") == "", F.lit(True))
    disp = (F.when(F.col("Source").isNull() | ~F.col("accepted"), F.lit(IGNORED))
            .when(F.col("ConfigurationFileID").isNull() | F.col("expected").isNull(), F.lit(NO_CONFIG))
            .when(empty, F.lit(ERROR))
            .when(F.col("Issue") != "", F.lit(ERROR))
            .otherwise(F.lit(VALID)))
    issue = F.when(F.col("Disposition") == ERROR,
                   F.when(empty, F.lit(K.EMPTY_TAG)).otherwise(F.col("Issue"))).otherwise(F.lit(""))
    out = (df.withColumn("Disposition", disp).withColumn("Issue", issue)
           .withColumn("TargetPath", target_path(layout))
           .withColumn("RowCount", F.lit(None).cast("long"))
           .withColumn("ExecutionGUID", F.lit(execution_guid))
           # the path inside the source folder: Bronze's SourceFile
           .withColumn("SourceFile", F.regexp_replace("relative", r"^[^/]*/", "")))
    return out.select(*[f.name for f in DISPOSITION_SCHEMA.fields], "Delimiter", "TextQualifier",
                      "DefaultCategory", "actual", "relative", "header_id", "multi_line", "number")


def rule_order(r) -> tuple:
    """Configured order, rows without one last, then the order of the file."""
    return r["ConfigurationColumnOrder"] is None, r["ConfigurationColumnOrder"] or 0, r["_row"]


def column_rules(cc_rows: list, config_id: int) -> list:
    return sorted([r for r in cc_rows if r["ConfigurationFileID"] == config_id], key=rule_order)


def text_bronze(df: DataFrame, rules: list) -> DataFrame:
    """File columns (text) -> Bronze text columns with NULL tokens gone."""
    # File -> Bronze: an expression when configured, else a first-wins rename.
    exprs = {r["ColumnName_Bronze"]: r["Transformation_FileToBronze"] for r in rules
             if r["ColumnName_Bronze"] and r["Transformation_FileToBronze"]}
    df = df.withColumns({k: F.expr(v) for k, v in exprs.items()}) if exprs else df
    df = rename_first_target_wins(df, [(r["ColumnName_File"], r["ColumnName_Bronze"])
                                       for r in rules if r["ColumnName_Bronze"] not in exprs])
    keep = [c for c in ("_path", MALFORMED) if c in df.columns]
    df = align(df, T.StructType([T.StructField(c, df.schema[c].dataType if c == "_path" else T.StringType())
                                 for c in BRONZE_TEXT_COLUMNS + keep]))
    return df.withColumns({c: null_tokens_to_null(c) for c in BRONZE_TEXT_COLUMNS})


def shape_bronze(df: DataFrame, rules: list) -> DataFrame:
    """File columns -> typed Bronze columns, plus ``_bad_columns`` and ``_raw``.

    The date is read in both orders of day and month unless its layout is declared: ``Date`` month
    first, ``_day_first``, with ``_family`` where the two may differ; ``settle_dates`` chooses.  ``_raw`` is there
    for rows that are bad or may become so then.
    """
    df = text_bronze(df, rules)
    types = {r["ColumnName_Bronze"]: (r["Datatype"] or "string") for r in rules
             if r["ColumnName_Bronze"] in BRONZE_TEXT_COLUMNS}
    base, order = declared_layout(types.get(DATE))
    text = F.when(F.col(MALFORMED).isNull(), F.col(DATE))
    open_order = base.lower() in ("date", "timestamp") and order is None
    cells = F.struct(*BRONZE_TEXT_COLUMNS)
    df = df.withColumns({"_family": date_family(text) if open_order else F.lit(None).cast("string"),
                         "_dated": text.isNotNull(), "_cells": cells})
    family = F.col("_family")
    df = df.withColumns({
        "_month_fits": F.when(family.isNotNull(), fits_order(text, MONTH_FIRST, family)),
        "_day_fits": F.when(family.isNotNull(), fits_order(text, DAY_FIRST, family)),
        "_day_first": F.when(family.isNotNull(), coerce_ordered(DATE, base.lower(), DAY_FIRST, family).cast("date"))
        if open_order else F.lit(None).cast("date")})
    if open_order:
        df = df.withColumn("_month_first", coerce_ordered(DATE, base.lower(), MONTH_FIRST, family))
        typed = coerce_columns(df, {c: t for c, t in types.items() if c != DATE}) \
            .withColumn(DATE, F.col("_month_first")).drop("_month_first")
    else:
        typed = coerce_columns(df, types)
    undated = F.col("_dated") & F.col(DATE).isNull()
    may_be_bad = F.col(MALFORMED).isNotNull() | (F.size("_bad_columns") > 0) | family.isNotNull() | undated
    return typed.withColumn("_raw", F.when(may_be_bad, F.coalesce(MALFORMED, F.to_json("_cells")))) \
        .withColumn("_bad_columns", F.when(
            F.col(MALFORMED).isNotNull(), F.array(F.lit(FIELD_COUNT))).otherwise(F.col("_bad_columns"))) \
        .drop(MALFORMED, "_cells")


def settle_dates(rows: DataFrame, orders: dict[tuple[int, str], str | None]) -> DataFrame:
    """One order of day and month for each file type's date column.

    ``orders``: (ConfigurationFileID, separator) -> order; dates of an open order are bad cells.
    """
    order = F.lit(None).cast("string")
    for (config_id, family), known in orders.items():
        order = F.when((F.col("ConfigurationFileID") == config_id) & (F.col("_family") == family),
                       F.lit(known or "open")).otherwise(order)
    rows = rows.withColumn("_order", order)
    date = F.when(F.col("_order") == DAY_FIRST, F.col("_day_first")).when(F.col("_order") == "open", None).otherwise(F.col(DATE))
    bad = F.col("_dated") & F.col(DATE).isNull() & ~F.array_contains("_bad_columns", DATE)
    return rows.withColumn(DATE, date).withColumn("_bad_columns", F.when(
        bad, F.concat(F.array(F.lit(DATE)), "_bad_columns")).otherwise(F.col("_bad_columns"))) \
        .drop("_order", "_family", "_month_fits", "_day_fits", "_day_first", "_dated")


def date_orders(spark: SparkSession, layout: Layout, rows: DataFrame, execution_guid: str, repeatable: bool):
    """(ConfigurationFileID, separator) -> order, from this load's cells and those counted by earlier loads."""
    cells = rows.where(F.col("_family").isNotNull()).groupBy("ConfigurationFileID", F.col("_family").alias("Family")).agg(
        F.count(F.lit(1)).alias("Cells"), F.sum(F.col("_month_fits").cast("bigint")).alias("MonthFirst"),
        F.sum(F.col("_day_fits").cast("bigint")).alias("DayFirst")) \
        .withColumns({"ColumnName_Bronze": F.lit(DATE), "ExecutionGUID": F.lit(execution_guid)})
    append_once(spark, align(cells, COLUMN_LAYOUT), layout.column_layouts, execution_guid, repeatable)
    known = read_or_empty(spark, layout.column_layouts, COLUMN_LAYOUT).where(F.col("ColumnName_Bronze") == DATE)
    # a row per file type and separator
    return {(r["ConfigurationFileID"], r["Family"]): r["_order"] for r in merged(known, ["ConfigurationFileID"])
            .withColumn("_order", chosen_order()).collect()}


def read_valid(valid: DataFrame, lines: DataFrame, cc_rows: list) -> DataFrame | None:
    """Valid files -> Bronze-shaped typed rows plus ``_path`` (the file's number), ``_bad_columns`` and ``_raw``.

    The driver takes one row per distinct layout; files find theirs by a join.
    """
    key = ["ConfigurationFileID", "Delimiter", "TextQualifier", "actual"]
    found = sorted(valid.groupBy(*key).agg(F.max("multi_line").alias("multi_line")).collect(), key=lambda r: [str(x) for x in r])
    by_config: dict[int, list] = {}
    for r in found:
        by_config.setdefault(r["ConfigurationFileID"], []).append(r)
    frames = []
    for config_id, rows in by_config.items():
        number = F.lit(None).cast("int")
        for i, r in enumerate(rows):
            number = F.when((F.col("Delimiter") == r["Delimiter"]) & (F.col("TextQualifier") == r["TextQualifier"])
                            & (F.col("actual") == F.array(*[F.lit(c) for c in r["actual"]])), i).otherwise(number)
        files = valid.where(F.col("ConfigurationFileID") == config_id) \
            .select(F.col("number").alias("path"), "header_id", "multi_line", number.alias("_layout"))
        own = lines.where(F.col("ConfigurationFileID") == config_id).drop("ConfigurationFileID")
        layouts = [FileLayout(r["Delimiter"], r["TextQualifier"], tuple(r["actual"])) for r in rows]
        records = records_of(own, files, ["_layout"], multi_line=any(r["multi_line"] for r in rows))
        df = parse_any(records, layouts, "_layout").withColumnRenamed("path", "_path")
        frames.append(shape_bronze(df, column_rules(cc_rows, config_id)))
    if not frames:
        return None
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def load_files_to_bronze(spark: SparkSession, layout: Layout, log: RunLog,
                         source: str | None = None, move_files: bool = False,
                         listed: DataFrame | None = None, guid: str | None = None) -> BronzeResult:
    """Loads the files below Inbound, or those of ``listed`` (columns as ``discover`` returns them)."""
    with log.step("LoadFileToBronze", Source=source or "") as main:
        main.guid = guid or main.guid
        with log.step("RetrieveConfigurations") as s:
            cf, cc = config_source.load(spark, layout.admin)
            cc_rows = cc.collect()  # configuration: a few rows per source
            s.file = layout.admin
            problems = check_configuration(spark, cf.collect(), cc_rows)
            for message in problems.values():
                log.warn(s, message)
        # A few rows per source: materialise once as a local relation so later
        # actions do not re-read and re-aggregate the configuration files.
        cfg_frame = source_configuration(cf, cc)
        cfg_rows = cfg_frame.collect()
        cfg = spark.createDataFrame(cfg_rows, cfg_frame.schema)
        layouts = sorted({(r["Delimiter"], r["TextQualifier"]) for r in cfg_rows})
        unusable = [k for k in problems if isinstance(k, int)]
        registry = shared_folder(spark, "registry")

        def kept(df: DataFrame, name: str) -> DataFrame:
            """``df`` written to the load's folder and read again."""
            df.write.parquet(f"{registry}/{name}")
            return spark.read.schema(df.schema).parquet(f"{registry}/{name}")

        with log.step("DiscoverInbound") as s:
            files = listed if listed is not None else discover(spark, layout.bronze_inbound, source)
            done = read_or_empty(spark, layout.disposition, DISPOSITION_SCHEMA) \
                .where(F.col("Disposition").isin(VALID, ERROR)).select("path", "size", "modified")
            files = files.join(done, ["path", "size", "modified"], "left_anti")
            files = kept(choose_configuration(files, cfg, unusable)
                         .withColumn("number", F.monotonically_increasing_id()), "files")
            s.source = layout.bronze_inbound

        with log.step("ValidateColumnHeaders") as s:
            folder = layout.bronze_inbound if source is None else f"{layout.bronze_inbound}/{source}"
            lines = candidate_lines(spark, folder, files, f"{registry}/lines")
            disp = kept(dispositions(layout, files, file_headers(lines), layouts, main.guid), "checked")
            s.parameters.update({r["Disposition"]: str(r["n"]) for r in
                                 disp.groupBy("Disposition").agg(F.count(F.lit(1)).alias("n")).collect()})
            missing = [r["Source"] for r in disp.where(F.col("Disposition") == NO_CONFIG)
                       .select("Source").distinct().collect() if r["Source"]]
            if missing:
                log.warn(s, "Files left in place, source(s) without configuration: "
                         + ", ".join(sorted(missing)))

        loaded = quarantined = 0
        rows = read_valid(disp.where(F.col("Disposition") == VALID), lines, cc_rows)
        if rows is not None:
            with log.step("WriteBronze") as s:
                file_meta = disp.where(F.col("Disposition") == VALID).select(
                    F.col("number").alias("_path"), "SourceFile", "Source", "DefaultCategory", "ConfigurationFileID")
                # Parsed once: good and bad rows are two writes over one persisted
                # parse (memory and disk; recomputable from the lines if lost).  What is the
                # same for a whole file is not kept with each row.
                parsed = rows.persist(StorageLevel.MEMORY_AND_DISK)
                rows = parsed.join(file_meta, "_path", "left").withColumn(
                    "Category", F.coalesce("Category", "DefaultCategory"))
                rows = add_bronze_audit(rows, main.guid, "Source", "SourceFile", F.lit(dt.datetime.now(dt.timezone.utc)))
                orders = date_orders(spark, layout, rows, main.guid, guid is not None)
                for (config_id, family), known in sorted(orders.items()):
                    if known is None:
                        log.warn(s, f"ConfigurationFileID {config_id}: {DATE} fits M{family}d{family}yyyy and "
                                    f"d{family}M{family}yyyy alike; its rows are set aside until one is configured")
                good, bad = split_quarantine(settle_dates(rows, orders), keep_bad_column=True)
                bad = bad.select(
                    "Source", "SourceFile", "_raw", "_bad_columns", "ExecutionGUID", "IngestDatetime")
                good, obs = observed(align(good, schemas.BRONZE_TRANSACTION), "bronze_rows")
                # Partitioned by source and load: Silver reads only the loads
                # that still have files to take (partition pruning).  A load that is
                # repeated under its own GUID replaces what it wrote before.
                (good.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy("Source", "ExecutionGUID").parquet(layout.bronze_transaction))
                loaded = obs.get.get("rows", 0)
                bad, obs_bad = observed(bad, "bronze_bad_rows")
                append_once(spark, bad, layout.bronze_quarantine, main.guid, guid is not None)
                quarantined = obs_bad.get.get("rows", 0) if guid is None else bad.count()
                counts = parsed.groupBy("_path").agg(F.count(F.lit(1)).alias("n"))
                disp = kept(with_row_counts(layout, disp, counts), "counted")
                parsed.unpersist()
                s.rows, s.target = loaded, layout.bronze_transaction
                if quarantined:
                    log.warn(s, f"{quarantined} row(s) with uncastable cells set aside")

        with log.step("RecordDispositions") as s:
            if move_files:
                intents = disp.where(F.col("TargetPath").isNotNull()).select("path", "TargetPath", "ExecutionGUID")
                append_once(spark, intents, layout.move_intents, main.guid, guid is not None)
            append_once(spark, disp.select(*[f.name for f in DISPOSITION_SCHEMA.fields]), layout.disposition,
                        main.guid, guid is not None)
            s.target = layout.disposition
        if move_files:
            with log.step("MoveFiles") as s:
                outcomes = carry_out_moves(spark, layout, main.guid)
                s.rows = outcomes.pop(MOVED, 0)
                s.parameters.update({k: str(v) for k, v in outcomes.items()})
        # The lines are needed no more; the registry stays for the result's readers.
        if exists(spark, f"{registry}/lines"):
            delete(spark, f"{registry}/lines")
        main.rows = loaded
    return BronzeResult(disp, loaded, quarantined)


def append_once(spark: SparkSession, df: DataFrame, table: str, guid: str, repeatable: bool) -> None:
    """Appends rows of a load; of a load that may be handed over again, only where its first try did not."""
    if repeatable and exists(spark, table) and not spark.read.schema("ExecutionGUID string").parquet(table) \
            .where(F.col("ExecutionGUID") == guid).isEmpty():
        return
    append(df, table)


def carry_out_moves(spark: SparkSession, layout: Layout, execution_guid: str) -> dict[str, int]:
    """Moves every file with a recorded intent and no acknowledgement; (outcome -> files).

    Also those of earlier loads that were interrupted.  Tasks move the files and acknowledge each; a
    repeated task finds what it has moved at its target.
    """
    root = qualify(spark, layout.root).rstrip("/")
    intents = spark.read.schema("path string, TargetPath string, ExecutionGUID string").parquet(layout.move_intents) \
        .select("path", "TargetPath", F.col("ExecutionGUID").alias("LoadGUID"))
    intents = intents.withColumn("TargetPath", F.concat(F.lit(root), F.substring(
        "TargetPath", len(layout.root.rstrip("/")) + 1, 1 << 20)))
    acknowledged = read_or_empty(spark, layout.move_outcomes, MOVE_OUTCOME)
    open_moves = intents.join(acknowledged.select("path", "LoadGUID"), ["path", "LoadGUID"], "left_anti")
    done = move(open_moves, root) if tasks_reach(root) else move_on_driver(spark, open_moves)
    append(done.withColumn("ExecutionGUID", F.lit(execution_guid)), layout.move_outcomes)
    return {r["Outcome"]: r["n"] for r in spark.read.schema(MOVE_OUTCOME).parquet(layout.move_outcomes)
            .where(F.col("ExecutionGUID") == execution_guid).groupBy("Outcome").agg(F.count(F.lit(1)).alias("n")).collect()}
