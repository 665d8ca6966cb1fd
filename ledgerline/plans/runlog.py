"""Execution log: one row per pipeline step, with a GUID tree and call stack.

Entries are per *step* (a handful per run), never per row or per file: file
outcomes live in the distributed file-disposition table.  The run's entries
are written once, ordered by Begin, as an append to the log table.
"""

from __future__ import annotations

import datetime as dt
import traceback
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline import schemas
from ledgerline.functions.guid import run_guid


@dataclass
class Step:
    guid: str
    parent: str | None
    call_stack: str
    action: str
    begin: dt.datetime
    parameters: dict[str, str] = field(default_factory=dict)
    rows: int | None = None
    source: str | None = None
    target: str | None = None
    file: str | None = None
    result: str = K.RESULT_SUCCESS
    severity: str = K.SEVERITY_INFO


class RunLog:
    def __init__(self, caller: str, parent_guid: str | None = None):
        self.caller = caller
        self.parent_guid = parent_guid
        self.entries: list[Step] = []
        self._stack: list[Step] = []

    @contextmanager
    def step(self, action: str, **parameters):
        parent = self._stack[-1] if self._stack else None
        s = Step(
            guid=run_guid(),
            parent=parent.guid if parent else self.parent_guid,
            call_stack=(parent.call_stack + K.CALL_STACK_JOINER + action) if parent else action,
            action=action, begin=dt.datetime.now(dt.timezone.utc).replace(tzinfo=None),
            parameters={k: str(v) for k, v in parameters.items()},
        )
        self._stack.append(s)
        try:
            yield s
        except Exception as exc:
            tb = traceback.extract_tb(exc.__traceback__)
            where = tb[-1] if tb else None
            s.severity = K.SEVERITY_ERROR
            s.result = (f"Error in {where.filename if where else self.caller} > "
                        f"{where.name if where else action}() on line "
                        f"{where.lineno if where else '?'}: {exc}")
            raise
        finally:
            self._stack.pop()
            s.end = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
            self.entries.append(s)

    def warn(self, step: Step, message: str) -> None:
        """Record a non-fatal problem on a step (the run continues)."""
        step.severity = K.SEVERITY_ERROR
        step.result = message if step.result == K.RESULT_SUCCESS else step.result + "; " + message

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(e.guid, e.parent, e.begin, getattr(e, "end", e.begin), e.severity, self.caller,
                 e.call_stack, e.action, e.rows, e.source, e.target, e.result, e.file,
                 e.parameters) for e in self.entries]
        return spark.createDataFrame(rows, schemas.LOG).orderBy("Begin")

    def write(self, spark: SparkSession, path: str) -> None:
        """Append this run's entries; an existing log must have the log schema."""
        from ledgerline.sources.tables import read_or_empty

        read_or_empty(spark, path, schemas.LOG)  # raises on a mismatching table
        self.to_frame(spark).coalesce(1).write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.LOG).parquet(path).orderBy("Begin")


def errors(log: DataFrame) -> DataFrame:
    return log.where(F.col("Severity") == K.SEVERITY_ERROR)


def trace(log: DataFrame, execution_guid: str) -> DataFrame:
    """Every step under one execution (itself included), with depth and path."""
    from ledgerline.plans.calltree import call_tree

    tree = call_tree(log.select("ExecutionGUID", "ParentExecutionGUID"))
    under = tree.where(F.col("path").contains(execution_guid))
    return under.join(log.withColumnRenamed("ExecutionGUID", "node"), "node") \
        .select("node", "depth", "path", "Action", "Severity", "Result", "RowCount", "Begin", "End")


def file_trace(spark: SparkSession, layout, source_file: str) -> DataFrame:
    """What happened to a file: its dispositions with the steps of each run."""
    from ledgerline.plans.bronze import DISPOSITION_SCHEMA
    from ledgerline.sources.tables import read_or_empty

    disp = read_or_empty(spark, layout.disposition, DISPOSITION_SCHEMA).where(
        (F.col("file_name") == source_file) | (F.col("SourceFile") == source_file))
    steps = read_log(spark, layout.log).select(
        F.col("ParentExecutionGUID").alias("ExecutionGUID"), F.col("Action").alias("Step"),
        F.col("Severity").alias("StepSeverity"), F.col("Result").alias("StepResult"),
        F.col("RowCount").alias("StepRows"))
    return disp.select("path", "Source", "Disposition", "Issue", "RowCount", "TargetPath",
                       "ExecutionGUID").join(steps, "ExecutionGUID", "left")
