"""Cleansing: NULL tokens, type coercion with quarantine, Direct/Expression
transformations, first-target-wins renames and alignment to a target schema.

Column rules come from configuration (a handful of rows per source); they are
read on the driver to *build* the plan, while all row work stays in Spark.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import constants as K
from ledgerline.functions.values import coerce, null_tokens_to_null


@dataclass(frozen=True)
class ColumnRule:
    """One column-configuration row, reduced to what a transformation needs."""

    source: str | None          # ColumnName_Bronze (or file column)
    target: str | None          # ColumnName_Silver
    kind: str = K.TRANSFORM_DIRECT
    expression: str | None = None
    datatype: str = "string"
    order: int = 0


def apply_null_tokens(df: DataFrame, columns: list[str] | None = None,
                      tokens: tuple[str, ...] = K.NULL_TOKENS) -> DataFrame:
    columns = columns if columns is not None else [
        f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: null_tokens_to_null(c, tokens) for c in columns})


def coerce_columns(df: DataFrame, types: dict[str, str], bad_column: str = "_bad_columns") -> DataFrame:
    """Cast text columns to declared types; list the columns that failed.

    A cell fails when its text is non-NULL but the typed value is NULL.
    """
    # Columns of their own, so that a cell is parsed once for its value and for the list.
    typed = {c: F.col(f"_typed_{c}") for c in types}
    df = df.withColumns({f"_typed_{c}": coerce(c, t) for c, t in types.items()}) if types else df
    failures = [F.when(F.col(c).isNotNull() & typed[c].isNull(), F.lit(c)) for c in types]
    bad = F.filter(F.array(*failures), lambda x: x.isNotNull()) if failures else \
        F.array().cast("array<string>")
    return df.withColumn(bad_column, bad).withColumns(typed).drop(*[f"_typed_{c}" for c in types])


def split_quarantine(df: DataFrame, bad_column: str = "_bad_columns",
                     keep_bad_column: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows with every cell typed, rows with at least one bad cell)."""
    good = df.where(F.size(bad_column) == 0)
    bad = df.where(F.size(bad_column) > 0)
    return (good if keep_bad_column else good.drop(bad_column)), bad


def rename_first_target_wins(df: DataFrame, pairs: list[tuple[str, str | None]]) -> DataFrame:
    """Rename source -> target in the given order, skipping a NULL target, a
    target already taken earlier, and sources absent from ``df``."""
    seen: set[str] = set()
    mapping: dict[str, str] = {}
    for source, target in pairs:
        if not source or not target or target in seen or source not in df.columns:
            continue
        mapping[source] = target
        seen.add(target)
    return df.withColumnsRenamed(mapping)


def align(df: DataFrame, target: T.StructType | list[str], fill_missing: bool = True) -> DataFrame:
    """Keep the target's columns, in target order.

    With a ``StructType``, missing columns are added as typed NULLs (or left
    out when ``fill_missing`` is false) and present ones are cast.
    """
    if isinstance(target, list):
        return df.select(*[c for c in target if c in df.columns])
    cols: list[Column] = []
    for f in target.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif fill_missing:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def rule_column(rule: ColumnRule) -> Column | None:
    """The Column a Direct or Expression rule produces (None for Lookup)."""
    if rule.kind == K.TRANSFORM_EXPRESSION and rule.expression:
        return F.expr(rule.expression).alias(rule.target)
    if rule.kind == K.TRANSFORM_DIRECT and rule.source:
        return F.col(rule.source).alias(rule.target)
    return None


def apply_rules(df: DataFrame, rules: list[ColumnRule], keep: list[str] | None = None) -> DataFrame:
    """Project ``df`` through Direct/Expression rules in configuration order.

    The first rule for a target wins; ``keep`` columns are carried through.
    """
    seen: set[str] = set()
    cols: list[Column] = [F.col(c) for c in (keep or [])]
    seen.update(keep or [])
    for rule in sorted(rules, key=lambda r: r.order):
        if not rule.target or rule.target in seen:
            continue
        c = rule_column(rule)
        if c is not None:
            cols.append(c)
            seen.add(rule.target)
    return df.select(*cols)
