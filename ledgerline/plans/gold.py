"""Gold layer: date dimension, fact build and spend summaries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_EPOCH = dt.date(1970, 1, 1)


def date_dimension(spark: SparkSession, start: dt.date, end: dt.date,
                   num_partitions: int | None = None) -> DataFrame:
    """One row per day in [start, end], generated in parallel by ``range``."""
    lo, hi = (start - _EPOCH).days, (end - _EPOCH).days
    days = spark.range(lo, hi + 1, numPartitions=num_partitions)
    d = F.date_from_unix_date(F.col("id").cast("int"))
    return days.select(d.alias("Date")).select(
        (F.year("Date") * 10000 + F.month("Date") * 100 + F.dayofmonth("Date")).alias("DateKey"),
        "Date",
        F.year("Date").alias("Year"),
        F.quarter("Date").alias("Quarter"),
        F.month("Date").alias("Month"),
        F.date_format("Date", "MMMM").alias("MonthName"),
        F.dayofmonth("Date").alias("DayOfMonth"),
        F.dayofweek("Date").alias("DayOfWeek"),
        F.date_format("Date", "EEEE").alias("DayName"),
        F.dayofweek("Date").isin(1, 7).alias("IsWeekend"),
    )


def date_range_of(df: DataFrame, column: str) -> tuple[dt.date, dt.date]:
    """(min, max) date of a column: one aggregate row comes back."""
    row = df.agg(F.min(F.to_date(column)).alias("lo"), F.max(F.to_date(column)).alias("hi")).first()
    return row["lo"], row["hi"]


def date_dimension_for(spark: SparkSession, df: DataFrame, column: str,
                       years_back: int = 0) -> DataFrame:
    """Date dimension covering a column's range (optionally more years back)."""
    lo, hi = date_range_of(df, column)
    if lo is None:
        return date_dimension(spark, dt.date.today(), dt.date.today()).limit(0)
    if years_back:
        lo = dt.date(lo.year - years_back, 1, 1)
    return date_dimension(spark, lo, hi)


def date_key(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).alias("DateKey")


def spend_by_category_month(facts: DataFrame, category: str, date: str, amount: str,
                            rollup: bool = False, lines: str | None = None) -> DataFrame:
    """Total spend and line count per category and month (optionally rolled up).

    ``facts`` may already be partial sums: pass ``lines`` to add up a count
    column instead of counting rows.
    """
    month = F.trunc(F.to_date(date), "month").alias("Month")
    n = F.col(lines) if lines else F.lit(1).cast("long")
    keyed = facts.select(F.col(category).alias("Category"), month,
                         F.col(amount).alias("_amt"), n.alias("_n"))
    grouped = keyed.rollup("Category", "Month") if rollup else keyed.groupBy("Category", "Month")
    return grouped.agg(F.sum("_amt").alias("Spend"), F.sum("_n").alias("Lines"))


def category_links(spark: SparkSession, layout) -> DataFrame:
    """(Category, ParentCategory) names: the configured hierarchy, and members that carry their parent's GUID."""
    from ledgerline.plans.silver import read_dimension
    from ledgerline.sources import config as config_source

    members = read_dimension(spark, layout, "Category")
    above = members.select(F.col("CategoryGUID").alias("ParentCategoryGUID"), F.col("Name").alias("ParentCategory"))
    own = members.join(above, "ParentCategoryGUID").select(F.col("Name").alias("Category"), "ParentCategory")
    return config_source.load_categories(spark, layout.admin).select("Category", "ParentCategory").unionByName(own)


def write_category_tree(spark: SparkSession, layout) -> None:
    """The closure of the category hierarchy, and the spend of each category with all below it.

    Both are replaced: the hierarchy may change, and the spend is summed from the summary by category
    and month, not from facts.
    """
    from ledgerline.operators.hierarchy import closure, sums_along
    from ledgerline.sources.files import exists

    tree = closure(category_links(spark, layout), "Category", "ParentCategory")
    tree.write.mode("overwrite").parquet(layout.gold_category_closure)
    if exists(spark, layout.gold_spend):
        spend = spark.read.parquet(layout.gold_spend).select("Category", "Month", "Spend", "Lines")
        sums_along(spend, spark.read.schema(tree.schema).parquet(layout.gold_category_closure), "Category", ["Month"],
                   ["Spend", "Lines"]).write.mode("overwrite").parquet(layout.gold_spend_tree)


def load_silver_to_gold(spark: SparkSession, layout, log, years_back: int = 5):
    """Date dimension, Gold dimensions, transaction fact and spend, incrementally.

    The date dimension comes first and always: it covers the current year and
    ``years_back`` before it, the dates of new facts and what it held before.  New
    members of the Silver dimensions are appended to Gold's.

    The fact is partitioned by YearMonth.  Only new Silver transactions are
    appended, and spend is recomputed only for the months they touch: those
    fact partitions are read (partition pruning) and the matching spend
    partitions are replaced (dynamic partition overwrite).
    """
    from ledgerline import constants as K
    from ledgerline import schemas
    from ledgerline.operators.audit import observed
    from ledgerline.operators.lookup import lookup
    from ledgerline.plans.silver import read_dimension
    from ledgerline.sources.files import exists
    from ledgerline.operators.cleanse import align
    from ledgerline.sources.tables import append, read_columns, read_or_empty

    with log.step("LoadSilverToGold") as main:
        # Silver runs not yet taken into Gold (small bookkeeping tables); only
        # their Silver partitions are read.
        taken = read_or_empty(spark, layout.gold_runs, schemas.GOLD_RUNS) \
            .select(F.col("SilverExecutionGUID").alias("ExecutionGUID")).distinct()
        runs = sorted(r["ExecutionGUID"] for r in read_or_empty(spark, layout.silver_files, schemas.SILVER_FILES)
                      .select("ExecutionGUID").distinct().join(taken, "ExecutionGUID", "left_anti").collect())
        silver = read_or_empty(spark, layout.silver_transaction, schemas.silver_transaction_schema())
        fresh = silver.where(F.col("ExecutionGUID").isin(runs))
        with log.step("DateDimension") as s:
            days = list(date_range_of(fresh, "Date")) if runs else []
            if years_back:
                year = dt.date.today().year
                days += [dt.date(year - years_back, 1, 1), dt.date(year, 12, 31)]
            have = date_range_of(spark.read.parquet(layout.gold_date), "Date") \
                if exists(spark, layout.gold_date) else (None, None)
            days = [d for d in (*days, *have) if d is not None]
            if days and (min(days), max(days)) != have:
                date_dimension(spark, min(days), max(days)).write.mode("overwrite").parquet(layout.gold_date)
            s.target = layout.gold_date
        with log.step("Dimensions") as s:
            for dim in K.SILVER_DIMENSIONS:
                members = read_dimension(spark, layout, dim)
                known = read_columns(spark, layout.gold_dimension(dim), f"{dim}GUID string")
                append(members.join(known, f"{dim}GUID", "left_anti"), layout.gold_dimension(dim))
            s.parameters["dimensions"] = ",".join(K.SILVER_DIMENSIONS)
        with log.step("TransactionFact", runs=len(runs)) as s:
            fact = fresh.withColumn("DateKey", date_key("Date")) \
                .withColumn("YearMonth", (F.year("Date") * 100 + F.month("Date")).cast("int"))
            for dim in ("Account",) + K.BRIDGE_DIMENSIONS:
                d = read_dimension(spark, layout, dim).select(f"{dim}GUID", F.col("Name").alias(dim))
                fact = lookup(fact, d, f"{dim}GUID", f"{dim}GUID", [dim])
            # Months touched come from the new facts only; the lookups leave their dates alone.
            months = [r[0] for r in fresh.select((F.year("Date") * 100 + F.month("Date")).cast("int")).distinct().collect()]
            # A fact without a date has no month, and counts in the spend like any other.
            in_months = F.col("YearMonth").isin([m for m in months if m is not None])
            if None in months:
                in_months = F.coalesce(in_months, F.lit(False)) | F.col("YearMonth").isNull()
            if months:
                # Guard against a repeat after an interrupted run: only the
                # touched month partitions are read.
                done = read_columns(spark, layout.gold_transaction,
                                    "TransactionGUID string, YearMonth int") \
                    .where(in_months).select("TransactionGUID")
                fact = fact.join(done, "TransactionGUID", "left_anti")
            # Rows of a month go together into few files; a large month is split.  The
            # count sits on top: a shuffle found empty would take it away.
            fact, obs = observed(fact.hint("rebalance", "YearMonth"), "gold_fact")
            fact.write.mode("append").partitionBy("YearMonth").parquet(layout.gold_transaction)
            s.rows, s.target = obs.get.get("rows", 0), layout.gold_transaction
        with log.step("SpendByCategoryMonth", months=len(months)) as s:
            if months:
                touched = spark.read.parquet(layout.gold_transaction) \
                    .where(in_months)
                spend = spend_by_category_month(touched, "Category", "Date", "Amount") \
                    .withColumn("YearMonth", (F.year("Month") * 100 + F.month("Month")).cast("int"))
                (spend.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy("YearMonth").parquet(layout.gold_spend))
            s.target = layout.gold_spend
        with log.step("SpendByCategoryTree") as s:
            write_category_tree(spark, layout)
            s.target = layout.gold_spend_tree
        if runs:
            taken_now = spark.createDataFrame(
                [(r, main.guid) for r in runs], "SilverExecutionGUID string, ExecutionGUID string")
            append(align(taken_now.withColumn("DateTimeInserted", F.current_timestamp()),
                         schemas.GOLD_RUNS), layout.gold_runs)
        main.rows = obs.get.get("rows", 0)
