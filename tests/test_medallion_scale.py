"""What the whole flow spends per row: joins with tables not there yet, repeats, files of keys, lines read."""

import datetime as dt
import os
from decimal import Decimal

from fixtures import build_inbound
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.layout import Layout
from ledgerline.operators.dedupe import keep_first
from ledgerline.plans import bronze, silver
from ledgerline.plans.runlog import RunLog
from ledgerline.sources import delimited
from ledgerline.sources.tables import read_columns, read_or_empty

BRONZE = ("Amount decimal(18,2), Category string, Date date, Description string, Source string, SourceFile string, "
          "ExecutionGUID string, IngestDatetime timestamp, ConfigurationFileID int")


def test_a_table_that_is_not_there_joins_without_a_shuffle(spark, tmp_path):
    rows = spark.range(10).select(F.col("id").cast("string").alias("TransactionGUID"))
    for none in (read_columns(spark, f"{tmp_path}/none", "TransactionGUID string, KeyMonth int"),
                 read_or_empty(spark, f"{tmp_path}/none", schemas.silver_transaction_schema())):
        out = rows.join(none, "TransactionGUID", "left_anti")
        assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
        assert out.count() == 10 and none.count() == 0
    assert read_or_empty(spark, f"{tmp_path}/none", schemas.BRIDGE).schema == schemas.BRIDGE


def test_one_load_a_file_keeps_the_rows_of_the_general_way(spark):
    day, t = dt.date(2024, 3, 1), dt.datetime(2024, 4, 1)
    rows = [(Decimal("1.00"), "c", day, "x", "s", "f", "L1", t, 1), (Decimal("1.00"), "c", day, "x", "s", "f", "L1", t, 1),
            (None, None, None, None, "s", "f", "L1", t, 1), (None, None, None, None, "s", "f", "L1", None, 1),
            (Decimal("1.00"), "c", day, "x", "s", "g", "L2", t + dt.timedelta(1), None),
            (Decimal("1.00"), "c", day, "x", "s", "g", "L2", t, None)]
    df = spark.createDataFrame(rows, BRONZE)
    want = keep_first(df, silver.BRONZE_VALUE_COLUMNS, ["IngestDatetime"], ["ExecutionGUID", "ConfigurationFileID"])
    for several in (False, True):
        got = silver.first_rows(df, several)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 3


def test_keys_of_a_month_go_into_few_files(spark, root):
    lay = Layout(root)
    facts = spark.range(0, 240, numPartitions=24).select(
        F.col("id").cast("string").alias("TransactionGUID"), F.lit("s").alias("Source"), F.lit("f").alias("SourceFile"),
        F.make_date(F.lit(2024), (F.col("id") % 3 + 1).cast("int"), F.lit(1)).alias("Date"))
    assert silver.append_transactions(spark, lay, facts, "r1") == 240
    for month in (202401, 202402, 202403):
        assert len([f for f in os.listdir(f"{lay.silver_keys}/KeyMonth={month}") if f.endswith(".parquet")]) <= 2
    assert silver.append_transactions(spark, lay, facts, "r2") == 0  # the recorded run's keys


def test_lines_without_qualified_line_ends_are_read_once(spark, root, monkeypatch):
    build_inbound(root)
    asked = []

    def assembled(lines):
        asked.append(lines)
        return bronze_assemble(lines)

    bronze_assemble = delimited.assemble
    monkeypatch.setattr(delimited, "assemble", assembled)
    monkeypatch.setattr(bronze, "LINES_A_FILE", 2)
    plain = bronze.load_files_to_bronze(spark, Layout(root), RunLog("t"))
    assert plain.rows_loaded > 0 and not asked


def test_a_held_back_file_is_taken_whole_after_the_mapping(spark, root):
    build_inbound(root)
    lay, log = Layout(root), RunLog("t")
    bronze.load_files_to_bronze(spark, lay, log)
    first = silver.load_bronze_to_silver(spark, lay, log)
    values = spark.read.parquet(lay.to_map).select("SourceValue").distinct()
    names = values.select("SourceValue", *[F.lit(d).alias(d) for d in ("Brand", "Category", "ProductService", "Seller")])
    silver.apply_manual_mapping(spark, lay, names)
    second = silver.load_bronze_to_silver(spark, lay, log)
    assert first.held_back_files > 0 and second.held_back_files == 0 and second.to_map_added == 0
    rows = spark.read.parquet(lay.bronze_transaction).select(*silver.BRONZE_VALUE_COLUMNS).distinct().count()
    assert first.transactions_added + second.transactions_added == rows
