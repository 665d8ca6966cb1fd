"""availableNow ingest: every file once, later files only once more."""

from fixtures import COLUMN_CONFIG, FILE_CONFIG, build_inbound, write
from ledgerline.layout import Layout
from ledgerline.plans.bronze import load_files_to_bronze
from ledgerline.plans.runlog import RunLog
from ledgerline.streaming.ingest import start_bronze_stream


def test_available_now_takes_each_file_once(spark, root):
    lay = Layout(root)
    write(f"{root}/Admin/ConfigurationFile.txt", FILE_CONFIG)
    write(f"{root}/Admin/ConfigurationColumn.txt", COLUMN_CONFIG)
    write(f"{lay.bronze_inbound}/bank/a.csv",
          "Date,Amount,Description\n2024-01-01,1.00,x\n2024-01-02,bad,y\n")
    q = start_bronze_stream(spark, lay, "bank")
    q.awaitTermination(120)
    assert spark.read.parquet(lay.bronze_transaction).count() == 1
    assert spark.read.parquet(lay.bronze_quarantine).count() == 1
    write(f"{lay.bronze_inbound}/bank/b.csv", "Date,Amount,Description\n2024-01-03,2.50,z\n")
    q = start_bronze_stream(spark, lay, "bank")
    q.awaitTermination(120)
    rows = spark.read.parquet(lay.bronze_transaction)
    assert rows.count() == 2
    assert {r["SourceFile"] for r in rows.collect()} == {"a.csv", "b.csv"}


def test_stream_and_batch_share_the_registry(spark, root):
    """Rejected, empty and reordered files of a stream get their dispositions; a batch load after it adds nothing."""
    build_inbound(root)
    lay = Layout(root)
    start_bronze_stream(spark, lay, "bank").awaitTermination(120)
    disp = spark.read.parquet(lay.disposition)
    got = {r["file_name"]: (r["Disposition"], r["Issue"]) for r in disp.collect()}
    assert got == {"good.csv": ("Valid", ""), "reordered.CSV": ("Valid", ""), "nulls.txt": ("Valid", ""), "extra.csv": ("Error", "ExtraColumns"),
                   "missing.csv": ("Error", "MissingColumns"), "both.csv": ("Error", "ExtraColumns.MissingColumns"),
                   "dup.csv": ("Error", "ExtraColumns"), "header_only.csv": ("Error", "Empty"), "zero.csv": ("Error", "Empty"),
                   "statement.pdf": ("Ignored", "")}
    assert disp.where("size IS NULL OR modified IS NULL").isEmpty()
    rows = spark.read.parquet(lay.bronze_transaction).count()
    assert rows == 7
    assert load_files_to_bronze(spark, lay, RunLog("t"), source="bank").rows_loaded == 0
    assert spark.read.parquet(lay.bronze_transaction).count() == rows
    # and what a batch load has taken the stream leaves alone
    write(f"{lay.bronze_inbound}/bank/next.csv", "Date,Amount,Description\n2024-03-01,5.00,late\n")
    assert load_files_to_bronze(spark, lay, RunLog("t"), source="bank").rows_loaded == 1
    start_bronze_stream(spark, lay, "bank").awaitTermination(120)
    assert spark.read.parquet(lay.bronze_transaction).count() == rows + 1
