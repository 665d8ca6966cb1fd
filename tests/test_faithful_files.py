"""Lines and headers are read as they stand: nothing cut, padded or split wrongly."""

from fixtures import COLUMN_CONFIG, FILE_CONFIG, write
from ledgerline.layout import Layout
from ledgerline.plans import bronze
from ledgerline.plans.bronze import load_files_to_bronze
from ledgerline.plans.runlog import RunLog
from ledgerline.streaming import ingest

NEW_FILE = "4|quirky|comma|'|Checking||*.csv\n"
NEW_COLUMNS = ("4|1|Date|Date|Date|date|Transaction|Date|Direct||\n"
               "4|2|Amount, USD|Amount|Amount|decimal(18,2)|Transaction|Amount|Direct||\n"
               "4|3|Description|Description|Description|string|Transaction|Description|Direct||\n")


def _load(spark, root, files):
    write(f"{root}/Admin/ConfigurationFile.txt", FILE_CONFIG + NEW_FILE)
    write(f"{root}/Admin/ConfigurationColumn.txt", COLUMN_CONFIG + NEW_COLUMNS)
    lay = Layout(root)
    for name, text in files.items():
        write(f"{lay.bronze_inbound}/{name}", text)
    return lay, load_files_to_bronze(spark, lay, RunLog("t"))


def test_surplus_and_short_lines_are_set_aside_whole(spark, root):
    lay, res = _load(spark, root, {"bank/a.csv": "Date,Amount,Description\n2024-01-05,1,200.00,Rent\n"
                                                 "2024-01-06,2.00\n2024-01-07,3.00,Tea\n"})
    assert (res.rows_loaded, res.rows_quarantined) == (1, 2)
    bad = {r["_raw"]: r["_bad_columns"] for r in spark.read.parquet(lay.bronze_quarantine).collect()}
    assert bad == {"2024-01-05,1,200.00,Rent": ["FieldCount"], "2024-01-06,2.00": ["FieldCount"]}


def test_qualified_line_ends_and_doubled_qualifiers(spark, root):
    lay, res = _load(spark, root, {
        "bank/a.csv": 'Date,Amount,Description\n2024-01-05,1.00,"two\nlines"\n2024-01-06,2.00,"a ""b"", c"\n',
        "bank/b.csv": 'Date,Amount,Description\n2024-01-05,1.00,5" pipe\n2024-01-06,2.00,plain\n'})
    assert (res.rows_loaded, res.rows_quarantined) == (4, 0)
    got = {r["Description"] for r in spark.read.parquet(lay.bronze_transaction).collect()}
    assert got == {"two\nlines", 'a "b", c', '5" pipe', "plain"}


def test_header_with_delimiter_in_a_name_and_own_qualifier(spark, root):
    lay, res = _load(spark, root, {"quirky/q.csv": "Date,'Amount, USD',Description\n2024-01-05,'1,200.00','it''s'\n"})
    assert [(r["Disposition"], r["Issue"]) for r in res.dispositions.collect()] == [("Valid", "")]
    row = spark.read.parquet(lay.bronze_transaction).first()
    assert (str(row["Amount"]), row["Description"]) == ("1200.00", "it's")


def test_a_repeated_batch_adds_nothing(spark, root, monkeypatch):
    write(f"{root}/Admin/ConfigurationFile.txt", FILE_CONFIG)
    write(f"{root}/Admin/ConfigurationColumn.txt", COLUMN_CONFIG)
    lay = Layout(root)
    write(f"{lay.bronze_inbound}/bank/sub/a b.Csv",
          "Date,Amount,Description\n2024-01-01,1.00,x\n2024-01-02,bad,y\n2024-01-03,1,2,z\n")
    real = bronze.append

    def crash_at_dispositions(df, path, *a):
        if path == lay.disposition:
            raise RuntimeError("lost")
        real(df, path, *a)

    with monkeypatch.context() as m:
        m.setattr(bronze, "append", crash_at_dispositions)
        try:
            ingest.start_bronze_stream(spark, lay, "bank").awaitTermination(120)
        except Exception as exc:
            assert "lost" in str(exc)
    assert spark.read.parquet(lay.bronze_quarantine).count() == 2
    ingest.start_bronze_stream(spark, lay, "bank").awaitTermination(120)
    assert spark.read.parquet(lay.bronze_transaction).count() == 1
    assert spark.read.parquet(lay.bronze_quarantine).count() == 2
    disp = spark.read.parquet(lay.disposition).collect()
    assert [(r["SourceFile"], r["RowCount"]) for r in disp] == [("sub/a b.Csv", 3)]
