"""Several file types of one source, told apart by FileNamePattern."""

from pyspark.sql import functions as F

from fixtures import write
from ledgerline.functions.text import fits_glob
from ledgerline.layout import Layout
from ledgerline.plans.bronze import load_files_to_bronze
from ledgerline.plans.runlog import RunLog
from ledgerline.plans.silver import load_bronze_to_silver

FILES = """ConfigurationFileID|Source|Delimiter|Account|FileNamePattern
1|bank|comma|Checking|check*.csv
2|bank|semicolon|Card|card/*
3|bank|comma|Other|
4|bank|comma|Twice|
5|shop|comma|Shop|sale?.csv
6|shop|comma|Shop|return*.csv
"""
COLUMNS = """ConfigurationFileID|ConfigurationColumnOrder|ColumnName_File|ColumnName_Bronze|ColumnName_Silver|Datatype|Transformation_FileToBronze|SilverEntity|Transformation_BronzeToSilver_Type|Transformation_BronzeToSilver
1|1|Date|Date||date||||
1|2|Amount|Amount||decimal(18,2)||||
1|3|Description|Description||string||||
2|1|Day|Date||date||||
2|2|Charge|Amount|Amount|decimal(18,2)||Transaction|Expression|-Amount
2|3|Text|Description||string||||
3|1|When|Date||date||||
3|2|Sum|Amount||decimal(18,2)||||
5|1|Date|Date||date||||
5|2|Total|Amount||decimal(18,2)||||
6|1|Date|Date||date||||
6|2|Total|Amount||decimal(18,2)|no_such_column|||
"""
MAPPING = """Account|SourceValue|Brand|Category|ProductService|Seller
Checking|tea|b|c|p|s
Card|tea|b|c|p|s
"""


def test_each_file_is_read_by_the_row_whose_pattern_fits(spark, root):
    write(f"{root}/Admin/ConfigurationFile.txt", FILES)
    write(f"{root}/Admin/ConfigurationColumn.txt", COLUMNS)
    write(f"{root}/Admin/ConfigurationBrandCategoryProductServiceSeller.txt", MAPPING)
    inb = f"{root}/Bronze/Inbound"
    write(f"{inb}/bank/Checking.CSV", "Date,Amount,Description\n2024-01-01,1.00,tea\n")
    write(f"{inb}/bank/card/x.csv", "Day;Charge;Text\n2024-01-02;2.00;tea\n")
    write(f"{inb}/bank/rest.csv", "When,Sum\n2024-01-03,3.00\n")
    write(f"{inb}/bank/check2.csv", "When,Sum\n2024-01-03,3.00\n")
    write(f"{inb}/shop/sale1.csv", "Date,Total\n2024-01-04,4.00\n")
    write(f"{inb}/shop/sales.csv", "Date,Total\n2024-01-05,5.00\n")
    write(f"{inb}/shop/sale10.csv", "Date,Total\n2024-01-06,6.00\n")
    write(f"{inb}/shop/returns.csv", "Date,Total\n2024-01-07,7.00\n")
    lay, log = Layout(root), RunLog("test")
    res = load_files_to_bronze(spark, lay, log)
    got = {r["SourceFile"]: (r["Disposition"], r["ConfigurationFileID"], r["Issue"])
           for r in res.dispositions.collect()}
    assert got == {
        "Checking.CSV": ("Valid", 1, ""),
        "card/x.csv": ("Valid", 2, ""),
        "rest.csv": ("Valid", 3, ""),  # no pattern fits: the first row without one
        "check2.csv": ("Error", 1, "ExtraColumns.MissingColumns"),
        "sale1.csv": ("Valid", 5, ""),
        "sales.csv": ("Valid", 5, ""),
        "sale10.csv": ("Valid", 5, ""),  # nothing fits and no row is without a pattern: the source's first
        "returns.csv": ("NoConfiguration", None, ""),  # its row is unusable: left in place
    }
    notes = " ".join(s.result for s in log.entries if s.result)
    assert "2 file-level configuration rows for pattern ''" in notes

    # Rules and accounts of Silver follow the file's own row.
    load_bronze_to_silver(spark, lay, log)
    load_bronze_to_silver(spark, lay, log)
    facts = spark.read.parquet(lay.silver_transaction).collect()
    account = {r["AccountGUID"]: r["Name"] for r in spark.read.parquet(lay.silver_dimension("Account")).collect()}
    assert sorted((r["SourceFile"], account[r["AccountGUID"]], str(r["Amount"])) for r in facts) == [
        ("Checking.CSV", "Checking", "1.00"), ("card/x.csv", "Card", "-2.00")]


def test_pattern_characters_stand_for_themselves(spark):
    cases = [("a.csv", "*.csv", True), ("aXcsv", "*.csv", False), ("A.CSV", "a.c?v", True), ("a+(1).csv", "a+(1).*", True),
             ("a.csv.bak", "*.csv", False), ("[x].csv", "[x].csv", True), ("x.csv", "[x].csv", False), ("a\nb", "a*", True)]
    df = spark.createDataFrame(cases, "name string, pattern string, want boolean")
    assert [r["got"] for r in df.select(fits_glob("name", "pattern").alias("got")).collect()] == [c[2] for c in cases]
    assert df.where(fits_glob(F.lit(None).cast("string"), "pattern")).isEmpty()
