"""Configured expressions that may not run, and date columns with one layout each."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fixtures import COLUMN_CONFIG, FILE_CONFIG, build_inbound, write
from ledgerline.functions.values import coerce
from ledgerline.layout import Layout
from ledgerline.operators.expressions import FUNCTIONS, validate_expression
from ledgerline.plans.bronze import load_files_to_bronze
from ledgerline.plans.runlog import RunLog
from ledgerline.plans.silver import apply_manual_mapping, load_bronze_to_silver

SCHEMA = T.StructType([T.StructField("Amount", T.DecimalType(18, 2)), T.StructField("Description", T.StringType()),
                       T.StructField("Date", T.DateType()), T.StructField("_load", T.StringType())])


@pytest.mark.parametrize("text", [
    "-Amount", "Amount * 1.2 + 3 DIV 2 % 5", "CASE WHEN Amount BETWEEN 1 AND 2 THEN upper(Description) ELSE 'x' END",
    "Description IS NOT NULL AND NOT Description LIKE 'a%' OR Amount IN (1, 2)", "CAST(Amount AS int)", "Amount::string",
    "trim(BOTH ' ' FROM Description) || '!'", "substring(Description FROM 1 FOR 2)", "extract(year FROM Date)",
    "date_add(Date, 3)", "if(Amount <=> NULL, 0, Amount)", "regexp_replace(description, '[0-9]+', '#')", "try_cast(Description AS int)",
    "split(Description, ' ')[0]", "nullif(Description, '')", "position('a' IN Description)", "`Amount`"])
def test_row_values_are_allowed(spark, text):
    assert validate_expression(spark, text, SCHEMA) is None


REFUSED = {
    "java_method('java.lang.System', 'getProperty', 'user.home')": "java_method", "reflect('java.util.UUID', 'randomUUID')": "reflect",
    "concat(Description, uuid())": "uuid", "rand()": "rand", "current_timestamp()": "current_timestamp",
    "monotonically_increasing_id()": "monotonically_increasing_id", "input_file_name()": "input_file_name",
    "sum(Amount)": "sum", "explode(array(1, 2))": "explode", "sum(Amount) OVER (PARTITION BY Description)": "WindowExpression",
    "(SELECT max(x) FROM t)": "ScalarSubquery", "*": "UnresolvedStar", "NoSuchColumn + 1": "does not resolve",
    "_load": "does not resolve", "current_date": "does not resolve", "Amount +": "", "transform(array(Amount), x -> x)": "transform",
    "abs(DISTINCT Amount)": "abs", "session.some_function(Amount)": "some_function", "Amount + array(1)": "", "1) FROM t --": ""}


@pytest.mark.parametrize("text, reason", REFUSED.items())
def test_anything_else_is_refused(spark, text, reason):
    got = validate_expression(spark, text, SCHEMA)
    assert got and reason in got


def test_listed_functions_exist(spark):
    known = {r[0] for r in spark.sql("SHOW FUNCTIONS").collect()}
    assert FUNCTIONS <= known | {"if"}, FUNCTIONS - known


@pytest.mark.parametrize("text", ["java_method('java.lang.System', 'getProperty', 'user.home')", "uuid()", "sum(Amount)",
                                  "explode(array(1, 2))"])
def test_only_the_source_itself_is_held_back(spark, root, text):
    build_inbound(root)
    write(f"{root}/Admin/ConfigurationColumn.txt", COLUMN_CONFIG.replace(
        "1|3|Description|Description|Description|string|Transaction|Description|Direct||Yes",
        f"1|3|Description|Description|Description|string|Transaction|Description|Expression|{text}|Yes"))
    lay, log = Layout(root), RunLog("t")
    load_files_to_bronze(spark, lay, log)
    load_bronze_to_silver(spark, lay, log)
    mapping = spark.createDataFrame([(v, "B", "C", "P", "S") for v in ("Coffee", "Rent", "Groceries", "Book, paper", "Tea", "Pen")],
                                    "SourceValue string, Brand string, Category string, ProductService string, Seller string")
    apply_manual_mapping(spark, lay, mapping)
    load_bronze_to_silver(spark, lay, log)
    silver = spark.read.parquet(lay.silver_transaction).collect()
    assert {r["Source"] for r in silver} == {"shop"} and len(silver) == 2
    said = [e.result for e in log.entries if e.action == "Transformations"]
    assert any("ConfigurationFileID 1: rule for Description does not resolve" in x and "its rows are held back" in x for x in said)


def test_declared_layouts(spark):
    df = spark.createDataFrame([("03/04/2024",), ("25/04/2024",), ("04/25/2024",), ("3.4.2024",), ("2024-04-03",), ("x",)], "t string")
    read = lambda kind: [str(r[0]) for r in df.select(coerce("t", kind)).collect()]
    assert read("date(d/M/yyyy)") == ["2024-04-03", "2024-04-25", "None", "2024-04-03", "2024-04-03", "None"]
    assert read("date(M/d/yyyy)") == ["2024-03-04", "None", "2024-04-25", "2024-03-04", "2024-04-03", "None"]
    assert read("date") == ["2024-03-04", "None", "2024-04-25", "None", "2024-04-03", "None"]
    clock = spark.createDataFrame([("25/04/2024 7:05",), ("25/04/2024 07:05:09",), ("25/04/2024",)], "t string")
    got = [str(r[0]) for r in clock.select(coerce("t", "timestamp(d/M/yyyy)").cast("string")).collect()]
    assert got == ["2024-04-25 07:05:00", "2024-04-25 07:05:09", "2024-04-25 00:00:00"]


def test_one_layout_for_a_column(spark, root):
    """Day first is found from the whole column; another file type of the load keeps its own."""
    write(f"{root}/Admin/ConfigurationFile.txt", FILE_CONFIG + "4|till|comma||Checking||*.csv\n")
    write(f"{root}/Admin/ConfigurationColumn.txt", COLUMN_CONFIG + "4|1|Date|Date|Date|date|||||\n4|2|Amount|Amount|Amount|decimal(18,2)|||||\n")
    lay = Layout(root)
    write(f"{lay.bronze_inbound}/bank/a.csv", "Date,Amount,Description\n03/04/2024,1,a\n25/04/2024,2,b\n2024-04-09,3,c\n04/31/2024,4,d\n")
    write(f"{lay.bronze_inbound}/bank/b.csv", "Date,Amount,Description\n01/02/2024,5,e\n31/01/2024,6,f\n")
    write(f"{lay.bronze_inbound}/till/a.csv", "Date,Amount\n03/04/2024,7\n04/25/2024,8\n")
    res = load_files_to_bronze(spark, lay, RunLog("t"))
    assert (res.rows_loaded, res.rows_quarantined) == (7, 1)
    got = {int(r["Amount"]): str(r["Date"]) for r in spark.read.parquet(lay.bronze_transaction).collect()}
    assert got == {1: "2024-04-03", 2: "2024-04-25", 3: "2024-04-09", 5: "2024-02-01", 6: "2024-01-31", 7: "2024-03-04", 8: "2024-04-25"}
    # the next load's cells fit both orders: what earlier loads counted decides
    write(f"{lay.bronze_inbound}/bank/c.csv", "Date,Amount,Description\n05/06/2024,9,g\n")
    load_files_to_bronze(spark, lay, RunLog("t"))
    assert str(spark.read.parquet(lay.bronze_transaction).where("Amount = 9").first()["Date"]) == "2024-06-05"


def test_an_open_layout_is_set_aside(spark, root):
    write(f"{root}/Admin/ConfigurationFile.txt", FILE_CONFIG)
    write(f"{root}/Admin/ConfigurationColumn.txt", COLUMN_CONFIG)
    lay, log = Layout(root), RunLog("t")
    write(f"{lay.bronze_inbound}/bank/a.csv", "Date,Amount,Description\n03/04/2024,1,a\n2024-04-09,bad,c\n2024-04-10,3,c\n,4,d\n")
    res = load_files_to_bronze(spark, lay, log)
    assert (res.rows_loaded, res.rows_quarantined) == (2, 2)
    bad = spark.read.parquet(lay.bronze_quarantine)
    assert sorted(r["_bad_columns"][0] for r in bad.collect()) == ["Amount", "Date"]
    assert "03/04/2024" in bad.where(F.array_contains("_bad_columns", "Date")).first()["_raw"]
    assert any("fits M/d/yyyy and d/M/yyyy alike" in e.result for e in log.entries if e.action == "WriteBronze")
