"""Tier 2: the Bronze / Silver / Gold loads on small generated inbound files."""

from pyspark.sql import functions as F

from fixtures import build_inbound
from ledgerline.layout import Layout
from ledgerline.plans.bronze import load_files_to_bronze
from ledgerline.plans.gold import load_silver_to_gold
from ledgerline.plans.runlog import RunLog
from ledgerline.plans.silver import apply_manual_mapping, load_bronze_to_silver, read_dimension

EXPECTED = {
    "good.csv": ("Valid", ""),
    "reordered.CSV": ("Valid", ""),
    "extra.csv": ("Error", "ExtraColumns"),
    "missing.csv": ("Error", "MissingColumns"),
    "both.csv": ("Error", "ExtraColumns.MissingColumns"),
    "dup.csv": ("Error", "ExtraColumns"),
    "header_only.csv": ("Error", "Empty"),
    "zero.csv": ("Error", "Empty"),
    "statement.pdf": ("Ignored", ""),
    "nulls.txt": ("Valid", ""),
    "orders.txt": ("Valid", ""),
    "x.csv": ("NoConfiguration", ""),
}


def _bronze(spark, root):
    build_inbound(root)
    lay = Layout(root)
    log = RunLog("test")
    return lay, log, load_files_to_bronze(spark, lay, log)


def test_each_file_gets_exactly_one_disposition(spark, root):
    _, _, res = _bronze(spark, root)
    got = {r["file_name"]: (r["Disposition"], r["Issue"]) for r in res.dispositions.collect()}
    assert got == EXPECTED


def test_error_target_names(spark, root):
    _, _, res = _bronze(spark, root)
    targets = {r["file_name"]: r["TargetPath"].rsplit("/", 1)[-1]
               for r in res.dispositions.where("Disposition = 'Error'").collect()}
    assert targets["both.csv"] == "both.InvalidColumnHeader.ExtraColumns.MissingColumns.csv"
    assert targets["header_only.csv"] == "header_only.Empty.csv"


def test_rows_in_equal_rows_landed_plus_quarantined(spark, root):
    lay, _, res = _bronze(spark, root)
    valid_lines = sum(r["RowCount"] for r in res.dispositions.where("Disposition = 'Valid'").collect())
    assert res.rows_loaded + res.rows_quarantined == valid_lines == 10
    bad = spark.read.parquet(lay.bronze_quarantine).collect()
    assert [r["_bad_columns"] for r in bad] == [["Date"]]


def test_typed_values_and_quoted_delimiters(spark, root):
    lay, _, _ = _bronze(spark, root)
    b = spark.read.parquet(lay.bronze_transaction)
    amounts = {r["Description"]: str(r["Amount"]) for r in b.collect()}
    assert amounts["Book, paper"] == "-3.00"      # accounting negative, quoted comma
    assert amounts["Tea"] == "4.20"               # currency symbol, other layout
    assert amounts["Rent"] == "1200.00"           # thousands separator
    nulls = b.where("SourceFile = 'nulls.txt'").orderBy("Date").collect()
    assert nulls[0]["Amount"] is None and nulls[0]["Description"] is None  # NULL tokens


def test_bronze_rerun_adds_nothing(spark, root):
    lay, _, _ = _bronze(spark, root)
    before = spark.read.parquet(lay.bronze_transaction).count()
    again = load_files_to_bronze(spark, lay, RunLog("test"))
    assert again.rows_loaded == 0
    assert spark.read.parquet(lay.bronze_transaction).count() == before


def test_silver_gold_flow(spark, root):
    lay, log, _ = _bronze(spark, root)
    first = load_bronze_to_silver(spark, lay, log)
    assert first.transactions_added == 0 and first.to_map_added == 7
    mapping = spark.createDataFrame(
        [(v, "B-" + v, "C-" + v[0], "P-" + v, "Seller") for v in
         ["Coffee", "Rent", "Groceries", "Book, paper", "Tea", "Pen"]],
        "SourceValue string, Brand string, Category string, ProductService string, Seller string")
    assert apply_manual_mapping(spark, lay, mapping) == 6
    second = load_bronze_to_silver(spark, lay, log)
    assert second.bridge_added == 6
    # good.csv has a duplicate row; nulls.txt keeps a NULL description, so it waits
    assert second.transactions_added == 6 and second.held_back_files == 1
    third = load_bronze_to_silver(spark, lay, log)
    assert third.transactions_added == 0 and third.bridge_added == 0
    silver = spark.read.parquet(lay.silver_transaction)
    for dim in ("Brand", "Category", "ProductService", "Seller", "Account"):
        orphans = silver.join(read_dimension(spark, lay, dim), f"{dim}GUID", "left_anti") \
            .where(F.col(f"{dim}GUID").isNotNull()).count()
        assert orphans == 0, dim
    # the shop's Dept column is a configured Lookup: its values became members
    assert {r["Name"] for r in read_dimension(spark, lay, "Category").collect()} >= {"Food", "Office"}
    load_silver_to_gold(spark, lay, log)
    spend = {(r["Category"], str(r["Month"])): float(r["Spend"])
             for r in spark.read.parquet(lay.gold_spend).collect()}
    assert spend[("C-R", "2024-01-01")] == 1200.0
    # the shop's configured Silver expression negates its amounts (charges)
    assert round(sum(spend.values()), 2) == 1200.0 + 12.5 + 40.1 - 3.0 - 4.2 - 1.1
    tea = silver.where("Description = 'Tea'").first()
    assert str(tea["Amount"]) == "-4.20"
    log_df = log.to_frame(spark)
    assert log_df.where("Action = 'LoadBronzeToSilver'").count() == 3


def test_silver_takes_only_pending_loads(spark, root):
    import datetime as dt
    from decimal import Decimal

    from fixtures import write
    from ledgerline import schemas
    from ledgerline.sources.tables import append

    lay, log, _ = _bronze(spark, root)
    mapping = spark.createDataFrame(
        [(v, "B", "C", "P", "S") for v in ["Coffee", "Rent", "Groceries", "Book, paper", "Tea",
                                           "Pen", "Lunch"]],
        "SourceValue string, Brand string, Category string, ProductService string, Seller string")
    load_bronze_to_silver(spark, lay, log)
    apply_manual_mapping(spark, lay, mapping)
    assert load_bronze_to_silver(spark, lay, log).transactions_added == 6
    # an orphan load: Bronze rows whose dispositions were never recorded
    orphan = spark.createDataFrame(
        [(Decimal("9.99"), None, dt.date(2024, 5, 1), "Coffee", "orphan-load", None, "bank",
          "lost.csv")], schemas.BRONZE_TRANSACTION)
    append(orphan, lay.bronze_transaction, ["Source", "ExecutionGUID"])
    # a new file in a later load
    write(f"{root}/Bronze/Inbound/bank/later.csv", "Date,Amount,Description\n2024-06-01,8.00,Lunch\n")
    load_files_to_bronze(spark, lay, log)
    assert load_bronze_to_silver(spark, lay, log).to_map_added == 1   # 'Lunch' waits
    apply_manual_mapping(spark, lay, mapping)
    assert load_bronze_to_silver(spark, lay, log).transactions_added == 1
    assert load_bronze_to_silver(spark, lay, log).transactions_added == 0
    silver = spark.read.parquet(lay.silver_transaction)
    assert silver.where("SourceFile = 'later.csv'").count() == 1
    assert silver.where("SourceFile = 'lost.csv'").count() == 0


def test_hand_maintained_mapping_file(spark, root):
    from fixtures import write

    lay, log, _ = _bronze(spark, root)
    write(f"{root}/Admin/ConfigurationBrandCategoryProductServiceSeller.txt",
          "Account|SourceValue|Brand|Category|ProductService|Seller\n"
          "Checking|Coffee|Cafe|Food|Drinks|Corner Cafe\n"
          "Checking|Rent|Landlord|Housing|Rent|Landlord\n"
          "Checking|Groceries|Shop|Food|Groceries|Market\n"
          "Checking|Book, paper|Shop|Office|Paper|Market\n")
    res = load_bronze_to_silver(spark, lay, log)
    # bank's good.csv and reordered.CSV are fully mapped by the file; nulls.txt waits
    assert res.bridge_added == 4 and res.transactions_added == 4
    cats = {r["Name"] for r in read_dimension(spark, lay, "Category").collect()}
    assert {"Food", "Housing", "Office"} <= cats


def test_rules_see_bronze_values_and_the_load_and_keys_stay(spark, root):
    from fixtures import COLUMN_CONFIG, FILE_CONFIG, write

    # Description is built from Amount and the load's date; Amount is negated beside it.
    columns = COLUMN_CONFIG.replace("2|3|Item|Description|Description|string|Transaction|Description|Direct||Yes", (
        "2|3|Item|Description|Description|string|Transaction|Description|Expression|"
        "concat(Description, ' ', Amount, ' ', year(IngestDatetime) > 2000)|Yes"))
    columns += "1|4||Category|Amount|string|Transaction|Amount|Expression|NoSuchColumn + 1||\n"
    columns = columns.replace("1|2|Amount|Amount|Amount|decimal(18,2)|Transaction|Amount|Direct||Yes\n",
                              "1|2|Amount|Amount||decimal(18,2)|||||\n")
    write(f"{root}/Admin/ConfigurationFile.txt", FILE_CONFIG)
    write(f"{root}/Admin/ConfigurationColumn.txt", columns)
    lay = Layout(root)
    write(f"{lay.bronze_inbound}/shop/o.txt", "Item|Dept|Posted|Total\nTea|Food|03/04/2024|4.20\n"
                                              "Tea|Drinks|03/04/2024|4.20\n|Food|03/04/2024|1.00\n")
    write(f"{lay.bronze_inbound}/bank/b.csv", "Date,Amount,Description\n2024-01-01,1.00,Tea\n")
    log = RunLog("t")
    load_files_to_bronze(spark, lay, log)
    load_bronze_to_silver(spark, lay, log)
    mapping = spark.createDataFrame(
        [("Tea", "B", "C", "P", "S"), (None, "B", "C", "P", "S")],
        "SourceValue string, Brand string, Category string, ProductService string, Seller string")
    apply_manual_mapping(spark, lay, mapping)
    # the bank's rule names no column: its rows wait, the shop's go on
    assert load_bronze_to_silver(spark, lay, log).transactions_added == 3
    rows = spark.read.parquet(lay.silver_transaction).collect()
    assert {(r["Description"], str(r["Amount"])) for r in rows} == {("Tea 4.20 true", "-4.20"), (None, "-1.00")}
    assert len({r["TransactionGUID"] for r in rows}) == 3
    write(f"{root}/Admin/ConfigurationColumn.txt", columns.replace("NoSuchColumn + 1", "Amount + 1"))
    assert load_bronze_to_silver(spark, lay, log).transactions_added == 1
    load_silver_to_gold(spark, lay, log)
    load_silver_to_gold(spark, lay, log)
    brands = spark.read.parquet(lay.gold_dimension("Brand")).collect()
    assert [r["Name"] for r in brands] == ["B"]
    assert spark.read.parquet(lay.gold_transaction).where("Brand = 'B'").count() == 4


def test_date_dimension_stands_before_any_fact(spark, root):
    import datetime as dt

    lay = Layout(root)
    load_silver_to_gold(spark, lay, RunLog("t"), years_back=5)
    year = dt.date.today().year
    dates = spark.read.parquet(lay.gold_date).agg(F.min("Date"), F.max("Date")).first()
    assert tuple(dates) == (dt.date(year - 5, 1, 1), dt.date(year, 12, 31))
