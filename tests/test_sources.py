"""Configuration get-or-create, header validation and file moves."""

import os

import pytest

from fixtures import build_inbound, write
from ledgerline import schemas
from ledgerline.layout import Layout
from ledgerline.plans.bronze import load_files_to_bronze
from ledgerline.plans.runlog import RunLog
from ledgerline.sources.config import ConfigurationError, load, retrieve_or_create


def test_missing_config_is_created_with_header(spark, root):
    cf, cc = load(spark, f"{root}/Admin")
    assert cf.count() == 0 and cc.count() == 0
    with open(f"{root}/Admin/ConfigurationFile.txt") as f:
        assert f.read().strip() == "|".join(x.name for x in schemas.CONFIG_FILE.fields)


def test_config_subset_and_order_is_accepted(spark, root):
    write(f"{root}/Admin/ConfigurationFile.txt",
          "Source|ConfigurationFileID|Delimiter\nbank|7|comma\nbank|8|pipe\n")
    cf = retrieve_or_create(spark, f"{root}/Admin/ConfigurationFile.txt", schemas.CONFIG_FILE,
                            ("ConfigurationFileID", "Delimiter", "Source"))
    rows = cf.orderBy("_row").collect()
    assert [(r["Source"], r["ConfigurationFileID"], r["Account"]) for r in rows] == [
        ("bank", 7, None), ("bank", 8, None)]


def test_config_with_unknown_column_is_rejected(spark, root):
    write(f"{root}/Admin/ConfigurationFile.txt", "Source|Nonsense\nbank|x\n")
    with pytest.raises(ConfigurationError):
        retrieve_or_create(spark, f"{root}/Admin/ConfigurationFile.txt", schemas.CONFIG_FILE)


def test_files_move_to_archive_and_error(spark, root):
    build_inbound(root)
    lay = Layout(root)
    load_files_to_bronze(spark, lay, RunLog("test"), source="bank", move_files=True)
    assert os.path.exists(f"{root}/Bronze/Archive/bank/good.csv")
    assert os.path.exists(f"{root}/Bronze/Error/bank/extra.InvalidColumnHeader.ExtraColumns.csv")
    assert os.path.exists(f"{root}/Bronze/Error/bank/header_only.Empty.csv")
    assert not os.path.exists(f"{root}/Bronze/Inbound/bank/good.csv")
    assert os.path.exists(f"{root}/Bronze/Inbound/bank/statement.pdf")   # ignored: left
    assert os.path.exists(f"{root}/Bronze/Inbound/shop/orders.txt")      # other source


def test_unresolvable_expression_disables_source(spark, root):
    from fixtures import COLUMN_CONFIG
    build_inbound(root)
    broken = COLUMN_CONFIG.replace(
        "ColumnIsInNaturalKey\n", "ColumnIsInNaturalKey|Transformation_FileToBronze\n").replace(
        "1|3|Description|Description|Description|string|Transaction|Description|Direct||Yes",
        "1|3|Description|Description|Description|string|Transaction|Description|Direct||Yes|nope * 2")
    write(f"{root}/Admin/ConfigurationColumn.txt", broken)
    log = RunLog("test")
    res = load_files_to_bronze(spark, Layout(root), log)
    got = {r["file_name"]: r["Disposition"] for r in res.dispositions.collect()}
    assert got["good.csv"] == "NoConfiguration" and got["orders.txt"] == "Valid"
    step = [e for e in log.entries if e.action == "RetrieveConfigurations"][0]
    assert step.severity == "Error" and "does not resolve" in step.result


def test_targets_keep_sub_folders(spark, root):
    build_inbound(root)
    write(f"{root}/Bronze/Inbound/bank/2024/jan/good.csv", "Date,Amount,Description\n2024-01-01,1,a\n")
    write(f"{root}/Bronze/Inbound/bank/2024/feb/good.csv", "Date,Amount\n2024-02-01,1\n")
    res = load_files_to_bronze(spark, Layout(root), RunLog("t"), source="bank")
    t = {r["relative"]: r["TargetPath"][len(root):] for r in res.dispositions.collect()
         if r["TargetPath"]}
    assert t["bank/2024/jan/good.csv"] == "/Bronze/Archive/bank/2024/jan/good.csv"
    assert t["bank/2024/feb/good.csv"] == \
        "/Bronze/Error/bank/2024/feb/good.InvalidColumnHeader.MissingColumns.csv"
    assert t["bank/good.csv"] == "/Bronze/Archive/bank/good.csv"
    rows = spark.read.parquet(f"{root}/Bronze/Transaction")
    assert rows.where("SourceFile = '2024/jan/good.csv'").count() == 1
