"""Same results when nothing is broadcast: the shuffle-join path of every
lookup (what large dimensions take at scale), with AQE skew splitting forced."""

import re

import pytest

from conftest import SF_ORACLE
from fixtures import build_inbound
from ledgerline.layout import Layout
from ledgerline.plans import silver
from ledgerline.plans.bronze import load_files_to_bronze
from ledgerline.plans.catalog import oracle_sql, queries
from ledgerline.plans.runlog import RunLog
from ledgerline.plans.silver import apply_manual_mapping, load_bronze_to_silver
from oracle import compare, duck

SHUFFLE_ONLY = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
}


@pytest.fixture()
def shuffle_only(spark):
    old = {k: spark.conf.get(k, None) for k in SHUFFLE_ONLY}
    for k, v in SHUFFLE_ONLY.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["map_resolve", "fact_build", "spend_by_category_month",
                                  "account_lookup", "call_tree", "bridge_new_rows"])
def test_catalog_without_broadcast(shuffle_only, name):
    df = queries()[name](shuffle_only, SF_ORACLE)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan
    res = compare(df, duck(SF_ORACLE), oracle_sql()[name])
    assert res["match"] and res["spark_rows"] > 0, res


def test_silver_rows_are_not_dealt_by_configuration_row(shuffle_only, root, monkeypatch):
    """All rows of a file type have one configuration row: dealt by it they would be one task's."""
    build_inbound(root)
    lay, log = Layout(root), RunLog("t")
    plans = []
    taken = silver.append_transactions

    def append_transactions(spark, layout, facts, guid):
        plans.append(facts._jdf.queryExecution().executedPlan().toString())
        return taken(spark, layout, facts, guid)

    monkeypatch.setattr(silver, "append_transactions", append_transactions)
    load_files_to_bronze(shuffle_only, lay, log)
    load_bronze_to_silver(shuffle_only, lay, log)
    assert plans and not re.search(r"hashpartitioning\(Source#\d+, ConfigurationFileID#\d+", plans[0])
    assert f"{lay.silver_dimension('Account')}" not in plans[0]  # an append to it would drop the persisted rows


def test_silver_without_broadcast(shuffle_only, root):
    spark = shuffle_only
    build_inbound(root)
    lay, log = Layout(root), RunLog("t")
    load_files_to_bronze(spark, lay, log)
    load_bronze_to_silver(spark, lay, log)
    mapping = spark.createDataFrame(
        [(v, "B", "C", "P", "S") for v in ["Coffee", "Rent", "Groceries", "Book, paper", "Tea", "Pen"]],
        "SourceValue string, Brand string, Category string, ProductService string, Seller string")
    apply_manual_mapping(spark, lay, mapping)
    res = load_bronze_to_silver(spark, lay, log)
    assert res.transactions_added == 6 and res.held_back_files == 1


def test_hot_source_value_through_silver(shuffle_only, root):
    """One description holds a third of all rows; every row arrives once."""
    from fixtures import COLUMN_CONFIG, FILE_CONFIG, write

    spark = shuffle_only
    write(f"{root}/Admin/ConfigurationFile.txt", FILE_CONFIG)
    write(f"{root}/Admin/ConfigurationColumn.txt", COLUMN_CONFIG)
    lines = ["Date,Amount,Description"]
    for i in range(3000):
        desc = "HOT" if i % 3 == 0 else f"item{i % 200}"
        lines.append(f"2024-{1 + i % 12:02d}-{1 + i % 28:02d},{i}.00,{desc}")
    for part in range(3):
        write(f"{root}/Bronze/Inbound/bank/p{part}.csv",
              "\n".join([lines[0]] + lines[1 + part * 1000: 1 + (part + 1) * 1000]) + "\n")
    lay, log = Layout(root), RunLog("t")
    assert load_files_to_bronze(spark, lay, log).rows_loaded == 3000
    load_bronze_to_silver(spark, lay, log)
    mapping = spark.createDataFrame(
        [("HOT", "B", "C", "P", "S")] + [(f"item{i}", "B", "C", "P", "S") for i in range(200)],
        "SourceValue string, Brand string, Category string, ProductService string, Seller string")
    apply_manual_mapping(spark, lay, mapping)
    res = load_bronze_to_silver(spark, lay, log)
    assert res.transactions_added == 3000 and res.held_back_files == 0
    silver = spark.read.parquet(lay.silver_transaction)
    assert silver.where("Description = 'HOT'").count() == 1000
    assert silver.select("TransactionGUID").distinct().count() == 3000
