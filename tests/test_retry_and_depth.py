"""Nothing is lost or doubled by a repeat, an undated fact or a deep tree."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.layout import Layout
from ledgerline.plans import silver
from ledgerline.plans.calltree import call_tree
from ledgerline.plans.gold import load_silver_to_gold
from ledgerline.plans.runlog import RunLog
from test_gold import _silver

ROWS = [{"TransactionGUID": f"t{i}", "Date": d, "Source": "s", "SourceFile": "a.csv", "Amount": Decimal("10.00")}
        for i, d in enumerate([dt.date(2024, 1, 1), dt.date(2024, 1, 2), None])]


def test_silver_run_interrupted_before_its_files_are_recorded(spark, root, monkeypatch):
    lay = Layout(root)

    def crash(*a, **k):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(silver, "append", crash)
        with pytest.raises(RuntimeError):
            silver.append_transactions(spark, lay, _silver(spark, ROWS), "run-1")
    assert silver.append_transactions(spark, lay, _silver(spark, ROWS), "run-2") == 3
    load_silver_to_gold(spark, lay, RunLog("t"), years_back=0)
    assert spark.read.parquet(lay.gold_transaction).count() == 3
    assert silver.append_transactions(spark, lay, _silver(spark, ROWS), "run-3") == 0


def test_undated_facts_count_once_in_spend(spark, root, monkeypatch):
    from ledgerline.plans import gold

    lay = Layout(root)
    silver.append_transactions(spark, lay, _silver(spark, ROWS), "run-1")

    def crash(*a, **k):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:  # after the fact, before the spend
        m.setattr(gold, "spend_by_category_month", crash)
        with pytest.raises(RuntimeError):
            load_silver_to_gold(spark, lay, RunLog("t"), years_back=0)
    load_silver_to_gold(spark, lay, RunLog("t"), years_back=0)
    assert spark.read.parquet(lay.gold_transaction).count() == 3
    total = spark.read.parquet(lay.gold_spend).agg(F.sum("Spend"), F.sum("Lines")).first()
    assert (str(total[0]), total[1]) == ("30.00", 3)


def test_call_tree_has_no_depth_limit_and_refuses_cycles(spark):
    chain = spark.createDataFrame([(str(i), str(i - 1) if i else None) for i in range(80)],
                                  "ExecutionGUID string, ParentExecutionGUID string")
    assert call_tree(chain).agg(F.max("depth"), F.count("*")).first() == (79, 80)
    loop = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("b", "c")],
                                 "ExecutionGUID string, ParentExecutionGUID string")
    with pytest.raises(ValueError):
        call_tree(loop)


def test_checkpoint_folder_is_needed_on_a_cluster():
    from ledgerline.session import ensure_checkpoint_dir

    class Conf:
        def get(self, *a):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
