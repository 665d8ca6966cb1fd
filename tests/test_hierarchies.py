"""Call trees and category hierarchies by doubling, dimension members once, guards by month."""

import datetime as dt
import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fixtures import build_inbound, write
from ledgerline.layout import Layout
from ledgerline.operators.hierarchy import closure
from ledgerline.plans import calltree, silver
from ledgerline.plans.bronze import load_files_to_bronze
from ledgerline.plans.calltree import call_tree
from ledgerline.plans.gold import load_silver_to_gold
from ledgerline.plans.runlog import RunLog
from ledgerline.plans.silver import apply_manual_mapping, load_bronze_to_silver
from test_gold import _silver

EDGE = "ExecutionGUID string, ParentExecutionGUID string"


def brute_tree(pairs):
    pairs = {(n, p) for n, p in pairs if n is not None}
    nodes = {n for n, _ in pairs}
    out = [(n, p, 0, n, n) for n, p in pairs if p not in nodes]
    level = out
    for _ in range(len(pairs) + 1):
        level = [(n, p, d + 1, r, f"{path} > {n}") for m, _, d, r, path in level for n, p in pairs if p == m]
        if not level:
            return sorted(out, key=str)
        out = out + level
    raise ValueError("cycle")


@pytest.mark.parametrize("pairs", [
    [], [("a", None)], [("a", "x"), ("b", "a"), ("b", "a"), (None, "a")], [("a", None), ("b", "a"), ("c", "a"), ("d", "b"), ("d", "c"), ("e", "d")],
    [("a", None), ("a", "b"), ("b", None), ("c", "a")],
    [(f"n{i}", f"n{random.Random(i).randrange(i)}" if i else None) for i in range(40)]])
def test_call_tree_matches_brute_force(spark, pairs):
    got = [tuple(r) for r in call_tree(spark.createDataFrame(pairs, EDGE)).collect()]
    assert sorted(got, key=str) == brute_tree(pairs)


def test_cycles(spark):
    """One that a root reaches is an error; one that none reaches is left out, and what hangs from it."""
    alone = [("a", None), ("b", "a"), ("x", "y"), ("y", "x"), ("z", "x")]
    assert sorted(r["node"] for r in call_tree(spark.createDataFrame(alone, EDGE)).collect()) == ["a", "b"]
    mixed = alone + [("z", "a")]
    assert sorted(r["path"] for r in call_tree(spark.createDataFrame(mixed, EDGE)).collect()) == ["a", "a > b", "a > z"]
    for rooted in ([("a", None), ("b", "a"), ("c", "b"), ("b", "c")], [("a", None), ("b", "a"), ("b", "b")],
                   [("r", None)] + [(f"n{i}", f"n{j}") for i in range(6) for j in range(6)] + [("n0", "r")]):
        with pytest.raises(ValueError, match="cycle"):
            call_tree(spark.createDataFrame(rooted, EDGE))


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    """10,000 steps; a round writes one checkpoint."""
    n, rounds = 10_000, []
    chain = spark.range(n).select(F.col("id").cast("string").alias("ExecutionGUID"),
                                  F.when(F.col("id") > 0, (F.col("id") - 1).cast("string")).alias("ParentExecutionGUID"))
    kind = type(chain)
    real = kind.checkpoint
    monkeypatch.setattr(kind, "checkpoint", lambda self, *a, **k: rounds.append(1) or real(self, *a, **k))
    out = call_tree(chain)
    assert out.agg(F.max("depth"), F.count("*"), F.max(F.size(F.split("path", " > ")))).first() == (n - 1, n, n)
    assert len(rounds) <= 15 + 2


def test_closure(spark):
    links = [("c", "b"), ("b", "a"), ("a", None), ("d", "b"), ("c", "b"), ("x", None), ("e", "d"), ("f", "e")]
    got = {(r["Ancestor"], r["Descendant"]): r["Distance"] for r in closure(
        spark.createDataFrame(links, "c string, p string"), "c", "p").collect()}
    up = {c: p for c, p in links if p}
    want = {}
    for node in {x for pair in links for x in pair if x}:
        at, d = node, 0
        while at:
            want[at, node] = d
            at, d = up.get(at), d + 1
    assert got == want
    with pytest.raises(ValueError, match="cycle"):
        closure(spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "c string, p string"), "c", "p")
    assert closure(spark.createDataFrame([], "c string, p string"), "c", "p").count() == 0


MAPPING = [(v, "B", c, "P", "S") for v, c in [("Coffee", "Drinks"), ("Rent", "Housing"), ("Groceries", "Food"),
                                              ("Book, paper", "Office"), ("Tea", "Drinks"), ("Pen", "Office")]]


def _loaded(spark, root, between=None):
    build_inbound(root)
    write(f"{root}/Admin/ConfigurationCategory.txt", "Category|ParentCategory\nDrinks|Food\nFood|Living\nHousing|Living\n")
    lay, log = Layout(root), RunLog("t")
    load_files_to_bronze(spark, lay, log)
    load_bronze_to_silver(spark, lay, log)
    apply_manual_mapping(spark, lay, spark.createDataFrame(
        MAPPING, "SourceValue string, Brand string, Category string, ProductService string, Seller string"))
    load_bronze_to_silver(spark, lay, log)
    if between:
        between(lay)
    load_silver_to_gold(spark, lay, log)
    return lay, log


def _spend(spark, path):
    return {(r["Category"], str(r["Month"])[:7]): str(r["Spend"]) for r in spark.read.parquet(path).collect()}


def test_spend_along_the_hierarchy(spark, root):
    lay, _ = _loaded(spark, root)
    flat, tree = _spend(spark, lay.gold_spend), _spend(spark, lay.gold_spend_tree)
    up = {"Drinks": "Food", "Food": "Living", "Housing": "Living"}
    want = {}
    for (category, month), value in flat.items():
        while category:
            want[category, month] = want.get((category, month), 0) + Decimal(value)
            category = up.get(category)
    assert {k: Decimal(v) for k, v in tree.items()} == want and ("Living", "2024-01") in tree
    below = spark.read.parquet(lay.gold_category_closure).where("Ancestor = 'Living'").collect()
    assert {(r["Descendant"], r["Distance"]) for r in below} == {("Living", 0), ("Food", 1), ("Housing", 1), ("Drinks", 2)}


def test_a_member_written_twice_counts_once(spark, root, tmp_path):
    """Two overlapping runs appended the same members: facts and spend stay, the repeat is reported."""
    from ledgerline.sources.tables import append

    plain, _ = _loaded(spark, str(tmp_path / "plain"))

    def repeat(lay):
        for dim in ("Brand", "Category", "Account"):
            rows = spark.read.parquet(lay.silver_dimension(dim))
            append(spark.createDataFrame(rows.collect(), rows.schema).withColumn("DateTimeInserted", F.current_timestamp()),
                   lay.silver_dimension(dim))

    lay, log = _loaded(spark, root, repeat)
    assert spark.read.parquet(lay.silver_dimension("Brand")).count() == 2
    assert _spend(spark, lay.gold_spend) == _spend(spark, plain.gold_spend)
    assert spark.read.parquet(lay.gold_transaction).count() == spark.read.parquet(plain.gold_transaction).count()
    assert spark.read.parquet(lay.gold_dimension("Brand")).count() == 1
    again = RunLog("t")
    load_bronze_to_silver(spark, lay, again)
    said = [e.result for e in again.entries if e.action == "Accounts"]
    assert "Brand: 1 repeated member row(s)" in said[0] and "Category: " in said[0] and "Account: " in said[0]


def _month(m, n, first=0):
    return [{"TransactionGUID": f"{m}-{i}", "Date": dt.date(2024, m, 1 + i % 28) if m else None, "Source": "s",
             "SourceFile": f"{m}.csv", "Amount": Decimal("1.00")} for i in range(first, n)]


def test_the_guard_reads_the_months_of_the_increment(spark, root):
    lay = Layout(root)
    for m in range(1, 11):
        assert silver.append_transactions(spark, lay, _silver(spark, _month(m, 20)), f"run-{m}") == 20
    # an overlapping increment: old rows of two months, new rows of one
    rows = _month(3, 25) + _month(7, 20)
    assert silver.append_transactions(spark, lay, _silver(spark, rows), "run-11") == 5
    guard = silver.recorded_keys(spark, lay, [202403, 202407])
    plan = guard._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*KeyMonth#\d+ IN \(202403,202407\)", plan)
    assert guard.count() == 20 + 20 + 5
    # undated rows are guarded too
    undated = _month(None, 4)
    assert silver.append_transactions(spark, lay, _silver(spark, undated), "run-12") == 4
    assert silver.append_transactions(spark, lay, _silver(spark, undated), "run-13") == 0


def test_a_root_without_keys_gets_them(spark, root):
    from ledgerline.sources.files import delete

    lay = Layout(root)
    silver.append_transactions(spark, lay, _silver(spark, _month(3, 5)), "run-1")
    delete(spark, lay.silver_keys)
    assert silver.append_transactions(spark, lay, _silver(spark, _month(3, 6)), "run-2") == 1
    assert silver.append_transactions(spark, lay, _silver(spark, _month(3, 6)), "run-3") == 0
