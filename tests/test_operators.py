"""Operator-level checks on small frames."""

from pyspark.sql import functions as F

from ledgerline.functions import coerce, error_file_name, extension, stable_guid, stem
from ledgerline.operators.cleanse import ColumnRule, apply_rules, rename_first_target_wins
from ledgerline.operators.dedupe import keep_first
from ledgerline.operators.header import header_check
from ledgerline.operators.mapping import null_safe_anti


def test_header_check_cases(spark):
    df = spark.createDataFrame([
        (1, ["Date", "Amount", "Description"]), (2, ["Description", "Date", "Amount"]),
        (3, ["Date", "Amount", "Description", "X"]), (4, ["Date", "Amount"]),
        (5, ["Date", "Amount", "X"]), (6, ["Date", "Amount", "Description", "Date"]),
        (7, ["date", "Amount", "Description"]),
    ], "id int, actual array<string>").withColumn(
        "expected", F.array(F.lit("Date"), F.lit("Amount"), F.lit("Description"), F.lit(None)))
    got = {r["id"]: r["Issue"] for r in header_check(df, "actual", "expected").collect()}
    assert got == {1: "", 2: "", 3: "ExtraColumns", 4: "MissingColumns",
                   5: "ExtraColumns.MissingColumns", 6: "ExtraColumns",
                   7: "ExtraColumns.MissingColumns"}


def test_keep_first_is_skew_safe_aggregate(spark):
    rows = [("hot", i, f"v{i}") for i in range(1000, 0, -1)] + [("cold", 5, "c")]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    out = keep_first(df, ["k"], ["o"], ["v"])
    assert {r["k"]: r["v"] for r in out.collect()} == {"hot": "v1", "cold": "c"}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_null_safe_anti_keeps_nothing_for_null_match(spark):
    a = spark.createDataFrame([(None, "x"), ("a", "y")], "k string, v string")
    b = spark.createDataFrame([(None,)], "k string")
    assert [r["v"] for r in null_safe_anti(a, b, ["k"]).collect()] == ["y"]


def test_rules_and_rename(spark):
    df = spark.createDataFrame([(1, 2.0, 0.5)], "a int, p double, d double")
    out = apply_rules(df, [ColumnRule("a", "A", order=1),
                           ColumnRule(None, "R", "Expression", "p * (1 - d)", order=2),
                           ColumnRule("p", "R", order=3)])
    assert out.columns == ["A", "R"] and out.first()["R"] == 1.0
    ren = rename_first_target_wins(df, [("a", "X"), ("p", "X"), ("d", None)])
    assert ren.columns == ["X", "p", "d"]


def test_coerce_and_names(spark):
    df = spark.createDataFrame([("(1,234.50)", "03/04/2024", "report.v2.CSV", "x")],
                               "a string, d string, n string, bad string")
    r = df.select(coerce("a", "decimal(18,2)").alias("a"), coerce("d", "date").alias("d"),
                  coerce("bad", "int").alias("bad"), extension("n").alias("e"),
                  stem("n").alias("s"), error_file_name("n", F.lit("ExtraColumns")).alias("err"),
                  stable_guid("Brand", F.lit("x")).alias("g1"),
                  stable_guid("Brand", F.lit("x")).alias("g2")).first()
    assert str(r["a"]) == "-1234.50" and str(r["d"]) == "2024-03-04" and r["bad"] is None
    assert (r["e"], r["s"]) == (".CSV", "report.v2")
    assert r["err"] == "report.v2.InvalidColumnHeader.ExtraColumns.CSV"
    assert r["g1"] == r["g2"] and len(r["g1"]) == 36
