"""What a load holds and parses per row: lines without their path, each cell parsed once, the same values as before."""

from pyspark.sql import functions as F

from fixtures import build_inbound
from ledgerline.functions.values import (
    DAY_FIRST, MONTH_FIRST, coerce_ordered, date_family, fits_order, parse_amount,
)
from ledgerline.layout import Layout
from ledgerline.operators.cleanse import coerce_columns
from ledgerline.plans import bronze
from ledgerline.plans.runlog import RunLog

CELLS = ["2024-02-03", "2024-2-30", "3/4/2024", "13/4/2024", "4/13/2024", "31/31/2024", "03.04.2024", "3-4-2024 10:30",
         "3/4/2024 1:02:03", " 3/4/2024 ", "3/4.2024", "5-Jan-2024", "20240102", "x", "", None]


def test_lines_of_a_load_carry_a_number_instead_of_the_path(spark, root, monkeypatch):
    build_inbound(root)
    seen, lines = [], bronze.candidate_lines

    def candidate_lines(*args):
        seen.append(lines(*args))
        seen.append({r["path"] for r in seen[0].select("path").distinct().collect()})
        return seen[0]

    monkeypatch.setattr(bronze, "candidate_lines", candidate_lines)
    res = bronze.load_files_to_bronze(spark, Layout(root), RunLog("t"))
    assert dict(seen[0].dtypes)["path"] == "bigint"
    numbers = [r["number"] for r in res.dispositions.select("number").collect()]
    assert len(numbers) == len(set(numbers)) and seen[1] and seen[1] <= set(numbers)


def test_a_known_family_gives_the_same_dates(spark):
    df = spark.createDataFrame([(c,) for c in CELLS], "c string").withColumn("family", date_family("c"))
    for order in (MONTH_FIRST, DAY_FIRST):
        for kind in ("date", "timestamp"):
            pairs = df.select(coerce_ordered("c", kind, order), coerce_ordered("c", kind, order, F.col("family")),
                              fits_order("c", order) & F.col("family").isNotNull(), fits_order("c", order, F.col("family"))).collect()
            assert all(a == b and bool(x) == bool(y) for a, b, x, y in pairs) and any(a for a, *_ in pairs)


def test_plain_amounts_are_as_any_other(spark):
    cells = {"12": "12.00", "-7.5": "-7.50", "0012.34": "12.34", "$12.34": "12.34", "(12.34)": "-12.34", "1,234.5": "1234.50",
             "12.345": "12.35", "12-": "-12.00", "1234567890123456.78": "1234567890123456.78", "12345678901234567": None,
             "1.": None, ".5": "0.50", "-": None, "x": None, " 3 ": "3.00", "+4": "4.00"}
    df = spark.createDataFrame([(c,) for c in cells], "c string").select("c", parse_amount("c").cast("string").alias("v"))
    assert {r.c: r.v for r in df.collect()} == cells


def test_a_cell_is_parsed_once(spark):
    df = spark.createDataFrame([("1", "x", "y"), ("z", "2", "y")], "a string, b string, c string")
    out = coerce_columns(df, {"a": "int", "b": "bigint"})
    assert out.columns == ["a", "b", "c", "_bad_columns"]
    assert [tuple(r) for r in out.collect()] == [(1, None, "y", ["b"]), (None, 2, "y", ["a"])]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(trim(a") <= 2  # the shape and the cast, not again for the list
