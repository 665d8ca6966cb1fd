"""Gold increments: spend for touched months is replaced, others kept."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.layout import Layout
from ledgerline.plans.gold import load_silver_to_gold
from ledgerline.plans.runlog import RunLog
from ledgerline.plans.silver import append_transactions


def _silver(spark, rows):
    cols = [f.name for f in schemas.silver_transaction_schema().fields]
    data = [{c: None for c in cols} | r for r in rows]
    return spark.createDataFrame([tuple(d[c] for c in cols) for d in data],
                                 schemas.silver_transaction_schema())


def test_incremental_spend_and_dates(spark, root):
    lay = Layout(root)
    first = [{"TransactionGUID": f"t{i}", "Date": dt.date(2024, 1, 1 + i), "Source": "s",
              "SourceFile": "a.csv", "Amount": Decimal("10.00")} for i in range(3)]
    append_transactions(spark, lay, _silver(spark, first), "silver-run-1")
    load_silver_to_gold(spark, lay, RunLog("t"), years_back=0)
    second = [{"TransactionGUID": "t9", "Date": dt.date(2024, 3, 5), "Amount": Decimal("2.50"),
               "Source": "s", "SourceFile": "b.csv"},
              {"TransactionGUID": "t8", "Date": dt.date(2024, 1, 9), "Amount": Decimal("1.00"),
               "Source": "s", "SourceFile": "b.csv"}]
    append_transactions(spark, lay, _silver(spark, second), "silver-run-2")
    load_silver_to_gold(spark, lay, RunLog("t"), years_back=0)
    load_silver_to_gold(spark, lay, RunLog("t"), years_back=0)     # nothing new: no change
    spend = {str(r["Month"]): (str(r["Spend"]), r["Lines"])
             for r in spark.read.parquet(lay.gold_spend).collect()}
    assert spend == {"2024-01-01": ("31.00", 4), "2024-03-01": ("2.50", 1)}
    assert spark.read.parquet(lay.gold_transaction).count() == 5
    dates = spark.read.parquet(lay.gold_date).agg(F.min("Date"), F.max("Date"), F.count("*")).first()
    assert (dates[0], dates[1], dates[2]) == (dt.date(2024, 1, 1), dt.date(2024, 3, 5), 65)
