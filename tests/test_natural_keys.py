"""Dimension members by a natural key of several columns."""

from fixtures import write
from ledgerline.layout import Layout
from ledgerline.operators.dimension import new_members
from ledgerline.operators.lookup import dimension_lookup
from ledgerline.plans.bronze import load_files_to_bronze
from ledgerline.plans.runlog import RunLog
from ledgerline.plans.silver import load_bronze_to_silver, read_dimension

UNIT, KEY = "UnitOfMeasurement", ["Name", "Abbreviation"]


def test_members_and_lookup_by_two_columns(spark):
    rows = [("gram", "g"), ("gram", "g"), ("gram", "gr"), ("gram", None), (None, "x"), (" ", "y"), ("ton", "t")]
    values = spark.createDataFrame(rows, "n string, a string")
    columns = {"Name": "n", "Abbreviation": "a"}
    first = new_members(values.limit(1), columns, read_empty(spark), UNIT, KEY)
    rest = new_members(values, columns, first, UNIT, KEY)
    assert sorted((r.Name, r.Abbreviation or "") for r in rest.collect()) == [("gram", ""), ("gram", "gr"), ("ton", "t")]
    dim = first.unionByName(rest)
    found = dimension_lookup(values, dim, columns, UNIT).collect()
    assert len(found) == len(rows)
    assert {(r.n, r.a): r[f"{UNIT}GUID"] is not None for r in found} == {
        (n, a): bool(n and n.strip()) for n, a in rows}
    assert len({r[f"{UNIT}GUID"] for r in found} - {None}) == 4
    # Key is the Name alone: one member, the smallest of what else it carries.
    one = new_members(values, columns, read_empty(spark), UNIT).collect()
    assert sorted((r.Name, r.Abbreviation) for r in one) == [("gram", "g"), ("ton", "t")]


def read_empty(spark):
    from ledgerline.schemas import dimension_schema

    return spark.createDataFrame([], dimension_schema(UNIT))


def test_configured_key_reaches_the_dimension(spark, root):
    write(f"{root}/Admin/ConfigurationFile.txt", "ConfigurationFileID|Source|Delimiter|Account\n1|bank|comma|A\n")
    write(f"{root}/Admin/ConfigurationColumn.txt",
          "ConfigurationFileID|ColumnName_File|ColumnName_Bronze|Datatype|SilverEntity|SilverColumn|"
          "Transformation_BronzeToSilver_Type|ColumnIsInNaturalKey\n"
          "1|Date|Date|date||||\n1|Amount|Amount|decimal(18,2)||||\n"
          f"1|Unit|Category|string|{UNIT}GUID|Name|Lookup|Yes\n"
          f"1|Short|Description|string|{UNIT}GUID|Abbreviation|Lookup|Yes\n")
    write(f"{root}/Admin/ConfigurationBrandCategoryProductServiceSeller.txt",
          "Account|SourceValue|Brand|Category|ProductService|Seller\nA|g|b|c|p|s\nA|gr|b|c|p|s\n")
    write(f"{root}/Bronze/Inbound/bank/a.csv",
          "Date,Amount,Unit,Short\n2024-01-01,1.00,gram,g\n2024-01-02,2.00,gram,gr\n2024-01-03,3.00,gram,g\n")
    lay, log = Layout(root), RunLog("test")
    load_files_to_bronze(spark, lay, log)
    load_bronze_to_silver(spark, lay, log)
    assert spark.read.parquet(lay.silver_transaction).count() == 3
    assert sorted((r.Name, r.Abbreviation) for r in read_dimension(spark, lay, UNIT).collect()) == [
        ("gram", "g"), ("gram", "gr")]
