"""The splittable scan of qualified fields against Spark's own unsplit reader, and moves that are interrupted."""

import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fixtures import build_inbound, write
from ledgerline.layout import Layout
from ledgerline.plans import bronze
from ledgerline.plans.runlog import RunLog
from ledgerline.sources import taskfiles
from ledgerline.sources.delimited import MALFORMED, csv_options, read_delimited, scan_lines, text_schema
from ledgerline.sources.delimited import Layout as FileLayout
from ledgerline.sources.records import CHANGE, INSIDE, KEEP, OUTSIDE, transition

SHAPE = FileLayout(",", '"', ("x", "y", "z"))


@pytest.fixture()
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "48", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def cells(df):
    return sorted(tuple(str(r[c]) for c in (*SHAPE.columns, MALFORMED)) for r in df.collect())


QUALIFIED = st.text("ab,\n\"é ", max_size=60).map(lambda v: '"' + v.replace('"', '""') + '"')
CELL = st.one_of(QUALIFIED, st.sampled_from(["plain", '5" pipe', "", "x y", '""', '"a""b"']))
ROW = st.lists(CELL, min_size=2, max_size=4).map(",".join)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(files=st.lists(st.tuples(st.sampled_from(["\n", "\r\n"]), st.lists(ROW, min_size=1, max_size=25)), min_size=1, max_size=2))
def test_equals_the_unsplit_reader(spark, tmp_path_factory, small_splits, files):
    folder = str(tmp_path_factory.mktemp("rows"))
    for i, (end, rows) in enumerate(files):
        write(f"{folder}/sub/f {i}+%.csv", end.join(["x,y,z", *rows, ""]))
    want = spark.read.schema(text_schema(SHAPE.columns)).option("header", True).option("multiLine", True) \
        .option("recursiveFileLookup", True).options(**csv_options(",", '"')).csv(folder)
    got = read_delimited(spark, folder, SHAPE)
    assert cells(got) == cells(want)


def test_records_over_many_splits(spark, root, small_splits):
    long = "line\n" * 200
    write(f"{root}/a.csv", f'x,y,z\n1,"{long}",2\n\n3,"a ""b""\n",4\n5,6,"open to the end\n7,8,9')
    assert scan_lines(spark, root).rdd.getNumPartitions() > 10
    assert cells(read_delimited(spark, root, SHAPE)) == [
        ("1", long, "2", "None"), ("3", 'a "b"\n', "4", "None"), ("5", "6", "open to the end\n7,8,9", "None")]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text('a,,""" ', max_size=14), min_size=60, max_size=60))
def test_what_a_line_does(spark, lines):
    kinds = {(0, 1): KEEP, (1, 0): CHANGE, (0, 0): OUTSIDE, (1, 1): INSIDE}

    def state(line, begin):  # character by character
        place = 2 if begin else 1
        for c in line:
            if place == 2:
                place = 3 if c == '"' else 2
            elif place == 3 and c == '"':
                place = 2
            elif c == '"' and place == 1:
                place = 2
            else:
                place = 1 if c == "," else 0
        return int(place == 2)

    df = spark.createDataFrame([(x,) for x in lines], "line string")
    for r in df.select("line", transition(F.col("line"), F.lit(","), F.lit('"')).alias("kind")).collect():
        assert r["kind"] == kinds[state(r["line"], 0), state(r["line"], 1)], r["line"]


def files_below(folder):
    return sorted(os.path.relpath(os.path.join(d, f), folder) for d, _, names in os.walk(folder) for f in names
                  if not f.startswith(".") and "_rows" not in d)


def test_an_interrupted_move_is_carried_on(spark, root, monkeypatch):
    """Half of the files are moved, nothing is acknowledged; the next run leaves each in exactly one place."""
    build_inbound(root)
    lay = Layout(root)
    every = len(files_below(lay.bronze_inbound))

    def killed(files, where):
        for r in files.limit(4).collect():
            os.makedirs(os.path.dirname(r["TargetPath"].removeprefix("file:")), exist_ok=True)
            os.rename(r["path"].removeprefix("file:"), r["TargetPath"].removeprefix("file:"))
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(bronze, "move", killed)
        with pytest.raises(RuntimeError, match="lost"):
            bronze.load_files_to_bronze(spark, lay, RunLog("t"), move_files=True)
    rows = spark.read.parquet(lay.bronze_transaction).count()
    left = files_below(lay.bronze_inbound)
    assert len(left) == every - 4
    log = RunLog("t")
    again = bronze.load_files_to_bronze(spark, lay, log, move_files=True)
    assert again.rows_loaded == 0 and spark.read.parquet(lay.bronze_transaction).count() == rows
    places = [files_below(f) for f in (lay.bronze_inbound, lay.bronze_archive, lay.bronze_error)]
    assert sum(map(len, places)) == every
    assert {f.rsplit("/", 1)[-1] for f in places[0]} == {"statement.pdf", "x.csv"}
    outcomes = spark.read.parquet(lay.move_outcomes).collect()
    assert len(outcomes) == every - 2 and {r["Outcome"] for r in outcomes} == {taskfiles.MOVED}
    assert [e.rows for e in log.entries if e.action == "MoveFiles"] == [every - 2]


def test_a_target_is_never_replaced(spark, root):
    build_inbound(root)
    lay = Layout(root)
    write(f"{lay.bronze_archive}/bank/good.csv", "earlier")
    bronze.load_files_to_bronze(spark, lay, RunLog("t"), source="bank", move_files=True)
    assert open(f"{lay.bronze_archive}/bank/good.csv").read() == "earlier"
    assert os.path.exists(f"{lay.bronze_inbound}/bank/good.csv")
    bad = spark.read.parquet(lay.move_outcomes).where(F.col("Outcome") != taskfiles.MOVED).collect()
    assert [(r["path"].rsplit("/", 1)[-1], r["Outcome"]) for r in bad] == [("good.csv", taskfiles.TARGET_EXISTS)]


def test_tasks_and_driver_list_and_move_alike(spark, root):
    build_inbound(root)
    lay = Layout(root)
    write(f"{lay.bronze_inbound}/bank/2024/ä b/_hidden/x.csv", "x")
    write(f"{lay.bronze_inbound}/bank/2024/ä b/100%+.csv", "x\n1\n")
    write(f"{lay.bronze_inbound}/top.csv", "x\n1\n")
    columns = ["path", "relative", "file_name", "size", "modified"]
    by_tasks = sorted(map(tuple, taskfiles.listing(spark, lay.bronze_inbound).select(columns).collect()))
    by_driver = sorted(map(tuple, taskfiles.driver_files.listing_frame(spark, lay.bronze_inbound).select(columns).collect()))
    assert by_tasks == by_driver and any(r[3] == 0 for r in by_tasks)
    lines = scan_lines(spark, lay.bronze_inbound).select("path").distinct().collect()
    assert {r["path"] for r in lines} == {r[0] for r in by_tasks if r[3] and r[2].lower().endswith((".csv", ".txt"))}
    assert not taskfiles.tasks_reach("viewfs://store/in") and not taskfiles.tasks_reach(f"file:{root}/none")
    moves = spark.createDataFrame([(f"file:{lay.bronze_inbound}/top.csv", f"file:{root}/to/top.csv", "g"),
                                   (f"file:{root}/gone", f"file:{root}/to/gone", "g")], "path string, TargetPath string, LoadGUID string")
    got = {r["path"].rsplit("/", 1)[-1]: r["Outcome"] for r in taskfiles.move_on_driver(spark, moves).collect()}
    assert got == {"top.csv": "Moved", "gone": "Missing"}
    got = {r["path"].rsplit("/", 1)[-1]: r["Outcome"] for r in taskfiles.move(moves, f"file:{root}").collect()}
    assert got == {"top.csv": "Moved", "gone": "Missing"}
